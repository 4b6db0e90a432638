"""Driver contract: entry() runs, every registered query runs on sf0.001 with
a stable, scalar schema, and every SQL oracle names a registered query."""

from pyspark.sql.types import ArrayType, MapType, StructType

import __spark_entry__ as ent


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["actorid", "quality_class", "is_active", "start_date", "end_date", "current_year"]


def test_oracle_keys_are_registered():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_all_queries_run_with_scalar_columns(spark):
    for name, fn in ent.queries().items():
        df = fn(spark, "/root/testdata/sf0.001")
        for f in df.schema.fields:
            assert not isinstance(f.dataType, (ArrayType, MapType, StructType)), (name, f.name)
        assert len(set(df.columns)) == len(df.columns), name
        df.write.format("noop").mode("overwrite").save()


def test_no_query_plans_a_nested_loop_or_cartesian_join(spark):
    """No registered query pairs rows by a nested loop or a cross product
    (the plans in PLANS.md); checked on the static plans."""
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bad = [name for name, fn in ent.queries().items()
               if any(op in fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
                      for op in ("BroadcastNestedLoopJoin", "CartesianProduct"))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert bad == []
