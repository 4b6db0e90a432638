import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from tributary.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the output of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        result = stage(spark, docs, SF)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        result.write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages_keep_the_columns_of_documents(stages):
    assert [len(cp.STAGES), cp.ORACLE_SQL] == [5, None]
    for before, after in stages[:4]:
        assert after.columns == before.columns
    assert stages[4][1].columns == [*stages[4][0].columns, "shard", "shard_depth"]


def test_quality_stage_keeps_exactly_the_kept(spark, stages):
    before, after = stages[0]
    judged = quality.judge(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(ids(after)) == sorted(r.doc_id for r in judged.filter("kept").collect()) and len(ids(after)) < before.count()


def test_one_document_of_each_group_stays(spark, stages):
    from test_near_dedup import brute_classes
    before, after = stages[1]
    assert sorted(ids(after)) == sorted({c for _, c in brute_classes([(r.doc_id, r.text) for r in before.collect()])})


def test_contaminated_documents_go(spark, stages):
    before, after = stages[2]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    items = {" ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    holds = {r.doc_id for r in before.collect() if any(i in " ".join(words(r.text)) for i in items)}
    gone = set(ids(before)) - set(ids(after))
    assert holds and holds <= gone and len(gone - holds) <= 3


def test_mixing_loses_nothing_and_repeats_at_most_twice(stages):
    before, after = stages[3]
    assert set(ids(after)) == set(ids(before)) and max(ids(after).count(i) for i in set(ids(after))) <= 2


def test_sharding_stage_and_run(spark, stages):
    before, after = stages[4]
    assert sorted(ids(after)) == sorted(ids(before))
    whole = cp.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, after.collect()))


def test_shard_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3, "mine")], "doc_id long, text string, lang string, source string, n_chars long, shard string")
    assert cp.STAGES[4][1](spark, docs, SF).columns == [*docs.columns, "_shard", "shard_depth"]


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, empty_docs):
    for docs in (odd_docs, empty_docs):
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()


def test_entry_registers_everything():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()
