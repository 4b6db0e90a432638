"""Segmented history.

The array form keeps an entity's whole history in one row, so one entity with a
third of the table is one row of one task, and every snapshot repeats what the
one before held.  Here a history is a table of *segments*: at most ``size``
items of one entity and one period, in order, with their partial sums.

* A segment never spans periods, so a snapshot of period ``p`` is the set of
  segments up to ``p``; nothing is repeated, and the step to a new period writes
  that period's segments alone (``sources.merge.replace_partitions``, safe to
  rerun).
* Items are dealt by (entity, period, order) ranges of equal row counts
  (:func:`tributary.operators.scan.ordered_segments`): no task and no row holds a
  hot entity.
* What is read from a whole history (counts, sums, first and latest item, class)
  comes from the segments' sums, one row per segment, aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.cumulative import QUALITY_CLASSES, classify
from tributary.operators.scan import ordered_segments


def history_segments(df: DataFrame, keys: Sequence[str], period: str, struct_cols: Sequence[str], *,
                     order_by: Sequence[str] | None = None, size: int = 1000,
                     sums: Mapping[str, Column] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Segments of at most ``size`` items: keys, period, ``segment`` (rising in
    order within keys and period), ``n_items``, ``items`` (structs in order),
    ``first_order`` and ``last_order`` (the order columns of its ends), the
    ``sums`` and the largest of each ``carry`` column.  NULL keys are keys."""
    keys, order = list(keys), list(order_by or struct_cols)
    extra = dict(sums or {})
    item = F.struct(*[F.col(c) for c in struct_cols])
    rows = df.select(*keys, period, *carry, item.alias("_item"), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("_o"),
                     *[c.alias(f"_s_{name}") for name, c in extra.items()])
    rows = ordered_segments(rows, [*keys, period], ["_o"])
    place = F.row_number().over(Window.partitionBy("_seg", *keys, period).orderBy("_o"))
    rows = rows.withColumn("_part", F.floor((place - 1) / size))
    sort = F.sort_array(F.collect_list(F.struct("_o", "_item")))
    out = rows.groupBy("_seg", *keys, period, "_part").agg(
        F.count(F.lit(1)).alias("n_items"), sort.alias("_items"), *[F.sum(f"_s_{name}").alias(name) for name in extra], *[F.max(c).alias(c) for c in carry])
    return out.select(*keys, period, (F.col("_seg") * F.lit(1 << 32) + F.col("_part")).cast("bigint").alias("segment"), "n_items",
                      F.transform("_items", lambda x: x["_item"]).alias("items"), F.element_at("_items", 1)["_o"].alias("first_order"),
                      F.element_at("_items", -1)["_o"].alias("last_order"), *extra, *carry)


def period_summary(segments: DataFrame, keys: Sequence[str], period: str, *, sums: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """One row per entity and period from the segments: ``n_items``, the first
    and the last item in order, the sums."""
    first, last = F.element_at("items", 1), F.element_at("items", -1)
    return segments.groupBy(*keys, period).agg(
        F.sum("n_items").alias("n_items"), F.min_by(first, "first_order").alias("first_item"), F.max_by(last, "last_order").alias("last_item"),
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in carry])


def cumulate_summary(prev: DataFrame, current: DataFrame, keys: Sequence[str], *, prev_period: str = "current_year", cur_period: str = "year",
                     sums: Sequence[str] = (), firsts: Sequence[str] = (), lasts: Sequence[str] = (), carry: Sequence[str] = (),
                     measure: str = "average_value", class_col: str = "quality_class", thresholds: Sequence[tuple[float, str]] = QUALITY_CLASSES,
                     active_col: str = "is_active") -> DataFrame:
    """One period's step of a summary snapshot (D2 without arrays): sums add up,
    firsts stay, lasts are replaced, the class follows the period's measure or
    stays; entities not seen are carried with period + 1.  Columns are matched by
    name; NULL keys match each other.  Both sides hold one row per entity."""
    cond = None
    for k in keys:
        c = F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}"))
        cond = c if cond is None else cond & c
    j = prev.alias("p").join(current.withColumn("_present", F.lit(True)).alias("c"), cond, "full_outer")
    present = F.col("c._present").isNotNull()
    either = lambda a, b, name: F.coalesce(F.col(f"{a}.{name}"), F.col(f"{b}.{name}")).alias(name)
    return j.select(
        *[F.when(present, F.col(f"c.{k}")).otherwise(F.col(f"p.{k}")).alias(k) for k in keys], *[either("c", "p", c) for c in carry],
        F.coalesce(F.col(f"p.{prev_period}") + 1, F.col(f"c.{cur_period}")).alias(prev_period),
        *[(F.coalesce(F.col(f"p.{c}"), F.lit(0)) + F.coalesce(F.col(f"c.{c}"), F.lit(0))).alias(c) for c in sums],
        *[either("p", "c", c) for c in firsts], *[either("c", "p", c) for c in lasts],
        F.coalesce(classify(F.col(f"c.{measure}"), thresholds), F.col(f"p.{class_col}")).alias(class_col), present.alias(active_col))

