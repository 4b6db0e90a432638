"""NULL-handling rules that differ between engines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_arrays(*cols: Column | str) -> Column:
    """``a || b`` where a NULL side counts as empty (V2); Spark's concat
    would return NULL."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.array()) for c in cols]
    return F.concat(*parts)


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition where NULL keys match each other."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def round_half_away(c: Column | str) -> Column:
    """PostgreSQL ``CAST(x AS INTEGER)`` rounding for non-negative averages
    (V3): half rounds up.  Same text in the oracle: floor(x + 0.5)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c + F.lit(0.5)).cast("long")


def safe_divide(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator (V6)."""
    return F.try_divide(num, den)


def desc_last(c: Column | str) -> Column:
    """``ORDER BY c DESC`` with NULLs last in every engine (V1)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def ratio4(num: Column | str, den: Column | str) -> Column:
    """num / den rounded half up to 4 places (ties towards plus infinity) for
    whole numbers, exact in ``decimal(38,0)``: numerators up to 10**33 fit.
    NULL when den is 0 or NULL; ``den`` is a count, so positive."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    whole = "decimal(38,0)"
    n, d = n.cast(whole), d.cast(whole)
    x, m = (n * F.lit(20000).cast("decimal(5,0)") + d).cast(whole), (d * F.lit(2).cast("decimal(1,0)")).cast(whole)
    q = F.when(d != 0, (x - F.pmod(x, m)) / m)
    return q.cast("double") / F.lit(10000.0)
