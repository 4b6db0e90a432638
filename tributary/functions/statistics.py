"""Distribution tails as column arithmetic.

Meant for the few rows that grouped moments leave.  Sums and continued fractions
run inside ``aggregate`` over a literal sequence, so an expression is one node
whatever the number of terms; everything stays in doubles in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the sums and steps of the continued fraction.
TERMS, STEPS = 240, 400


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|): 1 - erf by its series of positive terms, absolute error
    below 1e-14; 0 beyond eight standard deviations (where it is below 1.3e-15)."""
    x = F.abs(z).cast("double") / math.sqrt(2.0)
    xx = x * x

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * F.lit(2.0) * xx / (F.lit(2.0) * n + F.lit(1.0))
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.struct(x.alias("term"), x.alias("total")), add)["total"]
    return F.when(F.abs(z) > 8.0, F.lit(0.0)).when(z.isNotNull(), F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-xx) * series))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series at x + 10, taken back by the
    recurrence."""
    y = x + F.lit(10.0)
    r = F.lit(1.0) / (y * y)
    # the series' first coefficients: B(2k) / (2k (2k - 1))
    tail = (F.lit(1 / 12) + r * (F.lit(-1 / 360) + r * (F.lit(1 / 1260) + r * (F.lit(-1 / 1680) + r * F.lit(1 / 1188))))) / y
    back = F.lit(0.0)
    for k in range(10):
        back = back + F.log(x + F.lit(float(k)))
    return (y - F.lit(0.5)) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + tail - back


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, each step
    evaluated forward as a ratio of two products kept near one."""
    tiny = F.lit(1e-300)
    away = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def advance(s: Column, m: Column) -> Column:
        k = m.cast("double")
        even = k * (b - k) * x / ((a + F.lit(2.0) * k - F.lit(1.0)) * (a + F.lit(2.0) * k))
        odd = -(a + k) * (a + b + k) * x / ((a + F.lit(2.0) * k) * (a + F.lit(2.0) * k + F.lit(1.0)))
        d1, c1 = F.lit(1.0) / away(F.lit(1.0) + even * s["d"]), away(F.lit(1.0) + even / s["c"])
        half = F.struct(d1.alias("d"), c1.alias("c"), (s["h"] * d1 * c1).alias("h"))

        def second(t: Column) -> Column:
            d2, c2 = F.lit(1.0) / away(F.lit(1.0) + odd * t["d"]), away(F.lit(1.0) + odd / t["c"])
            return F.struct(d2.alias("d"), c2.alias("c"), (t["h"] * d2 * c2).alias("h"))

        # one half step bound to a variable, so that expressions do not double
        return F.get(F.transform(F.array(half), second), 0)

    d0 = F.lit(1.0) / away(F.lit(1.0) - (a + b) * x / (a + F.lit(1.0)))
    start = F.struct(d0.alias("d"), F.lit(1.0).alias("c"), d0.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, advance)["h"]


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta function I_x(a, b) for 0 <= x <= 1."""
    inside = F.when((x > 0) & (x < 1), x).otherwise(F.lit(0.5))
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(inside) + b * F.log(F.lit(1.0) - inside))
    low = front * _fraction(a, b, inside) / a
    high = F.lit(1.0) - front * _fraction(b, a, F.lit(1.0) - inside) / b
    body = F.when(inside < (a + F.lit(1.0)) / (a + b + F.lit(2.0)), low).otherwise(high)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(body)


def student_two_sided(t: Column, dof: Column) -> Column:
    """P(|T| > |t|) of Student's t with any positive (also fractional) degrees
    of freedom; NULL where either is NULL."""
    v = dof.cast("double")
    return F.when(t.isNotNull() & v.isNotNull(), incomplete_beta(v / (v + t * t), v / F.lit(2.0), F.lit(0.5)))
