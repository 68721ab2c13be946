"""Additive scorecard as native ``when`` chains (no row-wise Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import spec
from .columns import compare

_INF = float("inf")


def points(source: str, op: str, table, otherwise: int) -> Column:
    """Top-down point table; a comparison with a missing value is false, so
    a missing input gets ``otherwise``."""
    out = None
    for threshold, pts in table:
        cond = compare(source, op, threshold)
        out = F.when(cond, F.lit(pts)) if out is None else out.when(cond, F.lit(pts))
    return out.otherwise(F.lit(otherwise))


def ownership_points(col: str = "home_ownership") -> Column:
    out = None
    for value, pts in spec.OWNERSHIP_POINTS:
        cond = F.col(col) == F.lit(value)
        out = F.when(cond, F.lit(pts)) if out is None else out.when(cond, F.lit(pts))
    return out.otherwise(F.lit(0))


def loan_to_income_points(loan: str = "loan_amount", income: str = "income") -> Column:
    """Points of the raw ratio loan/income with IEEE semantics: income 0 gives
    +-inf (or NaN for 0/0), missing gives NaN; NaN compares false -> 0."""
    lo, inc = F.col(loan), F.col(income)
    r = F.try_divide(lo, inc)
    (t1, p1), (t2, p2) = spec.LOAN_TO_INCOME_POINTS
    hi_t, hi_p = spec.LOAN_TO_INCOME_HIGH
    zero = (inc == 0) & lo.isNotNull()
    return (
        F.when(r <= F.lit(t1), F.lit(p1))
        .when(r <= F.lit(t2), F.lit(p2))
        .when(r > F.lit(hi_t), F.lit(hi_p))
        .when(zero & (lo > 0), F.lit(hi_p))      # +inf
        .when(zero & (lo < 0), F.lit(p1))        # -inf
        .otherwise(F.lit(0))
    )


def score() -> Column:
    """Total scorecard points of a raw record (integer)."""
    total = ownership_points() + loan_to_income_points()
    for source, op, table, otherwise in spec.SCORECARD:
        total = total + points(source, op, table, otherwise)
    return total


def approval_label(noise: Column) -> Column:
    """``loan_approved = score + noise > 50`` as int; ``noise`` is a column
    supplied by the caller (the reference draws it from N(0, 10))."""
    return ((score().cast("double") + noise) > F.lit(float(spec.APPROVAL_CUTOFF))).cast("int")
