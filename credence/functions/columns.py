"""Scalar column expressions.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions``, so they stay inside whole-stage codegen. Missing
values follow one rule (SURVEY H1): NaN becomes NULL at the source, and every
predicate chain ends in an explicit ``otherwise``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import spec

_INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """P1 on raw inputs: NaN -> NULL (infinities are kept)."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def missing_to_null(x) -> Column:
    """P1 on derived values: NaN, +inf and -inf -> NULL."""
    x = _c(x)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(_INF)), F.lit(None).cast("double")).otherwise(x)


def ieee_divide(num, den) -> Column:
    """Division with IEEE results (x/0 -> +-inf, 0/0 -> NaN) under ANSI mode,
    where plain ``/`` raises on a zero divisor."""
    num, den = _c(num), _c(den)
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num / den)
        .when(num > 0, F.lit(_INF))
        .when(num < 0, F.lit(-_INF))
        .when(num.isNotNull() & den.isNotNull(), F.lit(float("nan")))
        .otherwise(F.lit(None).cast("double"))
    )


def safe_ratio(num, den) -> Column:
    """Zero denominator -> missing; NaN, +-inf or missing result -> 0.0."""
    return F.coalesce(missing_to_null(F.try_divide(_c(num).cast("double"), _c(den).cast("double"))),
                      F.lit(0.0))


def right_closed_bucket(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(e_i, e_{i+1}]``, the lowest edge included; below the first
    edge, above the last one, or missing -> NULL. Not ``Bucketizer``, which is
    left-closed."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = _c(x)
    out = F.when(x < F.lit(float(edges[0])), F.lit(None).cast("string"))
    for hi, label in zip(edges[1:], labels):
        hi_lit = F.lit(_INF) if math.isinf(hi) else F.lit(float(hi))
        out = out.when(x <= hi_lit, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


_OPS = {
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    "==": lambda a, b: a == b,
}


def compare(x, op: str, value) -> Column:
    return _OPS[op](_c(x), F.lit(value))


def threshold_flag(x, op: str, value) -> Column:
    """1.0 when the comparison holds, else 0.0 (missing -> 0.0)."""
    return F.when(compare(x, op, value), F.lit(1.0)).otherwise(F.lit(0.0))


def clip(x, lo, hi) -> Column:
    """Clip to [lo, hi]; missing stays missing (``least``/``greatest``
    would skip NULLs)."""
    x = _c(x)
    return F.when(x < F.lit(lo), F.lit(lo).cast("double")) \
        .when(x > F.lit(hi), F.lit(hi).cast("double")).otherwise(x)


def round_half_even(x, digits: int = 0) -> Column:
    """NumPy/pandas rounding: ``rint(x * 10^k) / 10^k``, half to even on
    the scaled binary value. ``round`` is half-up and ``bround`` rounds the
    shortest decimal text (0.545 -> 0.54 where pandas gives 0.55)."""
    scale = float(10 ** digits)
    x = _c(x).cast("double")
    if digits == 0:
        return F.rint(x)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def categorical_str(x) -> Column:
    """Cast to string, missing -> 'unknown'."""
    return F.coalesce(_c(x).cast("string"), F.lit(spec.UNKNOWN))


def confidence_band(p) -> Column:
    """Band of P(class 1)."""
    p = _c(p)
    out = None
    for lo, label in spec.CONFIDENCE_BANDS:
        out = F.when(p >= F.lit(lo), F.lit(label)) if out is None else out.when(p >= F.lit(lo), F.lit(label))
    return out.otherwise(F.lit(spec.CONFIDENCE_OTHERWISE))
