"""Rating arithmetic as Column expressions; missing is null, never NaN."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_prob(p: Column) -> Column:
    return F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))


def logistic10(diff: Column, scale: Column | float) -> Column:
    return 1 / (1 + F.exp(-diff / scale * math.log(10.0)))


def per_counting(points: Column, counting: Column) -> Column:
    return F.when(counting > 0, points / counting)


def relative_diff(a: Column, b: Column) -> Column:
    """100 (a - b) / min(a, b), where both are known and the smaller is positive."""
    return F.when(a.isNotNull() & b.isNotNull() & (F.least(a, b) > 0), 100 * (a - b) / F.least(a, b))


def observed_only(a: Column, b: Column, stem: str) -> dict[str, Column]:
    """Missing flags, both-observed flag and difference of two sides."""
    return {
        f"player_{stem}_missing_pre": a.isNull().cast("int"),
        f"opponent_{stem}_missing_pre": b.isNull().cast("int"),
        f"both_{stem}_observed_pre": (a.isNotNull() & b.isNotNull()).cast("int"),
        f"diff_{stem}_pre_observed_only": a - b,
    }


def symmetrise(p_ab: Column, p_ba: Column) -> Column:
    return (p_ab + 1 - p_ba) / 2
