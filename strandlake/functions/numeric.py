"""Exact sums, guarded ratios and rounding that do not depend on evaluation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(col, scale: int, digits: int = 18) -> Column:
    """Fixed-point form of a double column that holds ``scale`` decimals, so that sums are exact in any order."""
    return F.col(col).cast(f"decimal({digits},{scale})") if isinstance(col, str) else col.cast(
        f"decimal({digits},{scale})")


def exact_sum(col, scale: int) -> Column:
    return F.sum(fixed(col, scale)).cast("double")


def exact_mean(col, scale: int) -> Column:
    """Mean over non-null values; NULL for an empty group."""
    value = fixed(col, scale)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def half_up(col: Column, places: int = 2) -> Column:
    """Round half up on the double value itself (plain IEEE steps, same on any engine)."""
    factor = float(10 ** places)
    return F.floor(col * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column) -> Column:
    return ratio(top.cast("double") * F.lit(100.0), bottom)


def log2_fold(treated: Column, control: Column) -> Column:
    """log2 of a ratio; NULL when either side is not positive."""
    return F.when((treated > 0) & (control > 0), F.log2(ratio(treated, control)))


def log2_plus_one(col: Column) -> Column:
    return F.log2(col + F.lit(1.0))


def decay(distance: Column, scale: float = 80.0) -> Column:
    """exp(-d / scale)."""
    return F.exp(-distance / F.lit(scale))
