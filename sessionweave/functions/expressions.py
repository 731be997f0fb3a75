"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grid_bin(coordinate: Column, size: int) -> Column:
    return F.floor(coordinate / size).cast("long")


def popularity_category(sessions: Column, cuts) -> Column:
    """1 (rare) to 5 (popular): three upper bounds, then a lower bound for 5."""
    low, middle, high, top = cuts
    return (
        F.when(sessions <= low, 1).when(sessions <= middle, 2).when(sessions <= high, 3).when(sessions >= top, 5).otherwise(4)
    )


def time_parts(session_id: Column) -> dict[str, Column]:
    """Calendar parts held in the digits of a session id, month counted from 1."""
    digits = session_id.cast("string")

    def part(start):
        return F.substring(digits, start, 2).cast("int")

    return {
        "year": part(1),
        "month": part(3) + 1,
        "day": part(5),
        "hour": part(7),
        "minute": part(9),
        "second": part(11),
    }


def year_weight(session_id: Column, weights) -> Column:
    """Weight by the year digits 20, 21, 22; 1 for any other year."""
    year = time_parts(session_id)["year"]
    w20, w21, w22 = weights
    return F.when(year == 20, w20).when(year == 21, w21).when(year == 22, w22).otherwise(1.0)


def hash_int(text: Column) -> Column:
    """First 32 bits of the md5 of a text as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def nearest_index(n: Column, share: float) -> Column:
    """0-based position of the nearest-rank quantile in ``n`` sorted values."""
    return F.floor((n - 1) * F.lit(float(share)) + F.lit(0.5)).cast("int")


def matches(any_of) -> Column:
    """True where any predicate holds; a predicate is pairs of (column, value) that all hold."""
    condition = F.lit(False)
    for pairs in any_of:
        together = F.lit(True)
        for column, value in pairs:
            together = together & (F.col(column) == value)
        condition = condition | together
    return condition
