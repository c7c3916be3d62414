"""Numeric expressions: casts, clamps, guarded division, reproducible means."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import params


def mean_of(c: str | Column, decimals: int | None = None) -> Column:
    """Mean of a measure.

    With ``decimals`` the sum runs over scaled integers, so the result does not
    depend on row order or on how the data is partitioned; use it for measures
    quoted to a fixed number of decimals.
    """
    c = F.col(c) if isinstance(c, str) else c
    if decimals is None:
        return F.avg(c)
    return sum_of(c, decimals) / F.count(c)


def sum_of(c: str | Column, decimals: int | None = None) -> Column:
    """Sum of a measure; see :func:`mean_of` for ``decimals``. Null when no value is given."""
    c = F.col(c) if isinstance(c, str) else c
    if decimals is None:
        return F.sum(c)
    scale = 10**decimals
    return F.sum(F.round(c * scale).cast("bigint")) / F.lit(float(scale))


def clamp(c: str | Column, bound: float = params.PRICE_CLAMP) -> Column:
    """Limit to [-bound, bound]; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > bound, F.lit(bound)).when(c < -bound, F.lit(-bound)).otherwise(c)


def replace_outside(c: str | Column, low: Column, high: Column) -> Column:
    """Replace values strictly outside [low, high] by the bound; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > high, high).when(c < low, low).otherwise(c)


def guard_small(c: Column, guard: float = params.NET_LOAD_GUARD) -> Column:
    """Values closer to zero than ``guard`` become +guard, so they can divide."""
    return F.when(F.abs(c) < guard, F.lit(guard)).otherwise(c)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, not an error, on a zero denominator."""
    return F.try_divide(numerator, denominator)


def add_columns(*names: str) -> Column:
    return reduce(lambda a, b: a + b, [F.col(n) for n in names])


def display_round(c: str | Column, places: int = 2) -> Column:
    """Rounding for report tables: scaled, rounded half-even as a double, scaled back,
    which is what numeric arrays do (decimal half-even differs in the last binary digit)."""
    scale = float(10**places)
    return F.rint((F.col(c) if isinstance(c, str) else c).cast("double") * scale) / scale


def matches(c: str | Column, pattern: str) -> Column:
    """Regular-expression search. A pattern without special characters becomes a
    substring test, which parquet scans can use to skip data."""
    c = F.col(c) if isinstance(c, str) else c
    if re.search(r"[.^$*+?{}\[\]|()\\]", pattern):
        return c.rlike(pattern)
    return c.contains(pattern)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim column names and turn blanks into underscores."""
    return df.toDF(*[name.strip().replace(" ", "_") for name in df.columns])


def drop_suffixes(df: DataFrame, *suffixes: str) -> DataFrame:
    """Drop join leftovers by name ending."""
    return df.select([c for c in df.columns if not c.endswith(tuple(suffixes))])
