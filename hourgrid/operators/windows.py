"""Lag differences and guarded rolling sums per series.

Rows are unique per (series, hour) when these run, so one window partition holds
at most as many rows as there are hours in range, however skewed the raw data was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from hourgrid import params


def series_window(keys: str | list[str], time: str = params.TIME) -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else keys
    return Window.partitionBy(*keys).orderBy(time)


def lag_diff(c: str | Column, window: WindowSpec) -> Column:
    """Value minus the previous row's value; null when either is null."""
    c = F.col(c) if isinstance(c, str) else c
    return c - F.lag(c).over(window)


def with_lags(df: DataFrame, name: str, depth: int, window: WindowSpec) -> DataFrame:
    """Add columns _lag_1 .. _lag_depth of one column, in one pass over the window."""
    return df.withColumns({f"_lag_{k}": F.lag(name, k).over(window) for k in range(1, depth + 1)})


def _rolling(terms: list[Column], measure: str) -> Column:
    """Sum of terms given newest first, added oldest first; null when any is null."""
    return reduce(lambda a, b: a + b, [t.cast("double") for t in reversed(terms)]).cast(measure)


def with_rolling_sums(
    df: DataFrame, name: str, window: WindowSpec, steps: Sequence[int] = params.ROLLING_STEPS, measure: str = "float"
) -> DataFrame:
    """Add name_rolling_i, the sum over i + 1 rows ending here; null unless all have a value.

    Adding lagged columns propagates nulls, which is the wanted guard, and reads each
    row once; a sliding frame would be summed anew for every row and step.
    """
    lagged = with_lags(df, name, max(steps), window)
    terms = [F.col(name), *[F.col(f"_lag_{k}") for k in range(1, max(steps) + 1)]]
    sums = {f"{name}_rolling_{i}": _rolling(terms[: i + 1], measure) for i in steps}
    return lagged.withColumns(sums).drop(*[f"_lag_{k}" for k in range(1, max(steps) + 1)])


def with_diff_and_rolling_sums(
    df: DataFrame, value: str, diff: str, window: WindowSpec, steps: Sequence[int] = params.ROLLING_STEPS,
    measure: str = "float",
) -> DataFrame:
    """Add the change of ``value`` and the rolling sums of that change from one window pass."""
    depth = max(steps) + 1
    lagged = with_lags(df, value, depth, window)
    level = [F.col(value), *[F.col(f"_lag_{k}") for k in range(1, depth + 1)]]
    change = [(level[k] - level[k + 1]).cast(measure) for k in range(depth)]
    sums = {f"{diff}_rolling_{i}": _rolling(change[: i + 1], measure) for i in steps}
    return lagged.withColumns({diff: change[0], **sums}).drop(*[f"_lag_{k}" for k in range(1, depth + 1)])
