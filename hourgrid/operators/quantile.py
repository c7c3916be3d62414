"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one task. That is
right for bounded groups (the samples of one forecast hour) and used there. For
pooled measures the group may be the whole table, so the value is found in steps:

1. count rows per (group, value), combined on the map side, into a written table;
2. cut the range of the distinct values into slices by approximate quantiles; the
   number of slices follows the number of distinct values, so that a slice stays small
   however large the table is and however often one value occurs;
3. add up counts per (group, slice), a small table, to find the slice of each rank;
4. join by group and slice and order only the slices that hold a wanted rank.

Slices only divide the work; the answer is exact for any slicing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid.session import materialize

SLICES = 256                # at least; a power of two
SLICE_VALUES = 100_000      # distinct values of a slice to aim at
MOST_SLICES = 1 << 14       # edges are literals of the plan


def _ranks(levels: Sequence[float], n: Column, method: str) -> Column:
    """For each level the two 0-based ranks to mix and the weight of the upper one."""
    entries = []
    for level in levels:
        position = (n - 1) * F.lit(float(level))
        if method == "linear":
            low, high = F.floor(position), F.ceil(position)
            weight = position - low
        elif method == "nearest":
            low = high = F.floor(position + 0.5)
            weight = F.lit(0.0)
        else:
            raise ValueError(f"method must be linear or nearest, got {method!r}")
        entries.append(
            F.struct(
                F.lit(float(level)).alias("level"),
                low.cast("bigint").alias("low"),
                high.cast("bigint").alias("high"),
                weight.cast("double").alias("weight"),
            )
        )
    return F.array(*entries)


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    levels: Sequence[float],
    method: str = "linear",
    slices: int | None = None,
) -> DataFrame:
    """Rows (groups..., level, quantile). Nulls are ignored.

    ``linear`` interpolates between neighbours, ``nearest`` takes the nearest rank
    floor((n - 1) * level + 0.5).
    """
    counts = materialize(value_counts(df, groups, value), "value-counts")
    return quantiles_of_counts(counts, groups, levels, method, slices)


def approximate_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, levels: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Rows (groups..., level, quantile) from sketches, one aggregation: ranks are off by at most n / accuracy."""
    levels = [float(v) for v in levels]
    found = df.where(F.col(value).isNotNull()).groupBy(*groups).agg(
        F.percentile_approx(F.col(value).cast("double"), levels, accuracy).alias("_q")
    )
    pairs = F.arrays_zip(F.array(*[F.lit(v) for v in levels]).alias("level"), F.col("_q").alias("quantile"))
    return found.where(F.col("_q").isNotNull()).select(*groups, F.explode(pairs).alias("_p")).select(
        *groups, F.col("_p")["level"].alias("level"), F.col("_p")["quantile"].alias("quantile")
    )


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Rows (groups..., _v, _c): how often each value occurs, nulls included."""
    return df.groupBy(*groups, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def quantiles_of_counts(
    counts: DataFrame, groups: Sequence[str], levels: Sequence[float], method: str = "linear", slices: int | None = None,
) -> DataFrame:
    """Exact quantiles from the (written) result of :func:`value_counts`."""
    groups = list(groups)
    keys = groups or ["_all"]
    counts = counts.where(F.col("_v").isNotNull())
    counts = counts if groups else counts.withColumn("_all", F.lit(1))
    cut = with_slice(counts, "_v", slice_edges(counts, "_v", slices))
    totals = _slice_totals(cut, keys).withColumn("_want", _ranks(levels, F.col("_n"), method))
    first, last = F.col("_before"), F.col("_before") + F.col("_in") - 1
    wanted = totals.withColumn(
        "_want", F.filter("_want", lambda r: r["low"].between(first, last) | r["high"].between(first, last))
    ).where(F.size("_want") > 0)
    wanted = wanted.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_i").alias("_j"), "_before", "_want")
    match = F.col("_i") == F.col("_j")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        cut.join(wanted, match)
        .withColumn("_to", F.col("_before") + F.sum("_c").over(inside) - 1)
        .withColumn("_from", F.col("_to") - F.col("_c") + 1)
    )
    here = lambda rank: rank.between(F.col("_from"), F.col("_to"))
    hits = ranked.select(
        *groups, "_v", "_from", "_to",
        F.explode(F.filter("_want", lambda r: here(r["low"]) | here(r["high"]))).alias("_r"),
    )
    # At most two values reach each (group, level): the lower and the upper neighbour.
    low = F.max(F.when(here(F.col("_r.low")), F.col("_v")))
    high = F.max(F.when(here(F.col("_r.high")), F.col("_v")))
    return hits.groupBy(*groups, F.col("_r.level").alias("level")).agg(
        (low + (high - low) * F.max("_r.weight")).alias("quantile")
    )


def slice_edges(counts: DataFrame, value: str, slices: int | None = None) -> list[float]:
    """Values that cut the distinct values into slices; read to the driver, so that every use has the same cut.

    Nearly equal numbers of distinct values lie between two edges: how often a value
    occurs does not matter.
    """
    if slices is None:
        need = -(-counts.count() // SLICE_VALUES)
        slices = min(MOST_SLICES, max(SLICES, 1 << max(need - 1, 0).bit_length()))
    steps = [i / slices for i in range(1, slices)]
    found = counts.agg(F.percentile_approx(F.col(value).cast("double"), steps, 20 * slices)).first()[0]
    return sorted(set(found or ()))


def with_slice(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Add ``_i``, the number of edges below the value, found by halving the ordered edges."""
    out = df.withColumn("_edges", F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>")).withColumn("_i", F.lit(0))
    half = (1 << len(edges).bit_length()) // 2
    while half:
        passed = F.get("_edges", F.col("_i") + (half - 1)) < F.col(value)
        out = out.withColumn("_i", F.col("_i") + F.when(passed, half).otherwise(0))
        half //= 2
    return out.drop("_edges")


def _slice_totals(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per (group, slice) with the number of rows before it and in the group.

    Slices are cut over all groups together; a group has at most a row per slice here.
    """
    by_group = Window.partitionBy(*keys)
    before = by_group.orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.groupBy(*keys, "_i").agg(F.sum("_c").alias("_in"))
        .withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
        .withColumn("_n", F.sum("_in").over(by_group))
    )


def quantile_columns(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    named: dict[str, float],
    method: str = "linear",
    accuracy: int | None = None,
) -> DataFrame:
    """One row per group with a column per named level; with an ``accuracy`` approximate (nearest rank)."""
    levels = list(named.values())
    rows = exact_quantiles(df, groups, value, levels, method) if accuracy is None else approximate_quantiles(df, groups, value, levels, accuracy)
    return level_columns(rows, groups, named)


def level_columns(rows: DataFrame, groups: Sequence[str], named: dict[str, float]) -> DataFrame:
    """(groups..., level, quantile) rows to one column per named level."""
    columns = [
        F.max(F.when(F.col("level") == F.lit(float(level)), F.col("quantile"))).alias(name)
        for name, level in named.items()
    ]
    return rows.groupBy(*groups).agg(*columns) if groups else rows.agg(*columns)


def small_group_quantiles(value: str | Column, levels: Sequence[float]) -> Column:
    """Linear quantiles as one array, for groups whose size is bounded by design."""
    value = F.col(value) if isinstance(value, str) else value
    return F.percentile(value, F.array(*[F.lit(float(q)) for q in levels]))
