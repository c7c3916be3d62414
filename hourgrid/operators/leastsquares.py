"""Linear least squares from sufficient statistics.

One aggregation sums the products of all features, with the target and with each other, per key. Such
moments can be added (dates, tables, keys) without going back to the rows, and serve any number of regularisations. What
comes to the driver is one small matrix per key, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(rows: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """(keys, n, m): number of rows and sums of products of the features, the target and 1.

    ``m`` is the upper triangle, by rows, of the matrix over (1, features..., target). Rows with a null there are left out.
    """
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(target).cast("double")]
    full = rows.na.drop(subset=[*features, target])
    products = [F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*products).alias("m"))


def added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of the keys, from moments of finer keys."""
    size = F.posexplode("m").alias("at", "v")
    summed = parts.select(*keys, size).groupBy(*keys, "at").agg(F.sum("v").alias("v"))
    listed = summed.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("m"))
    counts = parts.groupBy(*keys).agg(F.sum("n").alias("n"))
    return counts.join(listed, list(keys)) if keys else counts.crossJoin(listed)


def matrix(m: Sequence[float]) -> np.ndarray:
    """The symmetric matrix of an upper triangle."""
    size = int((np.sqrt(8 * len(m) + 1) - 1) / 2)
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = m
    return out + np.triu(out, 1).T


def solve(m: np.ndarray, n: float, regularisations: Sequence[float]) -> list[np.ndarray]:
    """Coefficients (1, features...) for each regularisation, which weighs standardised features and not the constant.

    A feature that does not vary gets 0.
    """
    mean = m[0, 1:] / n
    centred = m[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(centred)[:-1], 0))
    use = scale > 1e-9 * (1 + np.abs(mean[:-1]))
    gram = centred[:-1, :-1][np.ix_(use, use)] / np.outer(scale[use], scale[use])
    cross = centred[:-1, -1][use] / scale[use]
    out = []
    for weight in regularisations:
        b = np.zeros(len(mean))
        b[1:][use] = np.linalg.lstsq(gram + weight * np.eye(int(use.sum())), cross, rcond=None)[0] / scale[use] if use.any() else 0.0
        b[0] = mean[-1] - mean[:-1] @ b[1:]
        out.append(b)
    return out


def fit(
    parts: DataFrame, key: str, regularisations: Sequence[float] = (0.01,), pooled_rows: float = 0.0,
) -> DataFrame:
    """(key, regularisation, n, coefficients) from moments by one key.

    With ``pooled_rows``, each key's moments get so many rows' worth of the mean moments of all keys, so a key with few
    rows leans on the others. One matrix a key is collected: keys must be few (steps of a horizon).
    """
    spark = parts.sparkSession
    rows = [(r[key], r["n"], matrix(r["m"])) for r in parts.select(key, "n", "m").collect()]
    total = sum(n for _, n, _ in rows)
    everything = sum((m for _, _, m in rows), np.zeros(())) / max(total, 1)
    found = [
        (k, float(weight), n, [float(v) for v in b])
        for k, n, m in rows
        for weight, b in zip(regularisations, solve(m + pooled_rows * everything, n + pooled_rows, regularisations))
    ]
    kind = parts.schema[key].dataType.simpleString()
    return spark.createDataFrame(found, f"{key} {kind}, regularisation double, n long, coefficients array<double>")


def predicted(coefficients: str, features: Sequence[str]) -> Column:
    """The value for a row's features, from an array column of coefficients."""
    out = F.col(coefficients)[0]
    for k, name in enumerate(features):
        out = out + F.col(coefficients)[k + 1] * F.col(name).cast("double")
    return out
