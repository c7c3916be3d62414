"""Snapshots of training data and the registry of champion models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.sources.tables import read_table, table_path

REGISTRY_SCHEMA = (
    "model string, artifact_folder string, data_snapshot_path string, train_timestamp timestamp_ntz, "
    "promoted_at timestamp_ntz, avg_mae double, avg_rmse double, avg_ci_coverage_error double"
)


def snapshot_tables(spark: SparkSession, base: str, names: Sequence[str], version: str, out_base: str | None = None) -> str:
    """Copy tables to a versioned folder and record it; training reads the copy."""
    folder = f"{(out_base or base).rstrip('/')}/snapshots/{version}"
    for name in names:
        spark.read.parquet(table_path(base, name)).write.mode("errorifexists").parquet(table_path(folder, name))
    log = spark.range(1).select(F.lit(version).alias("version"), F.lit(folder).alias("folder"))
    log.write.mode("append").parquet(f"{(out_base or base).rstrip('/')}/snapshot_log")
    return folder


def promote(spark: SparkSession, registry: str, row: dict) -> None:
    """Append a champion row; earlier rows stay for audit and for reverting."""
    names = [c.split()[0] for c in REGISTRY_SCHEMA.split(", ")]
    record = spark.createDataFrame([tuple(row.get(n) for n in names)], REGISTRY_SCHEMA)
    record.write.mode("append").parquet(registry)


def current_champion(registry: DataFrame, keys: Sequence[str] = ("model",), stamp: str = "promoted_at", ties: Sequence[str] = ("artifact_folder",)) -> DataFrame:
    """The newest champion row per model."""
    rest = [c for c in registry.columns if c not in keys]
    newest = registry.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(stamp, *ties)).alias("row"))
    return newest.select(*keys, "row.*").select(*registry.columns)


def read_champion(spark: SparkSession, registry: str) -> DataFrame | None:
    rows = read_table(spark, registry)
    return None if rows is None else current_champion(rows)


def revert(spark: SparkSession, registry: str, model: str, artifact_folder: str, at: str) -> None:
    """Point back to an earlier champion by appending its row with a new stamp."""
    rows = spark.read.parquet(registry)
    earlier = current_champion(rows.where((F.col("model") == model) & (F.col("artifact_folder") == artifact_folder)))
    found = earlier.take(1)
    if not found:
        raise ValueError(f"{artifact_folder} was never a champion of {model}")
    promote(spark, registry, {**found[0].asDict(), "promoted_at": _parse(at)})


def _parse(at: str):
    from datetime import datetime

    return datetime.fromisoformat(at)
