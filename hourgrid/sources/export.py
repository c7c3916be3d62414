"""CSV export of display tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_name(node: str | Column, start: str | Column) -> Column:
    """File name of one node's forecast, e.g. price-forecast-N-2026-03-01T05-00.csv."""
    node = F.col(node) if isinstance(node, str) else node
    start = F.col(start) if isinstance(start, str) else start
    return F.concat(
        F.lit("price-forecast-"), node, F.lit("-"), F.date_format(start, "yyyy-MM-dd'T'HH-mm"), F.lit(".csv")
    )


def write_csv(display: DataFrame, path: str, start: str = "origin") -> None:
    """All nodes in one job: a folder per forecast, named like the single-file download."""
    named = display.withColumn("forecast", export_name("node", start)).drop(start)
    (
        named.hint("rebalance", "forecast")
        .sortWithinPartitions("forecast", "time")
        .write.mode("overwrite")
        .partitionBy("forecast")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
