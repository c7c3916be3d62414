"""Streaming queries over the events file, run to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import DECIMALS, IV, mean, rounded, table
from checks.tables import LATEST_PRICE, PRICE_COLUMNS
from hourgrid.functions import timeutil as tu
from hourgrid.operators.upsert import upsert_table
from hourgrid.session import scratch_path
from hourgrid.streaming import streams

Q: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf)


@query("stream_hourly_mean", f"""WITH {IV}, w AS (SELECT max(ts) - INTERVAL 2 HOUR - INTERVAL 1 MICROSECOND AS mark FROM events)
SELECT he AS hour_ending, event_type, round({mean('value')}, 6) AS value, count(*) AS n_intervals FROM iv, w WHERE he <= mark GROUP BY he, event_type""")
def _(spark, sf):
    means = streams.hourly_means(event_stream(spark, sf), "ts", ["event_type"], ["value"], "2 hours", DECIMALS)
    base = scratch_path(spark, "stream-hourly")
    return rounded(streams.run_to_table(means, f"{base}/out", f"{base}/checkpoint"))


@query("stream_distinct", f"WITH {IV} SELECT DISTINCT event_type, he FROM iv")
def _(spark, sf):
    hours = event_stream(spark, sf).select("event_type", tu.hour_ending("ts").alias("he"), "ts")
    kept = streams.distinct_intervals(hours, "ts", ["event_type", "he"], "40 days").select("event_type", "he")
    base = scratch_path(spark, "stream-distinct")
    return streams.run_to_table(kept, f"{base}/out", f"{base}/checkpoint")


@query("stream_upsert", f"WITH {IV} {LATEST_PRICE}")
def _(spark, sf):
    """Each micro-batch of events merged into a stored price table."""
    base = scratch_path(spark, "stream-upsert")

    def merge(batch, _epoch):
        he = tu.hour_ending("ts")
        rows = batch.select(
            he.alias("Interval_HE"), he.alias("GMTIntervalEnd_HE"), tu.fixed_offset(he).alias("timestamp_mst_HE"),
            F.col("event_type").alias("Settlement_Location_Name"), F.col("event_type").alias("PNODE_Name"),
            *[F.col("value").alias(c) for c in ("LMP", "MLC", "MCC", "MEC")],
            F.col("ts").alias("file_create_time_utc"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("url"),
        )
        upsert_table(batch.sparkSession, rows, "lmp", base)

    writer = event_stream(spark, sf).writeStream.foreachBatch(merge).option("checkpointLocation", f"{base}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.parquet(f"{base}/lmp").select(*PRICE_COLUMNS))
