"""Streaming counterparts: continuous ingest, hourly means with late data, deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourgrid.functions.measures import mean_of
from hourgrid.operators.upsert import upsert_table
from hourgrid.schemas import SOURCE
from hourgrid.session import materialize
from hourgrid.sources import feeds, jobs
from hourgrid.sources.manifest import file_stamp
from hourgrid.sources.tables import read_table


def landed_stream(spark: SparkSession, feed: str, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of a feed's landed CSV files as a stream of text rows, header lines too, with their file."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return feeds.csv_lines(reader, feeds.get_feed(feed), path)


def continuous_ingest(
    spark: SparkSession,
    feed: str,
    landing: str,
    base: str,
    checkpoint: str,
    interval: str | None = None,
    max_files: int | None = None,
    stamp_hour: int = 0,
    hourly_method: str = "per_file",
) -> StreamingQuery:
    """Merge each micro-batch of landed files into the feed's table and append it to bronze.

    The merge keeps the latest vintage per key, and bronze takes only file versions that it does not
    hold, the logs of rejected rows and verdicts too; so replaying a batch after a failure changes nothing and a rebuild from
    bronze has all streamed rows. A file whose header does not fit is set aside and does not stop the stream. Without an interval, all waiting files are taken and the query ends.
    """
    spec = feeds.get_feed(feed)

    def merge(batch: DataFrame, _epoch: int) -> None:
        session = batch.sparkSession
        lines = materialize(batch, "lines")
        held, logs = read_table(session, feeds.bronze_path(base, spec)), jobs.read_logs(session, base, spec)
        if not lines.isEmpty():
            # The hour that ends at midnight has files of two dates, so a day to either side.
            day = F.to_date(file_stamp(F.col(SOURCE), spec, stamp_hour))
            first, last = lines.agg(F.date_sub(F.min(day), 1), F.date_add(F.max(day), 1)).first()
            dated = lambda df: None if df is None else feeds.dated(df, first, last)
            held, logs = dated(held), {log: dated(df) for log, df in logs.items()}
        everything = jobs.judged(lines, spec, stamp_hour, held, logs)
        rows = everything.rows
        if not rows.isEmpty():
            upsert_table(session, jobs.batch_for_table(everything, hourly_method), spec.target, base)
        fresh = rows if held is None else feeds.only_new_files(rows, held)
        jobs.store(replace(everything, rows=materialize(fresh, "fresh")), base, spec)

    writer = landed_stream(spark, feed, landing, max_files).writeStream.foreachBatch(merge)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def with_event_time(stream: DataFrame, time: str) -> DataFrame:
    """Event time as TIMESTAMP; watermarks do not accept NTZ columns."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def hourly_means(
    stream: DataFrame, time: str, keys: Sequence[str], values: Sequence[str], delay: str = "2 hours",
    decimals: int | None = None,
) -> DataFrame:
    """Mean of all intervals of an hour, closed once the watermark has passed it.

    The window end is the hour-ending label: intervals are moved back by a microsecond
    so that one stamped exactly on the hour belongs to the hour it ends.
    """
    timed = with_event_time(stream, time).withColumn(time, F.col(time) - F.expr("INTERVAL 1 MICROSECOND"))
    hour = F.window(time, "1 hour")
    out = timed.withWatermark(time, delay).groupBy(hour.alias("_w"), *keys).agg(
        *[mean_of(v, decimals).alias(v) for v in values], F.count(F.lit(1)).alias("n_intervals")
    )
    return out.select(F.col("_w.end").cast("timestamp_ntz").alias("hour_ending"), *keys, *values, "n_intervals")


def distinct_intervals(stream: DataFrame, time: str, keys: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """Drop re-delivered intervals that arrive within the watermark delay."""
    return with_event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into parquet and return the table."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode(mode).format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
