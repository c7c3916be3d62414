"""Whole collection jobs: files landed from the events, collected in several runs, tables read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import DECIMALS, IV, intervals, total
from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import mean_of, sum_of
from hourgrid.operators.upsert import rebuild_table
from hourgrid.session import scratch_path
from hourgrid.sources import feeds, jobs
from hourgrid.streaming import streams

Q: dict = {}
SHIFT = 1000        # a day's file carries the day before again, with its values shifted


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


def land(spark: SparkSession, lines: DataFrame, header: str, folder: str) -> None:
    """Rows (name, line) as landed files of these names, each with the header."""
    heads = lines.select("name").distinct().select("name", F.lit(header).alias("line"), F.lit(0).alias("at"))
    both = heads.unionByName(lines.select("name", "line", F.lit(1).alias("at")))
    staged = scratch_path(spark, "landing")
    both.repartition("name").sortWithinPartitions("name", "at").select("name", "line").write.partitionBy("name").text(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for found in fs.globStatus(path(f"{staged}/name=*/part-*")):
        name = found.getPath().getParent().getName().removeprefix("name=")
        target = path(f"{folder}/{name}")
        fs.delete(target, False)
        fs.rename(found.getPath(), target)


def text(time: str):
    return F.date_format(time, "MM/dd/yyyy HH:mm:ss")


def load_lines(spark, sf) -> DataFrame:
    """Rows (day, name, he, line): hourly sums of a day and, shifted, of the day before."""
    hours = intervals(spark, sf).groupBy("he").agg(sum_of("value", DECIMALS).alias("v"), F.count(F.lit(1)).alias("n"))
    days = hours.select(F.to_date("he").alias("day")).distinct()
    own = hours.withColumn("day", F.to_date("he"))
    again = own.withColumn("day", F.date_add("day", 1)).withColumn("v", F.col("v") + SHIFT).join(days, "day", "left_semi")
    rows = own.unionByName(again)
    name = F.concat(F.lit("MKT-OP-MTLF-"), F.date_format("day", "yyyyMMdd"), F.lit("0000.csv"))
    line = F.concat_ws(",", text("he"), text("he"), F.format_string("%.2f", "v"), F.col("n").cast("string"))
    return rows.select("day", name.alias("name"), "he", line.alias("line"))


LOAD_HEADER = "Interval,GMTIntervalEnd,MTLF,Averaged Actual"
HOURLY = f"""{IV}, h AS (SELECT he, {total('value')} AS v, count(*) AS n FROM iv GROUP BY he),
d AS (SELECT DISTINCT CAST(he AS DATE) AS day FROM h),
l AS (SELECT he, n, v + CASE WHEN CAST(he AS DATE) + 1 IN (SELECT CAST(day AS DATE) FROM d) THEN {SHIFT} ELSE 0 END AS v, CAST(he AS DATE) + 1 IN (SELECT CAST(day AS DATE) FROM d) AS again FROM h)"""
MTLF = "CAST(CAST({0} AS FLOAT) AS DOUBLE) AS MTLF, CAST(n AS DOUBLE) AS Averaged_Actual"


def loads(df: DataFrame) -> DataFrame:
    return df.select("GMTIntervalEnd", F.col("MTLF").cast("double").alias("MTLF"), F.col("Averaged_Actual").cast("double").alias("Averaged_Actual"))


def collect_load(spark, folder: str, base: str, first, last):
    hours = (last - first).days * 24 + 1
    return jobs.collect(spark, "load_forecast", folder, base, f"{last} 00:00:00", hours)


@query("collect_job", f"WITH {HOURLY} SELECT he AS GMTIntervalEnd, {MTLF.format('v')} FROM l")
def _(spark, sf):
    """Landed load files in two runs, the second over all of them, then a run without news."""
    lines, base = load_lines(spark, sf), scratch_path(spark, "collect")
    folder = f"{base}/landing"
    first, last = lines.agg(F.min("day"), F.max("day")).first()
    middle = first + timedelta(days=(last - first).days // 2)
    land(spark, lines.where(F.col("day") <= F.lit(middle)), LOAD_HEADER, folder)
    collect_load(spark, folder, base, first, middle)
    land(spark, lines.where(F.col("day") > F.lit(middle)), LOAD_HEADER, folder)
    collect_load(spark, folder, base, first, last)
    if collect_load(spark, folder, base, first, last)["stats"] is not None:
        raise ValueError("a repeated run found news")
    return loads(spark.read.parquet(f"{base}/mtlf"))


@query("recollect_job", f"WITH {HOURLY} SELECT he AS GMTIntervalEnd, {MTLF.format('v + CASE WHEN again THEN 5000 ELSE 0 END')} FROM l")
def _(spark, sf):
    """Files revised under their own names are taken again; the table is rebuilt from bronze."""
    lines, base = load_lines(spark, sf), scratch_path(spark, "recollect")
    folder = f"{base}/landing"
    first, last = lines.agg(F.min("day"), F.max("day")).first()
    land(spark, lines, LOAD_HEADER, folder)
    collect_load(spark, folder, base, first, last)
    part = F.split("line", ",")
    revised = F.concat_ws(",", part[0], part[1], F.format_string("%.2f", part[2].cast("double") + 5000), part[3])
    shifted = F.to_date("he") < F.col("day")
    land(spark, lines.withColumn("line", F.when(shifted, revised).otherwise(F.col("line"))), LOAD_HEADER, folder)
    collect_load(spark, folder, base, first, last)
    rebuild_table(spark, "mtlf", base, f"{base}/rebuilt")
    return loads(spark.read.parquet(f"{base}/rebuilt/mtlf"))


@query("continuous_ingest", f"WITH {HOURLY} SELECT he AS GMTIntervalEnd, {MTLF.format('v')}, CAST(CASE WHEN again THEN 2 ELSE 1 END AS BIGINT) AS n_vintages FROM l")
def _(spark, sf):
    """The same files as a stream of several micro-batches; bronze keeps every vintage."""
    base = scratch_path(spark, "continuous")
    land(spark, load_lines(spark, sf), LOAD_HEADER, f"{base}/landing")
    run = streams.continuous_ingest(spark, "load_forecast", f"{base}/landing", base, f"{base}/checkpoint", max_files=12)
    run.awaitTermination()
    vintages = feeds.read_bronze(spark, base, "load_forecast").groupBy("GMTIntervalEnd").agg(F.count(F.lit(1)).alias("n_vintages"))
    return loads(spark.read.parquet(f"{base}/mtlf")).join(vintages, "GMTIntervalEnd")


@query("rejected_job", f"""WITH {HOURLY}, f AS (SELECT he, CAST(he AS DATE) AS day FROM l UNION ALL SELECT he, CAST(he AS DATE) + 1 FROM l WHERE again),
k AS (SELECT strftime(CAST(day AS TIMESTAMP), '%Y%m%d') AS day, CASE hour(he) WHEN 3 THEN 'number' WHEN 4 THEN 'time' WHEN 5 THEN 'columns' END AS reason FROM f)
SELECT day, reason, count(*) AS n_rows FROM k WHERE reason IS NOT NULL GROUP BY day, reason""")
def _(spark, sf):
    """Lines with a bad number, a bad time or too few columns are stored with the reason."""
    lines, base = load_lines(spark, sf), scratch_path(spark, "rejected")
    hour = F.hour(F.col("he").cast("timestamp_ntz"))
    bad = F.when(hour == 3, F.regexp_replace("line", r",[^,]*,([^,]*)$", ",12x,$1")).when(hour == 4, F.concat(F.lit("not a time"), "line")).when(
        hour == 5, F.lit("01/01/2024,2")).otherwise(F.col("line"))
    land(spark, lines.withColumn("line", bad), LOAD_HEADER, f"{base}/landing")
    first, last = lines.agg(F.min("day"), F.max("day")).first()
    collect_load(spark, f"{base}/landing", base, first, last)
    stored = spark.read.parquet(f"{base}/rejected/mtlf")
    return stored.groupBy(F.regexp_extract("url", r"-(\d{8})0000\.csv$", 1).alias("day"), "reason").agg(F.count(F.lit(1)).alias("n_rows"))


REJECTS = f"""WITH {HOURLY}, f AS (SELECT he, CAST(he AS DATE) AS day FROM l UNION ALL SELECT he, CAST(he AS DATE) + 1 FROM l WHERE again),
k AS (SELECT strftime(CAST(day AS TIMESTAMP), '%Y%m%d') AS day, CASE WHEN day(day) % 5 = 0 THEN 'time' WHEN hour(he) = 3 THEN 'number' END AS reason FROM f)
SELECT day, reason, count(*) AS n_rows FROM k WHERE reason IS NOT NULL GROUP BY day, reason"""


def spoilt_lines(spark, sf) -> DataFrame:
    """Load lines; every fifth file has no good line at all, the others a bad number each."""
    lines = load_lines(spark, sf)
    hour = F.hour(F.col("he").cast("timestamp_ntz"))
    bad = F.when(F.dayofmonth("day") % 5 == 0, F.concat(F.lit("not a time"), "line")).when(
        hour == 3, F.regexp_replace("line", r",[^,]*,([^,]*)$", ",12x,$1")).otherwise(F.col("line"))
    return lines.withColumn("line", bad)


def rejects(stored: DataFrame) -> DataFrame:
    return stored.groupBy(F.regexp_extract("url", r"-(\d{8})0000\.csv$", 1).alias("day"), "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("rejected_repeat", REJECTS)
def _(spark, sf):
    """Three runs over the same files, also such as have no good line: rejected rows are stored once."""
    lines, base = spoilt_lines(spark, sf), scratch_path(spark, "repeat")
    land(spark, lines, LOAD_HEADER, f"{base}/landing")
    first, last = lines.agg(F.min("day"), F.max("day")).first()
    for _ in range(3):
        collect_load(spark, f"{base}/landing", base, first, last)
    return rejects(spark.read.parquet(f"{base}/rejected/mtlf"))


@query("stream_replay", REJECTS)
def _(spark, sf):
    """The files as a stream, and all of them again under a new checkpoint: rejected rows are stored once."""
    lines, base = spoilt_lines(spark, sf), scratch_path(spark, "replay")
    land(spark, lines, LOAD_HEADER, f"{base}/landing")
    for k in range(2):
        streams.continuous_ingest(spark, "load_forecast", f"{base}/landing", base, f"{base}/checkpoint{k}", max_files=16).awaitTermination()
    return rejects(spark.read.parquet(f"{base}/rejected/mtlf"))


@query("quarantine_job", f"""WITH {HOURLY}, q AS (SELECT he, n, v - CASE WHEN again THEN {SHIFT} ELSE 0 END AS v,
    day(CAST(he AS DATE)) % 5 <> 0 AS own, again AND day(CAST(he AS DATE) + 1) % 5 <> 0 AS next FROM l),
b AS (SELECT count(*) AS n_set_aside FROM d WHERE day(CAST(day AS DATE)) % 5 = 0)
SELECT he AS GMTIntervalEnd, {MTLF.format(f'v + CASE WHEN next THEN {SHIFT} ELSE 0 END')}, n_set_aside FROM q, b WHERE own OR next""")
def _(spark, sf):
    """Every fifth file has other columns: it is set aside, once, and the others are collected."""
    lines, base = load_lines(spark, sf), scratch_path(spark, "quarantine")
    bad = F.dayofmonth("day") % 5 == 0
    land(spark, lines.where(bad), "Interval,GMTIntervalEnd,Averaged Actual,MTLF", f"{base}/landing")
    land(spark, lines.where(~bad), LOAD_HEADER, f"{base}/landing")
    first, last = lines.agg(F.min("day"), F.max("day")).first()
    collect_load(spark, f"{base}/landing", base, first, last)
    if not collect_load(spark, f"{base}/landing", base, first, last)["verdicts"].isEmpty():
        raise ValueError("a repeated run judged a file again")
    aside = spark.read.parquet(f"{base}/verdicts/mtlf").where("verdict = 'header'").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return loads(spark.read.parquet(f"{base}/mtlf")).withColumn("n_set_aside", aside)


@query("hourly_mean_incremental", f"WITH {IV} SELECT he AS GMTIntervalEnd_HE, event_type AS node, true AS close FROM iv GROUP BY ALL")
def _(spark, sf):
    """Intervals of an hour spread over two files that come in different runs: means over all of them.

    Stored prices are 32-bit, so the query says whether each is within a thousandth of the exact mean.
    """
    base, e = scratch_path(spark, "hourly"), intervals(spark, sf)
    stamp = F.concat(F.date_format(F.to_date("he"), "yyyyMMdd"), F.when(F.col("event_id") % 3 == 0, "0000").otherwise("1200"))
    line = F.concat_ws(",", text("ts"), text("ts"), "event_type", "event_type", *[F.format_string("%.2f", "value")] * 4)
    # Whole seconds; a time that ends in the hour it began in.
    rows = e.select(F.to_date("he").alias("day"), F.concat(F.lit("MKT-RTBM-LMP-SL-"), stamp, F.lit(".csv")).alias("name"), line.alias("line"))
    folder = f"{base}/landing"
    first, last = rows.agg(F.min("day"), F.max("day")).first()
    for half in ("0000", "1200"):
        land(spark, rows.where(F.col("name").endswith(f"{half}.csv")), "Interval,GMTIntervalEnd,Settlement Location,Pnode,LMP,MLC,MCC,MEC", folder)
        jobs.collect(spark, "price_5min", folder, base, f"{last} 12:00:00", ((last - first).days * 24 + 13) * 12, hourly_method="mean")
    stored = spark.read.parquet(f"{base}/lmp").select("GMTIntervalEnd_HE", F.col("Settlement_Location_Name").alias("node"), "LMP")
    exact = e.groupBy(tu.hour_ending(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("GMTIntervalEnd_HE"), F.col("event_type").alias("node")).agg(
        mean_of("value", DECIMALS).alias("exact"))
    both = stored.join(exact, ["GMTIntervalEnd_HE", "node"], "full")
    return both.select("GMTIntervalEnd_HE", "node", F.coalesce(F.abs(F.col("LMP") - F.col("exact")) < 1e-3, F.lit(False)).alias("close"))
