"""Ingest, manifest, merge and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import DECIMALS, IV, ceil5, intervals, mean, rounded, table
from hourgrid.functions import timeutil as tu
from hourgrid.operators import asof, upsert
from hourgrid.plans import profile, registry
from hourgrid.schemas import FEEDS
from hourgrid.session import scratch_path
from hourgrid.sources import feeds, manifest
from hourgrid.sources.tables import load_tables

Q: dict = {}
PREFIX = "MKT"
BASE = "https://files.example/download?"
ALL_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


# --- manifests -------------------------------------------------------------------

def hour_manifest(spark, sf):
    """Every hour each event type should have, from its first to its last one."""
    i = intervals(spark, sf)
    bounds = i.groupBy("event_type").agg(F.max("he").alias("end"), F.min("he").alias("lo"))
    bounds = bounds.withColumn("n", tu.hours_between("end", "lo") + 1)
    return manifest.expand_manifest(bounds, "end", "n", "h").select("event_type", F.col("local_time").alias("he"))


MANIFEST = f"""WITH {IV}, b AS (SELECT event_type, min(he) AS lo, max(he) AS hi FROM iv GROUP BY ALL),
m AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS he FROM b) """


@query("manifest_hours", MANIFEST + "SELECT * FROM m")
def _(spark, sf):
    return hour_manifest(spark, sf)


@query("manifest_missing", MANIFEST + "SELECT * FROM m ANTI JOIN iv USING (event_type, he)")
def _(spark, sf):
    return manifest.missing(hour_manifest(spark, sf), intervals(spark, sf).select("event_type", "he"), ["event_type", "he"])


@query("manifest_landed", MANIFEST + "SELECT * FROM m SEMI JOIN iv USING (event_type, he)")
def _(spark, sf):
    return manifest.landed(hour_manifest(spark, sf), intervals(spark, sf).select("event_type", "he"), ["event_type", "he"])


def local_stamps(spark, sf):
    """Order dates with a time of day made from the key, so that daylight-saving changes occur."""
    o = table(spark, sf, "orders")
    minute = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"))
    return o.select("o_orderkey", (F.col("o_orderdate") + minute).alias("local_time"))


TO_UTC = "timezone('UTC', timezone('America/Chicago', {0}))"
TO_LOCAL = "timezone('America/Chicago', timezone('UTC', {0}))"
STAMPS = f"""WITH s AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(o_orderkey % 60 AS BIGINT)) AS ts FROM orders),
c AS (SELECT o_orderkey, {ceil5('ts')} AS t FROM s), u AS (SELECT o_orderkey, t, {TO_UTC.format('t')} AS u FROM c),
v AS (SELECT * FROM u WHERE {TO_LOCAL.format('u')} = t AND {TO_LOCAL.format('u + INTERVAL 1 HOUR')} <> t AND {TO_LOCAL.format('u - INTERVAL 1 HOUR')} <> t)
"""


@query("manifest_components", STAMPS + """SELECT o_orderkey, strftime(t, '%Y') AS "YEAR", strftime(t, '%m') AS "MONTH", strftime(t, '%d') AS "DAY",
 strftime(t, '%H') AS "HOUR", strftime(t, '%M') AS "MINUTE", strftime(t, '%Y%m') AS "YM", strftime(t, '%Y%m%d') AS "YMD",
 strftime(t, '%Y%m%d%H%M') AS "COMBINED", t AS timestamp_local, u AS timestamp_utc FROM v""")
def _(spark, sf):
    return manifest.with_time_components(local_stamps(spark, sf), five_min=True).drop("local_time")


@query("local_time_valid", f"""WITH s AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS t FROM orders),
u AS (SELECT *, {TO_UTC.format('t')} AS u FROM s)
SELECT o_orderkey, {TO_LOCAL.format('u')} = t AND {TO_LOCAL.format('u + INTERVAL 1 HOUR')} <> t AND {TO_LOCAL.format('u - INTERVAL 1 HOUR')} <> t AS valid FROM u""")
def _(spark, sf):
    t = F.col("o_orderdate") + tu.hours((F.col("o_orderkey") % 24).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", tu.local_time_exists_once(t).alias("valid"))


def _paths():
    day, month = "strftime(t, '%Y%m%d')", "'%2F' || strftime(t, '%m')"
    year = "'path=%2F' || strftime(t, '%Y')"
    comb = "strftime(t, '%Y%m%d%H%M')"
    d2 = "'%2F' || strftime(t, '%d')"
    return {
        "load_forecast": f"{year} || {month} || {d2} || '%2FMKT-OP-MTLF-' || {comb} || '.csv'",
        "renewable_forecast": f"{year} || {month} || {d2} || '%2FMKT-OP-MTRF-' || {comb} || '.csv'",
        "price_5min": f"{year} || {month} || '%2FBy_Interval' || {d2} || '%2FMKT-RTBM-LMP-SL-' || {comb} || '.csv'",
        "price_daily": f"{year} || {month} || '%2FBy_Day%2FMKT-RTBM-LMP-DAILY-SL-' || {day} || '.csv'",
        "generation_by_fuel": f"{year} || {month} || '%2FMKT-HRLY-GEN-CAP-BY-FUEL-TYPE-' || {day} || '.csv'",
    }


@query("manifest_paths", f"WITH c AS (SELECT event_id, {ceil5('ts')} AS t FROM events) SELECT event_id, " + ", ".join(
    f"'{BASE}' || {sql} AS {name}" for name, sql in _paths().items()) + " FROM c")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    parts = manifest.with_time_components(e, "ts", five_min=True)
    return parts.select("event_id", *[manifest.source_path(f, PREFIX, BASE).alias(n) for n, f in FEEDS.items()])


@query("provenance_parse", f"""WITH c AS (SELECT event_id, {ceil5('ts')} AS t FROM events)
SELECT event_id, {TO_UTC.format('t')} AS stamp_5min, {TO_UTC.format("date_trunc('day', t) + INTERVAL 15 HOUR")} AS stamp_daily,
 'RTBM-LMP-SL-' || strftime(t, '%Y%m%d%H%M') || '.parquet' AS output_name, 'MKT-RTBM-LMP-SL-' || strftime(t, '%Y%m%d%H%M') || '.csv' AS file FROM c""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    parts = manifest.with_time_components(e, "ts", five_min=True)
    five, daily = FEEDS["price_5min"], FEEDS["price_daily"]
    urls = parts.select(
        "event_id", manifest.source_path(five, PREFIX, BASE).alias("u5"), manifest.source_path(daily, PREFIX, BASE).alias("ud")
    )
    plain = F.regexp_replace("u5", "%2F", "/")
    return urls.select(
        "event_id", manifest.file_stamp(F.col("u5"), five).alias("stamp_5min"),
        manifest.file_stamp(F.col("ud"), daily, stamp_hour=15).alias("stamp_daily"),
        manifest.output_name(plain, PREFIX).alias("output_name"), manifest.file_name("u5").alias("file"),
    )


@query("load_tables", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ALL_TABLES))
def _(spark, sf):
    tables = load_tables(spark, sf, ALL_TABLES, ".parquet")
    out = None
    for name in tables:
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


# --- merge -------------------------------------------------------------------------

KEYS = ["event_type", "he"]
ORDER = ["ts", "event_id"]


def vintages(spark, sf):
    """Events as vintages of (event type, hour) rows; the event time is the stamp."""
    return intervals(spark, sf).select("event_type", "he", "ts", "event_id", "user_id", "value")


EARLY, LATE = "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-10'"


def batches(spark, sf):
    """A table as collected up to a day, and a later batch that collects part of it again."""
    v = vintages(spark, sf)
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    return v.where(F.col("ts") < stamp("2024-01-16 00:00:00")), v.where(F.col("ts") >= stamp("2024-01-10 00:00:00"))


def latest(source: str, where: str = "true") -> str:
    return f"""SELECT event_type, he, ts, event_id, user_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER
 (PARTITION BY event_type, he ORDER BY ts DESC, event_id DESC) AS rn FROM {source} WHERE {where}) WHERE rn = 1"""


@query("latest_wins", f"WITH {IV} {latest('iv')}")
def _(spark, sf):
    return rounded(upsert.latest_wins(vintages(spark, sf), KEYS, ORDER))


@query("latest_wins_settled", f"""WITH {IV} SELECT event_type, he, ts, event_id, user_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER
 (PARTITION BY event_type, he ORDER BY CASE WHEN value >= 50 THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) AS rn FROM iv) WHERE rn = 1""")
def _(spark, sf):
    v = vintages(spark, sf).withColumn("category", F.when(F.col("value") >= 50, "daily").otherwise("interval"))
    order = [upsert.settled_rank("category", ["daily"]), *ORDER]
    return rounded(upsert.latest_wins(v, KEYS, order).drop("category"))


@query("union_batches", f"""WITH {IV} SELECT event_type, he, ts, event_id, user_id, round(value, 6) AS value FROM iv WHERE {EARLY}
 UNION ALL SELECT event_type, he, ts, event_id, user_id, round(value, 6) AS value FROM iv WHERE {LATE}""")
def _(spark, sf):
    return rounded(upsert.union_batches(*batches(spark, sf)))


@query("upsert_merge", f"WITH {IV}, a AS (SELECT * FROM iv WHERE {EARLY} UNION ALL SELECT * FROM iv WHERE {LATE}) {latest('a')}")
def _(spark, sf):
    old, new = batches(spark, sf)
    return rounded(upsert.merge_latest(upsert.latest_wins(old, KEYS, ORDER), new, KEYS, ORDER))


@query("upsert_stats", f"""WITH {IV}, o AS (SELECT DISTINCT event_type, he, 1 AS old FROM iv WHERE {EARLY}), n AS (SELECT DISTINCT event_type, he, 1 AS new FROM iv WHERE {LATE}),
f AS (SELECT * FROM o FULL JOIN n USING (event_type, he))
SELECT count(old) AS rows_before, count(new) AS rows_batch, count(*) FILTER (WHERE old IS NULL) AS rows_inserted,
 count(*) FILTER (WHERE old = 1 AND new = 1) AS rows_updated, count(*) AS rows_after FROM f""")
def _(spark, sf):
    old, new = batches(spark, sf)
    return upsert.upsert_stats(old, new, KEYS)


@query("duplicate_keys", f"WITH {IV} SELECT event_type, he, user_id, count(*) AS n_rows FROM iv GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return upsert.duplicate_keys(intervals(spark, sf), ["event_type", "he", "user_id"])


def price_rows(spark, sf):
    """Events in the shape of hourly price rows with provenance; several vintages per hour."""
    return intervals(spark, sf).select(
        F.col("he").alias("Interval_HE"), F.col("he").alias("GMTIntervalEnd_HE"), F.col("timestamp_mst").alias("timestamp_mst_HE"),
        F.col("event_type").alias("Settlement_Location_Name"), F.col("event_type").alias("PNODE_Name"),
        *[F.col("value").alias(c) for c in ("LMP", "MLC", "MCC", "MEC")],
        F.col("ts").alias("file_create_time_utc"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("url"),
    )


PRICE_OUT = """ he AS "GMTIntervalEnd_HE", event_type AS "Settlement_Location_Name", event_type AS "PNODE_Name", round(value, 6) AS "LMP", ts AS file_create_time_utc """
LATEST_PRICE = f"""SELECT {PRICE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY event_type, he ORDER BY ts DESC, event_id DESC) AS rn FROM iv) WHERE rn = 1"""
PRICE_COLUMNS = ["GMTIntervalEnd_HE", "Settlement_Location_Name", "PNODE_Name", "LMP", "file_create_time_utc"]


@query("upsert_table", f"WITH {IV} {LATEST_PRICE}")
def _(spark, sf):
    """Two batches merged into a stored table, the second one overlapping the first."""
    base = scratch_path(spark, "upsert-table")
    rows, stamp = price_rows(spark, sf), F.col("file_create_time_utc")
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    upsert.upsert_table(spark, rows.where(stamp < lit("2024-01-16 00:00:00")), "lmp", base)
    upsert.upsert_table(spark, rows.where(stamp >= lit("2024-01-10 00:00:00")), "lmp", base)
    return rounded(spark.read.parquet(f"{base}/lmp").select(*PRICE_COLUMNS))


@query("rebuild_table", f"WITH {IV} {LATEST_PRICE}")
def _(spark, sf):
    """Stored vintages of both price feeds consolidated into a fresh table."""
    base, out = scratch_path(spark, "bronze"), scratch_path(spark, "rebuilt")
    rows = price_rows(spark, sf)
    interval = F.col("Settlement_Location_Name").isin("click", "view", "error")
    feeds.write_bronze(rows.where(interval), base, "price_5min")
    feeds.write_bronze(rows.where(~interval), base, "price_daily")
    upsert.rebuild_table(spark, "lmp", base, out)
    return rounded(spark.read.parquet(f"{out}/lmp").select(*PRICE_COLUMNS))


@query("vintage_as_of", """WITH u AS (SELECT DISTINCT user_id FROM events), d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
r AS (SELECT DISTINCT user_id, CAST(ts AS DATE) + INTERVAL 12 HOUR AS at FROM events)
SELECT r.user_id, r.at, max(e.ts) AS vintage, arg_max(e.value, e.ts) AS value FROM r LEFT JOIN events e ON e.user_id = r.user_id AND e.ts <= r.at GROUP BY ALL""")
def _(spark, sf):
    e = table(spark, sf, "events")
    noon = e.select("user_id", (F.to_date("ts").cast("timestamp_ntz") + tu.hours(12)).alias("at")).distinct()
    return asof.vintage_as_of(noon, e, ["user_id"], "at", "ts", ["value"])


# --- profiles and registry -----------------------------------------------------------

@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").dropDuplicates()


PROFILED = {
    "orders": ["o_totalprice"], "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "customer": ["c_acctbal"], "events": ["value"],
}


def _profile_sql():
    parts = []
    for t, cols in PROFILED.items():
        for c in cols:
            parts.append(
                f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS missing_count,
 round(min({c}), 6) AS min, round(max({c}), 6) AS max, round({mean(c)}, 6) AS avg, round(quantile_cont({c}, 0.25), 6) AS p25,
 round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS p75 FROM {t}"""
            )
    return " UNION ALL ".join(parts)


@query("table_profile", _profile_sql())
def _(spark, sf):
    frames = {t: table(spark, sf, t).select(*cols) for t, cols in PROFILED.items()}
    return rounded(profile.table_profile(frames, DECIMALS))


@query("time_profile", """SELECT 'o_orderdate' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE o_orderdate IS NULL) AS missing_count,
 min(o_orderdate) AS min_time, max(o_orderdate) AS max_time FROM orders""")
def _(spark, sf):
    return profile.time_profile(table(spark, sf, "orders"))


@query("champion_current", """SELECT p_brand AS model, artifact_folder, promoted_at FROM (SELECT p_brand, p_name || '-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS artifact_folder,
 TIMESTAMP '2024-01-01' + to_days(p_size) AS promoted_at, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name || '-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') DESC) AS rn FROM part) WHERE rn = 1""")
def _(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_brand").alias("model"), F.concat("p_name", F.lit("-"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("artifact_folder"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + tu.days(F.col("p_size"))).alias("promoted_at"),
    )
    return registry.current_champion(p)

