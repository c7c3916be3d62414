"""Landed CSV files to bronze parquet.

Each row keeps the file it came from, that file's creation stamp and when the file was last
written, so the merge can pick the latest vintage, also of a file that was revised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import mean_of
from hourgrid.schemas import (
    FEEDS, HOUR_ENDING_COLS, INTERVALS, LOCATION_COLS, MODIFIED, PRICE_COLS, SOURCE, STAMP, Feed,
)
from hourgrid.sources.manifest import file_name, file_stamp, missing


def get_feed(feed: str | Feed) -> Feed:
    return FEEDS[feed] if isinstance(feed, str) else feed


def csv_lines(reader, feed: Feed, path: str, names: str | None = None) -> DataFrame:
    """All lines of a feed's files as text columns, header lines too, with the file and its time."""
    lines = (
        reader.schema(feed.csv_schema())
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names or f"*{feed.file_tag}[0-9]*.csv")
        .csv(path)
    )
    return lines.withColumns({
        SOURCE: F.col("_metadata.file_path"), MODIFIED: F.col("_metadata.file_modification_time").cast("timestamp_ntz"),
    })


def _named(feed: Feed) -> list:
    """Per column: the text with everything but word characters as underscores, and the expected name."""
    return [(F.regexp_replace(F.trim(c), r"\W+", "_"), c) for c in feed.header]


def is_header(feed: Feed):
    return F.coalesce(_named(feed)[0][0].isin(list(feed.header)), F.lit(False))


def header_faults(lines: DataFrame, feed: Feed) -> DataFrame:
    """Files, by version, without a header line that has the feed's columns in their order, and one of their lines."""
    fits = is_header(feed) & F.col("_corrupt_record").isNull()
    for text, name in _named(feed):
        fits = fits & F.coalesce(text == name, F.lit(False))
    line = F.coalesce("_corrupt_record", F.concat_ws(",", *feed.header))
    found = lines.groupBy(SOURCE, MODIFIED).agg(
        F.max(fits).alias("fits"), F.coalesce(F.max(F.when(is_header(feed), line)), F.min(line)).alias("line")
    )
    return found.where(~F.col("fits")).select(SOURCE, MODIFIED, "line")


def check_headers(lines: DataFrame, feed: Feed) -> None:
    """Raise if a file has no header line with the feed's columns in their order."""
    bad = header_faults(lines, feed).select(SOURCE).limit(5).collect()
    if bad:
        raise ValueError(f"columns of {feed.name} are not {list(feed.header)} in {[r[0] for r in bad]}")


def read_landed(spark: SparkSession, feed: str | Feed, path: str, names: str | None = None) -> DataFrame:
    """All rows of a feed's landed CSV files as text, with the file path as ``url``.

    Files are matched by ``names``, a glob of file names (else by the feed's name tag), so one landing folder
    may hold all feeds. Headers are compared by name first (see :func:`check_headers`). Rows that do
    not fit the header keep their text in ``_corrupt_record``.
    """
    feed = get_feed(feed)
    lines = csv_lines(spark.read, feed, path, names)
    check_headers(lines, feed)
    return lines.where(~is_header(feed))


def name_glob(names: list[str], feed: Feed, most: int = 1000) -> str:
    """A glob of file names that lets the reader open the files of a manifest only.

    Beyond ``most`` names it goes by the months of their stamps; the manifest is still joined afterwards.
    """
    if len(names) <= most:
        return "{" + ",".join(sorted(names)) + "}"
    months = sorted({n.rsplit(feed.file_tag, 1)[1][:6] for n in names})
    return "{" + ",".join(f"*{feed.file_tag}{m}*.csv" for m in months) + "}"


def _typed(raw: DataFrame, feed: Feed) -> DataFrame:
    fmt = "yyyy-MM-dd'T'HH:mm:ss[XXX]" if feed.time_format == "iso" else feed.time_format
    out = raw.withColumnsRenamed(feed.renames)
    for name in feed.times:
        out = out.withColumn(f"{name}_text", F.col(name)).withColumn(
            name, tu.parse_feed_time(name, fmt, strict=False)
        )
    return out.withColumns({m: F.expr(f"try_cast({m} AS DOUBLE)") for m in feed.measures})


def _is_bad(feed: Feed):
    bad = F.col("_corrupt_record").isNotNull()
    for name in feed.times:
        bad = bad | F.col(name).isNull()
    return bad


def rejected_rows(raw: DataFrame, feed: str | Feed) -> DataFrame:
    """Rows that are left out or stored with a gap, and why: they do not fit the header
    (``columns``), a time does not parse (``time``), or a measure is no number (``number``: the row
    is stored, without that measure)."""
    feed = get_feed(feed)
    texts = raw.withColumnsRenamed(feed.renames).withColumns({f"{m}_text": F.col(m) for m in _renamed(feed)})
    typed = _typed(texts.withColumnsRenamed({v: k for k, v in feed.renames.items()}), feed)
    number = F.lit(False)
    for m in feed.measures:
        number = number | (F.col(m).isNull() & (F.coalesce(F.trim(f"{m}_text"), F.lit("")) != ""))
    time = F.lit(False)
    for name in feed.times:
        time = time | F.col(name).isNull()
    reason = F.when(F.col("_corrupt_record").isNotNull(), "columns").when(time, "time").when(number, "number")
    kept = [c for c in (SOURCE, MODIFIED) if c in raw.columns]
    return typed.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        *kept, "reason", "_corrupt_record", *[f"{n}_text" for n in (*feed.times, *feed.measures)]
    )


def _renamed(feed: Feed) -> tuple[str, ...]:
    return feed.measures


def process_feed(
    raw: DataFrame,
    feed: str | Feed,
    stamp_hour: int = 0,
    hourly_method: str = "per_file",
    measure: str = "float",
    decimals: int | None = None,
    with_counts: bool = False,
) -> DataFrame:
    """Rename, parse, add panel time, cast, aggregate price feeds, add provenance.

    ``hourly_method``: ``per_file`` averages within each file (a 5-minute file has
    one interval, so it yields that interval's price); ``mean`` averages all
    intervals of an hour over the files at hand and carries the newest stamp.
    """
    feed = get_feed(feed)
    typed = _typed(raw, feed).where(~_is_bad(feed))
    typed = typed.withColumns({
        "timestamp_mst": tu.fixed_offset("GMTIntervalEnd"),
        STAMP: file_stamp(SOURCE, feed, stamp_hour),
    })
    if not feed.hourly:
        keep = [*feed.times, *feed.measures, "timestamp_mst", STAMP, SOURCE, *_version(typed)]
        return typed.withColumns({m: F.col(m).cast(measure) for m in feed.measures}).select(keep).dropDuplicates()
    return hourly_prices(typed, hourly_method, measure, decimals, with_counts)


def _version(df: DataFrame) -> list[str]:
    return [MODIFIED] if MODIFIED in df.columns else []


def hourly_prices(
    intervals: DataFrame, method: str = "per_file", measure: str = "float", decimals: int | None = None, with_counts: bool = False,
) -> DataFrame:
    """Hour-ending mean of interval prices per location, with provenance."""
    he = {f"{c}_HE": tu.hour_ending(c) for c in ("Interval", "GMTIntervalEnd", "timestamp_mst")}
    keyed = intervals.withColumns(he)
    means = [mean_of(c, decimals).cast(measure).alias(c) for c in PRICE_COLS]
    keys = [*HOUR_ENDING_COLS, *LOCATION_COLS]
    if method == "per_file":
        out = keyed.groupBy(*keys, STAMP, SOURCE, *_version(keyed)).agg(*means, F.count(F.lit(1)).alias(INTERVALS))
    elif method == "mean":
        newest = F.max(F.struct(STAMP, SOURCE)).alias("newest")
        out = keyed.groupBy(*keys).agg(*means, newest).select(
            *keys, *PRICE_COLS, f"newest.{STAMP}", f"newest.{SOURCE}"
        )
    else:
        raise ValueError(f"method must be per_file or mean, got {method!r}")
    counts = [INTERVALS] if with_counts and INTERVALS in out.columns else []
    return out.select(*keys, *PRICE_COLS, STAMP, SOURCE, *_version(out), *counts)


def table_rows(bronze: DataFrame, method: str = "per_file", measure: str = "float") -> DataFrame:
    """Bronze rows as the consolidated table takes them.

    ``per_file``: as they are. ``mean``: the mean of an hour over the latest version of all its
    files, each with the number of its intervals as weight, and the newest file's provenance.
    """
    if INTERVALS not in bronze.columns or method == "per_file":
        return bronze.drop(INTERVALS)
    keys = [*HOUR_ENDING_COLS, *LOCATION_COLS]
    version = _version(bronze)
    rest = [*PRICE_COLS, STAMP, INTERVALS, *version]
    latest = bronze.groupBy(*keys, SOURCE).agg(F.max_by(F.struct(*rest), F.struct(*version, STAMP)).alias("row")).select(*keys, SOURCE, "row.*")
    weighed = lambda c: F.sum(F.col(c).cast("double") * F.col(INTERVALS)) / F.sum(F.when(F.col(c).isNotNull(), F.col(INTERVALS)))
    newest = F.max(F.struct(STAMP, SOURCE, *version)).alias("newest")
    return latest.groupBy(*keys).agg(*[weighed(c).cast(measure).alias(c) for c in PRICE_COLS], newest).select(
        *keys, *PRICE_COLS, *[f"newest.{c}" for c in (STAMP, SOURCE, *version)]
    )


def bronze_path(base: str, feed: str | Feed) -> str:
    return f"{base.rstrip('/')}/bronze/{get_feed(feed).category}"


def write_bronze(df: DataFrame, base: str, feed: str | Feed) -> None:
    """Append to the feed's bronze folder, partitioned by the date of the file stamp.

    The rebalance hint lets adaptive execution split a date that holds most rows
    and join small ones, so file sizes stay even.
    """
    dated = df.withColumn("file_date", F.to_date(STAMP))
    dated.hint("rebalance", "file_date").write.mode("append").partitionBy("file_date").parquet(
        bronze_path(base, feed)
    )


def dated(bronze: DataFrame, first, last) -> DataFrame:
    """Bronze rows of files stamped on these dates; other partitions are not listed."""
    return bronze.where(F.col("file_date").between(F.lit(first), F.lit(last)))


def read_bronze(spark: SparkSession, base: str, *feeds: str | Feed) -> DataFrame:
    """All vintages of one or more feeds of the same target."""
    parts = [spark.read.parquet(bronze_path(base, f)).drop("file_date") for f in feeds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def only_new_files(raw: DataFrame, bronze: DataFrame) -> DataFrame:
    """Rows of files, or versions of files, that bronze does not hold yet, so that a repeated run adds nothing."""
    on = [SOURCE, *[c for c in (MODIFIED,) if c in raw.columns and c in bronze.columns]]
    return missing(raw, bronze.select(*on).distinct(), on=on)


# --- verdicts on files -----------------------------------------------------------

VERDICTS = "verdicts"
REJECTED = "rejected"


def log_path(base: str, log: str, feed: str | Feed) -> str:
    return f"{base.rstrip('/')}/{log}/{get_feed(feed).category}"


def split_files(lines: DataFrame, feed: str | Feed) -> tuple[DataFrame, DataFrame]:
    """(rows of files with a fitting header, the set-aside files as rejected rows with reason ``header``)."""
    feed = get_feed(feed)
    faults = header_faults(lines, feed)
    rows = lines.where(~is_header(feed)).join(faults.select(SOURCE, MODIFIED), [SOURCE, MODIFIED], "left_anti")
    texts = [F.lit(None).cast("string").alias(f"{n}_text") for n in (*feed.times, *feed.measures)]
    return rows, faults.select(SOURCE, MODIFIED, F.lit("header").alias("reason"), F.col("line").alias("_corrupt_record"), *texts)


def verdicts(lines: DataFrame, rows: DataFrame, rejected: DataFrame, feed: str | Feed, stamp_hour: int = 0) -> DataFrame:
    """One row a file version: what became of it, and how many stored and rejected rows it has.

    ``rows``: it has rows that are stored; ``header``: its header does not fit; ``no rows``: nothing of it could be stored.
    """
    on = [SOURCE, MODIFIED]
    stored = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = rejected.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rejected"), F.max(F.col("reason") == "header").alias("_header"))
    out = lines.select(*on).distinct().join(stored, on, "left").join(bad, on, "left")
    verdict = F.when(F.col("_header"), "header").when(F.col("n_rows") > 0, "rows").otherwise("no rows")
    return out.select(
        *on, verdict.alias("verdict"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_rejected")],
        F.to_date(file_stamp(SOURCE, get_feed(feed), stamp_hour)).alias("file_date"),
    )


def append_once(df: DataFrame, path: str, held: DataFrame | None) -> None:
    """Append rows of file versions that the log does not have yet, by the date of the file's stamp.

    The append is committed as a whole, so a run that is repeated adds nothing.
    """
    fresh = df if held is None else missing(df, held.select(SOURCE, MODIFIED).distinct(), on=[SOURCE, MODIFIED])
    fresh.write.mode("append").partitionBy("file_date").parquet(path)


def file_report(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Manifest rows with a flag telling whether the file has landed with valid rows."""
    names = processed.select(file_name(SOURCE).alias("file")).distinct().withColumn("landed", F.lit(True))
    return (
        manifest.withColumn("file", file_name(SOURCE))
        .join(names, on="file", how="left")
        .withColumn("landed", F.coalesce("landed", F.lit(False)))
    )
