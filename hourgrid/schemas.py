"""Feed specifications and table keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from hourgrid.functions.timeutil import FEED_TIME_FORMAT


@dataclass(frozen=True)
class Feed:
    """How one kind of landed CSV file is named, read and normalised."""

    name: str
    category: str                       # bronze folder
    target: str                         # consolidated table it feeds
    frequency: str                      # step of its request manifest: D, h or 5min
    path: str                           # source path; {prefix} is the market's file prefix
    file_tag: str                       # file-name part that marks the feed
    header: tuple[str, ...]             # CSV columns in order, names normalised
    renames: dict[str, str] = field(default_factory=dict)
    measures: tuple[str, ...] = ()
    times: tuple[str, ...] = ("Interval", "GMTIntervalEnd")
    time_format: str = FEED_TIME_FORMAT
    hourly: bool = False                # aggregate 5-minute rows to hour ending
    stamp_format: str = "yyyyMMddHHmm"  # digits at the end of the file name

    def csv_schema(self) -> T.StructType:
        """All text, parsed afterwards, plus a column for rows that do not fit."""
        names = [*self.header, "_corrupt_record"]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


# File-name tags, path layouts and CSV headers of the five feeds.
FEEDS: dict[str, Feed] = {
    feed.name: feed
    for feed in [
        Feed(
            name="load_forecast", category="mtlf", target="mtlf", frequency="h",
            path="path=%2F{YEAR}%2F{MONTH}%2F{DAY}%2F{prefix}-OP-MTLF-{COMBINED}.csv",
            file_tag="OP-MTLF-",
            header=("Interval", "GMTIntervalEnd", "MTLF", "Averaged_Actual"),
            measures=("MTLF", "Averaged_Actual"),
        ),
        Feed(
            name="renewable_forecast", category="mtrf", target="mtrf", frequency="h",
            path="path=%2F{YEAR}%2F{MONTH}%2F{DAY}%2F{prefix}-OP-MTRF-{COMBINED}.csv",
            file_tag="OP-MTRF-",
            header=("Interval", "GMTIntervalEnd", "Wind_Forecast_MW", "Solar_Forecast_MW"),
            measures=("Wind_Forecast_MW", "Solar_Forecast_MW"),
        ),
        Feed(
            name="price_5min", category="lmp_5min", target="lmp", frequency="5min",
            path="path=%2F{YEAR}%2F{MONTH}%2FBy_Interval%2F{DAY}%2F{prefix}-RTBM-LMP-SL-{COMBINED}.csv",
            file_tag="RTBM-LMP-SL-",
            header=("Interval", "GMTIntervalEnd", "Settlement_Location", "Pnode", "LMP", "MLC", "MCC", "MEC"),
            renames={"Settlement_Location": "Settlement_Location_Name", "Pnode": "PNODE_Name"},
            measures=("LMP", "MLC", "MCC", "MEC"), hourly=True,
        ),
        Feed(
            name="price_daily", category="lmp_daily", target="lmp", frequency="D",
            path="path=%2F{YEAR}%2F{MONTH}%2FBy_Day%2F{prefix}-RTBM-LMP-DAILY-SL-{YMD}.csv",
            file_tag="RTBM-LMP-DAILY-SL-",
            header=("Interval", "GMT_Interval", "Settlement_Location_Name", "PNODE_Name", "LMP", "MLC", "MCC", "MEC"),
            renames={"GMT_Interval": "GMTIntervalEnd"},
            measures=("LMP", "MLC", "MCC", "MEC"), hourly=True, stamp_format="yyyyMMdd",
        ),
        Feed(
            name="generation_by_fuel", category="gen_cap", target="gen_cap", frequency="D",
            path="path=%2F{YEAR}%2F{MONTH}%2F{prefix}-HRLY-GEN-CAP-BY-FUEL-TYPE-{YMD}.csv",
            file_tag="HRLY-GEN-CAP-BY-FUEL-TYPE-",
            header=("GMT_TIME", "Coal_Market", "Coal_Self", "Hydro", "Natural_Gas", "Nuclear", "Solar", "Wind"),
            renames={"GMT_TIME": "GMTIntervalEnd"},
            measures=("Coal_Market", "Coal_Self", "Hydro", "Natural_Gas", "Nuclear", "Solar", "Wind"),
            times=("GMTIntervalEnd",), time_format="iso", stamp_format="yyyyMMdd",
        ),
    ]
}

HOUR_ENDING_COLS = ["Interval_HE", "GMTIntervalEnd_HE", "timestamp_mst_HE"]
LOCATION_COLS = ["Settlement_Location_Name", "PNODE_Name"]
PRICE_COLS = ["LMP", "MLC", "MCC", "MEC"]
STAMP = "file_create_time_utc"
SOURCE = "url"
MODIFIED = "file_modified"      # when the landed file was last written: tells a revised file of the same name
INTERVALS = "n_intervals"       # rows behind an hourly price of a file

TABLE_KEYS: dict[str, list[str]] = {
    "mtlf": ["GMTIntervalEnd"],
    "mtrf": ["GMTIntervalEnd"],
    "lmp": ["GMTIntervalEnd_HE", *LOCATION_COLS],
    "gen_cap": ["GMTIntervalEnd"],
}


def table_keys(target: str) -> list[str]:
    """Key columns of a consolidated table."""
    if target not in TABLE_KEYS:
        raise ValueError(f"target must be one of {sorted(TABLE_KEYS)}, got {target!r}")
    return TABLE_KEYS[target]
