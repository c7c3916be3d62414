"""As-of lookup: the latest vintage known at a given moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def vintage_as_of(
    requests: DataFrame,
    vintages: DataFrame,
    keys: Sequence[str],
    at: str,
    stamp: str,
    values: Sequence[str],
) -> DataFrame:
    """For each request (keys, at): ``values`` of the newest vintage with stamp <= at.

    Vintages and requests are merged in time order, so no pair of them is formed.
    The order runs within a calendar day; the newest vintage of earlier days comes
    from a table with one row per key and day, so a busy key is split by days.

    Every request comes out; one without a moment, with a null key or before the first vintage has a
    null vintage. Of vintages with the same stamp the one with the greatest values counts.
    """
    keys = list(keys)
    held = F.struct(F.col(stamp).alias("vintage"), *values)
    asked = requests.select(
        *keys, F.col(at).alias("_t"), F.to_date(at).alias("_day"), F.lit(1).alias("_ask"), F.lit(None).alias("_row")
    )
    usable = F.col(stamp).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    known = vintages.where(usable).select(
        *keys, F.col(stamp).alias("_t"), F.to_date(stamp).alias("_day"), F.lit(0).alias("_ask"), held.alias("_row")
    )
    asked = asked.withColumn("_row", F.col("_row").cast(known.schema["_row"].dataType))
    within = Window.partitionBy(*keys, "_day").orderBy("_t", "_ask", "_row").rowsBetween(Window.unboundedPreceding, 0)
    same_day = known.unionByName(asked).withColumn("_same", F.last("_row", ignorenulls=True).over(within)).where("_ask = 1")

    daily = known.groupBy(*keys, "_day").agg(F.max_by("_row", F.struct("_t", "_row")).alias("_row"))
    days = daily.unionByName(
        asked.select(*keys, "_day").distinct().withColumn("_row", F.lit(None).cast(known.schema["_row"].dataType))
    )
    merged = days.groupBy(*keys, "_day").agg(F.first("_row", ignorenulls=True).alias("_row"))
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = merged.select(*keys, "_day", F.last("_row", ignorenulls=True).over(before).alias("_earlier"))
    out = same_day.drop("_row").join(carried, [*keys, "_day"], "left")
    row = F.coalesce("_same", "_earlier")
    return out.select(*keys, F.col("_t").alias(at), row["vintage"].alias("vintage"), *[row[v].alias(v) for v in values])
