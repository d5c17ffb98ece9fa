"""Readings to one mean per asset and day, and the join with utilization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES, KEYS

# Grouping and join order. A sort compares the first key by a machine word and further keys only
# among equals, so the asset comes first: there are many more assets than days.
JOIN_KEYS = ("aircraftid", "date")


def daily_readings(readings: DataFrame) -> DataFrame:
    """Readings with the timestamp cut to its day. The reading's own day counts, not its file's."""
    return readings.withColumn("date", F.to_date("date"))


def daily_means(readings: DataFrame) -> DataFrame:
    """Mean value per day and asset.

    Partial means are formed before the shuffle, so each task ships one row per key it has seen,
    however many readings a single asset or day contributes.
    """
    return daily_readings(readings).groupBy(*JOIN_KEYS).agg(F.mean("value").alias("sensor_mean_value"))


def join_utilization(means: DataFrame, utilization: DataFrame, *extra: str, apart: bool = False) -> DataFrame:
    """Inner join on day and asset; asset-days missing on either side drop out.

    The means already lie partitioned by the join keys, so only utilization is shuffled here.
    Where they come out of another join, adaptive execution cannot split a key that utilization
    repeats; ``apart`` adds the day's number to the keys, so that both sides are shuffled for this
    join alone and it can. ``extra`` columns of the means are kept.
    """
    used = utilization.select(
        F.col("timeid").alias("date"), "aircraftid", "flighthours", "delayedminutes", "flightcycles"
    )
    keys = list(JOIN_KEYS)
    if apart:
        number = F.unix_date(F.to_date("date"))
        means, used, keys = means.withColumn("day", number), used.withColumn("day", number), [*keys, "day"]
    return means.join(used, keys, "inner").select(*KEYS, *FEATURES, *extra)


def keep_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose day and asset occur in ``keys``, each once."""
    return df.join(keys, list(JOIN_KEYS), "left_semi")


def missing_keys(keys: DataFrame, df: DataFrame) -> DataFrame:
    """Keys without a row in ``df``."""
    return keys.join(df, list(JOIN_KEYS), "left_anti")
