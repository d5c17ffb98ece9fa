"""Matrix build: feature rows per asset and day, and their labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.defaults import FEATURES, HORIZON_DAYS, KINDS, SCALE, SUBSYSTEM
from upkeep.functions.columns import rounded
from upkeep.functions.keys import as_date, request_date
from upkeep.operators.daily import (
    daily_means,
    daily_readings,
    join_utilization,
    keep_keys,
    missing_keys,
)
from upkeep.operators.labels import label_by_day, label_by_interval, qualifying


def request_keys(requests: DataFrame) -> DataFrame:
    """The distinct keys of a request table. Text that is no ISO date gives a null date."""
    is_text = isinstance(requests.schema["date"].dataType, T.StringType)
    day = request_date(F.col("date")) if is_text else F.to_date("date")
    return requests.select("aircraftid", day.alias("date")).distinct()


def build_features(
    readings: DataFrame,
    utilization: DataFrame,
    *,
    aircraftid: object | None = None,
    date: str | Date | None = None,
    requests: DataFrame | None = None,
    scale: int = SCALE,
) -> DataFrame:
    """Unlabelled rows: all, those of one asset and day, or those of a request table.

    Features are rounded here, once per asset-day, and not after labelling has repeated rows.
    """
    if (aircraftid is None) != (date is None):
        raise ValueError("give both aircraftid and date, or neither")
    if aircraftid is not None and requests is not None:
        raise ValueError("give one asset and day, or a request table, not both")

    if aircraftid is not None:
        day = F.lit(as_date(date))
        readings = daily_readings(readings).where(
            (F.col("date") == day) & (F.col("aircraftid") == F.lit(aircraftid))
        )
        utilization = utilization.where(
            (F.col("timeid") == day) & (F.col("aircraftid") == F.lit(aircraftid))
        )

    means = daily_means(readings)
    if requests is not None:
        keys = request_keys(requests)
        means = keep_keys(means, keys)
        used_keys = keys.withColumnRenamed("date", "timeid")
        utilization = utilization.join(used_keys, ["aircraftid", "timeid"], "left_semi")

    return rounded(join_utilization(means, utilization), FEATURES, scale)


def unmatched_requests(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Requested keys for which no feature row exists."""
    return missing_keys(request_keys(requests), features)


def build_matrix(
    readings: DataFrame,
    utilization: DataFrame,
    interruptions: DataFrame,
    *,
    subsystem: int | str = SUBSYSTEM,
    kinds: Sequence[str] = KINDS,
    horizon: int = HORIZON_DAYS,
    dedupe: bool = False,
    by_interval: bool = False,
    scale: int = SCALE,
) -> DataFrame:
    """Labelled rows, one per asset-day and matching interruption; with ``dedupe`` one per asset-day.

    ``by_interval`` joins on the interval and not day by day, for long horizons.
    """
    events = qualifying(interruptions, subsystem, kinds)
    label = label_by_interval if by_interval else label_by_day

    def with_utilization(labelled: DataFrame, *kept: str) -> DataFrame:
        return rounded(join_utilization(labelled, utilization, *kept, apart=True), FEATURES, scale)

    return label(daily_means(readings), events, horizon=horizon, dedupe=dedupe, complete=with_utilization)
