"""Labels: does a qualifying interruption start within the days ahead?

An asset-day is repeated once per matching interruption. Joined as they come, all interruptions
of a busy asset would meet in one task. Both joins here therefore count interruptions per key
before they shuffle, join on a key finer than the asset, and repeat rows afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.defaults import HORIZON_DAYS, KINDS, LABEL, SUBSYSTEM
from upkeep.functions.columns import code_equals, lead_days, within_horizon
from upkeep.operators.daily import JOIN_KEYS

# Copies of one row that a task emits in a row; more are spread over tasks.
BLOCK = 100_000
# Adds columns to labelled rows and keeps the named ones: (rows, *names) to rows.
Completion = Callable[..., DataFrame]


def qualifying(
    interruptions: DataFrame, subsystem: int | str = SUBSYSTEM, kinds: Sequence[str] = KINDS
) -> DataFrame:
    """Interruptions that count, with their start cut to its day."""
    return interruptions.where(
        code_equals(interruptions, "subsystem", subsystem) & F.col("kind").isin(list(kinds))
    ).withColumn("starttime", F.to_date("starttime"))


def counts_by_start(interruptions: DataFrame) -> DataFrame:
    """Interruptions per asset and start day."""
    return (
        interruptions.where(F.col("starttime").isNotNull())
        .groupBy(F.col("aircraftregistration").alias("aircraftid"), "starttime")
        .agg(F.count(F.lit(1)).alias("matches"))
    )


def counts_by_day(interruptions: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Interruptions per asset and each day from which they lie within the horizon."""
    first = F.date_sub("starttime", horizon - 1)
    return (
        interruptions.where(F.col("starttime").isNotNull())
        .select(
            F.col("aircraftregistration").alias("aircraftid"),
            F.explode(F.sequence(first, F.col("starttime"))).alias("date"),
        )
        .groupBy(*JOIN_KEYS)
        .agg(F.count(F.lit(1)).alias("matches"))
    )


def _bucket(day: str, horizon: int) -> Column:
    """Never null: a row without a day fails the interval anyway, and a null test on the bucket
    would give the two uses of the rows in ``label_by_interval`` different plans to compute."""
    return F.coalesce(F.floor(F.unix_date(day) / F.lit(horizon)).cast("int"), F.lit(0))


def interval_join(
    rows: DataFrame,
    starts: DataFrame,
    horizon: int = HORIZON_DAYS,
    how: str = "left",
) -> DataFrame:
    """Rows with the ``starts`` (counts by start day) that lie within the horizon.

    Days are cut into buckets as long as the horizon. A row's window then touches its own bucket
    and the next, so a start day is entered under its bucket and the one before, and asset plus
    bucket becomes an equality key; the exact interval stays as a condition. A row meets at most
    ``2 * horizon`` start days, and every pair is met once, in the row's bucket.
    """
    entered = starts.select(
        F.col("aircraftid").alias("start_aircraftid"),
        "starttime",
        "matches",
        F.explode(F.array(_bucket("starttime", horizon), _bucket("starttime", horizon) - 1)).alias(
            "start_bucket"
        ),
    )
    bucketed = rows.withColumn("bucket", _bucket("date", horizon))
    condition = (
        (F.col("aircraftid") == F.col("start_aircraftid"))
        & (F.col("bucket") == F.col("start_bucket"))
        & within_horizon(F.col("starttime"), F.col("date"), horizon)
    )
    kept = [] if how in ("left_semi", "left_anti") else ["starttime", "matches"]
    return bucketed.join(entered, condition, how).select(*rows.columns, *kept)


def lead_day_counts(
    rows: DataFrame, interruptions: DataFrame, horizon: int = HORIZON_DAYS
) -> DataFrame:
    """Matched pairs by the number of days between row and interruption."""
    pairs = interval_join(rows, counts_by_start(interruptions), horizon, "inner")
    return (
        pairs.groupBy(lead_days(F.col("starttime"), F.col("date")).alias("lead_days"))
        .agg(F.sum("matches").alias("pairs"))
    )


def _label() -> Column:
    return F.col("matches").isNotNull().cast("int").alias(LABEL)


def _copy(count: Column) -> Column:
    """Repeats a row ``count`` times; the array behind it never exceeds one block."""
    return F.explode(F.array_repeat(F.lit(0), count.cast("int"))).alias("copy")


def _first_block(joined: DataFrame, columns: Sequence[str], block: int) -> DataFrame:
    """Every row, labelled, with its copies up to one block."""
    count = F.least(F.coalesce(F.col("matches"), F.lit(1)), F.lit(block))
    return joined.select(*columns, _label(), _copy(count))


def _further_blocks(joined: DataFrame, columns: Sequence[str], block: int) -> DataFrame:
    """The copies beyond the first block, in as many tasks as there are blocks."""
    tasks = int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = [c for c in (*JOIN_KEYS, "starttime") if c in columns]
    last = F.floor((F.col("matches") - 1) / block)
    blocks = joined.select(
        *columns, "matches", F.explode(F.sequence(F.lit(1).cast("bigint"), last)).alias("block")
    )
    count = F.least(F.col("matches") - F.col("block") * block, F.lit(block))
    return blocks.repartition(tasks, *spread, "block").select(*columns, _label(), _copy(count))


def label_by_interval(
    rows: DataFrame,
    interruptions: DataFrame,
    *,
    horizon: int = HORIZON_DAYS,
    dedupe: bool = False,
    block: int = BLOCK,
    complete: Completion | None = None,
) -> DataFrame:
    """Label rows through the interval join; suits horizons too long to write out day by day.

    ``complete`` adds columns after that join, see ``label_by_day``.

    Start days with more matches than a block go a second way, see ``label_by_day``. With
    ``dedupe`` a row stays one row however many interruptions match.
    """
    starts = counts_by_start(interruptions)
    complete = complete or (lambda df, *kept: df)
    if dedupe:
        parts = (("left_semi", 1), ("left_anti", 0))
        due, clear = (
            interval_join(rows, starts, horizon, how).withColumn(LABEL, F.lit(label)) for how, label in parts
        )
        return complete(due.unionByName(clear), LABEL)
    heavy = starts.where(F.col("matches") > block).hint("rebalance")
    kept = ("starttime", "matches")
    joined = complete(interval_join(rows, starts, horizon), *kept)
    columns = [c for c in joined.columns if c != "matches"]
    first = _first_block(joined, columns, block)
    further = _further_blocks(complete(interval_join(rows, heavy, horizon, "inner"), *kept), columns, block)
    return first.unionByName(further).select(*[c for c in columns if c != "starttime"], LABEL)


def label_by_day(
    rows: DataFrame,
    interruptions: DataFrame,
    *,
    horizon: int = HORIZON_DAYS,
    dedupe: bool = False,
    block: int = BLOCK,
    complete: Completion | None = None,
) -> DataFrame:
    """Label rows through an equality join on asset and day.

    ``complete`` adds columns to the rows after the join and has to keep those it is given. A join
    that repeats a key belongs there: before it, both sides of the label join hold one row per
    key, so that no key is one task's burden.

    Interruptions are written out to the days of their window and counted there. The rows already
    lie partitioned by asset and day, so only these counts are shuffled. With ``dedupe`` a row
    stays one row however many interruptions match.

    Days with more matches than a block go a second way. They are a stage of their own, so
    adaptive execution knows their number before it runs the join: it broadcasts a few, and drops
    the whole branch where there are none.
    """
    matches = counts_by_day(interruptions, horizon)
    complete = complete or (lambda df, *kept: df)
    joined = complete(rows.join(matches, list(JOIN_KEYS), "left"), "matches")
    columns = [c for c in joined.columns if c != "matches"]
    if dedupe:
        return joined.select(*columns, _label())
    heavy = matches.where(F.col("matches") > block).hint("rebalance")
    first = _first_block(joined, columns, block)
    further = _further_blocks(complete(rows.join(heavy, list(JOIN_KEYS), "inner"), "matches"), columns, block)
    return first.unionByName(further).select(*columns, LABEL)
