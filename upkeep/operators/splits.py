"""Train and validation splits, and folds. None depends on how rows lie in partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.defaults import KEYS, SEED, SPLIT
from upkeep.functions.keys import key_bucket

# Buckets of a row split: shares are exact to one in so many.
BUCKETS = 10_000
# Copies of one row that a task numbers in a row; more are spread over tasks.
BLOCK = 100_000


def numbered_rows(df: DataFrame, column: str = "copy", block: int = BLOCK) -> DataFrame:
    """Rows with a running number among equal ones.

    Equal rows are counted before they are shuffled and repeated afterwards, so that a row with
    very many copies is one row on its way. A task numbers ``block`` copies of a row at once;
    further blocks go a second way, in which each is a row of its own that any task may take.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(column))
    n, one = F.col(column), F.lit(1).cast("bigint")
    numbered = lambda first, last: F.explode(F.sequence(first, last))
    first = counted.withColumn(column, numbered(one, F.least(n, F.lit(block).cast("bigint"))))
    number = fresh_name(df, "block")
    heavy = counted.where(n > block).hint("rebalance")
    blocks = heavy.withColumn(number, numbered(one, F.floor((n - 1) / block)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(tasks, *[c for c in df.columns], number)
    low = F.col(number) * block
    further = blocks.withColumn(column, numbered(low + 1, F.least(n, low + block))).drop(number)
    return first.unionByName(further)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _text(df: DataFrame, column: str) -> Column:
    """The value as text that every engine writes alike: fractions with six decimals."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(column).try_cast("decimal(38,6)").cast("string")
    return F.col(column).cast("string")


def row_bucket(df: DataFrame, buckets: int, salt: str, copy: str = "copy") -> Column:
    """Bucket of a row: hashed from all its values and its number among equal rows."""
    columns = [*[c for c in df.columns if c != copy], copy]
    texts = [F.coalesce(_text(df, c), F.lit("")) for c in columns]
    head = F.md5(F.concat_ws("|", F.lit(salt), *texts).cast("binary"))
    return (F.conv(F.substring(head, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def split_rows(
    df: DataFrame, weights: Sequence[float] = SPLIT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded split by row: equal rows are drawn one by one, and each draw depends on the row alone."""
    rows = numbered_rows(df)
    in_train = row_bucket(rows, BUCKETS, f"rows-{seed}") < F.lit(round(BUCKETS * weights[0] / sum(weights)))
    return rows.where(in_train).drop("copy"), rows.where(~in_train).drop("copy")


def with_row_fold(df: DataFrame, folds: int, seed: int = SEED, column: str = "fold") -> DataFrame:
    """Add a cross-validation fold by row."""
    rows = numbered_rows(df)
    return rows.withColumn(column, row_bucket(rows, folds, f"fold-{seed}")).drop("copy")


def split_and_fold(
    df: DataFrame, folds: int, weights: Sequence[float] = SPLIT, seed: int = SEED, part: str = "in_train", fold: str = "fold"
) -> DataFrame:
    """Rows with whether they are drawn for training, and a fold, both from one numbering of equal rows.

    ``in_train`` is the draw of ``split_rows``; the fold is that of ``with_row_fold`` over all rows.
    """
    rows = numbered_rows(df)
    share = F.lit(round(BUCKETS * weights[0] / sum(weights)))
    drawn = (row_bucket(rows, BUCKETS, f"rows-{seed}") < share).alias(part)
    return rows.select(*df.columns, drawn, row_bucket(rows, folds, f"fold-{seed}").alias(fold))


def split_keys(
    df: DataFrame, share: float = SPLIT[0], keys: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    """Split by key, so that copies of one asset-day never lie on both sides."""
    in_train = key_bucket(100, *keys, salt="split") < F.lit(round(share * 100))
    return df.where(in_train), df.where(~in_train)


def with_key_fold(
    df: DataFrame, folds: int, keys: Sequence[str] = KEYS, column: str = "fold"
) -> DataFrame:
    """Add a cross-validation fold that copies of one asset-day share."""
    return df.withColumn(column, key_bucket(folds, *keys, salt="fold"))
