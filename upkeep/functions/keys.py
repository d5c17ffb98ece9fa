"""Key columns: asset ids from file paths, request dates, stable buckets."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix of a CSV file, and the length of the asset id before it.
SUFFIX = ".csv"
ASSET_ID_LENGTH = 6


def asset_from_path(path: Column, length: int = ASSET_ID_LENGTH) -> Column:
    """Last characters of the base name, e.g. ``XY-ABC`` of ``.../010124-AAA-BBB-0001-XY-ABC.csv``.

    A file may also be a folder of parts, as Spark writes it: ``...-XY-ABC.csv/part-0.csv``. No
    regular expression runs per row.
    """
    name, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    base = F.when(name.startswith("part-") & folder.endswith(SUFFIX), folder).otherwise(name)
    return F.substring(base, -(length + len(SUFFIX)), length)


def as_date(value: str | date | datetime) -> date:
    """A request date. Only ISO text is accepted: Spark would read ``010124`` as the year 10124."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value, "%Y-%m-%d").date()


def request_date(column: Column) -> Column:
    """The same for a text column: null for anything but ISO dates."""
    return F.try_to_date(column, "yyyy-MM-dd")


def key_bucket(buckets: int, *columns: str, salt: str = "") -> Column:
    """Bucket of a key, equal on every run, partitioning and engine, whatever the key types."""
    text = F.concat_ws("|", F.lit(salt), *[F.col(c).cast("string") for c in columns])
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")
