"""Sharding by sampled splitters: near equal bytes in every shard, equal texts together.

Records are ordered by the hash of their text. Size-weighted samples of that order give quantile
boundaries, which cut the records into many ranges of similar weight; consecutive ranges fill the
shards up to the byte. A group of equal texts that is heavy beside a shard stands out in the
samples. Such groups are placed first, largest onto the emptiest shard; the ranges fill what is
left. Groups above a shard's share are subdivided by record.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import documents, local_rows, stored

LAW = "bytes"
#: Bytes that a record counts beside its text.
RECORD_BYTES = 16
#: Ranges for each shard, and samples for each range. Both bound what the driver holds.
RANGES, SAMPLES = 64, 8
#: A group of equal texts above 1/HEAVY of a shard is placed by itself.
HEAVY = 50
#: A range above so many times the mean is subdivided.
OVERFULL = 4


def sample_keys(records: DataFrame, step: float) -> list[tuple]:
    """Keys of sampled records, in order; a record of ``size`` bytes is drawn size/step times on average."""
    chance = (F.xxhash64("salt", F.lit(8)).bitwiseAND(0xFFFFF) + 0.5) / 0x100000
    drawn = records.withColumn("drawn", F.floor(F.col("size") / step + chance).cast("int")).where("drawn > 0")
    rows = drawn.select("group_key", "id_key", "salt", "drawn").collect()
    return sorted((r[0], r[1], r[2]) for r in rows for _ in range(r[3]))


def splitters(samples: list[tuple], ranges: int) -> list[tuple]:
    """Quantiles of the samples. A boundary inside a group moves to its start unless the group fills ranges."""
    every = max(1, len(samples) // ranges)
    picked, found = samples[every::every], []
    for i, key in enumerate(picked):
        spans = i > 0 and picked[i - 1][0] == key[0]
        found.append(key if spans else (key[0], -(1 << 63), -(1 << 63)))
    return sorted(set(found))


def placed_groups(pieces: list[tuple], shards: int) -> tuple[list[tuple], list[float]]:
    """(group, piece, shard) rows, largest piece first onto the emptiest shard, and the bytes on each shard."""
    load, rows = [0.0] * shards, []
    for group, part, size in sorted(pieces, key=lambda x: (-x[2], x[0], x[1])):
        shard = min(range(shards), key=lambda s: (load[s], s))
        load[shard] += size
        rows.append((group, part, shard))
    return rows, load


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into a shard, so that the shards' bytes are near equal.

    Returns doc_id, size (UTF-8 bytes of the text and 16 more), text_crc32, law, shard, slot
    (0, 1, 2, ... in each shard) and grown_shard (null: this law moves records when shards are
    added). Equal texts share a shard unless their bytes exceed a shard's share.

    A null text has no bytes; a null id is kept and sorts first. Repeated rows are separate
    records. An empty table gives no rows. Other columns are ignored, whatever their names.

    What reaches the driver is bounded by parameters: about ``shards * RANGES * SAMPLES`` sampled
    keys, sizes of the ranges, and at most ``shards * HEAVY`` heavy groups.
    """
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + RECORD_BYTES).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.xxhash64("text").alias("group_key"),
        F.xxhash64("doc_id").alias("id_key"),
        F.monotonically_increasing_id().alias("salt"),
    )
    records = stored(rows, "shard-records")  # from here on a record's salt stays what it is
    total = records.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / shards)

    # Groups that are heavy beside a shard: no more than shards * HEAVY of them exist.
    groups = records.groupBy("group_key").agg(F.sum("size").alias("bytes"))
    heavy = groups.where(F.col("bytes") > share / HEAVY).collect()
    parts = [(r[0], 1 if r[1] <= share else -(-4 * r[1] // int(share))) for r in heavy]
    parts = F.broadcast(local_rows(spark, parts, "group_key long, parts long"))
    tagged = records.join(parts, "group_key", "left")
    single = tagged.where("parts is not null")
    single = single.withColumn("part", F.pmod(F.xxhash64("id_key", "salt"), F.col("parts")).cast("int"))
    pieces = single.groupBy("group_key", "part").agg(F.sum("size")).collect()
    placed, load = placed_groups(pieces, shards)

    # The rest: ranges between sampled splitters, in the order of their keys. They start where a
    # group starts, and are cut between groups only, so that a group has one middle.
    light = tagged.where("parts is null")
    ranges = shards * RANGES
    step = max(1.0, (total - sum(r[1] for r in heavy)) / (ranges * SAMPLES))
    bounds = np.unique(np.array([key[0] for key in splitters(sample_keys(light, step), ranges)], np.int64))

    @F.pandas_udf("int")
    def range_of(group: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, group.to_numpy(), "right").astype(np.int32))

    light = light.withColumn("cell", range_of("group_key"))
    filled = stored(light.drop("parts"), "shard-ranges")
    sums = {r[0]: r[1] for r in filled.groupBy("cell").agg(F.sum("size")).collect()}
    mean = sum(sums.values()) / max(1, len(sums))
    over = [(c, -(-b // int(mean))) for c, b in sums.items() if b > OVERFULL * mean]
    cuts = F.broadcast(local_rows(spark, over, "cell int, cuts long"))
    part = F.pmod(F.xxhash64("group_key"), F.coalesce("cuts", F.lit(1))).cast("int")
    filled = filled.join(cuts, "cell", "left").withColumn("part", part).drop("cuts")
    start, starts = 0, []
    for r in sorted(filled.groupBy("cell", "part").agg(F.sum("size")).collect()):
        starts.append((r[0], r[1], start))
        start += r[2]
    starts = F.broadcast(local_rows(spark, starts, "cell int, part int, before long"))

    # A group lies where its middle lies; the shards' free bytes cut the line.
    free = [max(0.0, share - x) for x in load]
    scale, ends, at = (start / sum(free)) if sum(free) else 1.0, [], 0.0
    for x in free[:-1]:
        at += x * scale
        ends.append(at)
    ends = np.array(ends, float)
    order = Window.partitionBy("cell", "part").orderBy("group_key")
    upto = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, 0))
    own = F.sum("size").over(Window.partitionBy("cell", "part", "group_key"))
    middle = F.col("before") + F.col("upto") - F.col("own") / 2

    @F.pandas_udf("int")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, place.to_numpy(), "right").astype(np.int32))

    light = (
        filled.withColumns({"upto": upto, "own": own})
        .join(starts, ["cell", "part"])
        .withColumn("shard", shard_of(middle))
        .select("doc_id", "size", "text_crc32", "group_key", "id_key", "salt", "cell", "part", "shard")
    )
    where = F.broadcast(local_rows(spark, placed, "group_key long, part int, shard int"))
    single = single.join(where, ["group_key", "part"])
    # Heavy groups: cells after all ranges, 64 parts each so that no part is one task's burden.
    spread = F.pmod(F.xxhash64("salt"), F.lit(64)).cast("int")
    single = single.select(
        *light.columns[:6], F.lit(ranges + 1).alias("cell"), (F.col("part") * 64 + spread).alias("part"), "shard"
    )
    chosen = stored(light.unionByName(single), "shard-chosen")

    # Slots: the number of a record in its piece, after the pieces before it in the shard.
    piece = ["shard", "cell", "part"]
    counts = chosen.groupBy(*piece).count()
    first = F.sum("count").over(Window.partitionBy("shard").orderBy("cell", "part")) - F.col("count")
    first = F.broadcast(counts.select(*piece, first.alias("first")))
    number = F.row_number().over(Window.partitionBy(*piece).orderBy("group_key", "id_key", "salt"))
    return (
        chosen.withColumn("number", number)
        .join(first, piece)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            "shard",
            (F.col("first") + F.col("number") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
