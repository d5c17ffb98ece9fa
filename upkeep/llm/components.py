"""Connected components of a link table, by large-star and small-star steps.

Every step is a grouped minimum and a join. A hub with very many links is summed before the shuffle,
and as minima are stored before they are joined, adaptive execution can split its rows in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import stored
from upkeep.workspace import discard


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: (node, root), without the roots themselves.

    ``links`` has two long columns, ``u`` and ``v``; loops and repeated links do no harm.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links, before = stored(links, "links"), None
    while True:
        after = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if after == before or after[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        moved = stored(_large_star(links), "links")
        moved = stored(_small_star(moved), "links")
        discard(links)
        links, before = moved, after
