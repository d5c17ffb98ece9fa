"""SimHash near-duplicates through counts of set bits by segment.

A fingerprint is mapped to the number of set bits in each of its 32 two-bit segments. The Manhattan
distance of two such vectors never exceeds the number of differing bits, so it serves as a lower
bound. The vectors are joined on a grid: 32 segments form six blocks, and a distance of 4 can touch
four blocks at most, so that two blocks agree; each of the 15 pairs of blocks is a grid of its
own. Pairs within a cell pass the Manhattan bound first and the exact bit count after it.

Only distinct fingerprints enter the grid. A cell emits a forest over its links, never its pairs.
A cell above ``CELL`` fingerprints is dealt to tasks as pairs of its blocks of rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored
from upkeep.llm.components import components

SHINGLE, SEED = 4, 42
#: Fingerprints in a cell that one task compares at once.
CELL = 2048
#: Pairs that are compared in one step.
STEP_PAIRS = 4_000_000
EVEN = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a UTF-8 text's word shingles; zero if it has no word."""
    import xxhash

    parts = text.lower().split()
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(parts) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        some = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tie (a hash of the text) and fingerprint (long, the same 64 bits signed) of every row."""
    rows = documents(docs, id_col, text_col)
    rows = rows.select("doc_id", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("text"))

    def make(batches):
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], "<u8")
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "tie": batch.column("tie"), "fingerprint": values.view("<i8")}
            )

    return rows.mapInArrow(make, "doc_id long, tie long, fingerprint long")


def segment_counts(bits: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment in unary (00, 01, 11), so that XOR counts Manhattan distance."""
    low, high = bits & EVEN, (bits >> np.uint64(1)) & EVEN
    return (low | high) | ((low & high) << np.uint64(1))


def block_masks(max_bits: int) -> list[int]:
    """Masks over the segment counts. Two vectors within ``max_bits`` agree under one of them at least."""
    blocks = max_bits + 2
    borders = [round(i * 32 / blocks) for i in range(blocks + 1)]
    single = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(borders, borders[1:])]
    return [a | b for a, b in combinations(single, 2)]


def links_in_cells(cell: np.ndarray, bits: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the links within each run of equal ``cell``.

    Rows of a cell that was dealt as two blocks have side 0 and 1; only pairs across are compared there.
    """
    n = len(bits)
    counts = segment_counts(bits)
    label = np.arange(n)
    here, step = np.arange(n - 1), 0
    left, right, held = [], [], 0

    def merge():
        nonlocal left, right, held, label
        a, b = np.concatenate(left), np.concatenate(right)
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jump = label[label]
                if np.array_equal(jump, label):
                    break
                label = jump
        left, right, held = [], [], 0

    while len(here):
        step += 1
        here = here[here + step < n]
        here = here[cell[here] == cell[here + step]]
        near = here[np.bitwise_count(counts[here] ^ counts[here + step]) <= max_bits]
        near = near[np.bitwise_count(bits[near] ^ bits[near + step]) <= max_bits]
        near = near[(side[near] < 0) | (side[near] != side[near + step])]
        left.append(near)
        right.append(near + step)
        held += len(near)
        if held > STEP_PAIRS:
            merge()
    if left:
        merge()
    child = np.flatnonzero(label != np.arange(n))
    return bits[child], bits[label[child]]


def near_links(found: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) whose components are those of all pairs within ``max_bits``; ``found``: distinct fingerprints."""
    masks = block_masks(max_bits)
    low, high = int(EVEN), int(EVEN) << 1
    bits = F.col("fingerprint")
    even, odd = bits.bitwiseAND(low), F.shiftrightunsigned(bits, 1).bitwiseAND(low)
    unary = even.bitwiseOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1).bitwiseAND(F.lit(high - (1 << 64))))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("grid"), F.col("unary").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(signed)])
    cells = found.withColumn("unary", unary).select("fingerprint", F.explode(keys).alias("key")).select("key.*", "fingerprint")

    sizes = cells.groupBy("grid", "cell").count().where("count > 1")
    rows = stored(cells.join(sizes, ["grid", "cell"]), "simhash-cells")
    whole = rows.where(F.col("count") <= CELL).select("grid", "cell", "fingerprint", F.lit(-1).alias("side"))
    # Larger cells: rows fall into blocks, and every pair of blocks is a cell of its own.
    blocks = F.ceil(F.col("count") / (CELL // 2)).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
    large = rows.where(F.col("count") > CELL).withColumns({"blocks": blocks, "own": own})
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    large = large.select("grid", "cell", "fingerprint", "own", other)
    pair = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    large = large.select("grid", pair.alias("cell"), "fingerprint", side.alias("side"))
    dealt = whole.unionByName(large).select(F.xxhash64("grid", "cell").alias("cell"), "fingerprint", "side")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "fingerprint")

    def link(batches):
        kept = None
        for batch in batches:
            table = [np.asarray(batch.column(c)) for c in ("cell", "fingerprint", "side")]
            kept = table if kept is None else [np.concatenate(x) for x in zip(kept, table)]
            ready = int(np.searchsorted(kept[0], kept[0][-1])) if len(kept[0]) else 0
            if ready:
                yield forest([x[:ready] for x in kept])
                kept = [x[ready:] for x in kept]
        if kept is not None and len(kept[0]):
            yield forest(kept)

    def forest(columns):
        u, v = links_in_cells(columns[0], columns[1].view(np.uint64), columns[2], max_bits)
        return pa.record_batch({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.mapInArrow(link, "u long, v long")


def classes(docs: DataFrame, max_bits: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tie, fingerprint, root (a fingerprint that names the component) and component_id of every row."""
    made = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    found = made.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    roots = components(near_links(found.select("fingerprint"), max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = found.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return made.join(rooted.join(least, "root").select("fingerprint", "root", "component_id"), "fingerprint")


def near_duplicates(
    docs: DataFrame, max_bits: int = 4, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row.

    Two rows are linked if their fingerprints differ in ``max_bits`` bits or fewer; component_id
    is the smallest doc_id that a row reaches over links, its own included. Null and empty texts
    have fingerprint zero and are linked like any other. A null doc_id counts for no minimum, so a
    component of null ids only has a null id. Repeated rows stay. An empty table gives no rows.
    Other columns are ignored.
    """
    return classes(docs, max_bits, shingle, id_col, text_col).select("doc_id", "fingerprint", "component_id")


def one_of_each(
    docs: DataFrame, max_bits: int = 4, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null last), then text hash."""
    rows = classes(docs, max_bits, shingle, id_col, text_col)
    rows = rows.groupBy("root", "doc_id", "tie").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "n")).alias("best")
    chosen = stored(rows.groupBy("root").agg(best).select("best.doc_id", "best.tie", "best.n"), "representatives")

    def kept(some: DataFrame) -> DataFrame:
        tie = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
        same = docs[id_col].cast("long").eqNullSafe(some["doc_id"]) & (tie == some["tie"])
        return docs.join(some, same, "left_semi")

    single, repeated = kept(chosen.where("n = 1")), chosen.where("n > 1")
    if repeated.isEmpty():
        return single
    return single.unionByName(kept(repeated).dropDuplicates([id_col, text_col]))
