"""Hierarchical packing of documents into windows of several lengths.

Windows are powers of two, 4096 ids by default and three shorter tiers. A document goes to the
shortest tier that holds it; what exceeds the longest window is cut off in full windows. Each tier
is packed from the longest down: its documents largest first, then documents of shorter tiers
largest first into the gaps that are left, and at last one document is cut so that the window is
full; its rest falls back to the tier that holds it. A full window needs no padding, as its length
is a power of two, and only the last window of a unit of work stays open.

Tasks pack blocks of ids as they encode them, and carry what stays open into the next block.
What a task has left at its end is packed once more, together with what other tasks left.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored
from upkeep.llm.tokens import ChunkEncoder, default_tokenizer

WINDOW, TIERS = 4096, 4
END_ID = 2
#: Ids that a task packs at a time.
BLOCK_IDS = 2_000_000
#: Sequences of a step group.
STEP_SEQUENCES = 64
#: Partitions whose open windows are packed together.
FAN_IN = 64

PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, window int, step_group long"


def plan(lengths: list[int], window: int = WINDOW, tiers: int = TIERS) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Pack pieces of the given lengths.

    Returns the full windows, longest tier first, and the windows that stay open (one at most).
    A window is a list of (piece, start in the piece, length).
    """
    pool: list[tuple[int, int, int]] = []  # (length, piece, start), ascending
    full: list[list[tuple]] = []
    for piece, length in enumerate(lengths):
        whole = length // window * window
        full += [[(piece, at, window)] for at in range(0, whole, window)]
        if length > whole:
            pool.append((length - whole, piece, whole))
    pool.sort()
    left = sum(x[0] for x in pool)
    for tier in range(tiers):
        size = window >> tier
        floor = size // 2 if tier < tiers - 1 else 0  # a tier's own documents are longer than this
        while left >= size and pool[-1][0] > floor:
            free, filled = size, []
            while free:
                at = bisect_right(pool, (free, len(lengths), 0)) - 1
                length, piece, start = pool.pop(at if at >= 0 else 0)
                used = min(length, free)
                filled.append((piece, start, used))
                free -= used
                if length > used:
                    insort(pool, (length - used, piece, start + used))
            full.append(filled)
            left -= size
    rest = [(piece, start, length) for length, piece, start in reversed(pool)]
    return full, [rest] if rest else []


class Packer:
    """Packs blocks of pieces; a piece is [doc_id, start, doc_tokens, ids as bytes]."""

    def __init__(self, unit: int, window: int, tiers: int):
        self.unit, self.window, self.tiers = unit, window, tiers
        self.made, self.steps, self.waiting, self.n = 0, 0, [], 0

    def add(self, doc_id, start: int, doc_tokens: int, ids: bytes) -> None:
        self.waiting.append((doc_id, start, doc_tokens, ids))
        self.n += len(ids) // 4

    def packed(self, last: bool) -> list[tuple]:
        """Rows of the windows that are full, and at the end (``last``) those of the open one too."""
        full, rest = plan([len(x[3]) // 4 for x in self.waiting], self.window, self.tiers)
        rows = self.rows(full, True)
        left = [self.piece(*x) for w in rest for x in w]
        if last:
            rows += self.rows(rest, False)
            left = []
        self.waiting, self.n = left, sum(len(x[3]) // 4 for x in left)
        return rows

    def piece(self, number: int, start: int, length: int) -> tuple:
        doc_id, before, tokens, ids = self.waiting[number]
        return doc_id, before + start, tokens, ids[4 * start : 4 * (start + length)]

    def rows(self, windows: list[list[tuple]], full: bool) -> list[tuple]:
        # Windows of a length are dealt to step groups in turns, the ones with most pieces first.
        by_size: dict[int, list] = {}
        for w in windows:
            by_size.setdefault(sum(x[2] for x in w) if full else self.window, []).append(w)
        rows = []
        for size, some in sorted(by_size.items(), reverse=True):
            some.sort(key=len, reverse=True)
            steps = -(-len(some) // STEP_SEQUENCES)
            for k, w in enumerate(some):
                turn, place = divmod(k, steps)
                step = self.steps + (place if turn % 2 == 0 else steps - 1 - place)
                offset = 0
                for x in w:
                    doc_id, start, tokens, ids = self.piece(*x)
                    number = (self.unit << 32) + self.made
                    group = (self.unit << 32) + step
                    rows.append((doc_id, start, x[2], tokens, ids, number, offset, size, group, not full))
                    offset += x[2]
                self.made += 1
            self.steps += steps
        return rows


def batches_of(rows: list[tuple], size: int = 5000):
    for a in range(0, len(rows), size):
        columns = zip(*rows[a : a + size])
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, ARROW)], ARROW)


ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())]
    + [("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int32())]
    + [("step_group", pa.int64()), ("open", pa.bool_())]
)


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    tiers: int = TIERS,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts, each with the end id, and pack all ids into sequences.

    Returns a row per piece: doc_id, start (ids of its document before it), length, doc_tokens,
    ids (little-endian unsigned 32-bit), sequence_id, offset (in the sequence, gapless from 0),
    window (length of the sequence with its padding) and step_group (up to 64 sequences of one
    length). Null texts are empty and give the end id alone, null ids are kept, and repeated rows
    are documents of their own. An empty table gives no pieces.

    Pieces are written once to the shared folder: a lost task packs its partition again as a
    whole, and the second pass reads what the first has committed.
    """
    path = tokenizer or default_tokenizer()
    rows = documents(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    unit = F.spark_partition_id().cast("long").alias("unit")

    def first(batches):
        encoder, packer, tail = ChunkEncoder.of(path), None, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            if packer is None and batch.num_rows:
                packer = Packer(batch.column("unit")[0].as_py(), window, tiers)
            numbers, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for a in range(0, batch.num_rows, 500):
                for doc_id, ids in zip(numbers[a : a + 500], encoder.encode(texts[a : a + 500].to_pylist())):
                    packer.add(doc_id, 0, len(ids) // 4 + 1, ids + tail)
                if packer.n >= BLOCK_IDS:
                    yield from batches_of(packer.packed(False))
        if packer is not None:
            yield from batches_of(packer.packed(True))

    made = rows.select(unit, "*").mapInArrow(first, PIECE + ", open boolean")
    made = stored(made, "packed", compression="zstd")
    units = F.floor(F.col("sequence_id") / (1 << 32)).cast("long")
    left = made.where("open").withColumn("unit", F.floor(units / FAN_IN).cast("long"))

    def second(key, table):
        packer = Packer((1 << 30) + key[0].as_py(), window, tiers)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for r in table.select(["doc_id", "start", "doc_tokens", "ids"]).to_pylist():
            packer.add(r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
        return pa.Table.from_batches(batches_of(packer.packed(True)), ARROW).drop_columns("open")

    again = left.groupBy("unit").applyInArrow(second, PIECE)
    return made.where("not open").drop("open").unionByName(again)


