"""Language-model scores by context-tree weighting over bytes.

A text is the sequence of its UTF-8 bytes (A-Z lowered) and one end symbol. Every byte is eight
binary decisions, and each decision has a tree of contexts of 0 to ``DEPTH`` bytes before it. A node
holds a Krichevsky-Trofimov estimate; nodes of all depths are mixed by the weights that the training
texts give them. Once trained, the probability of a byte depends on the ``DEPTH`` bytes before it
only, so the model is a table from byte runs to code lengths, and it is never held in one place:

1. Tasks cut the documents into blocks and write, for each block, its texts, its distinct byte
   runs and its distinct words, each with its count in training texts.
2. Counts are summed by run. Tasks that hold all runs with the same two last context bytes weight
   the trees below; the nodes of depth 0 and 1 (at most 65,280) are finished on the driver.
3. Each block gets the code lengths of its own runs and the counts of its own words, and scores
   its texts. What a task holds is bounded by the size of a block, whatever the corpus.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored

DEPTH = 4
END = 0xFF  # never occurs in UTF-8
#: Bytes of text in a block, and in a step within it.
BLOCK_BYTES, STEP_BYTES = 16 << 20, 2 << 20
HELD_OUT = 10


def runs(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end symbol its run (last byte before it first, then earlier ones, then itself), and its text."""
    pad = bytes([END] * depth)
    data = b"".join([pad + t + b"\xff" for t in texts]) + bytes(8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(int(lengths.sum())) + depth * owner
    view = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))[at]
    context = view & np.uint64((1 << 8 * depth) - 1)
    return (context << np.uint64(8)) | ((view >> np.uint64(8 * depth)) & np.uint64(255)), owner


def log_gamma(x: np.ndarray) -> np.ndarray:
    shift, x = np.ones_like(x), x.copy()
    for _ in range(8):
        shift *= np.where(x < 9, x, 1.0)
        x = np.where(x < 9, x + 1, x)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that a Krichevsky-Trofimov estimator gives to the counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Tree:
    """The nodes of depth 2 to ``depth`` above a sorted set of distinct runs."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, self.codes = depth, codes
        self.node, self.key, self.zeros, self.ones, self.below = {}, {}, {}, {}, {}
        here, n, back = codes, counts.astype(float), np.arange(len(codes))
        for d in range(depth, 1, -1):
            if d < depth:
                shorter = ((here >> np.uint64(16)) << np.uint64(8)) | (here & np.uint64(255))
                here, up = np.unique(shorter, return_inverse=True)
                n, back = np.bincount(up, n, len(here)), up[back]
            for j in range(8):
                key = here >> np.uint64(8 - j)
                first = np.concatenate([[True], key[1:] != key[:-1]])
                starts, node = np.flatnonzero(first), np.cumsum(first) - 1
                bit = ((here >> np.uint64(7 - j)) & np.uint64(1)).astype(float)
                ones = np.add.reduceat(n * bit, starts)
                self.zeros[d, j], self.ones[d, j] = np.add.reduceat(n, starts) - ones, ones
                self.key[d, j], self.node[d, j] = key[starts], node[back]

    def weighted(self, d: int, j: int) -> np.ndarray:
        """Log of the weighted probability of each node; fills in what its children give (``below``)."""
        alone = log_estimate(self.zeros[d, j], self.ones[d, j])
        if d == self.depth:
            return alone
        key, low = self.key[d + 1, j], np.uint64((1 << j) - 1)
        parent = ((key >> np.uint64(j + 8)) << np.uint64(j)) | (key & low)
        place = np.searchsorted(self.key[d, j], parent)
        self.below[d, j] = np.bincount(place, self.weighted(d + 1, j), len(alone))
        return np.log(0.5) + np.logaddexp(alone, self.below[d, j])

    def top(self) -> list[np.ndarray]:
        """Sums by last context byte and decision (256 * byte + decision): zeros, ones, log weighted probability."""
        sums = [np.zeros(1 << 16) for _ in range(3)]
        for j in range(8):
            key = self.key[2, j]
            place = ((key >> np.uint64(j + 8)) << np.uint64(8)) | np.uint64(1 << j) | (key & np.uint64((1 << j) - 1))
            for total, x in zip(sums, (self.zeros[2, j], self.ones[2, j], self.weighted(2, j))):
                total += np.bincount(place.astype(np.int64), x, 1 << 16)
        return sums

    def log10(self, roots: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Log10 probability of each run's last byte; ``roots``: (weight, probability of one) at depths 0 and 1."""
        total = np.zeros(len(self.codes))
        symbol = (self.codes & np.uint64(255)).astype(np.int64)
        last = (self.codes >> np.uint64(8 * self.depth)).astype(np.int64)
        for j in range(8):
            self.weighted(2, j)
            bit = (symbol >> (7 - j)) & 1
            decision = (1 << j) | (symbol >> (8 - j))
            p = None
            for d in range(self.depth, -1, -1):
                if d >= 2:
                    zeros, ones, node = self.zeros[d, j], self.ones[d, j], self.node[d, j]
                    own = ((ones + 0.5) / (zeros + ones + 1))[node]
                    if d < self.depth:
                        own_weight = weight(log_estimate(zeros, ones), self.below[d, j])[node]
                else:
                    place = 256 * last + decision if d == 1 else decision
                    own_weight, own = roots[d][0][place], roots[d][1][place]
                own = np.where(bit == 1, own, 1 - own)
                p = own if p is None else own_weight * own + (1 - own_weight) * p
            total += np.log10(p)
        return total


def weight(alone: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Posterior weight of a node's own estimate against its children's."""
    return np.exp(alone - np.logaddexp(alone, below))


def rooted(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and estimates at depths 0 and 1 from the sums by last context byte and decision."""
    alone = log_estimate(zeros, ones)
    first = (weight(alone, below), (ones + 0.5) / (zeros + ones + 1))
    above = (np.log(0.5) + np.logaddexp(alone, below)).reshape(256, 256).sum(0)
    zeros, ones = zeros.reshape(256, 256).sum(0), ones.reshape(256, 256).sum(0)
    return [(weight(log_estimate(zeros, ones), above), (ones + 0.5) / (zeros + ones + 1)), first]


def whole_trees(batches, depth: int, least: int = 200_000):
    """Sorted (run, n) batches as sets of runs that share no pair of last context bytes with another set."""
    code, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shift = np.uint64(8 * (depth - 1))
    for batch in batches:
        code = np.concatenate([code, np.asarray(batch.column("gram")).view(np.uint64)])
        n = np.concatenate([n, np.asarray(batch.column("n"))])
        if len(code) >= least:
            cut = int(np.searchsorted(code, (code[-1] >> shift) << shift))
            if cut:
                yield code[:cut], n[:cut]
                code, n = code[cut:], n[cut:]
    if len(code):
        yield code, n


BLOCKS = "block long, doc_id long, text binary, held_out boolean, gram long, word binary, n long"


def blocks_of(docs: DataFrame, depth: int, block_bytes: int) -> DataFrame:
    """Texts by block, then the block's distinct runs and words with their counts in training texts."""
    names = ["block", "doc_id", "text", "held_out", "gram", "word", "n"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.int64()]

    def table(rows: int, block: int, **columns) -> pa.RecordBatch:
        columns["block"] = np.full(rows, block, np.int64)
        arrays = [pa.array(columns[n], k) if n in columns else pa.nulls(rows, k) for n, k in zip(names, kinds)]
        return pa.record_batch(arrays, names)

    def counted(texts: list[bytes], held: list[bool]):
        """Distinct runs with counts, in steps that bound the memory."""
        found, counts, start = [], [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) < STEP_BYTES):
                size += len(texts[end])
                end += 1
            code, owner = runs(texts[start:end], depth)
            train = ~np.array(held[start:end])[owner]
            code = np.sort((code << np.uint64(1)) | train)
            first = np.flatnonzero(np.concatenate([[True], (code[1:] ^ code[:-1]) > 1]))
            counts.append(np.add.reduceat((code & np.uint64(1)).astype(np.int64), first))
            found.append(code[first] >> np.uint64(1))
            start = end
        code, place = np.unique(np.concatenate(found), return_inverse=True)
        return code, np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)

    def stats(block: int, texts: list[bytes], held: list[bool]):
        code, n = counted(texts, held)
        yield table(len(code), block, gram=code.view(np.int64), n=n)
        train, other = Counter(), set()
        for text, out in zip(texts, held):
            if out:
                other.update(text.split())
            else:
                train.update(text.split())
        train[b""] = held.count(False)  # the end token
        words = list(train) + list(other.difference(train))
        counts = list(train.values()) + [0] * (len(words) - len(train))
        for a in range(0, len(words), 50_000):
            some = words[a : a + 50_000]
            yield table(len(some), block, word=some, n=counts[a : a + 50_000])

    def cut(batches):
        number, size, texts, held = -1, 0, [], []
        for batch in batches:
            if number < 0 and batch.num_rows:
                number = batch.column("part")[0].as_py() << 24
            ids, outs = batch.column("doc_id"), batch.column("held_out").to_pylist()
            for a in range(0, batch.num_rows, 200):
                some = [t.lower() for t in batch.column("text")[a : a + 200].to_pylist()]
                yield table(len(some), number, doc_id=ids[a : a + 200], text=some, held_out=outs[a : a + 200])
                texts += some
                held += outs[a : a + 200]
                size += sum(map(len, some))
                if size >= block_bytes:
                    yield from stats(number, texts, held)
                    number, size, texts, held = number + 1, 0, [], []
        if texts:
            yield from stats(number, texts, held)

    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(HELD_OUT)) == 0
    rows = docs.select(
        F.spark_partition_id().cast("long").alias("part"), "doc_id", F.col("text").cast("binary").alias("text"), held.alias("held_out")
    )
    return stored(rows.mapInArrow(cut, BLOCKS), "lm-blocks", compression="zstd")


def code_lengths(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, value): log10 probability of each run's last byte, from all runs' training counts (gram, n)."""
    pair = F.shiftrightunsigned("gram", 8 * (depth - 1)).alias("pair")
    counts = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")), "lm-counts")
    by_tree = counts.select("gram", "n", pair).repartition("pair").sortWithinPartitions("gram").select("gram", "n")

    def tops(batches):
        sums = [np.zeros(1 << 16) for _ in range(3)]
        for code, n in whole_trees(batches, depth):
            sums = [a + b for a, b in zip(sums, Tree(code, n, depth).top())]
        used = np.flatnonzero((sums[0] + sums[1]) > 0)
        yield pa.record_batch(
            {"place": used, "zeros": sums[0][used], "ones": sums[1][used], "below": sums[2][used]}
        )

    top = by_tree.mapInArrow(tops, "place long, zeros double, ones double, below double")
    sums = np.zeros((3, 1 << 16))
    for r in top.groupBy("place").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).collect():
        sums[:, r[0]] = r[1:]
    roots = counts.sparkSession.sparkContext.broadcast(rooted(*sums))

    def lengths(batches):
        for code, n in whole_trees(batches, depth):
            yield pa.record_batch({"gram": code.view(np.int64), "value": Tree(code, n, depth).log10(roots.value)})

    return by_tree.mapInArrow(lengths, "gram long, value double")


def text_scores(texts: list[bytes], grams: np.ndarray, values: np.ndarray, depth: int) -> np.ndarray:
    """Sum of the values of each text's runs; ``grams`` is sorted and holds them all."""
    scores, start = np.zeros(len(texts)), 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and end - start < 1 << 16 and (size == 0 or size + len(texts[end]) < STEP_BYTES):
            size += len(texts[end])
            end += 1
        code, owner = runs(texts[start:end], depth)
        code = np.sort((code << np.uint64(16)) | owner.astype(np.uint64))
        owner, code = (code & np.uint64(0xFFFF)).astype(np.int64), code >> np.uint64(16)
        first = np.concatenate([[True], code[1:] != code[:-1]])
        value = values[np.searchsorted(grams, code[first])]
        scores[start:end] = np.bincount(owner, value[np.cumsum(first) - 1], end - start)
        start = end
    return scores


def score_documents(
    docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score whole texts by a model of those whose crc32 of the id as text is not a multiple of 10.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words and one end token
    by smoothed frequency), score (log10 probability of the text's bytes and end) and
    bits_per_byte (code length by byte, the end symbol counted). Null texts are empty and have the
    end only; a null id counts as empty text and is held out; repeated rows are texts of their own.
    An empty table gives no rows, and without training texts all decisions are even.
    """
    made = blocks_of(documents(docs, id_col, text_col), depth, block_bytes)
    grams = made.where("gram is not null").select("block", "gram", "n")
    model = code_lengths(grams.select("gram", "n"), depth)
    valued = stored(grams.join(model, "gram").select("block", "gram", "value"), "lm-grams", compression="zstd")
    gram_part = valued.select("block", "gram", F.lit(None).cast("binary").alias("word"), "value")

    # Summed first and joined back: a word that every block holds is no task's burden, as the join can be split.
    words = made.where("word is not null").select("block", "word", "n")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("c")), "lm-word-counts", compression="zstd")
    known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0)))
    total, distinct = known.first()
    words = stored(words.select("block", "word").join(counts, "word"), "lm-words", compression="zstd")
    scale = total + 0.1 * (distinct + 1)
    word_part = words.select("block", F.lit(None).cast("long").alias("gram"), "word", F.col("c").cast("double").alias("value"))

    def score(left, right):
        values = right.column("value").to_numpy()
        grams = right.column("gram").combine_chunks()
        is_gram = np.asarray(grams.is_valid())
        code = grams.drop_null().to_numpy().view(np.uint64)
        order = np.argsort(code)
        texts = left.column("text").to_pylist()
        model = text_scores(texts, code[order], values[is_gram][order], depth)
        held = right.filter(pa.array(~is_gram)).column("word").to_pylist()
        count = dict(zip(held, values[~is_gram].tolist()))
        tokens, sure, base = [], [], []
        for text in texts:
            parts = text.split()
            parts.append(b"")
            c = np.fromiter(map(count.__getitem__, parts), float, len(parts))
            tokens.append(len(parts))
            sure.append(int((c > 0).sum()))
            base.append(float(np.log10((c + 0.1) / scale).sum()))
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(tokens, pa.int64()),
                "n_known": pa.array(sure, pa.int64()),
                "train_tokens": pa.array([total] * len(texts), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": model,
                "bits_per_byte": -model / np.log10(2) / size,
            }
        )

    texts = made.where("text is not null").select(F.col("block").alias("home"), "doc_id", "text", "held_out")
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    parts = gram_part.unionByName(word_part)
    return texts.groupBy("home").cogroup(parts.groupBy("block")).applyInArrow(score, kind)
