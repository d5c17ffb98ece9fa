"""Benchmark decontamination: BM25 retrieval by block-max WAND, then a check of the overlap.

The test items form an inverted index. Documents are read as overlapping passages, and every
passage of every document is a query. Items stand in blocks, and every term has a maximum for each
block: blocks whose maxima cannot add up to the threshold are skipped, the others are searched by
WAND, which moves to the first item whose maxima can. An item's threshold is the least score that a passage can
have if it holds 80 % of the item's five-word shingles, so retrieval loses no such passage: impacts
are divided by that threshold, and all items at 1 or more are retrieved. A retrieved item counts
if 80 % of its shingles stand in the passage, and half of the words of its question and its answer.

Words are runs of characters without white space and ASCII punctuation, in lower case. The last
line of an item is its answer; without lines the last sentence, without sentences its second half.
"""

from __future__ import annotations

import math
import string
import uuid
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, worker_state

SHINGLE, SIMILARITY, PART_OVERLAP = 5, 0.8, 0.5
K1, B = 1.2, 0.75
#: Items of a block at least, and blocks at most. Every term has a maximum for each block.
BLOCK, BLOCKS = 8, 64
#: Bytes of item text that are indexed and broadcast at once; more items are searched in several passes.
INDEX_BYTES = 16 << 20
_APART = bytes(32 if chr(c) in string.punctuation else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_APART).split()


def shingles(words: list) -> set[tuple]:
    """Distinct runs of five words; a shorter text is one run."""
    n = max(1, len(words) - SHINGLE + 1)
    return {tuple(words[i : i + SHINGLE]) for i in range(n)} if words else set()


def parts_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer."""
    lines = [x for x in text.split("\n") if words_of(x)]
    if len(lines) < 2:
        lines = [x for x in text.replace("? ", "?\n").replace(". ", ".\n").split("\n") if words_of(x)]
    if len(lines) < 2:
        words = words_of(text)
        return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]
    return words_of(" ".join(lines[:-1])), words_of(lines[-1])


def overlap(part: list[bytes], held: Counter) -> float:
    """Share of a part's words that the passage holds, each as often; 1 for no words."""
    wanted = Counter(part)
    return sum(min(n, held[w]) for w, n in wanted.items()) / len(part) if part else 1.0


class Index:
    """Inverted index of items with impacts relative to each item's threshold."""

    def __init__(self, items: list[tuple[int, str]]):
        kept = [(i, words_of(t or ""), t or "") for i, t in items]
        kept = [x for x in kept if x[1]]
        # Items with words in common stand together, which keeps the maxima of blocks low.
        often = Counter(w for x in kept for w in set(x[1]))
        kept.sort(key=lambda x: sorted(((-often[w], w) for w in set(x[1])))[:3])
        self.ids = [x[0] for x in kept]
        self.shingles = [shingles(x[1]) for x in kept]
        self.parts = [parts_of(x[2]) for x in kept]
        lengths = [len(x[1]) for x in kept]
        self.window = 2 * max(lengths, default=1)  # with a step of half of it, one window holds any run as long as an item
        mean = sum(lengths) / max(1, len(lengths))
        counts = [Counter(x[1]) for x in kept]
        df = Counter(w for c in counts for w in c)
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for item, c in enumerate(counts):
            norm = K1 * (1 - B + B * lengths[item] / mean)
            impact = {
                w: math.log(1 + (len(kept) - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in c.items()
            }
            # 20 % of the shingles can lack so many words at most.
            lost = int((1 - SIMILARITY) * max(1, lengths[item] - SHINGLE + 1) + 1e-9)
            least = sum(sorted(impact.values(), reverse=True)[lost:]) or min(impact.values())
            for w, x in impact.items():
                postings.setdefault(w, []).append((item, x / least))
        self.term = {w: i + 1 for i, w in enumerate(postings)}  # 0: a word that no item has
        self.items = [np.zeros(0, np.int64)] + [np.array([p[0] for p in x]) for x in postings.values()]
        self.impacts = [np.zeros(0)] + [np.array([p[1] for p in x]) for x in postings.values()]
        self.lists = [(i.tolist(), x.tolist()) for i, x in zip(self.items, self.impacts)]
        # Maxima of each term by block of items; row 0 is for words that no item has.
        self.size = max(BLOCK, -(-len(kept) // BLOCKS))
        self.most = np.zeros((len(self.items), max(1, -(-len(kept) // self.size))))
        for t, (items, x) in enumerate(zip(self.items, self.impacts)):
            np.maximum.at(self.most[t], items // self.size, x)

    def retrieve(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """The items of a block whose relative score is 1 or more, by WAND over the distinct terms."""
        low, high = block * self.size, (block + 1) * self.size
        cursors = []  # item, place in the term's list, its end, term
        for t in terms:
            items = self.lists[t][0]
            place, end = bisect_left(items, low), bisect_left(items, high)
            if place < end:
                cursors.append([items[place], place, end, t])
        most, found, goal = self.most[:, block], [], 1 - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += most[c[3]]
                if bound >= goal:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            if cursors[0][0] == item:
                here = [c for c in cursors if c[0] == item]
                score = sum(self.lists[c[3]][1][c[1]] for c in here)
                if score >= goal:
                    found.append((item, score))
                item += 1
            for c in cursors:
                if c[0] < item:
                    items = self.lists[c[3]][0]
                    c[1] = bisect_left(items, item, c[1], c[2])
                    c[0] = items[c[1]] if c[1] < c[2] else high
            cursors = [c for c in cursors if c[1] < c[2]]
        return found

    def search(self, text: str) -> list[tuple]:
        """(item, score, similarity, question overlap, answer overlap) of each item that the text holds."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        terms = np.fromiter(map(self.term.get, words, (0,) * len(words)), np.int32, len(words))
        step = max(1, self.window // 2)
        starts = np.arange(0, max(1, len(words) - step), step)
        ends = np.minimum(starts + self.window, len(words))
        # For all passages and blocks: the sum of the block's maxima, an upper bound of its items' scores.
        known = np.flatnonzero(terms)
        sums = np.zeros((len(known) + 1, self.most.shape[1]))
        np.cumsum(self.most[terms[known]], axis=0, out=sums[1:])
        bounds = sums[np.searchsorted(known, ends)] - sums[np.searchsorted(known, starts)]
        best: dict[int, tuple] = {}
        for k in np.flatnonzero((bounds >= 1 - 1e-6).any(1)).tolist():
            start, end = int(starts[k]), int(ends[k])
            distinct = np.unique(terms[start:end])
            distinct = distinct[distinct > 0]
            able = np.flatnonzero(self.most[distinct].sum(0) >= 1 - 1e-9).tolist()
            found = [x for block in able for x in self.retrieve(distinct.tolist(), block)]
            if not found:
                continue
            passage = words[start:end]
            runs, held = shingles(passage), Counter(passage)
            for item, score in found:
                wanted = self.shingles[item]
                if len(next(iter(wanted))) < SHINGLE:  # a short item: look for it anywhere
                    run = next(iter(wanted))
                    near = float(any(tuple(passage[i : i + len(run)]) == run for i in range(len(passage))))
                else:
                    near = len(wanted & runs) / len(wanted)
                parts = [overlap(p, held) for p in self.parts[item]]
                if near >= SIMILARITY and min(parts) >= PART_OVERLAP and near > best.get(item, (0, -1))[1]:
                    best[item] = (score, near, *parts)
        return [(self.ids[item], *x) for item, x in sorted(best.items())]


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """Names and broadcast blocks of test items, each bounded in bytes. Null texts match nothing."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = items.where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = max(1, -(-size // INDEX_BYTES))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = sorted({(r[0], r[1]) for r in some.collect()}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield uuid.uuid4().hex, spark.sparkContext.broadcast(rows)


def index_of(name: str, shared) -> Index:
    """The worker's index of a broadcast block."""
    known = worker_state().setdefault("indexes", {})
    if name not in known:
        known.clear()
        known[name] = Index(shared.value)
    return known[name]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and test item that it holds.

    Returns doc_id, item_id, score (BM25 relative to the item's threshold), similarity,
    question_overlap and answer_overlap, of the passage most similar to the item. Null texts hold
    nothing. A null id is kept as null; repeated rows give a row each; repeated items count once.
    Empty tables give no rows. Other columns are ignored.
    """
    rows, found = documents(docs, id_col, text_col), None
    for name, shared in indexes(benchmark):

        def search(batches, name=name, shared=shared):
            names = ["doc_id", "item_id", "score", "similarity", "question_overlap", "answer_overlap"]
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            for batch in batches:
                index, out = index_of(name, shared), []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    out += [(doc_id, *x) for x in index.search(text.as_py())]
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        kind = "doc_id long, item_id long, score double, similarity double, question_overlap double, answer_overlap double"
        some = rows.mapInArrow(search, kind)
        found = some if found is None else found.unionByName(some)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns and null texts stay."""
    for name, shared in indexes(benchmark):
        place = docs.columns.index(text_col)

        def clean(batches, name=name, shared=shared, place=place):
            for batch in batches:
                index, text = index_of(name, shared), batch.column(place)
                yield batch.filter(pa.array([not index.search(t.as_py() or "") for t in text], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
