"""Alignment of the tokens that two tokenizers cut a text into.

A text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B), and tokens are compared
by the bytes that they stand for. Tasks take documents in blocks. ``merge_asof``, keyed by document,
finds for each token start the token of the other side that covers it; both directions together are
the overlaps, and overlaps with equal ends close groups. All tokens of a group are linked.

Counts over the corpus take one row per block and pair of ids, however often the block holds it.
They are added up by pair, brought back to the blocks, and meet the documents there, so neither
tokens nor texts are shuffled and no task holds more than a block.

Chunks of a text between single spaces are encoded once a worker: neither tokenizer joins a space
to what lies before it, which is checked when they are loaded. Other texts are encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored, worker_state
from upkeep.workspace import discard

#: Bytes of text of a block, and distinct chunks that a worker keeps beside those of a block.
BLOCK_BYTES, KEPT_CHUNKS = 1 << 20, 450_000
#: Chunks that are encoded at once.
TOGETHER = 400
#: Links of a group that are listed one by one; larger groups count their distinct ids first.
GROUP_LINKS = 4096


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the ids of chunks seen before."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in texts are plain text
        letter, added = byte_letters(), self.a.get_added_tokens_decoder()
        size = max(self.a.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = token.encode() if number in added else bytes(map(letter.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes = [np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b)]
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)  # a space only begins a piece
        ends = [(b",", b"|"), (b",", b";")]
        self.digits = [
            np.array([b"%d%b" % (i, end) for end in e for i in range(len(t))], object)
            for t, e in zip((self.bytes_a, self.bytes_b), ends)
        ]
        self.bits = max(len(self.bytes_b) - 1, 1).bit_length()
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.again: set[str] = set()  # kept chunks that have come again

    @staticmethod
    def of(paths: tuple[str, str]) -> Tokenizers:
        """The worker's tokenizers."""
        loaded = worker_state().setdefault("pairs of tokenizers", {})
        if paths not in loaded:
            loaded[paths] = Tokenizers(*paths)
        return loaded[paths]

    def whole(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of each text on either side; none if a side's bytes are not a space and the text."""
        left = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        right = self.b.encode(texts, num_threads=1)
        found = []
        for text, a, b in zip(texts, left, right):
            want = b" " + text.encode()
            same = b"".join([self.bytes_a[i] for i in a.ids]) == want and b"".join([self.bytes_b[i] for i in b]) == want
            found.append((np.array(a.ids, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else None)
        return found

    def learned(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The same for chunks without spaces at their ends, many at once: joined by spaces they keep their ids."""
        found: list[tuple[bytes, bytes] | None] = []
        for start in range(0, len(chunks), TOGETHER):
            some = chunks[start : start + TOGETHER]
            joined = " ".join(some)
            (ids,) = self.whole([joined])
            if ids is None:
                found += self.whole(some)
                continue
            joined = joined.encode()
            spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20) + 1
            begins = np.concatenate([[0], spaces, [len(joined) + 1]])
            sides = []
            for side, size in zip(ids, self.sizes):
                cut = np.searchsorted(np.cumsum(size[np.frombuffer(side, "<u4")]), begins, "right") * 4
                cut = cut.tolist()
                sides.append([side[a:b] for a, b in zip(cut, cut[1:])])
            found += zip(*sides)
        return found

    def new(self, every: set[str]) -> set[str]:
        """The chunks not kept. If they overfill the cache, only chunks that have come again stay in it."""
        missing = every.difference(self.known)
        here = every - missing
        self.again |= here
        if len(self.known) + len(missing) > KEPT_CHUNKS:
            stay = self.again if len(self.again) <= KEPT_CHUNKS // 2 else here
            self.known = {c: self.known[c] for c in stay}
            self.again = here
        return missing

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The same, through chunks where spaces are single and lie between other signs."""
        chunks = [t.split(" ") if t else [] for t in texts]
        every = set().union(*chunks)
        loose = {c for c in every if c != c.strip() or not c}
        plain = [self.apart and (not loose or loose.isdisjoint(some)) for some in chunks]
        if not all(plain):
            every = set().union(*[c for c, p in zip(chunks, plain) if p])
        missing = list(self.new(every))
        self.known.update(zip(missing, self.learned(missing)))
        other = [i for i, p in enumerate(plain) if not p]
        found: list[tuple[bytes, bytes] | None] = [None] * len(texts)
        for i, ids in zip(other, self.whole([texts[i] for i in other]) if other else ()):
            found[i] = ids
        for i, some in enumerate(chunks):
            if plain[i] and some:
                parts = list(map(self.known.__getitem__, some))
                if None not in parts:
                    left, right = zip(*parts)
                    found[i] = (b"".join(left), b"".join(right))
        return found


def overlaps(doc_a, start_a, doc_b, start_b) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens (numbers in a and b) that share a byte, some twice; starts rise throughout."""
    left = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(start_a))})
    right = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(start_b))})
    covering_b = pd.merge_asof(left, right, on="start", by="doc")
    covering_a = pd.merge_asof(right, left, on="start", by="doc")
    pairs = pd.concat([covering_b[["a", "b"]], covering_a[["a", "b"]]])
    return pairs["a"].to_numpy(np.int64), pairs["b"].to_numpy(np.int64)


class Block:
    """The alignment of some documents: groups, links and their texts."""

    def __init__(self, ids: list[tuple[bytes, bytes]], known: Tokenizers):
        self.known, n = known, len(ids)
        sides = [[np.frombuffer(x[s], "<u4").astype(np.int64) for x in ids] for s in (0, 1)]
        self.counts = [np.array([len(x) for x in side], np.int64) for side in sides]
        self.ids = [np.concatenate([np.zeros(0, np.int64), *side]) for side in sides]
        self.docs = [np.repeat(np.arange(n), c) for c in self.counts]
        ends = [np.cumsum(size[i]) for size, i in zip(known.sizes, self.ids)]
        starts = [e - size[i] for e, size, i in zip(ends, known.sizes, self.ids)]
        a, b = overlaps(self.docs[0], starts[0], self.docs[1], starts[1])
        equal = ends[0][a] == ends[1][b]
        closing = [np.zeros(len(i), bool) for i in self.ids]  # the last tokens of groups
        for last, tokens in zip(closing, (a, b)):
            last[tokens[equal]] = True
        self.groups = [np.cumsum(last) - last for last in closing]
        self.n = int(closing[0].sum())
        self.sizes = [np.bincount(g, minlength=self.n) for g in self.groups]
        self.doc_of = self.docs[0][closing[0]]

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.doc_of, minlength=len(self.counts[0]))

    def n_links(self) -> np.ndarray:
        links = np.zeros(len(self.counts[0]), np.int64)
        np.add.at(links, self.doc_of, self.sizes[0] * self.sizes[1])
        return links

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair of ids and number of links, sorted by document and pair."""
        (a, b), (ga, gb), bits = self.ids, self.groups, self.known.bits
        first = np.cumsum(self.sizes[1]) - self.sizes[1]
        small = (self.sizes[0] * self.sizes[1] <= GROUP_LINKS)[ga]
        many = np.where(small, self.sizes[1][ga], 0)
        left = np.repeat(np.arange(len(a)), many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[ga], many)
        keys, times = [a[left] << bits | b[right]], [np.ones(len(left), np.int64)]
        docs = [self.docs[0][left]]
        for g in np.flatnonzero(self.sizes[0] * self.sizes[1] > GROUP_LINKS):
            x, nx = np.unique(a[slice(*np.searchsorted(ga, [g, g + 1]))], return_counts=True)
            y, ny = np.unique(b[slice(*np.searchsorted(gb, [g, g + 1]))], return_counts=True)
            keys.append((x[:, None] << bits | y).ravel())
            times.append((nx[:, None] * ny).ravel())
            docs.append(np.full(len(keys[-1]), self.doc_of[g]))
        keys, times, docs = (np.concatenate(x) for x in (keys, times, docs))
        wide = len(self.known.bytes_a).bit_length() + bits  # bits of a pair
        order = np.argsort(docs << wide | keys) if len(self.counts[0]) >> (62 - wide) == 0 else np.lexsort((keys, docs))
        keys, times, docs = keys[order], times[order], docs[order]
        run = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])])) if len(keys) else []
        return (docs[run], keys[run], np.add.reduceat(times, run)) if len(run) else (docs, keys, times)

    def texts(self) -> list[bytes]:
        """The groups of each document as ``a1,a2|b1;a3|b2,b3``."""
        before_a = np.cumsum(self.sizes[1]) - self.sizes[1]
        before_b = np.cumsum(self.sizes[0])
        signs = np.empty(len(self.ids[0]) + len(self.ids[1]), object)
        for side, before in ((0, before_a), (1, before_b)):
            ids, group = self.ids[side], self.groups[side]
            last = np.append(group[1:] != group[:-1], True)[: len(ids)]
            signs[np.arange(len(ids)) + before[group]] = self.known.digits[side][ids + last * (len(self.known.digits[side]) // 2)]
        ends = np.cumsum(self.counts[0] + self.counts[1]).tolist()
        return [b"".join(signs[a:b].tolist())[:-1] for a, b in zip([0, *ends], ends)]


ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, groups_sha256 string, "
    "pairs binary, times binary, held binary"
)


def aligned_blocks(docs: DataFrame, paths: tuple[str, str], spell: bool) -> DataFrame:
    """A row per document, and a row per block that lists its pairs.

    Document rows name their pairs by place in the block's list (``pairs``) and the links of each
    (``times``). Block rows have the list (``pairs``) and in how many documents each pair is (``held``).
    """

    def align(batches):
        import hashlib
        import uuid

        known = Tokenizers.of(paths)
        waiting, size = [], 0

        def block():
            found = known.encode([t for _, t in waiting])
            good = [i for i, x in enumerate(found) if x is not None]
            aligned = Block([found[i] for i in good], known)
            doc, key, times = aligned.pairs()
            keys, place = np.unique(key, return_inverse=True)
            name = uuid.uuid4().int >> 65
            cut = np.searchsorted(doc, np.arange(len(good) + 1)).tolist()
            numbers = zip(*(x.tolist() for x in (*aligned.counts, aligned.n_groups(), aligned.n_links())))
            place, times = place.astype("<u4"), times.astype("<u8")
            rows = {i: (0, 0, 0, 0, b"", "", b"", b"") for i in range(len(waiting))}
            for i, text, some, a, b in zip(good, aligned.texts(), numbers, cut, cut[1:]):
                sha = hashlib.sha256(text).hexdigest()
                rows[i] = (*some, text if spell else None, sha, place[a:b].tobytes(), times[a:b].tobytes())
            listed = [(name, d, *rows[i], None) for i, (d, _) in enumerate(waiting)]
            held = np.bincount(place, minlength=len(keys)).astype("<u4").tobytes()
            listed.append((name, None, *[None] * 6, keys.astype("<i8").tobytes(), None, held))
            columns = zip(*listed)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        names = [c.split() for c in ALIGNED.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in names])
        for batch in batches:
            for number, text in zip(batch.column("doc_id"), batch.column("text")):
                number, text = number.as_py(), text.as_py()
                waiting.append((number, text))
                size += 4 * len(text)  # bytes at most
                if size >= 4 * BLOCK_BYTES:
                    yield block()
                    waiting, size = [], 0
        if waiting:
            yield block()

    return docs.mapInArrow(align, ALIGNED)


def token_groups(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and groups of every row: ``a1,a2|b1;a3|b2,b3``, the ids of A and B in order, empty without tokens."""
    found = aligned_blocks(documents(docs, id_col, text_col), paths or default_tokenizers(), True)
    return found.where("held is null").select("doc_id", F.col("groups").cast("string").alias("groups"))


def pair_counts(blocks: DataFrame, bits: int) -> DataFrame:
    """(block, pair, n, best) of every pair in a block: documents that hold it, and whether no pair of its A id has more."""

    def explode(batches):
        for batch in batches:
            for block, pairs, held in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "held"))):
                pairs = np.frombuffer(pairs, "<i8")
                n = np.frombuffer(held, "<u4").astype(np.int64)
                yield pa.record_batch({"block": np.full(len(pairs), block), "pair": pairs, "n": n})

    rows = blocks.select("block", "pairs", "held").mapInArrow(explode, "block long, pair long, n long")
    counts = stored(rows.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts", compression="zstd")
    a = F.shiftright("pair", bits).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    judged = counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    judged = stored(judged, "judged-pairs", compression="zstd")
    found = stored(rows.select("block", "pair").join(judged, "pair"), "block-counts", compression="zstd")
    discard(counts, judged)
    return found


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``paths``: the files of a byte-level tokenizer (A) and a piece tokenizer (B). A's tokens are
    those of a space and the text. Offsets at which tokens of both sides end cut them into groups;
    every token of A is linked with every token of B in its group. A pair of ids counts the rows
    that hold it linked: ``count_sum`` adds that up over a row's links, and ``n_best`` counts the
    links whose pair has the highest count of its A id, ties included. ``groups_sha256`` is the hash
    of the text that ``token_groups`` gives.

    Null and empty texts, and texts that one side does not give back byte by byte, have no tokens:
    all numbers are zero and the hash is empty. Repeated rows are rows of their own, and count.
    Null ids stay null. An empty table gives no rows. Other columns are ignored.
    """
    paths = paths or default_tokenizers()
    made = stored(aligned_blocks(documents(docs, id_col, text_col), paths, False), "aligned", compression="zstd")
    pieces = Tokenizers.of(paths).bits
    counts = pair_counts(made.where("held is not null"), pieces)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    rows = made.where("held is null").select("block", *columns, "groups_sha256", "pairs", "times")

    def finish(left, right):
        order = np.argsort(np.asarray(right.column("pair").combine_chunks()))
        n = np.asarray(right.column("n").combine_chunks())[order]
        best = np.asarray(right.column("best").combine_chunks().cast(pa.int8()))[order]
        sums, bests = [], []
        for pairs, times in zip(left.column("pairs").to_pylist(), left.column("times").to_pylist()):
            place, times = np.frombuffer(pairs, "<u4"), np.frombuffer(times, "<u8").astype(np.int64)
            sums.append(int((n[place] * times).sum()))
            bests.append(int((best[place] * times).sum()))
        found = left.select([*columns, "groups_sha256"])
        return found.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = rows.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(finish, schema)
    return done.select(*columns, "n_best", "count_sum", "groups_sha256")
