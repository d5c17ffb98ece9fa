"""Repeated byte strings, found by expanding intervals of a Burrows-Wheeler transform.

A string of ``LENGTH`` bytes that occurs twice has to meet its copy in one task. Each such window
of a text names an anchor: the position in it whose hash is least. Equal windows name the same
anchor, so anchors are grouped by the ``KEY`` bytes that follow them, and the windows that one
anchor stands for are compared within its group only. Anchors that nothing shares drop out here.

A group first puts equal contexts (all bytes of an anchor's windows) together: their windows are
repeats. One context of each kind goes on, in chunks of ``CHUNK`` windows. All windows of a chunk
hold the same core of ``LENGTH - CHUNK + 1`` bytes; chunks that share no core with another drop
out, and a shared core becomes one symbol. Tasks join the chunks to one text, sort its suffixes, and
expand intervals of the transform by one symbol to the left, breadth first: intervals of length n
set the common prefixes of length n that are not set yet. At the length of a window the expansion
stops; neighbours without a value share a window. Groups with too many contexts for a task compare
hashes of their windows instead, which are dealt to all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored
from upkeep.workspace import discard

LENGTH, KEY = 400, 128
#: Windows of a chunk.
CHUNK = 32
#: Bytes of text that a task looks through at once, contexts that it compares and symbols that it sorts.
STEP_BYTES, STEP_CONTEXTS, SORT_SYMBOLS = 2 << 20, 20_000, 1 << 20
#: Contexts of a group that one task sorts; larger groups take the way over window hashes.
GROUP_CONTEXTS = 8192


def anchors(texts: list[bytes], length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, ...]:
    """For each anchor: text, position, first and last start of the windows that it stands for."""
    long = [i for i, t in enumerate(texts) if len(t) >= length]
    if not long:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    data = b"".join([texts[i] for i in long])
    sizes = np.fromiter((len(texts[i]) for i in long), np.int64, len(long))
    starts = np.cumsum(sizes) - sizes
    n, span = len(data), length - key + 1
    grams = np.ndarray((n,), "<u8", buffer=data + bytes(8), strides=(1,)).copy()
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams &= ~np.uint64(0xFFFFFFFF)
    grams |= np.arange(n, dtype=np.uint64)  # of equal hashes the first
    padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = grams
    rows = padded.reshape(-1, span)
    upto = np.minimum.accumulate(rows, 1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(onward[: n - span + 1], upto[span - 1 : n]) & np.uint64(0xFFFFFFFF)
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(long)), windows)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows - starts, windows)
    place = least[at].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    base = starts[owner[first]]
    return np.array(long)[owner[first]], place[first] - base, at[first] - base, at[last] - base


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, compared up to ``depth`` symbols at least."""
    n = len(symbols)
    size = int(symbols.max()) + 2
    packed = np.zeros(n + 4, np.int64)
    packed[:n] = symbols + 1
    width = max(1, min(4, int(62 // np.log2(size))))
    key = np.zeros(n, np.int64)
    for k in range(width):
        key = key * size + packed[k : n + k]
    order = np.argsort(key)
    done = width
    while True:
        ordered = key[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        if done >= depth or first.all():
            return order
        follow = np.zeros(n, np.int64)
        follow[: n - done] = rank[done:] + 1
        # Only positions whose rank is shared move, and only among their equals.
        single = first & np.concatenate([first[1:], [True]])
        moving = np.flatnonzero(~single)
        some = order[moving]
        key = rank * (n + 1)
        key[some] += follow[some]
        order[moving] = some[np.argsort(key[some], kind="stable")]
        done *= 2


def shared_prefixes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffix at each position shares ``length`` symbols with another one."""
    n = len(symbols)
    order = suffix_order(symbols, length)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    left = rank[order - 1]  # where the suffix one symbol longer stands (the first symbol's is the last)
    first_symbol = symbols[order]
    unset = np.ones(n + 1, bool)  # the common prefix with the suffix before is not known yet
    unset[0] = unset[n] = False
    lower, upper = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lower):
            break
        sizes = upper - lower
        owner = np.repeat(np.arange(len(lower)), sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(lower - (np.cumsum(sizes) - sizes), sizes)
        reached = np.sort((owner << 32) | left[at])
        owner, reached = reached >> 32, reached & 0xFFFFFFFF
        breaks = (owner[1:] != owner[:-1]) | (reached[1:] != reached[:-1] + 1)
        breaks |= first_symbol[reached[1:]] != first_symbol[reached[:-1]]
        starts = np.concatenate([[0], np.flatnonzero(breaks) + 1])
        ends = np.concatenate([starts[1:], [len(reached)]])
        lower, upper = reached[starts], reached[ends - 1] + 1
        new = unset[upper]
        unset[upper[new]] = False
        lower, upper = lower[new], upper[new]
    shared = np.zeros(n, bool)
    shared[order] = unset[:-1] | unset[1:]
    return shared


def pieces(context: bytes, place: int, length: int, chunk: int):
    """The windows of a context in chunks by their distance to the anchor, which stands at ``place``.

    All windows of a chunk hold its core, ``length - chunk + 1`` bytes. Yields chunk, core, the
    bytes before and after it that some window of the context reaches, and first and last window.
    """
    size, windows = length - chunk + 1, len(context) - length + 1
    for number in range((place - windows + 1) // chunk, place // chunk + 1):
        at = place - number * chunk
        first, last = max(0, at - chunk + 1), min(windows - 1, at)
        yield number, context[at : at + size], context[first:at], context[at + size : last + length], first, last


def repeated_windows(rows: list[dict], length: int) -> list[np.ndarray]:
    """For each context (anchor, place in its bytes, bytes) which of its windows another one holds.

    Contexts whose chunk has the same core form a group, in which the core is one symbol: windows
    are then ``chunk`` symbols long, and intervals are expanded up to that length.
    """
    import xxhash

    chunk = min(CHUNK, length)
    groups: dict[tuple, dict[tuple, list]] = {}
    hits = [np.zeros(len(r["bytes"]) - length + 1, bool) for r in rows]
    for number, row in enumerate(rows):
        for part, core, before, after, first, last in pieces(row["bytes"], row["place"] - row["low"], length, chunk):
            kinds = groups.setdefault((row["anchor"], part, xxhash.xxh64_intdigest(core)), {})
            kinds.setdefault((before, after), []).append((number, first, last + 1))
    mixed = []
    for kinds in groups.values():
        for members in kinds.values():
            if len(members) > 1:  # equal pieces
                for number, first, end in members:
                    hits[number][first:end] = True
        if len(kinds) > 1:
            mixed.append(kinds)
    start = 0
    while start < len(mixed):
        end, size = start, 0
        while end < len(mixed) and size < SORT_SYMBOLS:
            size += 2 * chunk * len(mixed[end])
            end += 1
        expand(mixed[start:end], chunk, hits)
        start = end
    return hits


def expand(groups: list[dict[tuple, list]], chunk: int, hits: list[np.ndarray]) -> None:
    """Mark the windows that different pieces of a group share."""
    kinds = [k for g in groups for k in g]
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    data = b"".join([b"%b\0%b\0" % k for k in kinds])
    before = np.fromiter((len(k[0]) for k in kinds), np.int64, len(kinds))
    sizes = before + np.fromiter((len(k[1]) for k in kinds), np.int64, len(kinds)) + 2
    begins = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(data, np.uint8).astype(np.int64)
    symbols[begins + before] = 256 + owner
    symbols[begins + sizes - 1] = 256 + len(groups) + np.arange(len(kinds))  # ends match nothing
    shared = shared_prefixes(symbols, chunk)
    members = (m for g in groups for m in g.values())
    for begin, some in zip(begins.tolist(), members):
        for number, first, end in some:
            hits[number][first:end] |= shared[begin : begin + end - first]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that intervals cover."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[first], ends[np.concatenate([first[1:], [True]])]


def text_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(1), "text").alias("t2"),
        F.col("text").cast("binary").alias("text"),
    )


ANCHOR_NAMES = ["t1", "t2", "anchor", "place", "low", "high", "context"]
ANCHOR = "t1 long, t2 long, anchor long, place int, low int, high int, context long"


def anchor_table(texts: DataFrame, length: int, key: int) -> DataFrame:
    """Every anchor with hashes of its key and of its context."""

    def find(batches):
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            t1, t2, all_texts = batch.column("t1"), batch.column("t2"), batch.column("text")
            start = 0
            while start < batch.num_rows:
                texts, size, end = [], 0, start
                while end < batch.num_rows and (size < STEP_BYTES):
                    texts.append(all_texts[end].as_py())
                    size += len(texts[-1])
                    end += 1
                owner, place, low, high = anchors(texts, length, key)
                rows = list(zip(owner.tolist(), place.tolist(), low.tolist(), high.tolist()))
                keys = np.fromiter((digest(texts[o][p : p + key]) for o, p, _, _ in rows), np.uint64, len(rows))
                around = (digest(texts[o][a : b + length], p - a) for o, p, a, b in rows)
                context = np.fromiter(around, np.uint64, len(rows))
                take = pa.array(owner + start)
                columns = [t1.take(take), t2.take(take), keys.view(np.int64), place.astype(np.int32)]
                columns += [low.astype(np.int32), high.astype(np.int32), context.view(np.int64)]
                yield pa.record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ANCHOR_NAMES)
                start = end

    long = texts.where(F.octet_length("text") >= length).select("t1", "t2", "text")
    return stored(long.mapInArrow(find, ANCHOR), "anchors", compression="zstd")


COVER_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def compared(contexts: DataFrame, length: int) -> DataFrame:
    """(t1, t2, low, high) of runs of bytes covered by windows that another context of the group holds."""

    def compare(batches):
        waiting = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(waiting) >= STEP_CONTEXTS and row["anchor"] != waiting[-1]["anchor"]:
                    yield covered(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield covered(waiting)

    def covered(rows):
        out = []
        for row, hit in zip(rows, repeated_windows(rows, length)):
            if row["n"] == 1 and hit.any():
                at = np.flatnonzero(hit) + row["low"]
                for a, b in zip(*merged(at, at + length)):
                    out.append((row["t1"], row["t2"], int(a), int(b)))
        columns = list(zip(*out)) or [[]] * 4
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, COVER_KINDS)], ["t1", "t2", "low", "high"])

    rows = contexts.repartition("anchor").sortWithinPartitions("anchor", "context")
    return rows.mapInArrow(compare, "t1 long, t2 long, low int, high int")


def hashed(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: windows are compared by two hashes, each dealt to a task of its own."""

    def explode(batches):
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for row in batch.to_pylist():
                data = row["bytes"]
                parts = [data[i : i + length] for i in range(len(data) - length + 1)]
                n = len(parts)
                yield pa.record_batch(
                    {
                        "t1": np.full(n, row["t1"]),
                        "t2": np.full(n, row["t2"]),
                        "n": np.full(n, row["n"]),
                        "low": np.arange(row["low"], row["low"] + n, dtype=np.int32),
                        "w1": np.array([digest(p, 1) for p in parts], np.uint64).view(np.int64),
                        "w2": np.array([digest(p, 2) for p in parts], np.uint64).view(np.int64),
                    }
                )

    windows = contexts.mapInArrow(explode, "t1 long, t2 long, n long, low int, w1 long, w2 long")
    often = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    found = windows.where("n = 1").join(often, ["w1", "w2"], "left_semi")
    return found.select("t1", "t2", "low", (F.col("low") + length).alias("high"))


def covers(texts: DataFrame, known: DataFrame, length: int, key: int) -> DataFrame:
    """(t1, t2, spans): low and high of runs of bytes of distinct texts that repeated windows cover."""
    made = anchor_table(texts, length, key)  # copies of a text repeat its anchors, as they repeat its windows
    one = [F.first(c).alias(c) for c in ("t1", "t2", "place", "low", "high")]
    kinds = made.groupBy("anchor", "context").agg(F.count("*").alias("n"), *one)
    kinds = stored(kinds, "anchor-kinds", compression="zstd")
    # Equal contexts: all their windows are repeats.
    equal = kinds.where("n > 1").select("anchor", "context")
    whole = made.join(equal, ["anchor", "context"], "left_semi")
    whole = whole.select("t1", "t2", "low", (F.col("high") + length).alias("high"))
    # Different contexts of one anchor: one of each kind is compared with the others.
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    wanted = kinds.join(mixed.select("anchor", "kinds"), "anchor").join(known.select("t1", "t2", "home"), ["t1", "t2"])
    wanted = stored(wanted, "wanted-contexts", compression="zstd")  # before the texts are shuffled
    cut = F.substring("text", F.col("low") + 1, F.col("high") - F.col("low") + length).alias("bytes")
    same = [texts[c] == wanted[c] for c in ("t1", "t2")] + [texts["doc_id"].eqNullSafe(wanted["home"])]
    contexts = texts.join(wanted, same).select("anchor", "context", wanted["t1"], wanted["t2"], "place", "low", "n", "kinds", cut)
    contexts = stored(contexts.dropDuplicates(["anchor", "context"]), "contexts", compression="zstd")
    few = compared(contexts.where(F.col("kinds") <= GROUP_CONTEXTS).drop("kinds"), length)
    many = hashed(contexts.where(F.col("kinds") > GROUP_CONTEXTS), length)
    found = whole.unionByName(few).unionByName(many)
    spans = found.groupBy("t1", "t2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    spans = stored(spans, "repeat-spans", compression="zstd")
    discard(made, kinds, wanted, contexts)
    return spans


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, key: int = KEY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which also starts anywhere else.

    Returns one row per document: doc_id, kept (the remaining bytes), n_bytes, n_removed and
    n_spans (maximal removed runs). Strings are judged on the texts as given, within documents and
    across them, overlaps included. Null and empty texts are empty; texts shorter than ``length``
    stay; a text that occurs twice, as another row or a repeated one, goes wholly if it is as long.
    Null ids stay null. An empty table gives no rows. Other columns are ignored.
    """
    texts = text_columns(documents(docs, id_col, text_col))
    known = texts.groupBy("t1", "t2").agg(F.min("doc_id").alias("home"), F.count("*").alias("copies"))
    known = stored(known, "distinct-texts")
    spans = covers(texts, known, length, key)
    copies = known.where("copies > 1").select("t1", "t2", "copies")
    marks = stored(spans.join(copies, ["t1", "t2"], "full"), "repeat-marks", compression="zstd")
    joined = texts.join(marks, ["t1", "t2"], "left").select("doc_id", "text", "spans", "copies")

    def clean(batches):
        for batch in batches:
            rows = []
            for text, spans, copies in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "copies"))):
                if copies and len(text) >= length:
                    rows.append((b"", len(text), len(text), 1))
                elif not spans:
                    rows.append((text, len(text), 0, 0))
                else:
                    low, high = merged(np.array([s["low"] for s in spans]), np.array([s["high"] for s in spans]))
                    begins = np.concatenate([[0], high]).tolist()
                    kept = b"".join([text[a:b] for a, b in zip(begins, [*low.tolist(), len(text)])])
                    rows.append((kept, len(text), len(text) - len(kept), len(low)))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 4, kinds)]
            yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(clean, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

