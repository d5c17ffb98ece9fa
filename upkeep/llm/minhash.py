"""MinHash near-duplicates by tensored banding.

A set of shingles gets two collections of ``HALVES`` half keys, each made of ``ROWS`` minhashes. A
table's key is a pair, one half key of either collection, so ``2 * HALVES * ROWS`` minhashes give
``HALVES`` squared tables of keys over ``2 * ROWS`` minhashes each; tables of their own would take
``HALVES`` times as many minhashes. Two sets meet if they share a half key on both sides. Sets of
similarity 0.85 miss each other with a chance of 2 in 100,000, more similar ones more rarely.

Half keys of the first collection that no other set has are dropped before pairs are formed, so a
set that resembles nothing costs ``HALVES`` keys and not their square. Candidates are verified in
two rounds. First every set of a bucket is compared with one of its members only, the one that
meets most other sets: groups of copies join through it, however large. Then only pairs whose ends
are still in different components are looked at, which is all that can change a component. A task
compares the sets of a half key in place, those whose minhashes agree often enough on the full
sets, and returns a forest of the links; half keys above ``CELL`` sets are dealt as pairs of
blocks. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import documents, stored
from upkeep.llm.components import components
from upkeep.workspace import discard

SHINGLE, PERCENT = 5, 85
#: Half keys of each collection, and minhashes of a half key.
HALVES, ROWS = 12, 3
SIGNATURE = 2 * HALVES * ROWS
SEED = 42
#: Sets of a bucket that one task compares at once, pairs of one set that share a task, and
#: shingles whose minhashes are computed in one step.
CELL, PAIRS, STEP = 2048, 1024, 8192
#: Binary logarithm of the bits that tell which texts are read again.
BITS = 24


def multipliers(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` hash functions, the same everywhere."""
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, (2, count), np.uint64, endpoint=False)
    return drawn[0] | np.uint64(1), drawn[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer: every bit of the input changes half of the output's bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words; a worker keeps those of short ones, up to a number."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh64_intdigest(word, SEED)
        if len(word) < 64 and len(self) < 1_000_000:
            self[word] = found
        return found


def shingle_set(text: bytes, known: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a UTF-8 text's distinct shingles; the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    factors = multipliers(shingle)[0]
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total += mixed(hashes[k : len(words) - size + 1 + k] + np.uint64(k)) * factors[k]
    return np.unique(mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minhashes of each set (none of them empty) as rows of unsigned 32-bit numbers."""
    factor, offset = multipliers(SIGNATURE, SEED + 1)
    found = np.full((len(sets), SIGNATURE), np.iinfo(np.uint32).max, np.uint32)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for start in range(0, len(every), STEP):
        some, own = every[start : start + STEP], owner[start : start + STEP]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        values = np.multiply.outer(factor, some)
        values += offset[:, None]
        values >>= np.uint64(32)
        least = np.minimum.reduceat(values, first, axis=1).astype(np.uint32).T
        found[own[first]] = np.minimum(found[own[first]], least)
    return found


def half_keys(signature: np.ndarray) -> np.ndarray:
    """The half keys of rows of minhashes: ``HALVES`` of the first collection, then of the second."""
    parts = signature.reshape(len(signature), 2 * HALVES, ROWS).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k] + np.uint64(1))
    return key


def set_table(docs: DataFrame, shingle: int) -> DataFrame:
    """Every row's doc_id, hashes of its text (t1, t2) and set (s1, s2), set size and minhashes."""

    def make(batches):
        import xxhash

        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), known, shingle) for t in batch.column("text")]
            names = [xxhash.xxh128_intdigest(s.tobytes()) for s in sets]
            mask = (1 << 64) - 1
            filled = [i for i, s in enumerate(sets) if len(s)]
            minima = [None] * len(sets)
            if filled:
                for i, row in zip(filled, signatures([sets[i] for i in filled])):
                    minima[i] = row.astype("<u4").tobytes()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "t1": batch.column("t1"),
                    "t2": batch.column("t2"),
                    "s1": np.array([n & mask for n in names], np.uint64).view(np.int64),
                    "s2": np.array([n >> 64 for n in names], np.uint64).view(np.int64),
                    "n_shingles": np.array([len(s) for s in sets], np.int64),
                    "signature": pa.array(minima, pa.binary()),
                }
            )

    rows = docs.select("doc_id", *text_hashes(), F.col("text").cast("binary").alias("text"))
    made = rows.mapInArrow(
        make, "doc_id long, t1 long, t2 long, s1 long, s2 long, n_shingles long, signature binary"
    )
    return stored(made, "minhash-sets", compression="zstd")


def text_hashes() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, part, half, node, size): the tables' keys that several sets have, with their first half."""

    def halves(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = half_keys(unpacked(batch.column("signature"))).view(np.int64)
            seconds = pa.array(np.repeat(keys[:, HALVES:], HALVES, axis=0).ravel())
            yield pa.record_batch(
                {
                    "node": np.repeat(np.asarray(batch.column("node")), HALVES),
                    "part": np.tile(np.arange(HALVES, dtype=np.int32), n),
                    "half": keys[:, :HALVES].ravel(),
                    "seconds": pa.ListArray.from_arrays(np.arange(0, len(seconds) + 1, HALVES, dtype=np.int32), seconds),
                }
            )

    firsts = nodes.select("node", "signature").mapInArrow(halves, "node long, part int, half long, seconds array<long>")
    shared = firsts.groupBy("part", "half").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    shared = stored(shared.select("part", "half"), "shared-halves")  # so that adaptive execution can split the join
    pairs = firsts.join(shared, ["part", "half"], "left_semi")
    pairs = pairs.select("node", "part", "half", F.posexplode("seconds").alias("other", "second"))
    keys = pairs.select(F.xxhash64("part", "half", "other", "second").alias("bucket"), "part", "half", "node")
    keys = stored(keys, "bucket-keys", compression="zstd")
    sizes = stored(keys.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket-sizes")
    rows = stored(keys.join(sizes, "bucket"), "buckets", compression="zstd")
    discard(shared, keys, sizes)
    return rows


def unpacked(column: pa.Array) -> np.ndarray:
    """A column of minhashes as a table of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), SIGNATURE)


def leader_pairs(buckets: DataFrame) -> DataFrame:
    """Distinct (u, v): every set of a bucket with the member that meets most other sets, over all buckets."""
    meets = stored(buckets.groupBy("node").agg(F.sum("size").alias("meets")), "meetings")
    known = buckets.join(meets, "node")
    leader = known.groupBy("bucket").agg(F.max(F.struct("meets", (-F.col("node")).alias("u"))).alias("best"))
    leader = stored(leader.select("bucket", (-F.col("best.u")).alias("u")), "leaders")
    pairs = buckets.join(leader, "bucket").where("u <> node")
    pairs = stored(pairs.select("u", F.col("node").alias("v")).distinct(), "leader-pairs")
    discard(meets, leader)
    return pairs


def agreeing(percent: int) -> int:
    """Minhashes that have to agree: 5.5 standard deviations below what ``percent`` gives on average."""
    share = percent / 100
    return max(0, int(share * SIGNATURE - 5.5 * (share * (1 - share) * SIGNATURE) ** 0.5))


def pairs_in_cells(rows: dict[str, np.ndarray], signature: np.ndarray, percent: int):
    """Yields index pairs of rows in different components that may be links, within runs of equal ``cell``.

    ``rows`` hold sets that share the first half key of table ``part``, sorted by cell. Pairs are
    found by equal second half keys. One is taken in the first table that it shares only, and only
    if its set sizes and minhashes allow the similarity. Rows of a cell that was dealt as two blocks
    have side 0 and 1; only pairs across are taken there.
    """
    n, least = len(signature), agreeing(percent)
    second = half_keys(signature)[:, HALVES:].ravel()
    row, other_part = np.repeat(np.arange(n), HALVES), np.tile(np.arange(HALVES), n)
    order = np.lexsort((rows["root"][row], second, other_part, rows["cell"][row]))
    row, other_part, second = row[order], other_part[order], second[order]
    cell, root = rows["cell"][row], rows["root"][row]
    new = (cell[1:] != cell[:-1]) | (other_part[1:] != other_part[:-1]) | (second[1:] != second[:-1])
    ends = lambda new: np.append(np.flatnonzero(new) + 1, len(row))
    spread = lambda ends: np.repeat(ends, np.diff(ends, prepend=0))
    end, other = spread(ends(new)), spread(ends(new | (root[1:] != root[:-1])))  # first row of a later root
    here = np.arange(len(row))
    while True:
        inside = other < end[here]
        here, other = here[inside], other[inside]
        if not len(here):
            return
        for some in np.array_split(np.arange(len(here)), len(here) // 50_000 + 1):
            x, y = row[here[some]], row[other[some]]
            low, high = np.minimum(rows["size"][x], rows["size"][y]), np.maximum(rows["size"][x], rows["size"][y])
            fits = (100 * low >= percent * high) & ((rows["side"][x] < 0) | (rows["side"][x] != rows["side"][y]))
            x, y, last = x[fits], y[fits], other_part[here[some]][fits]
            same = signature[x] == signature[y]
            close = same.sum(1) >= least
            x, y, last = x[close], y[close], last[close]
            halves = same[close].reshape(len(x), 2, HALVES, ROWS).all(3)
            first = halves.argmax(2)  # of each collection the first half key that agrees
            mine = (first[:, 0] == rows["part"][x]) & (first[:, 1] == last)
            yield x[mine], y[mine]
        other = other + 1


def shared_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many shingles the sets at ``x`` and ``y`` share, pair by pair."""
    order = np.argsort(x, kind="stable")
    found = np.zeros(len(x), np.int64)
    for some in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        mine = sets[x[some[0]]]
        for few in np.array_split(some, len(some) // 500 + 1):
            others = [sets[i] for i in y[few]]
            every = np.concatenate(others)
            place = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
            sizes = np.cumsum([0, *map(len, others[:-1])])
            found[few] = np.add.reduceat((mine[place] == every).astype(np.int64), sizes)
    return found


class Forest(dict):
    """Joins nodes; ``add`` tells whether a link joined two trees."""

    def top(self, node: int) -> int:
        while node in self:
            node = self[node]
        return node

    def add(self, u: int, v: int) -> bool:
        u, v = self.top(u), self.top(v)
        if u != v:
            self[max(u, v)] = min(u, v)
        return u != v


def further_links(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, roots: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Links (u, v) between components, as a forest of each cell.

    A cell are the sets that share a first half key and, somewhere, a bucket with a set of another
    component. Their pairs are compared in place, on the full sets, and never listed.
    """
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted.drop("size"), "bucket-roots", compression="zstd")
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    open_ = stored(open_.select("bucket"), "open-buckets")
    rows = rooted.join(open_, "bucket", "left_semi").select("part", "half", "node", "root").distinct()
    rows = stored(rows, "open-rows")
    sizes = stored(rows.groupBy("part", "half").agg(F.count("*").alias("n")), "open-sizes")
    blocks = F.when(F.col("n") <= CELL, 1).otherwise(F.ceil(F.col("n") / (CELL // 2))).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, ["part", "half"]).withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("part", "half", "node", "root", "own", other)
    cell = F.xxhash64("part", "half", F.least("own", "other"), F.greatest("own", "other")).alias("cell")
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")
    sized = nodes.select("node", F.col("n_shingles").alias("size"), "signature")
    names = ["cell", "part", "node", "root", "side"]
    dealt = dealt.select(cell, "part", "node", "root", side)

    def columns(batch):
        rows = {c: np.asarray(batch.column(c)) for c in (*names, "size")}
        return rows, pairs_in_cells(rows, unpacked(batch.column("signature")), percent)

    def paired(batch):
        rows, pairs = columns(batch)
        meets = np.zeros(batch.num_rows, bool)
        for x, y in pairs:
            meets[x] = meets[y] = True
        return pa.record_batch({c: rows[c][meets] for c in names})

    def links(batch):
        sets = [np.frombuffer(s.as_buffer(), "<u8") for s in batch.column("shingles")]
        rows, pairs = columns(batch)
        forest, found = Forest(), []
        for x, y in pairs:
            if len(x):
                shared = shared_counts(sets, x, y)
                linked = 100 * shared >= percent * (rows["size"][x] + rows["size"][y] - shared)
                ends = zip(rows["node"][x[linked]].tolist(), rows["node"][y[linked]].tolist())
                found += [pair for pair in ends if forest.add(*pair)]
        us, vs = zip(*found) if found else ((), ())
        return pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    # Only sets whose minhashes agree with another one's are read and sent to their cells.
    close = cell_by_cell(dealt.join(sized, "node"), paired, "cell long, part int, node long, root long, side int")
    close = stored(close, "close-rows")
    sets = full_sets(docs, nodes, close.select("node"), shingle)
    found = cell_by_cell(close.join(sized, "node").join(sets, "node"), links, "u long, v long")
    found = stored(found, "further-links")
    discard(rooted, open_, rows, sizes, close, sets)
    return found


def cell_by_cell(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on Arrow batches of whole cells."""

    def run(batches):
        kept = None
        for batch in batches:
            kept = batch if kept is None else pa.concat_batches([kept, batch])
            cells = np.asarray(kept.column("cell"))
            ready = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            if ready:
                yield work(kept.slice(0, ready))
                kept = kept.slice(ready)
        if kept is not None and kept.num_rows:
            yield work(kept)

    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, schema)


def full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): the sets of the ``wanted`` nodes, as sorted 64-bit hashes.

    Texts are shuffled only if their hash falls on a bit that a wanted one has set. There are
    2 ** ``BITS`` bits, so the table that is broadcast has 2 ** (``BITS`` - 6) rows at most.
    """
    key = F.xxhash64("doc_id", "t1", "t2").alias("key")
    wanted = nodes.join(wanted.distinct(), "node", "left_semi").select("node", "home.*")
    wanted = stored(wanted.select("node", key, "t1", "t2"), "wanted-sets")
    slot = F.pmod(F.col("key"), F.lit(1 << BITS))
    word, bit = F.shiftright(slot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    bits = stored(wanted.groupBy(word).agg(F.bit_or(bit).alias("bits")), "wanted-bits")
    texts = docs.select("doc_id", "text", *text_hashes()).select("text", key, "t1", "t2")
    texts = texts.withColumn("bit", bit).withColumn("word", word)
    texts = texts.join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    # Of repeated rows one; their texts lie where the join has brought them.
    keys = ["key", "t1", "t2"]
    found = texts.select(*keys, "text").join(wanted, keys).dropDuplicates(keys)
    found = found.select("node", F.col("text").cast("binary").alias("text"))

    def make(batches):
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), known, shingle).tobytes() for t in batch.column("text")]
            yield pa.record_batch({"node": batch.column("node"), "shingles": pa.array(sets, pa.binary())})

    sets = stored(found.mapInArrow(make, "node long, shingles binary"), "full-sets")
    discard(wanted, bits)
    return sets


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (u, v) among ``pairs``: ``percent`` of the union or more is shared.

    Pairs of one u are dealt to several tasks, ``PAIRS`` to each; its set comes first there and
    those of the others stream past it.
    """
    many = stored(pairs.groupBy("u").agg(F.count("*").alias("n")), "pair-counts")
    share = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / PAIRS)).cast("int").alias("share")
    dealt = stored(pairs.join(many, "u").select("u", "v", share), "dealt-pairs")
    firsts = dealt.select("u", "share").distinct().select("u", "share", F.lit(None).cast("long").alias("v"), F.col("u").alias("node"))
    others = dealt.select("u", "share", "v", F.col("v").alias("node"))
    rows = firsts.unionByName(others).join(sets, "node").select("u", "share", "v", "shingles")
    rows = rows.repartition("u", "share").sortWithinPartitions("u", "share", F.col("v").asc_nulls_first())

    def check(batches):
        mine = None
        for batch in batches:
            links = []
            for u, v, data in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), batch.column("shingles")):
                some = np.frombuffer(data.as_buffer(), "<u8")
                if v is None:
                    mine = some
                    continue
                small, large = (some, mine) if len(some) < len(mine) else (mine, some)
                if 100 * len(small) < percent * len(large):
                    continue
                place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[place] == small).sum())
                if 100 * shared >= percent * (len(small) + len(large) - shared):
                    links.append((u, v))
            us, vs = zip(*links) if links else ((), ())
            yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    links = stored(rows.mapInArrow(check, "u long, v long"), "links")
    discard(many, dealt)
    return links


def near_duplicate_sets(
    docs: DataFrame,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    A row's set are the distinct runs of ``shingle`` words of its lowered text (A-Z only); fewer
    words make one run. Rows are linked if their sets share ``percent`` per cent of their union or
    more; component_id is the smallest doc_id that a row reaches over links, its own included, and
    kept tells whether it is the row's own. Null and empty texts and texts without words have an
    empty set and are linked with nothing. A null doc_id counts for no minimum; a component of
    null ids only has a null id and its rows are kept. Repeated rows stay, each with the same
    result. An empty table gives no rows. Other columns are ignored.

    Words and runs are told apart by 64-bit hashes, sets by 128 bits.
    """
    texts = documents(docs, id_col, text_col)
    made = set_table(texts, shingle)
    known = made.where("n_shingles > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.min(F.struct("doc_id", "t1", "t2", "signature")).alias("home"),
    )
    number = F.monotonically_increasing_id().alias("node")
    nodes = known.select(number, "s1", "s2", "first", "n_shingles", "home", F.col("home.signature").alias("signature"))
    nodes = stored(nodes.withColumn("home", F.col("home").dropFields("signature")), "distinct-sets", compression="zstd")
    buckets = bucket_rows(nodes)
    pairs = leader_pairs(buckets)
    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))
    sets = full_sets(texts, nodes, ends, shingle)
    roots = components(confirmed(pairs, sets, percent))
    discard(sets, pairs)
    more = further_links(texts, nodes, buckets, roots, percent, shingle)
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
    discard(buckets)
    rooted = nodes.select("node", "s1", "s2", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    classes = stored(rooted.join(least, "root").select("s1", "s2", "least"), "set-classes")
    rows = made.select("doc_id", "s1", "s2", "n_shingles").join(classes, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
