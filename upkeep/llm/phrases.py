"""Phrases of words that keep company, mined with stripes.

A stripe is a prefix of one to three words with a counter of the words that follow it, one of which
is the end of the piece. Tasks build stripes of the texts they hold, and stripes of equal prefixes
are merged element by element. One merged stripe gives the counts of all phrases that extend its
prefix, the count of the prefix itself (the sum of the counter) and the most frequent extension;
seen from their last words, the same entries give the most frequent extension to the left.

Prefixes are grown level by level. A phrase that occurs ``least`` times consists of words and
shorter phrases that do, so a task builds stripes only where the level before has set a bit: its
frequent phrases are hashed to 2 ** ``BITS`` bits, whatever their number. A wrong bit costs work and
changes no count. The counter of a prefix that is very frequent is cut into slices by the next
word, more of them the more frequent the prefix is, so that no task merges all of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import stored
from upkeep.llm.minhash import WordHashes, mixed
from upkeep.workspace import discard

LEAST, PERCENT, TOP, LONGEST = 30, 80, 2000, 4
#: Binary logarithm of the bits that tell frequent phrases.
BITS = 24
#: From how many occurrences a prefix is cut into how many slices.
SLICES = ((1 << 16, 16), (1 << 20, 256), (1 << 24, 4096))
#: Bytes of text whose stripes a task builds at once, and entries that it merges at once.
STEP_BYTES, STEP_ENTRIES = 8 << 20, 1 << 20
#: Parts of a language in which its phrases are ranked before all are.
RANK_PARTS = 64
BREAKS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"  # in no UTF-8 text
TO_END = bytes.maketrans(BREAKS, END * len(BREAKS))
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a sort key that tell the next word; those above tell the prefix.
PART_BITS = 24
PART_MASK = np.uint64((1 << PART_BITS) - 1)


def lang_hash(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 7))


def extended(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Hashes of phrases, each with one more word."""
    return mixed(h * FACTOR + ids + np.uint64(1))


def by_language(batches, work):
    """``work`` on a language and texts of it, some ``STEP_BYTES`` at a time."""
    waiting: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            text = text.as_py()
            waiting.setdefault(lang, []).append(text)
            size += len(text)
            if size >= STEP_BYTES:
                yield from (work(*some) for some in waiting.items())
                waiting, size = {}, 0
    yield from (work(*some) for some in waiting.items())


def words_of(texts: list[bytes]) -> list[bytes]:
    """The lowered words of all texts, with ``END`` after each piece."""
    return (END.join(texts) + END).lower().translate(TO_END).replace(END, b" \xff ").split()


def encoded(words: list[bytes], known: WordHashes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, their hashes (zero for ``END`` only), and for each word its number among them."""
    known[END] = 0
    codes = pa.array(words, pa.binary()).dictionary_encode()
    distinct = codes.dictionary.to_pylist()
    return codes.dictionary, np.fromiter(map(known.__getitem__, distinct), np.uint64, len(distinct)), np.asarray(codes.indices)


def word_ids(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Hashes of words; zero for ``END`` only."""
    _, hashes, codes = encoded(words, known)
    return hashes[codes]


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, id, word, n): every word of every language."""

    def count(batches):
        known = WordHashes()

        def work(lang, some):
            words, ids, codes = encoded(words_of(some), known)
            n = np.bincount(codes, minlength=len(ids))
            real = ids != 0
            words = words.filter(pa.array(real)).cast(pa.string())
            columns = [pa.array([lang] * len(words), pa.string()), pa.array(ids[real].view(np.int64)), words]
            return pa.record_batch([*columns, pa.array(n[real].astype(np.int64))], ["lang", "id", "word", "n"])

        yield from by_language(batches, work)

    made = texts.mapInArrow(count, "lang string, id long, word string, n long")
    return made.groupBy("lang", "id").agg(F.min("word").alias("word"), F.sum("n").alias("n"))


class Bits:
    """Bits of hashed phrases; a phrase whose bit is not set is not among them."""

    def __init__(self, words: np.ndarray, bits: int):
        self.data, self.mask = words.view(np.uint8), np.uint64((1 << bits) - 1)

    @staticmethod
    def of(phrases: DataFrame, bits: int) -> Bits:
        """From a column ``slot`` of hashes; at most 2 ** (``bits`` - 6) numbers come to the driver."""
        slot = F.col("slot").bitwiseAND(F.lit((1 << bits) - 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
        rows = phrases.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[np.asarray(rows.column("word"))] = np.asarray(rows.column("bits"))
        return Bits(words, bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h & self.mask
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrase_slots(entries: DataFrame) -> DataFrame:
    """(slot, n): the hashes of phrases given as (lang, ids, n)."""

    def find(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("ids")
            ids = np.asarray(lists.flatten()).view(np.uint64).reshape(batch.num_rows, -1)
            langs = batch.column("lang").dictionary_encode()
            seeds = np.array([lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)
            h = seeds[np.asarray(langs.indices)]
            for k in range(ids.shape[1]):
                h = extended(h, ids[:, k])
            yield pa.record_batch({"slot": h.view(np.int64), "n": batch.column("n")})

    return entries.select("lang", "ids", "n").mapInArrow(find, "slot long, n long")


STRIPE = "lang string, prefix array<long>, slice int, slices int, next array<long>, counts array<long>"


def lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Lists of ``values`` that begin at ``starts``."""
    return pa.ListArray.from_arrays(np.append(starts, len(values)).astype(np.int32), pa.array(values))


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if len(columns[0]) else np.zeros(0, np.int64)


def stripes(texts: DataFrame, length: int, frequent: Bits, hot: list[tuple[int, Bits]]) -> DataFrame:
    """Stripes of all prefixes of ``length`` words that may be frequent, as tasks see them."""

    def build(batches):
        known = WordHashes()

        def work(lang, some):
            ids = word_ids(words_of(some), known)
            n = len(ids)
            ids = np.concatenate([ids, np.zeros(length, np.uint64)])
            h, whole = np.full(n + length, lang_hash(lang)), np.ones(n + length, bool)
            for k in range(length):
                word = np.concatenate([ids[k:], np.zeros(k, np.uint64)])
                h, whole = extended(h, word), whole & (word != 0)
            whole[whole] = frequent.has(h[whole])
            at = np.flatnonzero(whole)
            after = np.where(whole[at + 1], ids[at + length], np.uint64(0))  # no phrase goes on from here
            prefix = h[at]
            # Equal entries, slices and prefixes side by side, by one sort; a slice is a range of ``part``.
            # Where different ones should share a number they stay apart.
            part = mixed(after) & PART_MASK
            order = np.argsort((prefix & ~PART_MASK) | part)
            at, after, prefix, part = at[order], after[order], prefix[order], part[order]
            first = starts_of(after, *[ids[at + k] for k in range(length)])
            counts = np.diff(np.append(first, len(order)))
            at, after, prefix, part = at[first], after[first], prefix[first], part[first]
            slices = np.ones(len(at), np.int64)
            for number, bits in hot:
                slices[bits.has(prefix)] = number
            piece = (part.astype(np.int64) * slices) >> PART_BITS
            parts = [ids[at + k] for k in range(length)]
            first = starts_of(piece, *parts)
            prefixes = np.stack([p[first] for p in parts], 1).view(np.int64).ravel()
            columns = [
                pa.array([lang] * len(first), pa.string()),
                lists(prefixes, np.arange(len(first)) * length),
                pa.array(piece[first].astype(np.int32)),
                pa.array(slices[first].astype(np.int32)),
                lists(after.view(np.int64), first),
                lists(counts.astype(np.int64), first),
            ]
            return pa.record_batch(columns, ["lang", "prefix", "slice", "slices", "next", "counts"])

        yield from by_language(batches, work)

    return texts.mapInArrow(build, STRIPE)


def merged_stripes(made: DataFrame, length: int, least: int) -> DataFrame:
    """One row per prefix and slice: total, and the extensions that occur ``least`` times or more."""

    def merge(batches):
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            kept.append(batch)
            size += len(batch.column("next").flatten())
            if size >= STEP_ENTRIES:
                whole = summed(pa.Table.from_batches(kept).combine_chunks())
                last = whole.num_rows - 1  # more of it may follow
                yield finished(whole.slice(0, last))
                kept = [whole.slice(last)]
                size = len(kept[0].column("next").flatten())
        if kept:
            yield finished(summed(pa.Table.from_batches(kept).combine_chunks()))

    def summed(rows):
        """Rows of equal prefix and slice, which follow each other, as one."""
        n = rows.num_rows
        column = lambda c: rows.column(c).chunk(0) if n else pa.array([], rows.schema.field(c).type)
        prefix = np.asarray(column("prefix").flatten()).reshape(-1, length)
        langs = column("lang").dictionary_encode()
        first = starts_of(np.asarray(langs.indices), np.asarray(column("slice")), *prefix.T)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
        entry = np.repeat(group, np.asarray(column("next").value_lengths()))
        after, counts = np.asarray(column("next").flatten()), np.asarray(column("counts").flatten())
        order = np.lexsort((after, entry))
        entry, after, counts = entry[order], after[order], counts[order]
        run = starts_of(entry, after)
        counts = np.add.reduceat(counts, run) if len(run) else counts
        entry, after = entry[run], after[run]
        begins = np.searchsorted(entry, np.arange(len(first)))
        take = pa.array(first)
        columns = [column(c).take(take) for c in ("lang", "prefix", "slice", "slices")]
        columns += [lists(after, begins), lists(counts, begins)]
        return pa.record_batch(columns, ["lang", "prefix", "slice", "slices", "next", "counts"])

    def finished(rows):
        """Without rare extensions and rare prefixes."""
        counts, after = np.asarray(rows.column("counts").flatten()), np.asarray(rows.column("next").flatten())
        sizes = np.asarray(rows.column("counts").value_lengths())
        group, ends = np.repeat(np.arange(rows.num_rows), sizes), np.cumsum(sizes)
        summed_up = np.concatenate([[0], np.cumsum(counts)])
        total = summed_up[ends] - summed_up[ends - sizes]
        often = (counts >= least) & (after != 0)
        begins = np.searchsorted(group[often], np.arange(rows.num_rows))
        columns = [rows.column("lang"), rows.column("prefix"), pa.array(total)]
        columns += [lists(after[often], begins), lists(counts[often], begins)]
        keep = pa.array((total >= least) | (np.asarray(rows.column("slices")) > 1))
        return pa.record_batch(columns, ["lang", "prefix", "total", "next", "counts"]).filter(keep)

    key = ["lang", "prefix", "slice"]
    # Sorted by a number first: languages and lists are compared only where it is equal.
    rows = made.repartition(*key).withColumn("hash", F.xxhash64(*key)).sortWithinPartitions("hash", *key).drop("hash")
    return rows.mapInArrow(merge, "lang string, prefix array<long>, total long, next array<long>, counts array<long>")


def hot_bits(slots: DataFrame) -> list[tuple[int, Bits]]:
    """For each number of slices the prefixes that are cut into so many."""
    found = [(slices, slots.where(F.col("n") >= least)) for least, slices in SLICES]
    return [(slices, Bits.of(some, 16)) for slices, some in found]


def phrase_table(texts: DataFrame, words: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, ids, f, longer) of frequent phrases below ``longest`` words, and (lang, ids, a) of two words or more.

    ``longer``: occurrences of the most frequent phrase with one word more on either side.
    """
    level = words.where(F.col("n") >= least).select("lang", F.array("id").alias("ids"), "n")
    known, phrases, frames = [], [], []
    for length in range(1, longest):
        slots = stored(phrase_slots(level), "phrase-slots")
        made = stripes(texts, length, Bits.of(slots, BITS), hot_bits(slots))
        found = stored(merged_stripes(made, length, least), "stripes", compression="zstd")
        entry = F.explode(F.arrays_zip(F.col("next"), F.col("counts"))).alias("e")
        level = found.select("lang", "prefix", entry)
        level = level.select("lang", F.concat("prefix", F.array("e.next")).alias("ids"), F.col("e.counts").alias("n"))
        totals = found.select("lang", F.col("prefix").alias("ids"), F.col("total").alias("f"), F.array_max("counts").alias("longer"))
        left = level.select("lang", F.slice("ids", 2, length).alias("ids"), F.lit(0).cast("long").alias("f"), F.col("n").alias("longer"))
        known += [totals, left]
        phrases.append(level.select("lang", "ids", F.col("n").alias("a")))
        frames.append(found)
        discard(slots)
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    sums = union(known).groupBy("lang", "ids").agg(F.sum("f").alias("f"), F.max("longer").alias("longer"))
    known = stored(sums, "phrase-counts", compression="zstd")
    phrases = stored(union(phrases), "phrases", compression="zstd")
    discard(*frames)
    return known, phrases


def exact(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,0)")


def scored(known: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, ids, a, score, l, r) of all phrases, by their lowest-scoring cut."""
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = cuts.withColumn("head", F.slice("ids", F.lit(1), F.col("k")))
    cuts = cuts.withColumn("tail", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    part = lambda ids, f: known.select("lang", F.col("ids").alias(ids), F.col("f").alias(f))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    top = (exact("a") * F.lit(2_000_000).cast("decimal(7,0)")).alias("top")
    score = F.call_function("div", top, exact("l") + exact("r"))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "ids", "a").agg(best).select("lang", "ids", "a", "best.score", "best.l", "best.r")


def spelled(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``phrase``, the words behind ``ids``, joined by spaces."""
    parts = rows.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
    placed = F.sort_array(F.collect_list(F.struct("at", "word")))
    phrase = F.array_join(F.transform(placed, lambda x: x["word"]), " ").alias("phrase")
    return rows.join(parts.groupBy("lang", "ids").agg(phrase), ["lang", "ids"])


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST,
    percent: int = PERCENT,
    top: int = TOP,
    longest: int = LONGEST,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Texts are lowered (A-Z only) and split into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. ``a`` counts the occurrences of a phrase of 2 to ``longest`` words
    within pieces, overlaps included; phrases below ``least`` are left out. ``l`` and ``r`` count the
    two parts of the cut with the lowest score, floor(2,000,000 a / (l + r)), the earliest of equals.
    A phrase goes if one that contains it has ``percent`` per cent of its occurrences or more. ``n``
    counts all words of the language. ``top`` phrases of a language stay, by score, then a, then
    the phrase's bytes.

    A null language is ``und``; null and empty texts and texts without words add nothing. Repeated
    rows count as often as they occur. An empty table gives no rows. Other columns are ignored.
    Words are told apart by 64-bit hashes.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counts = stored(word_counts(texts), "word-counts", compression="zstd")
    all_words = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(counts.where(F.col("n") >= least), "frequent-words")
    known, phrases = phrase_table(texts, words, least, longest)
    # A phrase held by a longer one is held by one that has a single word more and occurs no less often.
    longer = known.select("lang", "ids", "longer")
    held = F.coalesce(exact("longer") * 100 >= exact("a") * percent, F.lit(False))
    left = phrases.join(longer, ["lang", "ids"], "left").where(~held).drop("longer")
    rows = stored(spelled(scored(known, left), words), "scored-phrases", compression="zstd")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    best = first.where(F.col("rank") <= top).drop("rank")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    found = ranked.where(F.col("rank") <= top).join(all_words, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
