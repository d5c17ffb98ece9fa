"""Quality rules by hashed n-gram log-likelihood ratios.

Words and word pairs are hashed into buckets. Two multinomials over the buckets are counted: one
from documents that labels trust, one from all documents. A document's score is the mean over its
n-grams of the log ratio of both, so it does not depend on the length. The threshold is a quantile
of the scores of the trusted documents themselves, each scored without its own counts, as an
unlabelled document is; so the same share of good documents is lost in small and in large tables.

A mean cannot tell documents of good prose that differ by a few words. Words that labelled toxic
documents hold much more often than trusted ones are therefore found by their log-likelihood ratio,
and a document that holds one of them goes. All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.common import MARKS, bit_hits, bit_table, documents, fresh, let, numbers, stored, word_array
from upkeep.workspace import discard

BUCKETS = 1 << 16
#: Count added to every bucket of both multinomials.
SMOOTHING = 0.5
#: Log ratios are rounded to 1/UNIT, so that sums do not depend on an order.
UNIT = 1000
#: Share of held-out trusted documents whose mean log ratio is below the threshold.
LOSS = 0.02
#: Parts that a range of scores is cut into; as many scores or fewer are sorted by the driver.
BINS = 4096
#: Least ratio of a word's share of toxic documents and its share of trusted ones.
TOXIC_RATIO = 20
#: Fewer toxic documents than this do not make a word toxic.
TOXIC_DOCS = 3
MIN_WORDS = 50
MAX_REPEATED = 50


def bucket(key: Column) -> Column:
    """The bucket of a 64-bit hash."""
    return key.bitwiseAND(F.lit(BUCKETS - 1))


def neighbours(values: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of every element and the one after it."""
    size = F.size(values)
    return F.zip_with(F.slice(values, F.lit(1), F.greatest(size - 1, F.lit(0))), F.slice(values, F.lit(2), size), body)


def hashed(found: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the 64-bit hashes of all words, and those of all pairs of neighbours; both are computed once."""
    singles = F.transform(found, lambda w: F.xxhash64(w))
    return let(singles, lambda s: let(neighbours(found, lambda a, b: F.xxhash64(a, b)), lambda p: body(s, p)))


def repeated_words(pairs: Column) -> Column:
    """Words covered by windows of three words that occur twice or more, from the hashes of all pairs.

    Windows are compared by a 64-bit hash of their two pairs' hashes.
    """

    def covered(hashes: Column) -> Column:
        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"]))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"))
        return let(places, lambda s: F.aggregate(positions(s), start, step, lambda a: a["n"]))

    hashes = neighbours(pairs, lambda a, b: F.xxhash64(a, b))
    distinct = lambda h: F.size(F.array_distinct(h)) == F.size(h)
    return let(hashes, lambda h: F.when(distinct(h), 0).otherwise(covered(h))).cast("long")


def base_columns(text: Column, found: Column, pairs: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(MARKS)) != "")
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.char_length(F.array_join(found, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(pairs),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEATED)


def marked(docs: DataFrame, id_col: str, text_col: str, **marks: DataFrame) -> DataFrame:
    """The texts of all rows whose id a frame of ``marks`` holds in its column ``doc_id``; for each mark, whether that one does.

    Ids are told by two sets of bits: those of a mark's ids, and those of the other ids of documents
    that fall on them. Texts are joined with the ids, and shuffled, only if theirs falls on both.
    """
    ids = [x.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.lit(m == name).alias(m) for m in marks]) for name, x in marks.items()]
    ids = reduce(DataFrame.unionByName, ids).dropna(subset=["doc_id"]).groupBy("doc_id").agg(*[F.bool_or(m).alias(m) for m in marks])
    ids = stored(ids, "labelled-ids")
    texts, slot = documents(docs, id_col, text_col), F.xxhash64("doc_id")
    first = {m: ids.where(m) for m in marks}
    falling = bit_hits(texts.select("doc_id").dropna(), slot, bit_table(slot, **first))
    held = ids.select("doc_id", *[F.col(m).alias(f"is_{m}") for m in marks])
    falling = falling.join(held, "doc_id", "left")
    wrong = {f"no_{m}": falling.where(F.col(m) & ~F.coalesce(f"is_{m}", F.lit(False))) for m in marks}
    wrong = stored(bit_table(slot, **wrong), "label-bits")
    bits = stored(bit_table(slot, **first).join(wrong, "word", "left").na.fill(0), "label-bits")
    found = bit_hits(texts, slot, bits)
    unsure = reduce(Column.__or__, [F.col(m) & F.col(f"no_{m}") for m in marks])
    sure = found.where(~unsure & reduce(Column.__or__, [F.col(m) for m in marks])).select("text", *marks)
    return sure.unionByName(found.where(unsure).select("doc_id", "text").join(ids, "doc_id").select("text", *marks))


def graded(texts: DataFrame) -> DataFrame:
    """``texts`` with ``grams``, the buckets of their n-grams, and ``sound``: whether they pass the base rules."""

    def grades(found: Column, singles: Column, pairs: Column) -> Column:
        grams = F.transform(F.concat(singles, pairs), lambda h: bucket(h).cast("int"))
        return F.struct(grams.alias("grams"), (~base_failed(F.size(found), repeated_words(pairs))).alias("sound"))

    grade = let(word_array(F.col("text")), lambda f: hashed(f, lambda s, p: grades(f, s, p)))
    return texts.withColumn("grade", grade).select(*texts.columns, "grade.*")


def by_bucket(grams: DataFrame) -> list[int]:
    """How often each value of the column ``bucket`` occurs."""
    counts = [0] * BUCKETS
    for place, n in grams.groupBy("bucket").count().where("bucket is not null").collect():
        counts[place] = n
    return counts


def counted(texts: DataFrame) -> list[int]:
    """Counts of the n-grams by bucket. Words become rows beside the next word, so that Spark compiles all of it."""
    words = texts.select(word_array(F.col("text")).alias("word"))
    after = F.slice("word", F.lit(2), F.size("word")).alias("next")
    rows = words.select(F.explode(F.arrays_zip("word", after)).alias("x"))
    place = lambda *w: F.pmod(F.xxhash64(*w), F.lit(BUCKETS)).cast("int")
    pair = F.when(F.col("x.next").isNotNull(), place("x.word", "x.next"))
    return by_bucket(rows.select(F.explode(F.array(place("x.word"), pair)).alias("bucket")))


def bucket_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[int], list[int]]:
    """Counts of the trusted and of all n-grams by bucket."""
    return counted(marked(docs, id_col, text_col, trusted=trusted)), counted(documents(docs, id_col, text_col))


def ratios_of(target: list[int], raw: list[int]) -> list[int]:
    extra = SMOOTHING * BUCKETS
    shift = math.log(sum(raw) + extra) - math.log(sum(target) + extra)
    return [round(UNIT * (math.log((t + SMOOTHING) / (r + SMOOTHING)) + shift)) for t, r in zip(target, raw)]


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """The log ratio of trusted and raw probability by bucket, in units of 1/UNIT.

    ``trusted`` holds ids in its column ``doc_id``; all of them are used. All documents count as
    raw. The result has ``BUCKETS`` numbers whatever the input.
    """
    return ratios_of(*bucket_counts(docs, trusted, id_col, text_col))


def constants(values: list, kind: str = "long") -> Column:
    """One constant array, which expressions over rows can index; its size is a parameter."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def looked_up(spark: SparkSession, values: list, kind: str = "long") -> Column:
    """The same array as a scalar subquery, for lookups at random places: its numbers lie side by side in memory.

    A constant's numbers are objects, which do not fit into a core's cache. Expressions over arrays
    take no subquery, so it has to be a column of its own before one uses it, once, by ``let``. The
    numbers come as an Arrow table, as a plan holds a constant in all its descriptions, which the
    driver keeps: megabytes for each query.
    """
    column = pa.array([values], pa.list_(pa.float64() if kind == "double" else pa.int64()))
    return spark.createDataFrame(pa.table({"values": column})).scalar()


def mean_ratio(singles: Column, pairs: Column, ratios: Column) -> Column:
    """The mean of the ratios of all hashes' buckets; null without any."""
    add = lambda a, h: a + ratios[bucket(h)]
    total = F.aggregate(pairs, F.aggregate(singles, F.lit(0).cast("long"), add), add)
    size = (F.size(singles) + F.size(pairs)).cast("long")
    return F.when(size > 0, total / (size * UNIT))


def value_at(values: DataFrame, rank: int) -> float:
    """The value of the only column, ``score``, that ``rank`` others precede in order.

    Ranges that hold it are cut into ``BINS`` parts until few values are left, so that neither the
    driver nor a task gets more of them. ``values`` is read several times.
    """
    low, high, n = values.agg(F.min("score"), F.max("score"), F.count("score")).first()
    while low < high and n > BINS:
        part = F.floor((F.col("score") - low) / (high - low) * BINS).alias("part")
        inside = values.where(F.col("score").between(low, high))
        for _, low, high, n in inside.groupBy(part).agg(F.min("score"), F.max("score"), F.count("*")).orderBy("part").collect():
            if rank < n:
                break
            rank -= n
    return low if low == high else sorted(r[0] for r in values.where(F.col("score").between(low, high)).collect())[rank]


def quantile(values: DataFrame, share: float) -> float | None:
    """The exact quantile of the column ``score``, between two values the weighted mean of both; None without values."""
    n = values.count()
    if not n:
        return None
    place = (n - 1) * share
    lower, upper = math.floor(place), math.ceil(place)
    if lower == upper:
        return value_at(values, lower)
    return (upper - place) * value_at(values, lower) + (place - lower) * value_at(values, upper)


def held_out_threshold(
    docs: DataFrame, trusted: DataFrame, target: list[int], raw: list[int], loss: float = LOSS, id_col: str = "doc_id", text_col: str = "text"
) -> float:
    """The quantile ``loss`` of the scores of trusted documents, each without its own counts in the target.

    Documents that fail the base rules are left out. Without any other the threshold is minus infinity.
    """
    return held_out_quantile(graded(marked(docs, id_col, text_col, trusted=trusted)), target, raw, loss)


def held_out_quantile(texts: DataFrame, target: list[int], raw: list[int], loss: float) -> float:
    """The same of the trusted texts, which are ``graded``.

    Every n-gram adds its log ratio as if the text held it once; those that it holds more often, which
    are neighbours that are equal once all are sorted, add what that leaves out.
    """
    alone = lambda t: math.log((t - 1 + SMOOTHING) / (t + SMOOTHING)) if t else 0.0
    once = [r / UNIT + alone(t) for r, t in zip(ratios_of(target, raw), target)]
    every = sum(target) + SMOOTHING * BUCKETS
    spark = texts.sparkSession
    texts = texts.withColumns({"once": looked_up(spark, once, "double"), "counts": looked_up(spark, target)})

    def rest(again: Column, counts: Column) -> Column:  # sorted; of c equal n-grams it holds c - 1
        starts = F.filter(numbers(F.size(again)), lambda i: F.coalesce(F.get(again, i - 1) != again[i], F.lit(True)))

        def kinds(at: Column) -> Column:  # by bucket: its count in the target, and in the document
            own = lambda p, k: F.coalesce(F.get(at, k + 1), F.size(again)) - p + 1
            return F.transform(at, lambda p, k: F.struct(counts[again[p]].alias("t"), own(p, k).alias("c")))

        left = lambda x: x["c"] * F.log((x["t"] - x["c"] + SMOOTHING) / (x["t"] - 1 + SMOOTHING))
        return F.aggregate(let(starts, kinds), F.lit(0.0), lambda a, x: a + left(x))

    def held_out(grams: Column, once: Column, counts: Column) -> Column:
        n = F.size(grams)
        total = F.aggregate(grams, F.lit(0.0), lambda a, b: a + once[b])
        equal = lambda s: F.zip_with(s, F.slice(s, 2, n), lambda a, b: F.when(a == b, a))
        again = let(F.sort_array(grams), lambda s: F.filter(equal(s), lambda x: x.isNotNull()))
        return F.when(n > 0, (total + let(again, lambda x: rest(x, counts))) / n - F.log(1 - n / every))

    own = F.struct("once", "counts")
    score = F.when(F.col("sound"), let(own, lambda x: held_out(F.col("grams"), x["once"], x["counts"])))
    scores = stored(texts.select(score.alias("score")).dropna(), "held-out-scores")
    found = quantile(scores, loss)
    discard(scores)
    return -math.inf if found is None else found


def toxic_words(docs: DataFrame, trusted: DataFrame, toxic: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """64-bit hashes of the words that tell toxic documents from trusted ones.

    Such a word is in ``TOXIC_DOCS`` toxic documents at least, its share of them is ``TOXIC_RATIO``
    times its share of the trusted ones, and its log-likelihood ratio, of its documents in both, is
    above the logarithm of the number of words that toxic documents hold. ``toxic`` holds ids as
    ``trusted`` does, and all of them are used.
    """
    rows = stored(marked(docs, id_col, text_col, trusted=trusted, toxic=toxic), "labelled-texts", compression="zstd")
    found = telling_words(rows)
    discard(rows)
    return found


def telling_words(labelled: DataFrame) -> list[int]:
    """The same of texts that are marked as trusted, as toxic or as both."""
    rows = [labelled.where(mark).select("text", F.lit(k).alias("toxic")) for k, mark in enumerate(("trusted", "toxic"))]
    rows = rows[0].unionByName(rows[1])
    sizes = dict(rows.groupBy("toxic").count().collect())
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or n1 < TOXIC_DOCS:
        return []
    hashes = F.array_distinct(F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)))
    words = rows.select("toxic", F.explode(hashes).alias("word"))
    words = words.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where("a > 0")
    words = stored(words, "toxic-words")  # counted, then judged
    a, b = F.col("a"), F.col("b")
    term = lambda seen, share: F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)
    with_word, without = (a + b) / (n0 + n1), (n0 + n1 - a - b) / (n0 + n1)
    gain = term(a, with_word * n1) + term(b, with_word * n0) + term(n1 - a, without * n1) + term(n0 - b, without * n0)
    often = ((a + SMOOTHING) / (n1 + 1)) >= TOXIC_RATIO * ((b + SMOOTHING) / (n0 + 1))
    found = words.where((a >= TOXIC_DOCS) & often & (gain >= math.log(max(2, words.count()))))
    found = sorted(r[0] for r in found.select("word").collect())
    discard(words)
    return found


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic: DataFrame | None = None,
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of the rules' numbers, and that column's name.

    The struct holds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score (mean log ratio; null without words) and n_toxic_words (distinct ones). Null and empty
    texts have no words, fail the base rules and are not kept. Ids may be null or repeated: an id
    only tells which rows are trusted or toxic. Without a ``threshold`` it is the quantile ``LOSS``
    of held-out trusted scores. Without trusted rows the target is uniform, and the score rejects
    nothing; without ``toxic`` rows no word is toxic. An empty table stays empty.
    """
    marks = {"trusted": trusted} if toxic is None else {"trusted": trusted, "toxic": toxic}
    labelled = stored(graded(marked(docs, id_col, text_col, **marks)), "labelled-texts", compression="zstd")
    good = labelled.where("trusted")
    target = by_bucket(good.select(F.explode("grams").alias("bucket")))
    raw = counted(documents(docs, id_col, text_col))
    if threshold is None:
        threshold = held_out_quantile(good, target, raw, LOSS)
    bad_words = constants([] if toxic is None else telling_words(labelled))
    discard(labelled)
    ratios = looked_up(docs.sparkSession, ratios_of(target, raw))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name, ratio_col = fresh(docs, "quality"), fresh(docs, "ratios")

    def rules(found: Column, singles: Column, pairs: Column, ratios: Column) -> Column:
        n_toxic = F.size(F.array_intersect(singles, bad_words)).cast("long")
        columns = base_columns(text, found, pairs) | {"score": mean_ratio(singles, pairs, ratios), "n_toxic_words": n_toxic}
        return F.struct(*[c.alias(n) for n, c in columns.items()])

    def verdict(x: Column) -> Column:
        failed = base_failed(x["n_words"], x["n_repeat_words"])
        kept = ~failed & F.coalesce(x["score"] >= threshold, F.lit(False)) & (x["n_toxic_words"] == 0)
        fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        more = {"base_failed": failed, "kept": kept, "score": x["score"], "n_toxic_words": x["n_toxic_words"]}
        return F.struct(*[x[n].alias(n) for n in fields], *[c.alias(n) for n, c in more.items()])

    def quality(ratios: Column) -> Column:
        return let(let(word_array(text), lambda f: hashed(f, lambda s, p: rules(f, s, p, ratios))), verdict)

    rows = docs.withColumn(ratio_col, ratios)
    return rows.withColumn(name, let(F.col(ratio_col), quality)).drop(ratio_col), name


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as of good quality and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def toxic_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as toxic, though of good quality."""
    return labels.where("quality = 1 and toxic = 1").select("doc_id")
