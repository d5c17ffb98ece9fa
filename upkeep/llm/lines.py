"""Line dedup by a join of deletion neighbourhoods. DataFrame functions only.

A line is its sequence of words. It goes if an earlier line of the corpus has the same words or,
where both have ``NEAR_WORDS`` words or more, differs by one word replaced, inserted or deleted.
Earlier means a smaller (doc_id, hash of the text, line number).

Lines that differ by one word share their first or their last words, about half of a line each, so
lines that share neither with another line need no variants. The others emit every variant with
one word deleted, as a hashed key. Lines whose variants agree at the same position differ by a
replaced word; a variant that equals a whole line differs by an inserted one. In every group of
equal keys each line is compared with the earliest only, which decides whether it goes; pairs are
never listed. The edit distance of each such pair is verified on the words. Where it refutes a pair,
the lines with that key are grouped once more, by hashes of their variants' words in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import MARKS, bit_hits, bit_table, fresh, let, numbers, stored, word_array

NEAR_WORDS = 8


def anchors(words: Column) -> Column:
    """Hashes of the first and last words: half a line or less, rounded down to a power of two.

    Lines of n and n + 1 words that differ by one edit share (n + 1) // 2 words at an end.
    """
    size = lambda n: F.pow(F.lit(2), F.floor(F.log2(n / 2) + 1e-9)).cast("int")
    n = F.size(words)
    sizes = F.array_distinct(F.array(size(n), size(n + 1)))
    ends = lambda k: F.array(
        F.xxhash64(F.lit(0), F.slice(words, 1, k)), F.xxhash64(F.lit(1), F.slice(words, n - k + 1, k))
    )
    return F.flatten(F.transform(sizes, ends))


def line_table(docs: DataFrame) -> DataFrame:
    """Every line with a word: its place, two hashes of its words, and the anchors of longer lines."""
    lines = docs.select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    hashes = lambda w: F.struct(
        F.xxhash64(w).alias("h1"),
        F.xxhash64(F.lit(1), w).alias("h2"),
        F.when(F.size(w) >= NEAR_WORDS, anchors(w)).alias("anchors"),
    )
    worded = lines.where(F.btrim("line", F.lit(MARKS)) != "")
    return worded.select("doc_id", "tie", "pos", let(word_array(F.col("line")), hashes).alias("x")).select(
        "doc_id", "tie", "pos", "x.*"
    )


def variants(words: Column) -> Column:
    """Keys of a line's deletion neighbourhood: (kind, key).

    Kind 0 lacks the word at a position that the key knows; equal keys are lines that differ there
    at most. Kind 1 lacks a word anywhere and equals kind 2, the whole line, of a line without it;
    these keys combine hashes of neighbouring words, so that each takes constant time.
    """
    word = lambda w, i: F.coalesce(F.get(w, i), F.lit(""))
    link = lambda w, i: F.xxhash64(word(w, i - 1), word(w, i))
    every = lambda hashes: F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))
    entry = lambda kind, *parts: F.struct(F.lit(kind).alias("kind"), F.xxhash64(*parts).alias("key"))

    def of(w: Column) -> Column:
        n = F.size(w)
        placed = F.transform(w, lambda x, k: F.xxhash64(x, k))
        links = F.transform(F.sequence(F.lit(0), n), lambda i: link(w, i))

        def masked(h: Column) -> Column:
            return let(every(h), lambda all_: F.transform(h, lambda x, k: entry(0, F.lit(0), n, k, all_.bitwiseXOR(x))))

        def shorter(g: Column) -> Column:
            def without(all_: Column, i: Column) -> Column:
                joined = F.xxhash64(word(w, i - 1), word(w, i + 1))
                return all_.bitwiseXOR(g[i]).bitwiseXOR(g[i + 1]).bitwiseXOR(joined)

            deleted = lambda all_: F.transform(numbers(n), lambda i: entry(1, F.lit(1), n - 1, without(all_, i)))
            return let(every(g), lambda all_: F.concat(deleted(all_), F.array(entry(2, F.lit(1), n, all_))))

        return F.concat(let(placed, masked), let(links, shorter))

    return let(words, of)


def one_edit(a: Column, b: Column) -> Column:
    """Whether two sequences of words differ by one edit at most."""
    n, m = F.size(a), F.size(b)
    differ = lambda x, y: F.size(F.filter(F.zip_with(x, y, lambda p, q: p != q), lambda d: d))

    def inserted(long: Column, short: Column) -> Column:
        place = F.array_position(F.zip_with(F.slice(long, 1, F.size(short)), short, lambda p, q: p != q), F.lit(True))
        place = F.when(place == 0, F.size(long)).otherwise(place).cast("int")
        rest = F.slice(long, place + 1, F.size(long))
        return rest == F.slice(short, place, F.size(long))

    return (
        F.when(n == m, differ(a, b) <= 1).when(n == m + 1, inserted(a, b)).when(m == n + 1, inserted(b, a)).otherwise(False)
    )


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (h1, h2, doc_id, tie, pos) with ``line``, once for each row of the document.

    Lines are shuffled only if their place falls on a bit that one of ``places`` has set.
    """
    slot = F.xxhash64("doc_id", "tie", "pos")
    texts = docs.select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    texts = bit_hits(texts, slot, bit_table(slot, at=places)).drop("at")
    same = [texts["doc_id"].eqNullSafe(places["doc_id"]), texts["tie"] == places["tie"], texts["pos"] == places["pos"]]
    return places.join(texts, reduce(Column.__and__, same)).select(*[places[c] for c in places.columns], "line")


def close_lines(docs: DataFrame, lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """rank, h1, h2 and words of the distinct lines that share an end with another; ranks follow their order."""
    ends = lines.where("anchors is not null").select("h1", F.explode("anchors").alias("anchor"))
    shared = ends.groupBy("anchor").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")
    # Stored, so that adaptive execution can split the join where very many lines begin alike.
    shared = stored(shared.select("anchor"), "shared-anchors")
    close = ends.join(shared, "anchor", "left_semi").select("h1").distinct()
    places = stored(firsts.join(close, "h1", "left_semi").select("h1", "h2", "doc_id", "tie", "pos"), "line-places")
    held = lines_at(docs, places)
    held = held.dropDuplicates(["h1", "h2"]).orderBy("doc_id", "tie", "pos")
    words = word_array(F.col("line")).alias("words")
    return stored(held.select(F.monotonically_increasing_id().alias("rank"), "h1", "h2", words), "close-lines")


def verified(pairs: DataFrame, close: DataFrame) -> DataFrame:
    """``pairs`` of rank and earlier with ``near``: whether one edit leads from one to the other."""
    mine = close.select("rank", "words")
    theirs = close.select(F.col("rank").alias("earlier"), F.col("words").alias("before"))
    near = one_edit(F.col("words"), F.col("before")).alias("near")
    return pairs.join(mine, "rank").join(theirs, "earlier").select("rank", "earlier", near)


def with_leads(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """``by``, rank and earlier: each line beside the earliest that its key says it resembles."""
    least = [F.min(F.when(F.col("kind") == i, F.col("rank"))).alias(f"least{i}") for i in range(3)]
    groups = keys.groupBy(*by).agg(F.count("*").alias("n"), *least).where("n > 1")
    groups = stored(groups, f"{name}-groups")
    lead = F.when(F.col("kind") == 0, F.col("least0")).when(F.col("kind") == 1, F.col("least2")).otherwise(F.col("least1"))
    pairs = keys.join(groups, by).select(*by, "rank", lead.alias("earlier")).where("earlier < rank")
    return stored(pairs, f"{name}-pairs")


def spelled_keys(keys: DataFrame, shared: DataFrame, close: DataFrame) -> DataFrame:
    """(kind, h1, h2, rank) of the variants whose key is in ``shared``, hashed from all their words in order.

    Keys combine hashes of neighbours, so lines of the same neighbours in another order, or of
    neighbours that cancel out, have equal ones. These hashes tell them apart as they tell lines.
    """
    members = keys.join(shared, "key", "left_semi").select("rank").distinct()
    lines = close.join(members, "rank", "left_semi")
    entries = lines.select("rank", F.posexplode(variants(F.col("words"))).alias("pos", "v")).select("rank", "pos", "v.*")
    entries = entries.join(shared, "key", "left_semi").groupBy("rank").agg(F.collect_set(F.struct("kind", "pos")).alias("at"))
    words, n = F.col("words"), F.size("words")

    def spelled(entry: Column) -> Column:
        # The variants without the word at 0, 1, ... of kind 0, then those of kind 1, then the whole line.
        kind, place = entry["kind"], (entry["pos"] % n).cast("int")
        rest = F.concat(F.slice(words, F.lit(1), place), F.slice(words, place + 2, n))
        rest = F.when(kind == 2, words).otherwise(rest)
        masked = F.when(kind == 0, place).otherwise(-1)
        hashed = [F.xxhash64(F.lit(i), masked, rest).alias(f"h{i}") for i in (1, 2)]
        return F.struct(kind.alias("kind"), *hashed)

    found = close.select("rank", "words").join(entries, "rank")
    return found.select("rank", F.explode(F.transform("at", spelled)).alias("v")).select("v.*", "rank")


def near_repeats(docs: DataFrame, lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that an earlier line resembles by one edit."""
    close = close_lines(docs, lines, firsts)
    keys = close.select("rank", F.explode(variants(F.col("words"))).alias("v")).select("v.*", "rank")
    keys = stored(keys, "line-variants", compression="zstd")
    pairs = with_leads(keys, ["key"], "variant")
    first = stored(verified(pairs.select("rank", "earlier").distinct(), close), "line-verdicts")
    found = first.where("near").select("rank")
    failed = first.where("not near").select("rank", "earlier")
    if not failed.isEmpty():
        # Equal keys of different variants: all lines with such a key are grouped anew by the variants' words.
        shared = stored(pairs.join(failed, ["rank", "earlier"], "left_semi").select("key").distinct(), "shared-keys")
        again = stored(spelled_keys(keys, shared, close), "spelled-variants", compression="zstd")
        again = with_leads(again, ["h1", "h2"], "spelled").select("rank", "earlier").distinct()
        found = found.unionByName(verified(again, close).where("near").select("rank"))
    return close.join(found.distinct(), "rank", "left_semi").select("h1", "h2")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_lines (with a word) and dropped (sorted line numbers) of documents with such lines."""
    lines = stored(line_table(docs), "lines", compression="zstd")
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "tie", "pos")).alias("first"))
    firsts = stored(firsts.select("h1", "h2", "first.*"), "first-lines", compression="zstd")
    near = near_repeats(docs, lines, firsts).withColumn("near", F.lit(True))
    place = F.struct("doc_id", "tie", "pos")
    judged = stored(firsts.join(near, ["h1", "h2"], "left"), "judged-lines", compression="zstd")
    judged = judged.select("h1", "h2", place.alias("first"), "near")
    goes = F.coalesce("near", F.lit(False)) | ~place.eqNullSafe(F.col("first"))
    marked = lines.drop("anchors").join(judged, ["h1", "h2"]).select("doc_id", "tie", "pos", goes.alias("goes"))
    dropped = F.sort_array(F.collect_set(F.when(F.col("goes"), F.col("pos"))))
    found = marked.groupBy("doc_id", "tie").agg(F.count_distinct("pos").alias("n_lines"), dropped.alias("dropped"))
    return stored(found, "dropped-lines", compression="zstd")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` without repeated lines, and the name of a new struct column with n_lines and dropped.

    ``text_col`` holds the lines that stay, joined as before; lines without a word always stay.
    ``n_lines`` counts lines with a word and ``dropped`` lists the numbers (from 0) of those that
    went. Null texts stay null. Null ids come first in the order. Rows with equal id and text are
    one document: they get the same result. An empty table stays empty.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).alias("text")
    ).where("text is not null")
    found = repeated_lines(rows)
    name, key, tie = (fresh(docs, n) for n in ("lines", "_line_id", "_line_tie"))
    found = found.select(
        F.col("doc_id").alias(key), F.col("tie").alias(tie), F.struct(F.col("n_lines").cast("long").alias("n_lines"), "dropped").alias(name)
    )
    same = docs[id_col].cast("long").eqNullSafe(found[key]) & (F.xxhash64(docs[text_col]) == found[tie])
    kept = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(F.col(name)["dropped"], i))
    none = F.struct(F.lit(0).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("dropped"))
    joined = docs.join(found, same, "left").drop(key, tie)
    changed = F.when(F.size(F.col(name)["dropped"]) > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col))
    return joined.withColumn(text_col, changed).withColumn(name, F.coalesce(name, none)), name
