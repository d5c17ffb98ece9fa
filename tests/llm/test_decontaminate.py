import random
from collections import Counter

import odd

from upkeep.llm.decontaminate import SIMILARITY, Index, contaminated, overlap, parts_of, shingles, without_benchmark, words_of
from upkeep.llm.queries import all_queries

ITEMS = [
    (0, odd.prose(900, 20) + ".\n" + odd.prose(901, 8)),
    (1, odd.prose(902, 30)),
    (1, odd.prose(902, 30)),  # a repeated item
    (2, "tiny item"),
    (3, None),
    (4, ""),
    (5, odd.prose(903, 12) + "? " + odd.prose(904, 6) + "."),
]
LEAKS = [
    (100, odd.prose(50, 200) + " " + ITEMS[0][1].upper().replace("\n", " !\n\n") + " " + odd.prose(51, 130)),
    (101, ITEMS[1][1]),
    (102, odd.prose(52, 300) + ", tiny -- ITEM; " + odd.prose(53, 4)),
    (103, odd.prose(54, 10) + " " + " ".join(ITEMS[1][1].split()[:15])),  # half an item
    (104, " ".join(ITEMS[0][1].split()[:20])),  # a question without its answer
    (105, odd.prose(55, 70) + " " + ITEMS[6][1] + "\n" + ITEMS[0][1]),
    (None, ITEMS[6][1]),
    (106, ITEMS[6][1]),
    (106, ITEMS[6][1]),
]
FOUND = [(100, 0), (101, 1), (102, 2), (105, 0), (105, 5), (None, 5), (106, 5), (106, 5)]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(*x, "s") for x in items], "item_id long, text string, score string")


def test_leaks_are_found_and_nothing_else(spark):
    docs = odd.documents(spark, odd.TEXTS + LEAKS)
    rows = contaminated(docs, benchmark(spark)).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in rows), key=repr) == sorted(FOUND, key=repr)
    kept = without_benchmark(docs, benchmark(spark))
    assert kept.schema == docs.schema
    clean = [x for x in LEAKS if x[0] in (103, 104)]
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=repr) == sorted(odd.TEXTS + clean, key=repr)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("upkeep.llm.decontaminate.INDEX_BYTES", 150)
    test_leaks_are_found_and_nothing_else(spark)


def test_empty_tables(spark, docs, none):
    assert contaminated(none, benchmark(spark)).count() == 0
    assert contaminated(docs, benchmark(spark, [])).count() == 0
    assert without_benchmark(docs, benchmark(spark, [])).count() == docs.count()


def test_retrieval_equals_full_scores():
    rng = random.Random(2)
    vocabulary = odd.prose(1, 60).split()
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 25)))) for i in range(120)]
    index = Index(items)
    for _ in range(60):
        terms = sorted({index.term[w] for w in rng.choices(vocabulary, k=rng.randint(1, 60)) if w in index.term})
        scores = {}
        for t in terms:
            for item, x in zip(*index.lists[t]):
                scores[item] = scores.get(item, 0) + x
        want = {i for i, s in scores.items() if s >= 1 - 1e-9}
        got = {i for b in range(index.most.shape[1]) for i, _ in index.retrieve(terms, b)}
        assert got == want


def test_no_passage_with_enough_shingles_is_missed():
    """All passages, by shingles alone, against retrieval and verification."""
    rng = random.Random(6)
    items = [(i, odd.prose(i, rng.randint(5, 40))) for i in range(50)]
    index = Index(items)
    for k in range(200):
        i, text = rng.choice(items)
        words = text.split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        passage = odd.prose(1000 + k, rng.randint(0, 90)).split() + words + odd.prose(2000 + k, rng.randint(0, 90)).split()
        held = shingles(words_of(" ".join(passage)))
        want = {
            j
            for j, t in items
            if len(shingles(words_of(t)) & held) >= SIMILARITY * len(shingles(words_of(t)))
            and all(overlap(p, Counter(words_of(" ".join(passage)))) >= 0.5 for p in parts_of(t))
        }
        assert {x[0] for x in index.search(" ".join(passage))} == want


def test_query_over_the_table(spark, tables, table_docs):
    items = [(r["item_id"], shingles(words_of(r["text"]))) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    want = set()
    for r in table_docs.collect():
        held = shingles(words_of(r["text"]))
        want |= {(r["doc_id"], i) for i, s in items if len(s & held) >= SIMILARITY * len(s)}
    found = all_queries()["op6_decontamination"](spark, tables).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and want
