from collections import defaultdict

import numpy as np
import odd
import pytest

from upkeep.llm import minhash
from upkeep.llm.minhash import near_duplicate_sets, shingle_set, signatures


def words_set(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(texts, percent=85):
    """(id, set size, component, kept) of every row, from all pairs of sets."""
    sets = [words_set(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (number, _) in enumerate(texts):
        least[root(i)].append(number)
    found = []
    for i, (number, _) in enumerate(texts):
        known = [x for x in least[root(i)] if x is not None]
        component = number if not sets[i] else min(known) if known else None
        found.append((number, len(sets[i]), component, number == component))
    return sorted(found, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_equals_brute_force(spark, docs):
    found = near_duplicate_sets(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(found) == brute(odd.TEXTS)


def test_no_documents(none):
    assert near_duplicate_sets(none).count() == 0


def test_only_texts_without_words(spark):
    texts = [(3, None), (2, ""), (2, " \t\n"), (None, "")]
    assert result(near_duplicate_sets(odd.documents(spark, texts))) == brute(texts)


def test_table_equals_its_sql(spark, tables, oracle):
    from compare import rows_of
    from upkeep.llm.oracles import all_oracles
    from upkeep.llm.queries import all_queries

    found = all_queries()["op11_minhash"](spark, tables).toArrow()
    assert rows_of(found) == rows_of(oracle.sql(all_oracles()["op11_minhash"]).to_arrow_table())


def changed(words, *places):
    """The words with new ones at some places."""
    return " ".join(f"other{places[0]}x{i}" if i in places else w for i, w in enumerate(words))


@pytest.mark.parametrize("hub", [True, False])
@pytest.mark.parametrize("cell", [2048, 8])
def test_a_star_of_copies(spark, monkeypatch, hub, cell):
    # Each copy is close to the middle text only, and the copies are as close to each other as links come short of.
    monkeypatch.setattr(minhash, "CELL", cell)
    monkeypatch.setattr(minhash, "PAIRS", 7)
    middle = odd.prose(50, 100).split()
    texts = [(100 + i, changed(middle, 2 + 5 * i)) for i in range(20)]
    texts += [(200 + i, changed(middle, 12 + 5 * i, 40)) for i in range(5)]
    texts += [(7, " ".join(middle))] if hub else []
    want = brute(texts)
    assert (len({c for _, _, c, _ in want}) < 10) == hub
    assert result(near_duplicate_sets(odd.documents(spark, texts))) == want


def test_copies_are_one_set(spark):
    texts = [(i, odd.prose(60, 80).upper() if i % 2 else odd.prose(60, 80)) for i in range(300)]
    texts += [(1000 + i, odd.prose(70 + i, 80)) for i in range(20)]
    found = near_duplicate_sets(odd.documents(spark, texts)).where("component_id = 0")
    assert found.count() == 300 and found.where("kept").count() == 1


def test_a_chain_reaches_its_end(spark):
    words = odd.prose(80, 200).split()
    texts = [(i, " ".join([f"new{k}" for k in range(5 * i)] + words[5 * i :])) for i in range(25, -1, -1)]
    want = brute(texts)
    assert {c for _, _, c, _ in want} == {0}
    assert result(near_duplicate_sets(odd.documents(spark, texts))) == want


def test_minhashes_estimate_similarity():
    known = minhash.WordHashes()
    words = odd.prose(90, 4000).split()
    for share in (0.5, 0.7, 0.85, 0.95):
        cut = round(len(words) * (1 - share) / (1 + share))
        a, b = (shingle_set(" ".join(w).encode(), known) for w in (words[cut:], words[:-cut]))
        similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        left, right = signatures([a, b])
        assert abs((left == right).mean() - similarity) < 0.2


def test_step_does_not_change_minhashes(monkeypatch):
    known = minhash.WordHashes()
    sets = [shingle_set(odd.prose(i, 20 + 40 * i).encode(), known) for i in range(12)]
    want = signatures(sets)
    monkeypatch.setattr(minhash, "STEP", 50)
    assert np.array_equal(signatures(sets), want)
    for one, row in zip(sets, want):
        assert np.array_equal(signatures([one])[0], row)
