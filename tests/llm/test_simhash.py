import re

import numpy as np
import odd
import pytest
import xxhash

from upkeep.llm.components import components
from upkeep.llm.queries import all_queries
from upkeep.llm.simhash import block_masks, fingerprint, links_in_cells, near_duplicates, near_links, one_of_each, segment_counts


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if runs else 0


def classes(values, bits):
    """Smallest member index by brute force."""
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def check(rows, texts):
    prints = [plain(t) for _, t in texts]
    root = classes(prints, 4)
    least = {}
    for (i, _), r in zip(texts, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, p, least.get(r)) for (i, _), p, r in zip(texts, prints, root)]
    bits = lambda x: int(x, 16) if isinstance(x, str) else x % (1 << 64)
    got = [(r["doc_id"], bits(r["fingerprint"]), r["component_id"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_documents(spark, docs):
    check(near_duplicates(docs).collect(), odd.TEXTS)


def test_table(spark, tables, table_docs):
    texts = [tuple(r) for r in table_docs.select("doc_id", "text").collect()]
    found = all_queries()["op3_simhash"](spark, tables).collect()
    check(found, texts)
    assert all(len(r["fingerprint"]) == 16 and r["fingerprint"] == r["fingerprint"].lower() for r in found)


def test_no_documents(spark, none):
    assert near_duplicates(none).count() == 0 and one_of_each(none).count() == 0


def test_long_texts():
    text = odd.prose(3, 200_000)
    assert fingerprint(text.encode()) == fingerprint(text.upper().encode())


def near_prints(seed, groups, each):
    rng = np.random.default_rng(seed)
    values = set()
    for _ in range(groups):
        centre = int(rng.integers(1 << 63)) * 2 + 1
        for _ in range(each):
            value = centre
            for b in rng.integers(64, size=rng.integers(0, 9)):
                value ^= 1 << int(b)
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize("bits", [0, 1, 4, 6])
def test_grids_keep_every_component(spark, bits):
    values = near_prints(bits, 40, 12)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    found = {r["node"]: r["root"] for r in components(near_links(frame, bits)).collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    ours = {}
    for v in signed:
        ours.setdefault(found.get(v, v), set()).add(v)
    theirs = {}
    for v, r in zip(signed, classes(values, bits)):
        theirs.setdefault(r, set()).add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_large_cells_are_dealt_as_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr("upkeep.llm.simhash.CELL", 16)
    test_grids_keep_every_component(spark, 4)


def test_counts_bound_the_distance():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(1 << 63, size=5000).astype(np.uint64) for _ in range(2))
    assert (np.bitwise_count(segment_counts(a) ^ segment_counts(b)) <= np.bitwise_count(a ^ b)).all()
    near = a ^ np.bitwise_or.reduce([np.uint64(1) << rng.integers(64, size=5000).astype(np.uint64) for _ in range(4)])
    agree = np.zeros(5000, bool)
    for m in block_masks(4):
        agree |= ((segment_counts(a) ^ segment_counts(near)) & np.uint64(m)) == 0
    assert agree.all()


def test_sides_compare_across_only():
    bits = np.array([0, 1, 3, 0], np.uint64)
    u, v = links_in_cells(np.zeros(4, int), bits, np.array([0, 0, 0, 0]), 4)
    assert len(u) == 0
    u, v = links_in_cells(np.zeros(4, int), bits, np.array([0, 0, 0, 1]), 4)
    assert len(u) == 3


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(7, 7), (500, 900), (900, 500)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {900: 500}


def test_components_of_a_chain_of_200_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7), (500, 900), (900, 500)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {900: 500}


def test_one_row_of_each_component(spark, docs):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    prints = [plain(t) for _, t in odd.TEXTS]
    best = {}
    for (i, t), r in zip(odd.TEXTS, classes(prints, 4)):
        best.setdefault(r, []).append((i is None, i or 0))
    assert sorted((i is None, i or 0) for i, _ in rows) == sorted(min(x) for x in best.values())
