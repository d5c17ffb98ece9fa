import zlib
from collections import Counter, defaultdict

import odd
import pytest

from upkeep.llm.queries import all_queries
from upkeep.llm.sharding import shard, splitters


def size(text):
    return len((text or "").encode()) + 16


def check(rows, texts, shards):
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (size(t), zlib.crc32((t or "").encode())) for _, t in texts
    )
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_documents(spark, docs):
    rows = shard(docs, shards=3).collect()
    check(rows, odd.TEXTS, 3)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in odd.TEXTS)


def test_no_documents(spark, none):
    assert shard(none).count() == 0


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_bytes_are_near_equal_and_copies_together(spark, shards):
    texts = [(i, odd.prose(i, 5 + i % 40)) for i in range(4000)]
    texts += [(10_000 + i, odd.prose(3, 30)) for i in range(60)]  # a group of copies, lighter than a shard
    rows = shard(odd.documents(spark, texts), shards=shards).collect()
    check(rows, texts, shards)
    load, homes = Counter(), defaultdict(set)
    for r in rows:
        load[r["shard"]] += r["size"]
        homes[r["text_crc32"], r["size"]].add(r["shard"])
    assert max(load.values()) <= 1.03 * min(load.values())
    assert all(len(h) == 1 for h in homes.values())


def test_a_third_of_the_rows_are_copies(spark):
    texts = [(i, odd.prose(i, 20)) for i in range(2000)] + [(5000 + i, odd.prose(1, 25)) for i in range(500)]
    texts += [(7, odd.prose(2, 25))] * 500  # rows repeated as a whole
    rows = shard(odd.documents(spark, texts), shards=20).collect()
    check(rows, texts, 20)
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) <= 1.1 * min(load.values())


@pytest.mark.parametrize("seed", range(4))
def test_groups_below_a_share_have_one_home_beside_a_hot_text(spark, seed):
    text = lambda k: f"{seed} {k:06d} " + "words " * 20
    numbers = [0] * 6000 + [1 + i // 8 for i in range(7200)] + [1000 + i for i in range(4800)]
    texts = [(i, text(k)) for i, k in enumerate(numbers)]  # 900 groups of 8 rows, a little below share / HEAVY
    shards = 40
    rows = shard(odd.documents(spark, texts), shards=shards).collect()
    check(rows, texts, shards)
    load, homes, rows_of = Counter(), defaultdict(set), Counter(numbers)
    for r in rows:
        load[r["shard"]] += r["size"]
        homes[numbers[r["doc_id"]]].add(r["shard"])
    assert all(len(h) == 1 for k, h in homes.items() if rows_of[k] <= len(numbers) / shards)
    assert max(load.values()) <= 1.1 * min(load.values())


def test_boundaries_within_a_group_only_where_it_fills_ranges():
    samples = sorted([(1, k, 0) for k in range(40)] + [(2, 5, 0), (3, 6, 0), (4, 7, 0), (4, 8, 0)])
    found = splitters(samples, 11)
    assert sum(k[0] == 1 for k in found) > 5
    assert all(k[1] == -(1 << 63) for k in found if k[0] > 1)


def test_query_over_the_table(spark, tables, table_docs):
    texts = [(r["doc_id"], r["text"]) for r in table_docs.select("doc_id", "text").collect()]
    rows = all_queries()["op8_sharding"](spark, tables).collect()
    check(rows, texts, 40)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in texts
    )
    groups, text_of = Counter(), dict(texts)
    for _, t in texts:
        groups[t or ""] += size(t)
    share, load, homes = sum(groups.values()) / 40, Counter(), defaultdict(set)
    for r in rows:
        load[r["shard"]] += r["size"]
        homes[text_of[r["doc_id"]] or ""].add(r["shard"])
    assert all(len(homes[t]) == 1 for t, n in groups.items() if n <= share)
    # A range is cut between groups only, so a shard misses its share by a group that is not heavy or by two.
    loose = max(n for n in groups.values() if n <= share)
    assert max(load.values()) - min(load.values()) <= 2 * loose
