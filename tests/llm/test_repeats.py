import hashlib
import random

import numpy as np
import odd
import pytest

from upkeep.llm.queries import all_queries
from upkeep.llm.repeats import anchors, merged, remove_repeats, repeated_windows, shared_prefixes


def expected(texts, length):
    """(bytes, removed, spans, what is kept) of each text, by a table of all windows."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for t in data:
        for i in range(len(t) - length + 1):
            w = hashlib.blake2b(t[i : i + length], digest_size=16).digest()
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in data:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[hashlib.blake2b(t[i : i + length], digest_size=16).digest()] > 1:
                cover[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((len(t), int(cover.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~cover])))
    return out


def check(frame, texts, length=400, key=128):
    rows = remove_repeats(frame, length, key).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows), key=repr)
    assert got == sorted(((i, *x) for (i, _), x in zip(texts, expected([t for _, t in texts], length))), key=repr)


def test_odd_documents(spark, docs):
    check(docs, odd.TEXTS)


def test_no_documents(spark, none):
    assert remove_repeats(none).count() == 0


def shuffled(seed, n=60):
    """Texts made of shared pieces, short alphabets and runs, for windows of 24 bytes."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("ab", k=rng.randint(1, 60))) for _ in range(6)]
    pieces += ["".join(rng.choices("abcdefgh ", k=rng.randint(10, 90))) for _ in range(8)] + ["c" * 50, "é" * 30]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_against_brute_force(spark, seed):
    texts = shuffled(seed)
    check(odd.documents(spark, texts), texts, 24, 8)


def test_groups_above_the_limit(spark, monkeypatch):
    monkeypatch.setattr("upkeep.llm.repeats.GROUP_CONTEXTS", 2)
    texts = shuffled(3)
    check(odd.documents(spark, texts), texts, 24, 8)


def test_intervals_find_shared_prefixes():
    rng = np.random.default_rng(4)
    for length in (1, 3, 7, 20):
        for alphabet in (1, 2, 5):
            symbols = rng.integers(0, alphabet, 300)
            symbols[[50, 120, 200]] = 256 + np.arange(3)
            symbols = np.concatenate([symbols, symbols[60:110], [300]])
            runs = {}
            for i in range(len(symbols)):
                runs.setdefault(tuple(symbols[i : i + length]), []).append(i)
            want = np.zeros(len(symbols), bool)
            for r, at in runs.items():
                want[at] = len(at) > 1 and len(r) == length
            assert (shared_prefixes(symbols, length) == want).all()


def test_windows_of_contexts_against_brute_force():
    """Contexts around an anchor at random places; equal windows count at equal distance only."""
    rng = random.Random(8)
    for length in (5, 12, 40, 90):
        for _ in range(30):
            base = "".join(rng.choices("abc", k=3 * length)).encode()
            rows = []
            for k in range(rng.randint(2, 7)):
                text = bytearray(base)
                for _ in range(rng.randint(0, 2)):
                    text[rng.randrange(len(text))] = 100 + k
                place = length + 3
                low = place - rng.randint(0, length - 1)
                high = min(place, low + rng.randint(0, length))
                rows.append({"anchor": 1, "place": place, "low": low, "bytes": bytes(text[low : high + length])})
            seen = {}
            for r in rows:
                for i in range(len(r["bytes"]) - length + 1):
                    key = (r["low"] + i, r["bytes"][i : i + length])
                    seen[key] = seen.get(key, 0) + 1
            for r, hit in zip(rows, repeated_windows(rows, length)):
                want = [seen[r["low"] + i, r["bytes"][i : i + length]] > 1 for i in range(len(hit))]
                # A window may also occur at another distance, which is a repeat as well.
                assert all(h or not w for h, w in zip(hit, want))
                extra = [i for i, (h, w) in enumerate(zip(hit, want)) if h and not w]
                others = [x["bytes"] for x in rows]
                assert all(sum(o.count(r["bytes"][i : i + length]) for o in others) > 1 for i in extra)


def test_every_window_has_one_anchor():
    rng = random.Random(9)
    texts = ["".join(rng.choices("ab", k=n)).encode() for n in (0, 39, 40, 41, 500)] + [b"z" * 100]
    owner, place, low, high = anchors(texts, 40, 16)
    seen = [[0] * max(0, len(t) - 39) for t in texts]
    for o, p, a, b in zip(owner, place, low, high):
        for s in range(a, b + 1):
            seen[o][s] += 1
            assert s <= p <= s + 24
    assert all(x == 1 for s in seen for x in s)


def test_merged():
    low, high = merged(np.array([9, 0, 4, 20]), np.array([12, 5, 9, 21]))
    assert (low.tolist(), high.tolist()) == ([0, 20], [12, 21])


def test_query_over_the_table(spark, tables, table_docs):
    rows = [tuple(r) for r in table_docs.select("doc_id", "text").collect()]
    want = {i: x for (i, _), x in zip(rows, expected([t for _, t in rows], 400))}
    found = all_queries()["op10_repeats"](spark, tables).collect()
    assert len(found) == len(want)
    for r in found:
        size, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size, removed, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
