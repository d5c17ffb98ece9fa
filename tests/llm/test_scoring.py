import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest

from upkeep.llm.queries import all_queries
from upkeep.llm.scoring import log_gamma, runs, score_documents

DEPTH = 4


def low(text):
    return (text or "").encode().lower()


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def steps(text, depth):
    data = b"\xff" * depth + text + b"\xff"
    for k in range(depth, len(data)):
        node = 1
        for j in range(7, -1, -1):
            bit = data[k] >> j & 1
            yield data[k - depth : k][::-1], node, bit
            node = 2 * node + bit


class Plain:
    """The same model with a dictionary of nodes."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, defaultdict(lambda: [0, 0])
        for t in texts:
            for context, node, bit in steps(t, depth):
                for d in range(depth + 1):
                    self.counts[context[:d], node][bit] += 1
        self.alone = {
            k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            for k, (a, b) in self.counts.items()
        }
        self.below = defaultdict(float)
        for k in sorted(self.counts, key=lambda k: -len(k[0])):
            whole = self.alone[k]
            if len(k[0]) < depth:
                whole = math.log(0.5) + float(np.logaddexp(self.alone[k], self.below[k]))
            if k[0]:
                self.below[k[0][:-1], k[1]] += whole

    def log10(self, text):
        total = 0.0
        for context, node, bit in steps(text, self.depth):
            p = 0.0
            for d in range(self.depth, -1, -1):
                k = (context[:d], node)
                n = self.counts.get(k, (0, 0))
                own = (n[bit] + 0.5) / (sum(n) + 1)
                a, b = self.alone.get(k, 0.0), self.below.get(k, 0.0)
                w = 1.0 if d == self.depth else math.exp(a - float(np.logaddexp(a, b)))
                p = w * own + (1 - w) * p
            total += math.log10(p)
        return total


def check(rows, texts, depth=DEPTH):
    train = [low(t) for i, t in texts if not held_out(i)]
    counts = Counter(w for t in train for w in [*t.split(), b""])
    n, scale = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    model = Plain(train, depth)
    want = []
    for i, t in texts:
        tokens = [*low(t).split(), b""]
        base = sum(math.log10((counts[w] + 0.1) / scale) for w in tokens)
        want.append((i, held_out(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base, model.log10(low(t))))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[6], 4))
    got = sorted((tuple(r)[:7] for r in rows), key=key)
    want.sort(key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("depth,block", [(4, 16 << 20), (2, 500), (5, 3000)])
def test_odd_documents(spark, docs, depth, block):
    check(score_documents(docs, depth=depth, block_bytes=block).collect(), odd.TEXTS, depth)


def test_no_documents_and_no_training(spark, none):
    assert score_documents(none).count() == 0
    only = [(i, odd.prose(i, 3)) for i in range(200) if held_out(i)]
    check(score_documents(odd.documents(spark, only)).collect(), only)


def test_runs_hold_each_byte_once():
    code, owner = runs([b"ab", b"", b"c"], 3)
    assert owner.tolist() == [0, 0, 0, 1, 2, 2]
    f = 0xFF
    want = [[f, f, f, 97], [97, f, f, 98], [98, 97, f, f], [f, f, f, f], [f, f, f, 99], [99, f, f, f]]
    assert [list(int(c).to_bytes(4, "big")) for c in code] == want


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 60, 0.5), [1e3, 1e6 + 0.5, 1e12]])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_table_and_held_out_texts(spark, tables, table_docs):
    texts = [tuple(r) for r in table_docs.select("doc_id", "text").orderBy("doc_id").collect()]
    rows = all_queries()["op4_lm_scoring"](spark, tables).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r["held_out"]]
    size = {i: len(low(t)) + 1 for i, t in texts}
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(size[r["doc_id"]] for r in held)
    letters = Counter(b for i, t in texts for b in low(t))
    flat = -sum(n * math.log2(n / sum(letters.values())) for n in letters.values()) / sum(letters.values())
    assert bits < 0.75 * flat  # far below the entropy of single bytes
