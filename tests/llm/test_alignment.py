import hashlib
from collections import Counter, defaultdict

import odd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from upkeep.llm import alignment
from upkeep.llm.alignment import align_documents, byte_letters, default_tokenizers, token_groups
from upkeep.llm.queries import all_queries


def groups_of(text, a, b):
    """[(A ids, B ids)] by plain loops over byte ends; none if a side's bytes differ."""
    letter = byte_letters()
    left = a.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in left]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if any(b"".join(x for _, x in side) != want for side in (left, right)):
        return []
    ends = []
    for side in (left, right):
        at, found = 0, []
        for i, x in side:
            at += len(x)
            found.append((at, i))
        ends.append(found)
    shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    found, low = [], 0
    for high in shared:
        found.append(tuple([i for e, i in side if low < e <= high] for side in ends))
        low = high
    return found


def brute(texts):
    path_a, path_b = default_tokenizers()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    groups = [groups_of(t, a, b) if t else [] for _, t in texts]
    links = [Counter((x, y) for p, q in some for x in p for y in q) for some in groups]
    count = Counter(pair for some in links for pair in some)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for (number, _), some, pairs in zip(texts, groups, links):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in some)
        rows.append(
            (
                number,
                sum(len(p) for p, _ in some),
                sum(len(q) for _, q in some),
                len(some),
                sum(pairs.values()),
                sum(n for pair, n in pairs.items() if count[pair] == best[pair[0]]),
                sum(n * count[pair] for pair, n in pairs.items()),
                hashlib.sha256(text.encode()).hexdigest() if some else "",
            )
        )
    return sorted(rows, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


TRICKY = [
    (500, "<|endoftext|> and <s> </s> <unk> are text"),
    (501, " leading and  double   spaces \n\n and a tab\there "),
    (502, "▁ a real ▁low line▁ and <0x41> bytes \x00 \x1c \x85 \xa0x"),
    (503, "don't we'll I'VE 12345 3.14159 é ﬁ \U0001f469‍\U0001f680 مرحبا"),
    (504, "﻿mark " + "ab" * 4000 + " " + "é一" * 900),
    (505, " " * 300 + "x" + "\t" * 50),
]


@pytest.mark.parametrize("block, links", [(1 << 20, 4096), (2000, 3)])
def test_equals_brute_force(spark, monkeypatch, block, links):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "GROUP_LINKS", links)
    texts = odd.TEXTS + TRICKY
    found = align_documents(odd.documents(spark, texts))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert result(found) == brute(texts)


def test_groups_as_text(spark):
    rows = token_groups(odd.documents(spark, TRICKY + [(1, None), (2, "")])).collect()
    hashes = {r[0]: r[7] for r in brute(TRICKY + [(1, None), (2, "")])}
    assert {r["doc_id"]: hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "" for r in rows} == hashes


def test_no_documents(none):
    assert align_documents(none).count() == 0 and token_groups(none).count() == 0


def test_table_equals_brute_force(spark, tables):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    assert result(all_queries()["op13_alignment"](spark, tables)) == brute(texts)


def test_a_full_cache_changes_no_ids(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 12)
    known = alignment.Tokenizers(*alignment.default_tokenizers())
    blocks = [[f"the word {i} and {i % 7} tail{i // 2}", f"the  loose {i}", f"word{i} the\u2003", ""] for i in range(40)]
    for texts in blocks:
        assert known.encode(texts)[:3] == known.whole(texts)[:3]
        assert known.again <= known.known.keys() and len(known.known) <= 12 + 10
    assert {"the", "word", "and"} <= known.again  # what comes in every block stays
