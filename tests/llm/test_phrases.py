import re
from collections import Counter, defaultdict

import odd
import pytest

from upkeep.llm import phrases
from upkeep.llm.phrases import mine_phrases


def brute(rows, least=2, percent=80, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in frequent.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        best = []
        for p, a in frequent.items():
            if 100 * inside[p] < percent * a:
                score, _, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            found.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(found)


def frame(spark, rows):
    full = [(i, t, lang, *"sxabcdefgh"[:10]) for i, (lang, t) in enumerate(rows)]
    full = [(i, t, lang, "s", None, *["x"] * 8) for i, t, lang, *_ in full]
    return spark.createDataFrame(full, odd.SCHEMA).repartition(3)


SOME = [(("en", None, "de")[i % 3], t) for i, (_, t) in enumerate(odd.TEXTS)]
SOME += [("en", "a a a a a a a A! A a\ta, a\x0ba a; " + odd.prose(1, 90)), ("und", "one two. three one two"), ("", "one two")]


def result(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("least, small", [(2, False), (3, True)])
def test_equals_brute_force(spark, monkeypatch, least, small):
    if small:  # steps, slices and parts of every size give the same
        monkeypatch.setattr(phrases, "STEP_BYTES", 300)
        monkeypatch.setattr(phrases, "STEP_ENTRIES", 10)
        monkeypatch.setattr(phrases, "SLICES", ((3, 2), (6, 5)))
        monkeypatch.setattr(phrases, "BITS", 8)
    found = mine_phrases(frame(spark, SOME), least=least)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert result(found) == brute(SOME, least)


def test_first_of_each_language(spark):
    assert result(mine_phrases(frame(spark, SOME), least=2, top=5)) == brute(SOME, 2, top=5)


def test_no_documents(spark, none):
    assert mine_phrases(none).count() == 0
    assert mine_phrases(frame(spark, [("en", None), (None, ""), ("en", " .\n")])).count() == 0


def test_table_equals_its_sql(spark, tables, oracle):
    from compare import rows_of
    from upkeep.llm.oracles import all_oracles
    from upkeep.llm.queries import all_queries

    found = all_queries()["op12_phrases"](spark, tables).toArrow()
    assert rows_of(found) == rows_of(oracle.sql(all_oracles()["op12_phrases"]).to_arrow_table())


def test_stripes_are_sorted_by_a_number_first(spark):
    """So that languages and lists of words are compared only where that number is equal."""
    from upkeep.llm.phrases import STRIPE, merged_stripes

    merged = merged_stripes(spark.createDataFrame([("en", [1, 2], 0, 1, [5, 6], [2, 3]), ("en", [1, 2], 0, 1, [6], [4])], STRIPE), 2, 3)
    assert "Sort [hash" in merged._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in merged.collect()] == [("en", [1, 2], 9, [6], [7])]
