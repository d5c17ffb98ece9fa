import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from upkeep.llm.chat import escaped, format_conversations, overlap, read_back, render, unescaped
from upkeep.llm.queries import TRICKY, all_queries

ROWS = [
    (1, 0, "system", "be <|role|> kind"),
    (1, 1, "user", None),
    (1, 2, "assistant", "  \n leading <|end|> and \\l \\b \\\\ trailing \n "),
    (1, 3, "assistant", ""),
    (1, 4, "assistant", "é🙂한 " + TRICKY),
    (2, None, "user", "no turn"),
    (2, 1, None, "no role"),
    (2, 1, "assistant", "tie b"),
    (2, 1, "assistant", "tie a"),
    (3, 0, "assistant", "same"),
    (3, 0, "assistant", "same"),
    (None, 0, "user", "no id"),
    (4, 0, "assistant", "word " * 20_000),
]


def conversations(spark, rows=ROWS):
    kind = "conv_id long, turn long, role string, text string, formatted string, turns int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], kind)


def expected(rows):
    whole = {}
    for i, turn, role, text in rows:
        whole.setdefault(i, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {
        i: ([x[2:] for x in sorted(turns)], "".join(x[3] for x in sorted(turns) if x[2] == "assistant"))
        for i, turns in whole.items()
    }


def test_turns_and_loss_text_come_back(spark):
    read = read_back(format_conversations(conversations(spark))).collect()
    found = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_text"]) for r in read}
    assert found == expected(ROWS)


def test_rows_without_an_id_are_conversations_of_their_own(spark):
    rows = [(None, i % 3, "assistant", f"text {i // 2}") for i in range(40)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    read = read_back(format_conversations(conversations(spark, rows))).collect()
    found = sorted(([tuple(t) for t in r["turns"]], r["loss_text"]) for r in read if r["conv_id"] is None)
    assert found == sorted(([x[2:]], x[3]) for x in rows[:40])
    assert [len(r["turns"]) for r in read if r["conv_id"] == 1] == [2] and len(read) == 41


def test_no_rows(spark):
    assert read_back(format_conversations(conversations(spark, []))).count() == 0


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_escapes_are_reversible(text):
    assert "<" not in escaped(text) and unescaped(escaped(text)) == text


def test_overlap_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(300):
        cuts = np.sort(rng.choice(60, 9, replace=False))
        tokens = np.stack([cuts[:-1], cuts[1:]], 1)
        marks = np.sort(rng.choice(60, 4, replace=False)).tolist()
        starts, ends = marks[0::2], marks[1::2]
        found = overlap(tokens, starts, ends)
        for (a, b), (low, high) in zip(tokens.tolist(), found.tolist()):
            parts = [(max(a, s), min(b, e)) for s, e in zip(starts, ends) if max(a, s) < min(b, e)]
            assert (low, high) == (parts[0] if parts else (0, 0))


def test_render_marks_assistant_texts_only():
    text, starts, ends = render([("user", "hi"), ("assistant", "a<b"), ("assistant", "")])
    assert [text[a:b] for a, b in zip(starts, ends)] == ["a\\lb"]


def test_query_over_the_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {r["conv_id"]: r for r in all_queries()["op1_chat"](spark, tables).collect()}
    want = expected(rows)
    assert found.keys() == want.keys()
    for i, (turns, loss) in want.items():
        assert found[i]["n_turns"] == len(turns)
        assert found[i]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (found[i]["loss_chars"], found[i]["loss_sha256"]) == (len(loss), sha(loss))
