import random

import duckdb
import odd
from pyspark.sql import functions as F

from compare import rows_of
from upkeep.llm.lines import NEAR_WORDS, dedup_lines
from upkeep.llm.oracles import all_oracles
from upkeep.llm.queries import all_queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def tie_of(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    return {r["t"]: r["h"] for r in rows.collect()}


def expected(texts, ties):
    """(id, text) to the text that stays, by comparing every line with every earlier one."""
    lines = []
    for i, t in {(i, t) for i, t in texts if t is not None}:
        for n, line in enumerate(t.split("\n")):
            words = [w for w in line.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
            if words:
                lines.append(((i is not None, i or 0, ties[t], n), (i, t), words))
    lines.sort(key=lambda x: x[0])
    gone = {}
    for k, (place, doc, words) in enumerate(lines):
        for _, _, before in lines[:k]:
            near = min(len(words), len(before)) >= NEAR_WORDS and abs(len(words) - len(before)) < 2 and distance(words, before) < 2
            if words == before or near:
                gone.setdefault(doc, []).append(place[3])
                break
    return {
        (i, t): ("\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), ())), gone.get((i, t), []))
        for i, t in texts
        if t is not None
    }


def check(spark, frame, texts):
    rows, name = dedup_lines(frame)
    assert rows.columns == [*frame.columns, name]
    want = expected(texts, tie_of(spark, {t for _, t in texts if t is not None}))
    got = sorted(((r["doc_id"], r["text"], list(r[name]["dropped"])) for r in rows.collect()), key=repr)
    assert got == sorted(((i, *(want[i, t] if t is not None else (None, []))) for i, t in texts), key=repr)


def test_odd_documents(spark, docs):
    check(spark, docs, odd.TEXTS)


def test_no_documents(spark, none):
    assert dedup_lines(none)[0].count() == 0


def edited(words, rng):
    words = list(words)
    for _ in range(rng.randint(0, 2)):
        k = rng.randrange(len(words))
        kind = rng.randrange(4)
        if kind == 0:
            words[k] = "new" + str(rng.randrange(3))
        elif kind == 1:
            words.insert(rng.randrange(len(words) + 1), words[k])
        elif kind == 2 and len(words) > 2:
            del words[k]
        else:
            words[k], words[k - 1] = words[k - 1], words[k]
    return words


def test_edits_against_brute_force(spark):
    rng = random.Random(3)
    base = [odd.prose(s, n).split() for s, n in enumerate([3, 7, 8, 8, 9, 12, 17, 40])]
    base.append(["a", "b"] * 6)
    texts = [(i, "\n".join(" ".join(edited(rng.choice(base), rng)) for _ in range(4))) for i in range(60)]
    check(spark, odd.documents(spark, texts), texts)


def test_lines_that_differ_at_one_place_are_one_group(spark):
    frame = odd.documents(spark, [(i, f"this is page number {i} of a long report") for i in range(300)])
    rows, name = dedup_lines(frame)
    assert rows.where(F.size(F.col(name)["dropped"]) == 0).select("doc_id").collect() == [(0,)]


def test_colliding_keys_are_compared_with_all(spark, monkeypatch):
    """With keys that tell positions apart no longer, verification decides and loses no link."""
    import upkeep.llm.lines as module

    real = module.variants
    monkeypatch.setattr(
        module,
        "variants",
        lambda w: F.transform(real(w), lambda v: F.struct(v["kind"].alias("kind"), F.least(v["kind"], F.lit(1)).cast("long").alias("key"))),
    )
    rng = random.Random(4)
    base = [odd.prose(s, 9).split() for s in range(4)]
    texts = [(i, " ".join(edited(rng.choice(base), rng))) for i in range(40)]
    check(spark, odd.documents(spark, texts), texts)


def permuted(count):
    """Cells in any order between the same marks, half of the lines with a last word that the others lack.

    So all lines without it equal, by their neighbours, every line with it but for one word.
    """
    rng = random.Random(5)
    cells = [f"c{k}" for k in range(9)]
    lines = []
    for k in range(count):
        rng.shuffle(cells)
        lines.append("first | " + " | ".join(cells) + (" | last" if k % 2 else " |"))
    return lines


def test_lines_of_the_same_neighbours_against_brute_force(spark):
    rng = random.Random(6)
    lines = permuted(40)
    lines += [" ".join(edited(line.split(), rng)) for line in lines]
    lines += ["x y " * k + "end of the line that begins like others" for k in range(1, 9)]
    rng.shuffle(lines)
    texts = list(enumerate(lines))
    check(spark, odd.documents(spark, texts), texts)


def test_many_lines_of_the_same_neighbours(spark):
    """100,000 lines whose keys are all equal: no pairs of them are listed, and each repeat is found."""
    lines = permuted(100_000)
    lines += [line.replace("last", "least") for line in lines[1:11:2]]
    frame = odd.documents(spark, [(k, "\n".join(lines[k : k + 1000])) for k in range(0, len(lines), 1000)])
    rows, name = dedup_lines(frame)
    gone = {r["doc_id"] + p for r in rows.collect() for p in r[name]["dropped"]}
    seen, want = set(), set()
    for k, line in enumerate(lines):
        # One edit apart are only lines of the same order, as a cell elsewhere takes two.
        order = tuple(w for w in line.split() if w.startswith("c"))
        if order in seen:
            want.add(k)
        seen.add(order)
    assert gone == want and len(want) > 5


def test_query_equals_its_sql(spark, tables):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tables}/documents.parquet'")
    found = all_queries()["op5_line_dedup"](spark, tables).toArrow()
    assert rows_of(found) == rows_of(connection.sql(all_oracles()["op5_line_dedup"]).to_arrow_table())


def test_no_python_in_the_plan(spark, tables):
    rows, _ = dedup_lines(spark.read.parquet(f"{tables}/documents.parquet"))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_lines_at_places(spark, monkeypatch):
    """Only the lines asked for are joined; with few bits, whose lines fall together, the same."""
    from upkeep.llm import common
    from upkeep.llm.lines import lines_at

    docs = spark.createDataFrame([(i, i, f"a {i}\n\nb {i}") for i in range(40)] + [(None, 1, "x\ny"), (3, 3, "a 3\n\nb 3")], "doc_id long, tie long, text string")
    places = spark.createDataFrame([(1, 2, 3, 3, 2), (4, 5, None, 1, 1), (6, 7, 9, 9, 0)], "h1 long, h2 long, doc_id long, tie long, pos int")
    want = [(1, 2, 3, 3, 2, "b 3")] * 2 + [(4, 5, None, 1, 1, "y"), (6, 7, 9, 9, 0, "a 9")]
    for bits in (24, 6):
        monkeypatch.setattr(common, "BITS", bits)
        assert sorted(map(tuple, lines_at(docs, places).collect())) == want
