import zlib

import numpy as np
import odd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upkeep.llm.packing import STEP_SEQUENCES, pack, plan
from upkeep.llm.queries import all_queries
from upkeep.llm.sequences import BATCH, SequenceReader, arrow_address, located, read_documents, store, write_sequences
from upkeep.llm.tokens import ChunkEncoder, default_tokenizer

ENCODER = ChunkEncoder(default_tokenizer())


def direct(text):
    return np.array(ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def ids_of(text):
    return np.frombuffer(direct(text) + np.array([2], "<u4").tobytes(), "<u4")


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_chunks_equal_whole_texts(text):
    assert ENCODER.encode([text.encode()]) == [direct(text)]


def test_odd_and_table_texts(table_docs):
    texts = [t or "" for _, t in odd.TEXTS] + [r[0] for r in table_docs.select("text").collect()]
    assert ENCODER.encode([t.encode() for t in texts]) == [direct(t) for t in texts]


MARKED = [
    "hello <|endoftext|> world",
    "Hello<|startoftext|>A <|endoftext|>B<|endoftext|>",
    "<|ENDOFTEXT|> is no mark, <|EndOfText|> neither",
    "<|endoftext|>, <|ENDOFTEXT|> É don't",
    "<|endoftext |> <| endoftext|>",
]


def test_added_tokens_as_the_library_finds_them(spark):
    fresh = Tokenizer.from_file(default_tokenizer())
    want = [fresh.encode(t, add_special_tokens=False).ids for t in MARKED]
    found = ENCODER.encode([t.encode() for t in MARKED])
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == want
    assert [ENCODER.encode([t.encode()]) for t in MARKED] == [[x] for x in found]
    assert want[0] == [3306, 49407, 1002] and 49407 not in want[2]
    docs = odd.documents(spark, list(enumerate(MARKED)))
    pieces = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in pack(docs).collect()}
    assert {i: x[: len(want[i])] for i, x in pieces.items()} == dict(enumerate(want))


def test_files_hold_all_ids_in_order(spark, docs, tmp_path):
    shards = write_sequences(docs, str(tmp_path / "files"))
    found = read_documents(shards, str(tmp_path / "files")).orderBy("start").collect()
    want = sorted(odd.TEXTS, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in found] == [i for i, _ in want]
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    key = lambda x: (x[0] is not None, *x)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=key) == sorted(
        ((i, len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for i, t in want), key=key
    )
    name = shards.first()["name"]
    reader = SequenceReader(located(spark, str(tmp_path / "files")), f"{name}.arrow")
    ids, mask = reader.sequence(0, BATCH)
    assert len(ids) == len(mask) == reader.length and ids.base is not None
    with pa.ipc.open_file(str(tmp_path / "files" / f"{name}.arrow")) as file:
        assert pa.types.is_fixed_size_list(file.schema.field("ids").type)


def test_roots_are_those_of_spark(spark):
    assert located(spark, "/a/b") == "file:/a/b"  # the default of a local session
    assert store("file:/a/b")[1] == store("file:///a/b")[1] == "/a/b"
    assert located(spark, "s3a://bucket/x") == "s3a://bucket/x"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://names:8020")
    try:
        assert located(spark, "/a/b") == "hdfs://names:8020/a/b"
        assert located(spark, "file:/a/b") == "file:/a/b"
    finally:
        conf.set("fs.defaultFS", before)
    assert arrow_address("s3a://bucket/x") == "s3://bucket/x"
    assert arrow_address("hdfs://names:8020/a b") == "hdfs://names:8020/a%20b"


def test_unknown_file_systems_are_refused_before_anything_is_read(spark, docs):
    with pytest.raises(ValueError, match="ftp is none of"):
        write_sequences(docs, "ftp://host/files")


def test_parts_of_lost_tasks_go(spark, docs, tmp_path):
    root = tmp_path / "files"
    root.mkdir()
    for name in ("_shard-000000.arrow.1f.part", "_index-2e.part"):
        (root / name).write_bytes(b"half")
    shards = write_sequences(docs, str(root))
    assert not list(root.glob("_*"))
    assert read_documents(shards, str(root)).count() == docs.count()


def test_no_documents(spark, none, tmp_path):
    shards = write_sequences(none, str(tmp_path / "files"))
    assert read_documents(shards, str(tmp_path / "files")).count() == 0
    assert pack(none).count() == 0


@given(st.lists(st.integers(1, 300), max_size=60))
@settings(max_examples=200, deadline=None)
def test_plan_covers_every_id_once(lengths):
    full, rest = plan(lengths, window=64, tiers=3)
    seen = [np.zeros(n, int) for n in lengths]
    for w in full + rest:
        for piece, start, length in w:
            seen[piece][start : start + length] += 1
    assert all((s == 1).all() for s in seen)
    assert all(sum(x[2] for x in w) in (64, 32, 16) for w in full)
    assert len(rest) <= 1 and all(sum(x[2] for x in w) < 16 for w in rest)


@pytest.mark.parametrize("name", ["odd", "table"])
def test_packed_pieces(spark, docs, table_docs, name):
    source = docs if name == "odd" else table_docs
    pieces = pack(source).collect()
    texts = [(r["doc_id"], ids_of(r["text"])) for r in source.select("doc_id", "text").collect()]
    sequences, ids = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
        assert len(p["ids"]) == 4 * p["length"]
        ids.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    for some in sequences.values():
        some.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in some] == [sum(q["length"] for q in some[:k]) for k in range(len(some))]
        assert sum(p["length"] for p in some) <= some[0]["window"]
    total = sum(len(x) for _, x in texts)
    padded = sum(p[0]["window"] for p in sequences.values())
    assert padded - total <= 4096 * 2
    # Documents of one id and length are told apart by their ids only.
    joined = sorted((-1 if k[0] is None else k[0], b"".join(x for _, x in sorted(v))) for k, v in ids.items())
    once = {}
    for i, x in texts:
        once.setdefault((i, len(x)), []).append(x.tobytes())
    if name == "table":
        assert joined == sorted((k[0], b"".join(v)) for k, v in once.items())
    else:
        assert sum(len(x) for _, x in joined) == 4 * total
    steps = {}
    for p in pieces:
        steps.setdefault(p["step_group"], {})[p["sequence_id"]] = p["window"]
    assert all(len(x) <= STEP_SEQUENCES and len(set(x.values())) == 1 for x in steps.values())


def test_queries_over_the_table(spark, tables, table_docs):
    want = {r["doc_id"]: ids_of(r["text"]) for r in table_docs.collect()}
    found = {r["doc_id"]: r for r in all_queries()["op7_token_files"](spark, tables).collect()}
    assert found.keys() == want.keys()
    at = 0
    for i in sorted(want):
        assert (found[i]["start"], found[i]["n_tokens"]) == (at, len(want[i]))
        assert found[i]["ids_crc32"] == zlib.crc32(want[i].tobytes())
        at += len(want[i])
    pieces = all_queries()["op2_packing"](spark, tables).where(F.col("length") > 0).collect()
    for p in pieces:
        part = want[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(want[p["doc_id"]])
    assert sum(p["length"] for p in pieces) == sum(map(len, want.values()))


class Recorder:
    """A tokenizer that notes what is encoded in batches."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_signs_after_words_are_encoded_apart():
    encoder = ChunkEncoder(default_tokenizer())
    encoder.tokenizer = recorder = Recorder(encoder.tokenizer)
    texts = ["that*** that re%%%. été### \"(x)\" a_ don't' $$$", "that*** été### that", "", "new&&& ***"]
    found = encoder.encode([t.encode() for t in texts])
    assert sorted(recorder.seen) == sorted(["***", "%%%.", "###", '"(x)"', "_", "don't'", "$$$", "&&&"])
    fresh = Tokenizer.from_file(default_tokenizer())
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [fresh.encode(t, add_special_tokens=False).ids for t in texts]
