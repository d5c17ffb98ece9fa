"""Token ids as binary files of equal-length sequences.

A shard is two Arrow IPC files. ``shard-N.arrow`` holds record batches with two columns of
fixed-size lists: ``ids`` (16-bit where the vocabulary allows, else 32-bit) and ``mask`` (true for
a token, false for padding, which only the last sequence has). Buffers are not compressed, so a
reader that maps the file gets ids and masks of sequence k without copying or parsing what lies
before. ``shard-N.index.arrow`` holds doc_id, start and length of each document in the shard.
Shards are ranges of doc_id in ascending order.
"""

from __future__ import annotations

import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.common import documents, local_rows
from upkeep.llm.tokens import ChunkEncoder, default_tokenizer
from upkeep.workspace import scratch, stabilise

#: Ids of a sequence, and sequences of a record batch.
SEQUENCE, BATCH = 4096, 64
END_ID = 2


#: Schemes of Spark's addresses, and what Arrow calls the same file systems.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfss": "abfss"}


def located(spark: SparkSession, root: str) -> str:
    """``root`` as Spark's writers understand it, in full: a path without a scheme lies on the default file system.

    Raises ValueError, before anything is written, where Arrow has no such file system.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.toUri().getScheme():
        default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration())
        path = path.makeQualified(default, spark._jvm.org.apache.hadoop.fs.Path("/"))
    scheme = path.toUri().getScheme()
    if scheme not in SCHEMES:
        raise ValueError(f"token files cannot be written to {root}: {scheme} is none of {', '.join(SCHEMES)}")
    return path.toString()


def store(root: str):
    """The file system of ``root``, as ``located`` returns it, and its path there."""
    from pyarrow import fs

    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(arrow_address(root))


def arrow_address(root: str) -> str:
    """``root``, as ``located`` returns it, as an address for Arrow."""
    scheme, _, rest = root.partition(":")
    return f"{SCHEMES[scheme]}:{quote(rest, safe='/:@')}"


def sweep(spark: SparkSession, root: str) -> None:
    """Delete what attempts that were lost or ran twice have left unfinished under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for left in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "_*.part")) or []:
        files.delete(left.getPath(), False)


def schema_for(bits: int, length: int) -> pa.Schema:
    kind = pa.uint16() if bits == 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a stream of ids into sequences; the file appears under its name only when complete."""

    def __init__(self, root: str, name: str, bits: int, length: int, per_batch: int):
        self.fs, base = store(root)
        self.fs.create_dir(base)
        self.final, self.part = f"{base}/{name}", f"{base}/_{name}.{np.random.SeedSequence().entropy:x}.part"
        self.schema, self.length, self.per_batch = schema_for(bits, length), length, per_batch
        self.dtype = np.uint16 if bits == 16 else np.uint32
        self.file = self.fs.open_output_stream(self.part)
        self.out = pa.ipc.new_file(self.file, self.schema)
        self.waiting, self.n = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.n += len(ids)
        if self.n >= self.length * self.per_batch:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids, size = np.concatenate([*self.waiting, np.zeros(0, self.dtype)]), self.length * self.per_batch
        while len(ids) >= size or last and len(ids):
            some, ids = ids[:size], ids[size:]
            whole = -(-len(some) // self.length) * self.length
            mask = np.zeros(whole, bool)
            mask[: len(some)] = True
            some = np.pad(some, (0, whole - len(some)))
            columns = [pa.array(some), pa.array(mask)]
            lists = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in columns]
            self.out.write_batch(pa.record_batch(lists, self.schema))
        self.waiting, self.n = [ids], len(ids)

    def close(self) -> str:
        self.flush(True)
        self.out.close()
        self.file.close()
        self.fs.move(self.part, self.final)
        return self.final


class SequenceReader:
    """Random access to the sequences of one shard."""

    def __init__(self, root: str, name: str):
        self.fs, base = store(root)
        local = self.fs.type_name == "local"
        self.file = pa.memory_map(f"{base}/{name}") if local else self.fs.open_input_file(f"{base}/{name}")
        self.reader = pa.ipc.open_file(self.file)
        self.length = self.reader.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def block(self, number: int) -> pa.RecordBatch:
        if number != self.at:
            self.at, self.batch = number, self.reader.get_batch(number)
        return self.batch

    def ids(self, start: int, length: int, per_batch: int):
        """Views of the ids from ``start`` on, one for each record batch that holds some."""
        size = per_batch * self.length
        while length > 0:
            number, offset = divmod(start, size)
            values = self.block(number).column("ids").flatten().to_numpy(zero_copy_only=True)
            some = values[offset : offset + length]
            yield some
            start, length = start + len(some), length - len(some)

    def sequence(self, number: int, per_batch: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        block, row = self.block(number // per_batch), number % per_batch
        part = slice(row * self.length, (row + 1) * self.length)
        ids = block.column("ids").flatten().to_numpy(zero_copy_only=True)[part]
        return ids, block.column("mask").flatten().to_numpy(zero_copy_only=False)[part]


def write_sequences(
    docs: DataFrame,
    root: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    length: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts and write them under ``root`` in ascending order of their id.

    Returns one row per shard, in order: shard, name, n_docs, n_tokens, before (ids of all shards
    before it). Null texts are empty and give the end id alone; null ids come first; rows with
    equal ids are ordered by a hash of their text, and repeated rows each have a place. An empty
    table gives no files. A task that runs again replaces its files by equal ones; what lost tasks
    leave unfinished is deleted in the end. A root without a scheme lies on Spark's default file system.
    """
    spark = docs.sparkSession
    root = located(spark, root)
    path = tokenizer or default_tokenizer()
    rows = documents(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    order = ["doc_id", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select(F.spark_partition_id().alias("shard"), "doc_id", F.col("text").cast("binary").alias("text"))

    def write(batches):
        encoder = ChunkEncoder.of(path)
        bits = 16 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 32
        out, index, shard, start = None, [], 0, 0
        tail = np.array([end_id], "<u4")
        for batch in batches:
            if out is None and batch.num_rows:
                shard = batch.column("shard")[0].as_py()
                out = SequenceWriter(root, f"shard-{shard:06}.arrow", bits, length, BATCH)
            ids, texts = batch.column("doc_id"), batch.column("text")
            counts = np.zeros(batch.num_rows, np.int64)
            for a in range(0, batch.num_rows, 500):
                for i, found in enumerate(encoder.encode(texts[a : a + 500].to_pylist()), a):
                    found = np.concatenate([np.frombuffer(found, "<u4"), tail])
                    counts[i] = len(found)
                    out.add(found)
            starts = start + np.cumsum(counts) - counts
            index.append(pa.record_batch({"doc_id": ids, "start": starts, "length": counts}))
            start += int(counts.sum())
        if out is None:
            return
        out.close()
        files, base = store(root)
        name = f"{base}/shard-{shard:06}.index.arrow"
        part = f"{base}/_index-{np.random.SeedSequence().entropy:x}.part"
        with files.open_output_stream(part) as file, pa.ipc.new_file(file, index[0].schema) as writer:
            for batch in index:
                writer.write_batch(batch)
        files.move(part, name)
        rows = sum(b.num_rows for b in index)
        yield pa.record_batch({"shard": [shard], "n_docs": [rows], "n_tokens": [start]})

    manifest = stabilise(ranged.mapInArrow(write, "shard long, n_docs long, n_tokens long"))
    sweep(spark, root)
    rows, before = [], 0
    for r in sorted(manifest.collect()):  # a row for each file
        rows.append((r[0], f"shard-{r[0]:06}", r[1], r[2], before))
        before += r[2]
    schema = "shard long, name string, n_docs long, n_tokens long, before long"
    return local_rows(spark, rows, schema, len(rows))


def read_documents(shards: DataFrame, root: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    root = located(shards.sparkSession, root)

    def read(batches):
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist()):
                files, base = store(root)
                with files.open_input_file(f"{base}/{name}.index.arrow") as file:
                    index = pa.ipc.open_file(file).read_all()
                reader = SequenceReader(root, f"{name}.arrow")
                starts, lengths = (index.column(c).to_numpy() for c in ("start", "length"))
                checks = np.zeros(len(starts), np.int64)
                for i, (start, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
                    value = 0
                    for ids in reader.ids(start, n, BATCH):
                        value = zlib.crc32(ids.astype("<u4"), value)
                    checks[i] = value
                yield pa.record_batch(
                    {
                        "doc_id": index.column("doc_id").combine_chunks(),
                        "start": starts + before,
                        "n_tokens": lengths,
                        "ids_crc32": checks,
                    }
                )

    return shards.select("name", "before").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, root: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as sequence files (to the shared folder unless ``root`` is given) and read them back."""
    root = root or scratch(docs.sparkSession, "sequences")
    return read_documents(write_sequences(docs, root, **options), root)
