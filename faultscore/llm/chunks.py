"""Texts packed in chunks, and messages between chunks and hash buckets.

Operators that compare every place of every text send far more keys than the
texts have rows.  Texts are therefore packed in chunks of a few megabytes
(compressed, written once to the shared folder in buckets of the chunk's
number, so that joining answers to them never moves a text).  A chunk sends each hash
bucket one message with all its keys there; the bucket, one shuffle
partition, answers each chunk with one message; answers meet their chunk in a
join.  A chunk sends a key once however often it holds it, so a key in a
third of all rows costs its bucket one entry per chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, shared_path, shuffle_partitions, written

CHUNK_BYTES = 4 << 20
#: A row without an id comes after all others.
NO_ID = np.iinfo(np.int64).max

CHUNK_SCHEMA = "chunk long, n_bytes long, ids array<long>, sizes array<long>, texts binary"
_ARROW = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())])


@dataclass
class Chunk:
    """Texts one after the other, with their ids (None: no id) and sizes."""

    chunk: int
    ids: list
    sizes: np.ndarray
    data: bytes

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def order_ids(self) -> np.ndarray:
        return np.array([NO_ID if i is None else i for i in self.ids], dtype=np.int64)


def pack(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk; null texts are empty.  Written, so chunks stay as they are."""
    rows = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def row():
            blob = b"".join(texts)
            return pa.RecordBatch.from_pydict({"chunk": [(part << 32) + seq], "n_bytes": [len(blob)], "ids": [ids], "sizes": [[len(t) for t in texts]], "texts": [squeeze.compress(blob)]}, schema=_ARROW)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                held += len(t)
                if held >= chunk_bytes:
                    yield row()
                    seq, ids, texts, held = seq + 1, [], [], 0
        if ids:
            yield row()

    return _bucketed(rows.mapInArrow(run, CHUNK_SCHEMA))


def _bucketed(chunks: DataFrame) -> DataFrame:
    """The chunks from a table in the shared folder, bucketed by number.

    The catalog's entry is dropped at once: the DataFrame has its files and
    bucketing, and the folder is the checkpoint folder's to clean.
    """
    spark = chunks.sparkSession
    name = f"faultscore_chunks_{uuid.uuid4().hex}"
    parts = shuffle_partitions(spark)
    chunks.write.bucketBy(parts, "chunk").option("path", shared_path(spark, "chunks")).option("compression", "uncompressed").saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return table


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, int]]:
    """The chunks of a batch, with their row number."""
    expand = zstandard.ZstdDecompressor()
    for r in range(batch.num_rows):
        col = lambda name, r=r: batch.column(batch.schema.get_field_index(name))[r]
        size = col("n_bytes").as_py()
        data = expand.decompress(col("texts").as_py(), max_output_size=size) if size else b""
        yield Chunk(col("chunk").as_py(), col("ids").as_py(), np.array(col("sizes").as_py(), dtype=np.int64), data), r


def replies_of(batch: pa.RecordBatch, r: int) -> list[dict[int, bytes]]:
    """For each round of questions so far, the payload of each bucket."""
    out = []
    while (at := batch.schema.get_field_index(f"replies{len(out)}")) >= 0:
        out.append({x["bucket"]: x["payload"] for x in batch.column(at)[r].as_py() or ()})
    return out


_MESSAGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("payload", pa.binary())])
MESSAGE_SCHEMA = "bucket int, chunk long, payload binary"


def _message_rows(rows: Iterable[tuple[int, int, bytes]], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _MESSAGE.types)], schema=_MESSAGE)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _MESSAGE.types)], schema=_MESSAGE)


def ask(chunks: DataFrame, buckets: int, emit: Callable[..., Iterable[tuple[int, bytes]]], answer: Callable[[list[tuple[int, bytes]]], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """(to_chunk, replies): what the buckets answer to each chunk; written.

    ``emit(chunk, replies)`` yields a payload per bucket; ``answer([(chunk
    number, payload)])`` yields a payload per chunk.
    """

    def send(batches):
        for batch in batches:
            yield from _message_rows((b, chunk.chunk, p) for chunk, r in unpack(batch) for b, p in emit(chunk, replies_of(batch, r)))

    def receive(batches):
        got: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for b, c, p in zip(*(batch.column(i).to_pylist() for i in range(3))):
                got.setdefault(b, []).append((c, p))
        yield from _message_rows((b, c, p) for b in sorted(got) for c, p in answer(sorted(got.pop(b))))

    messages = chunks.mapInArrow(send, MESSAGE_SCHEMA)
    answers = messages.repartitionById(buckets, F.col("bucket")).mapInArrow(receive, MESSAGE_SCHEMA)
    per_chunk = answers.groupBy(F.col("chunk").alias("to_chunk")).agg(F.collect_list(F.struct("bucket", "payload")).alias("replies"))
    return written(per_chunk, "replies", "uncompressed")


def with_replies(chunks: DataFrame, *rounds: DataFrame) -> DataFrame:
    """Chunks with the answers of each round as replies0, replies1, ..."""
    for i, replies in enumerate(rounds):
        named = replies.select("to_chunk", F.col("replies").alias(f"replies{i}"))
        chunks = chunks.join(named, chunks["chunk"] == named["to_chunk"], "left").drop("to_chunk")
    return chunks


def bucket_count(chunks: DataFrame, bytes_per_bucket: int) -> int:
    """Buckets for the texts' size, so that one bucket's messages fit in memory."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return shuffle_partitions(chunks.sparkSession, total, bytes_per_bucket)


# ------------------------------------------------------------ packed numbers

LOW = (1 << 48) - 1


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def to_six(values: np.ndarray) -> bytes:
    """The low 48 bits of each value, six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices in ascending order) of every bucket in use."""
    if buckets < 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by radix
    order = np.argsort(bucket, kind="stable")
    held = bucket[order]
    cuts = np.flatnonzero(held[1:] != held[:-1]) + 1
    for of_one in np.split(order, cuts) if len(order) else ():
        yield int(bucket[of_one[0]]), of_one


# ------------------------------------------------------------------ hashing

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_RANDOM = np.random.default_rng(20240607).integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out[:n]


INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result hangs on every bit of h."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value[i] * BASE ** i below each place: range_hash() input."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end], the same wherever the range stands."""
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def byte_values(data: bytes) -> np.ndarray:
    return _RANDOM[np.frombuffer(data, dtype=np.uint8)]


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the words of a chunk's texts, in order."""
    raw = np.frombuffer(chunk.data, dtype=np.uint8)
    inside = ~SPACES[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[chunk.starts] = True
    before = np.r_[False, inside[:-1]] if len(raw) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.r_[inside[1:], False] if len(raw) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(chunk.starts + chunk.sizes, start, side="right")


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = prefix_sums(byte_values(data))
    return range_hash(sums, start, end, powers(len(data) + 1, INVERSE))
