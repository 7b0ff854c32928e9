"""Token-ID files with Elias-Fano document boundaries (operator 10).

A file is a Parquet table of shards, written through Spark so that a lost task
leaves nothing half done. A shard holds the ids of many documents end to end, as
unsigned integers of the smallest width that the vocabulary needs, and where
each document ends as an Elias-Fano sequence: low bits packed, high bits as
unary gaps in a bitmap, with the place of every 64th one kept for select, by which
the reader finds where a document ends. Shards are in ascending order of (part,
seq), documents in ascending order of their ids, which are stored as they are.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import freeing, fresh_path, pick, prepare_python
from .words import encode_dropping_space

END_ID = 2
#: Ids and documents after which a shard is closed.
SHARD_IDS = 1 << 18
SHARD_DOCS = 1 << 14
_SAMPLE = 64
_HEAD = struct.Struct("<QQB")  # values, universe, low bits

SHARD_SCHEMA = "part int, seq int, n_ids long, width int, doc_ids array<long>, ends binary, ids binary"


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``universe`` in near-minimal space."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray) -> None:
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n, universe = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        marks = np.zeros((universe >> low_bits) + n + 1, dtype=np.uint8)
        ones = (values >> low_bits) + np.arange(n)
        marks[ones] = 1
        return cls(n, universe, low_bits, low.tobytes(), np.packbits(marks, bitorder="little").tobytes(), ones[::_SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.n, self.universe, self.low_bits) + self.samples.tobytes() + self.low + self.high

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, low_bits = _HEAD.unpack_from(data)
        low_at = _HEAD.size + 4 * -(-n // _SAMPLE)
        cut = low_at + -(-n * low_bits // 8)
        return cls(n, universe, low_bits, data[low_at:cut], data[cut:], np.frombuffer(data[_HEAD.size : low_at], "<u4"))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        piece = int.from_bytes(self.low[at >> 3 : (at + self.low_bits + 7) >> 3], "little")
        return (piece >> (at & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value (from 0): jump to the nearest sampled one, then count ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // _SAMPLE]), i % _SAMPLE
        at, skip = place >> 3, place & 7
        byte = self.high[at] >> skip << skip
        while (ones := byte.bit_count()) <= left:
            left -= ones
            at += 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        place = (at << 3) + (byte & -byte).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64)) if self.low_bits else np.zeros(self.n, np.int64)
        return ((ones - np.arange(self.n)) << self.low_bits) | low


def _shards(path: str, end_id: int, width: int) -> Callable:
    """Encode sorted (doc_id, text) rows into shards."""
    kind = f"<u{width}"
    end = np.array([end_id], dtype=kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        pieces: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            ends = EliasFano.build(np.cumsum(sizes)).to_bytes()
            row = {"part": part, "seq": seq, "n_ids": held, "width": width, "doc_ids": list(doc_ids), "ends": ends, "ids": b"".join(pieces)}
            return pa.RecordBatch.from_pylist([row], SHARD)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_dropping_space([t or "" for t in batch.column(1).to_pylist()], path, kind), strict=True):
                doc_ids.append(doc_id)
                pieces += (ids, end)
                sizes.append(len(ids) // width + 1)
                held += sizes[-1]
                if held >= SHARD_IDS or len(sizes) >= SHARD_DOCS:
                    yield shard()
                    seq, held = seq + 1, 0
                    doc_ids, sizes, pieces = [], [], []
        if sizes:
            yield shard()

    return run


SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.binary()), ("ids", pa.binary())])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending order of doc_id.

    Null texts are empty: such a document has the end id only. Null ids come
    first; rows with one id follow each other in order of their texts; other
    columns are ignored; an empty table leaves a table without shards. ``width``
    is the bytes of an id: 2 is enough for 65,536 ids.
    """
    prepare_python(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(freeing(_shards(tokenizer_path, end_id, width)), SHARD_SCHEMA).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            bounds = EliasFano.from_bytes(row["ends"])
            ends = np.array([bounds.select(i) for i in range(bounds.n)], dtype=np.int64)
            ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}").astype("<u4").tobytes()
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(ends)
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crcs, pa.int64())], ["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files.

    ``start`` adds up the parts before, the shards of the part before, and the
    documents of the shard before. Only the parts, one small row for each task
    that wrote, are added up in one task.
    """
    prepare_python(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sums = lambda n, window: F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", sums("n", Window.orderBy("part")).alias("before"))
    within = shards.select("part", "seq", sums("n_ids", Window.partitionBy("part").orderBy("seq")).alias("ahead"))
    bases = within.join(parts, "part").select("part", "seq", (F.col("before") + F.col("ahead")).alias("base"))
    found = shards.mapInArrow(freeing(_documents), "part int, seq int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return found.join(bases, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the files (by default to a new shared folder) and describe the documents read back."""
    path = path or fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, **options)
    return read_documents(docs.sparkSession, path)
