"""SimHash near-deduplication by multi-index hashing (operator 4).

Fingerprints of 64 bits come from 3-word shingles. Equal fingerprints collapse
first. Each distinct fingerprint is cut into two segments of 32 bits; if two
fingerprints differ in at most 2 bits, one segment differs in at most 1, so
probing the ball of radius 1 around each segment finds every link. Matches are
verified on all 64 bits.

A segment value that more than ``BUCKET`` fingerprints hold would give pairs
with the square of that number. Such buckets are left out of the probing, and
all fingerprints that probe them are linked exactly another way: two
fingerprints differ in at most 2 bits if and only if they share a point at 1 bit
or less from both, so grouping by these 65 points and linking each group to its
smallest member loses no link and makes no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, materialise, pick, prepare_python
from .components import connected_components

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
SEGMENT_BITS = 32
#: A bucket with more fingerprints than this is linked by shared points.
BUCKET = 64
_VOTES_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the 3-word shingles; 0 if there are no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return 0
    if n < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=max(1, n - SHINGLE_WORDS + 1))
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _VOTES_AT_ONCE):
        part = hashes[start : start + _VOTES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(prints, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    prepare_python(docs.sparkSession)
    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(freeing(_fingerprint_batches), "doc_id long, fp long")


def _segments(df: DataFrame) -> DataFrame:
    """The table: a row (key, fp) for each segment; a key holds the segment's number and value."""
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    return df.select("fp", F.explode(F.array(high, low.bitwiseOR(F.lit(1 << SEGMENT_BITS)))).alias("key"))


def _probes(df: DataFrame) -> DataFrame:
    """The balls of radius 1 around each segment, as keys of the table."""
    flips = F.expr(f"explode(sequence(0, {SEGMENT_BITS}))")
    ball = _segments(df).select("fp", "key", flips.alias("flip"))
    one = F.expr(f"if(flip = {SEGMENT_BITS}, 0L, shiftleft(1L, flip))")
    return ball.select("fp", F.col("key").bitwiseXOR(one).alias("key"))


def _shared_points(df: DataFrame) -> DataFrame:
    """Links (a, b) to the smallest fingerprint with which a point at 1 bit or less is shared."""
    one = F.expr("if(flip = 64, 0L, shiftleft(1L, flip))")
    points = df.select("fp", F.expr("explode(sequence(0, 64))").alias("flip")).select("fp", F.col("fp").bitwiseXOR(one).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return points.join(least, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within MAX_DISTANCE bits."""
    table = _segments(distinct)
    crowded = materialise(table.groupBy("key").count().where(F.col("count") > bucket).select("key"), "crowded", distinct.count() // bucket)
    probes, rest = _probes(distinct), None
    if not crowded.isEmpty():
        rest = _shared_points(probes.join(crowded, "key", "left_semi").select("fp").distinct())
        table = table.join(crowded, "key", "left_anti")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
    found = probes.withColumnRenamed("fp", "a").join(table.withColumnRenamed("fp", "b").hint("shuffle_hash"), "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    return found if rest is None else found.union(rest)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """Return doc_id, fingerprint (16 hex digits), component_id for every row.

    component_id is the smallest doc_id reachable over fingerprints that differ
    in at most 2 bits, the row's own included. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows stay; a null
    doc_id is kept and never is a component's id unless all ids in it are null;
    other columns are ignored; an empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct", prints.count())
    classes = connected_components(links(distinct.select("fp"), bucket)).withColumnRenamed("node", "fp")
    classed = distinct.join(classes, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classed.join(named, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
