"""Exact top-k inner-product search by distributed histogram selection (operator 9).

Every candidate is scored against every query of a block. For each query a
histogram of the scores in its current range is summed over all partitions; the
bin that holds the kth score becomes the next range, until a range is a single
score. A last pass keeps the scores at or above the kth one, breaking ties by
the smaller id, so a partition hands on at most k rows for a query.

A block holds about ``BLOCK`` queries, which is all that is sent to the tasks;
more queries mean more blocks, not larger ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeing, materialise, pick, prepare_python

SCALE = 256
K = 5
#: Queries in a block, on average; their vectors are what a task receives.
BLOCK = 1024
#: Bins of a query's histogram in a pass; each task hands on so many counts a query at most.
BINS = 128
#: Up to this square of a vector's length all inner products are exact in double precision.
LARGEST = float(1 << 53)
_CANDIDATES_AT_ONCE = 1024


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(256 * x) of each component. Rows without a whole finite vector go."""
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    picked = pick(vectors, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("long"), v.cast("array<double>").alias("v"))
    return picked.where(v.isNotNull() & whole).select("vec_id", F.transform(v, lambda x: F.when(F.abs(x) < LARGEST, F.floor(F.least(F.greatest(x, F.lit(-LARGEST)), F.lit(LARGEST)) * F.lit(float(SCALE))).cast("double")).otherwise(x)).alias("v"))


class _Block:
    """The queries of one block: ids and one matrix for each vector length."""

    def __init__(self, rows: list) -> None:
        self.ids = np.array([r.vec_id for r in rows], dtype=np.int64)
        self.sizes = np.array([len(r.v) for r in rows], dtype=np.int64)
        self.vectors = {n: np.array([rows[i].v for i in np.flatnonzero(self.sizes == n)], dtype=np.float64).reshape(-1 if n else int((self.sizes == n).sum()), n) for n in set(self.sizes.tolist())}

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(queries' places, candidates' ids, integer scores) for pieces of the batches."""
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
            starts = np.concatenate(([0], np.cumsum(ends)[:-1]))
            for n, queries in self.vectors.items():
                rows = np.flatnonzero(ends == n)
                for at in range(0, len(rows), _CANDIDATES_AT_ONCE):
                    some = rows[at : at + _CANDIDATES_AT_ONCE]
                    found = flat[starts[some][:, None] + np.arange(n)]
                    yield np.flatnonzero(self.sizes == n), ids[some], np.rint(queries @ found.T).astype(np.int64)


def _ranges(block: _Block) -> Callable:
    """Smallest and largest score of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full(len(block.ids), np.iinfo(np.int64).max)
        high = np.full(len(block.ids), np.iinfo(np.int64).min)
        for places, ids, scores in block.scores(batches):
            own = block.ids[places][:, None] == ids[None, :]
            low[places] = np.minimum(low[places], np.where(own, np.iinfo(np.int64).max, scores).min(axis=1))
            high[places] = np.maximum(high[places], np.where(own, np.iinfo(np.int64).min, scores).max(axis=1))
        got = np.flatnonzero(low <= high)
        yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(low[got]), pa.array(high[got])], ["q", "low", "high"])

    return run


def _histograms(block: _Block, low: np.ndarray, width: np.ndarray) -> Callable:
    """Counts of each query's scores in BINS bins of its range; the last also takes what lies above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(block.ids), BINS + 1), dtype=np.int64)
        for places, ids, scores in block.scores(batches):
            bins = np.clip((scores - low[places][:, None]) // width[places][:, None], -1, BINS) + 1
            bins[block.ids[places][:, None] == ids[None, :]] = 0
            counts[places] += np.bincount((np.arange(len(places))[:, None] * (BINS + 2) + bins).ravel(), minlength=len(places) * (BINS + 2)).reshape(len(places), -1)[:, 1:]
        q, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], ["q", "bin", "n"])

    return run


def _best(block: _Block, kth: np.ndarray, k: int) -> Callable:
    """The partition's k best candidates at or above each query's kth score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((0, 3), dtype=np.int64)  # query's place, score, candidate
        for places, ids, scores in block.scores(batches):
            at, c = np.nonzero((scores >= kth[places][:, None]) & (block.ids[places][:, None] != ids[None, :]))
            kept = np.concatenate((kept, np.stack((places[at], scores[at, c], ids[c]), axis=1)))
            kept = kept[np.lexsort((kept[:, 2], -kept[:, 1], kept[:, 0]))]
            first = np.searchsorted(kept[:, 0], kept[:, 0])
            kept = kept[np.arange(len(kept)) - first < k]
        yield pa.RecordBatch.from_arrays([pa.array(block.ids[kept[:, 0]]), pa.array(kept[:, 2]), pa.array(kept[:, 1])], ["query_id", "vec_id", "score"])

    return run


def _search(vectors: DataFrame, block: _Block, k: int) -> DataFrame:
    found = vectors.mapInArrow(freeing(_ranges(block)), "q long, low long, high long").groupBy("q").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    low, high, wanted = (np.full(len(block.ids), x, dtype=np.int64) for x in (0, 0, k))
    for r in found:
        low[r.q], high[r.q] = r.low, r.high
    while (high > low).any():
        width = np.maximum(1, -(-(high - low + 1) // BINS))
        # the kth score lies in the first bin from above at which the running count reaches k
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        counts = vectors.mapInArrow(freeing(_histograms(block, low, width)), "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        running = counts.withColumn("over", F.sum("n").over(down))
        for r in running.where(F.col("over") >= k).groupBy("q").agg(F.max("bin").alias("bin")).collect():
            low[r.q] += r.bin * width[r.q]
            wanted[r.q] = 0
        short = wanted == k  # fewer than k candidates: every one is kept
        high = np.where(short, low, low + width - 1)
        wanted[:] = k
    return vectors.mapInArrow(freeing(_best(block, low, k)), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 50, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Return query_id, rank (from 1), vec_id, score for rows whose id is divisible by ``every``.

    Candidates are all rows but those with the query's own id. Ties go to the
    smaller vec_id. Repeated rows are candidates each; of a query id that occurs
    with several vectors the smallest vector is the query. Null vectors, vectors
    with a null or non-finite component and null ids take no part; vectors are
    compared with those of the same length only; fewer than k candidates are all
    returned; other columns are ignored; an empty table gives an empty result.
    Raises ValueError if a quantised vector's square is beyond LARGEST: its
    products might not be whole.
    """
    spark = vectors.sparkSession
    prepare_python(spark)
    whole = materialise(quantise(vectors, id_col, vector_col).where("vec_id IS NOT NULL"), "quantised")
    largest = whole.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    if largest is not None and largest > LARGEST:
        raise ValueError(f"a vector's square, {largest}, is beyond {LARGEST}")
    queries = whole.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // block))
    found = []
    for number in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).groupBy("vec_id").agg(F.min("v").alias("v")).collect()
        if rows:
            found.append(materialise(_search(whole, _Block(rows), k), "best"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
