import numpy as np
import pytest

from meridia.llm import topk


def brute(rows, every=50, k=5):
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in whole:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [topk.BLOCK, 2])
def test_against_brute_force(spark, block):
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [rows[7], rows[50], rows[50]]  # ties and repeated rows
    rows += [(500, None), (550, [None] * 8), (600, [float("nan")] * 8), (650, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    rows += [(700, [1.0, 2.0]), (701, [0.5, 0.5]), (750, []), (800, [1.0])]  # other lengths: fewer than k candidates
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    assert sorted(map(tuple, topk.top_k(table, block=block).collect())) == brute(rows)


def test_small_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert sorted(map(tuple, topk.top_k(table).collect())) == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_products_that_may_not_be_whole(spark):
    with pytest.raises(ValueError, match="beyond"):
        topk.top_k(spark.createDataFrame([(50, [1e12, 1.0]), (51, [2.0, 1e300])], "vec_id long, embedding array<double>"))
