"""Token counts through a digest cache (operator 7).

The cache is a Parquet table of (content, tokenizer, n_tokens): the SHA-256 of
the normalised text, that of the tokenizer's file, and the stored count. Rows
are joined to it by digest; only distinct texts that it lacks are encoded, once
each, and appended. A later run, or another tokenizer version, shares the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freeing, fresh_path, materialise, pick, prepare_python

LIMIT = 4096
CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def as_is(text: Column) -> Column:
    """The normal form for tokenizers that see every character, as those of the queries do: null becomes empty."""
    return F.coalesce(text, F.lit(""))


@lru_cache(maxsize=2)
def _counter(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda texts: [len(tokenizer.encode(x, add_special_tokens=False).ids) for x in texts]


def _count(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _counter(path)(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """content, n_tokens stored for this tokenizer; a digest stored twice counts once."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, normalise: Callable[[Column], Column] = as_is) -> DataFrame:
    """Return doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every row.

    ``cache`` is a folder that all executors share (by default a new one).
    ``normalise`` must not change a text's token count. Null texts are empty and
    have 0 tokens; repeated rows and null ids stay; other columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    cache = cache or fresh_path(spark, "token-cache")
    version = hashlib.sha256(Path(tokenizer_path).read_bytes()).hexdigest()
    text = normalise(F.col("text"))
    # the row's own digest tells rows with one id apart, so that one row stands for each content
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.octet_length(as_is(F.col("text"))).cast("long").alias("n_bytes"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("content"))
    digests = materialise(rows.drop("text"), "digests")
    known = read_cache(spark, cache, version)
    missing = materialise(digests.groupBy("content").agg(F.min("doc_id").alias("first")).join(known, "content", "left_anti"), "missing")
    texts = rows.select("content", "doc_id", "text").join(missing.withColumnRenamed("content", "c"), (F.col("content") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("first")))
    counted = texts.select("content", "text").mapInArrow(freeing(_count(tokenizer_path)), "content binary, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    # written first: the join then has shuffles of its own, whose large partitions Spark splits
    counts = materialise(read_cache(spark, cache, version), "counts")
    return digests.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
