"""Operators 5, 7 and 10 against the tokenizers' own libraries."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meridia.llm import bpe_trie, registry, token_counts, token_store, words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
ENDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = st.lists(st.sampled_from([*"aabBsS  \n\t'1²٣é\x1c\x85\xa0漢字🙂ÉΣςİſ.,-ǅт", "<|endoftext|>", "<|startoftext|>", "'ll", " the", "\r\n"]), max_size=40).map("".join)


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.text(max_size=60)))
def test_trie_encodes_and_decodes_as_the_library(text):
    bpe, tokenizer = bpe_trie.load(BYTES), Tokenizer.from_file(BYTES)
    (ids,) = bpe.encode([text])
    found = np.frombuffer(ids, "<u4").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids
    assert bpe.decode(ids) == tokenizer.decode(found, skip_special_tokens=False)


@pytest.mark.parametrize("seed", range(3))
def test_decoding_any_ids(seed):
    ids = np.random.default_rng(seed).integers(0, 50_257, 500).astype("<u4")
    assert bpe_trie.load(BYTES).decode(ids.tobytes()) == Tokenizer.from_file(BYTES).decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.text(max_size=60)))
def test_word_by_word_encoding(text):
    assert np.frombuffer(words.encode_dropping_space([text], ENDS)[0], "<u2").tolist() == library(ENDS)(text)


def test_full_stores_start_anew():
    bpe = bpe_trie.ByteBpe(BYTES)
    bpe.store.most = 3
    texts = ["one two three four", "x" * 300 + " five six", "one two", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(texts)] == list(map(library(BYTES), texts))


def test_a_process_keeps_few_words_and_texts(spark, monkeypatch):
    """Two Python processes share 3000 MB with the executor's JVM."""
    asked = []
    bpe = bpe_trie.ByteBpe(BYTES)
    whole = bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda texts: asked.append(len(texts)) or whole(texts))
    monkeypatch.setattr(bpe_trie, "load", lambda path: bpe)
    taken = []
    monkeypatch.setattr(bpe_trie, "freeing", lambda run: taken.append(run) or run)
    bpe_trie.encode_decode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), BYTES)
    batch = pa.RecordBatch.from_arrays([pa.array(range(1024)), pa.array([None if i % 9 == 0 else f"text {i}" for i in range(1024)])], ["doc_id", "text"])
    (found,) = taken[0](iter([batch]))
    assert bpe.store.most <= 300_000 and max(asked) <= 256 and sum(asked) == 1024
    assert found.column(0).to_pylist() == list(range(1024)) and found.column(2).to_pylist() == [t or "" for t in batch.column(1).to_pylist()]


def test_encode_decode_all_documents(docs, doc_rows, no_docs):
    expected = Counter()
    for doc_id, text, *_ in doc_rows:
        ids = np.array(library(BYTES)(text), dtype="<u4").tobytes()
        expected[doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    found = bpe_trie.encode_decode(docs, BYTES).select("doc_id", F.expr("octet_length(ids) div 4"), F.sha2("ids", 256), F.sha2("decoded", 256))
    assert Counter(map(tuple, found.collect())) == expected
    assert bpe_trie.encode_decode(no_docs, BYTES).count() == 0


@pytest.mark.parametrize("path", [PIECES, BYTES])
def test_counts(docs, doc_rows, no_docs, path):
    if path == PIECES:
        import sentencepiece

        count = lambda t, m=sentencepiece.SentencePieceProcessor(model_file=path): len(m.encode(t or ""))
    else:
        count = lambda t: len(library(path)(t))
    expected = Counter((i, len((t or "").encode()), n := count(t), n > 4096) for i, t, *_ in doc_rows)
    assert Counter(map(tuple, token_counts.token_counts(docs, path).collect())) == expected
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_cache_is_used_and_appended_to(spark, tmp_path, monkeypatch):
    cache = f"file://{tmp_path}/cache"
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    more = spark.createDataFrame([(1, "a b"), (4, "c")], "doc_id long, text string")
    before = sorted(map(tuple, token_counts.token_counts(first, PIECES, cache).collect()))
    assert spark.read.parquet(cache).count() == 2  # one row a content
    # a stored count is believed, so nothing that is stored is encoded again
    spark.read.parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 100).write.parquet(f"{cache}-marked")
    after = {r.doc_id: r.n_tokens for r in token_counts.token_counts(more, PIECES, f"{cache}-marked").collect()}
    assert after == {1: before[0][2] + 100, 4: 1}
    assert spark.read.parquet(f"{cache}-marked").count() == 3
    # another tokenizer finds nothing of it
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(more, BYTES, f"{cache}-marked").collect()} == {1: 2, 4: 1}


@given(st.lists(st.integers(0, 5000), max_size=300))
@settings(max_examples=100, deadline=None)
def test_elias_fano_round_trip(steps):
    values = np.cumsum(np.array(steps, dtype=np.int64))
    held = token_store.EliasFano.from_bytes(token_store.EliasFano.build(values).to_bytes())
    assert held.values().tolist() == values.tolist()
    assert [held.select(i) for i in range(len(values))] == values.tolist()
    with pytest.raises(IndexError):
        held.select(len(values))


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    assert len(token_store.EliasFano.build(values).to_bytes()) < 10_000 * 14 / 8


def test_token_files(docs, doc_rows, no_docs, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 50)
    order = sorted(doc_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = Counter(), 0
    for doc_id, text, *_ in order:
        ids = np.array([*library(ENDS)(text), 2], dtype="<u4")
        expected[doc_id, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert Counter(map(tuple, token_store.token_files(docs, ENDS).collect())) == expected
    assert token_store.token_files(no_docs, ENDS).count() == 0


def test_queries_on_the_small_tables(spark, sf_dir):
    rnd = random.Random(3)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: r for r in registry.op5_bpe_encode_decode(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for doc_id in rnd.sample(sorted(texts), 50):
        ids = np.array(library(BYTES)(texts[doc_id]), dtype="<u4").tobytes()
        assert (found[doc_id].n_tokens, found[doc_id].ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())


def test_memory_of_a_long_word():
    """A word without spaces takes memory in proportion to its length."""
    import tracemalloc

    rnd = random.Random(3)
    word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    bpe = bpe_trie.ByteBpe(BYTES)
    tracemalloc.start()
    (ids,) = bpe.encode([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1000 * len(word) and np.frombuffer(ids, "<u4").tolist() == library(BYTES)(word)


@settings(max_examples=100, deadline=None)
@given(ODD)
def test_the_piece_model_normalises_nothing(text):
    """So the content that its counts are stored by is the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert model.normalize(text).replace("▁", " ") == (" " + text if text else "")


def test_select_from_stored_bytes():
    values = np.cumsum(np.random.default_rng(4).integers(0, 900, 1000))
    held = token_store.EliasFano.from_bytes(token_store.EliasFano.build(values).to_bytes())
    assert [held.select(i) for i in range(held.n)] == held.values().tolist() == values.tolist()
