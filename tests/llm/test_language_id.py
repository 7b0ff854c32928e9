import zlib

from meridia.llm import language_id


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = language_id.identify(docs).collect()
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in lang}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in found)


def test_labels_are_no_input_of_predictions(spark, docs):
    plain = docs.select("doc_id", "text", "lang", "source")
    first = sorted(map(str, language_id.identify(plain).collect()))
    held = language_id.is_held_out(plain.doc_id)
    from pyspark.sql import functions as F

    other = plain.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("?"))
    assert sorted(map(str, language_id.identify(other).collect())) == first


def test_hard_cases(spark, docs, doc_rows, no_docs):
    found = language_id.identify(docs).collect()
    assert len(found) == len(doc_rows)
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert unknown == {i for i, t, *_ in doc_rows if not any(c.isalpha() for c in t or "")}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert language_id.identify(no_docs).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language_id.identify(unlabelled).select("lang_pred", "score").collect()] == [("und", 0.0)]


def test_a_bound_trigram_is_the_product_of_permuted_letters():
    codes = language_id.grams("ab")
    assert len(codes) == 2  # " ab", "ab "
    letters = language_id._letters()
    assert (language_id.bind(codes)[0] == letters[0][0] * letters[1][1] * letters[2][2]).all()
    assert (language_id.bundle([codes])[0] == language_id.bind(codes).sum(axis=0)).all()
    assert len(language_id.grams("12 !?")) == 0
