"""Documents with every hard case: nulls, empties, ties, repeats, long texts, clashing names."""

from __future__ import annotations

import random

import pytest

WORDS = "the and of river stone light over under garden window paper seven morning quiet engine harbor copper violet".split()


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


def documents() -> list[tuple]:
    rnd = random.Random(7)
    lines = [sentence(rnd, 14) + "." for _ in range(40)]
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(rnd.sample(lines, 2) + [sentence(rnd, rnd.randint(1, 60))]), rnd.choice(["en", "xx"]), "s"))
    rows += [(100 + i, rows[i][1], "en", "s") for i in range(5)]  # exact copies
    rows += [(200 + i, rows[i][1].replace("river", "rivers", 1), "en", None) for i in range(20)]
    rows += [(300, None, None, None), (301, "", "en", "s"), (302, " \n\t\n ", None, "s"), (303, "word", "en", "s"), (304, "two words", "en", "s")]
    rows += [rows[0], rows[0], (None, "no id here at all " * 3, "en", "s"), (None, None, None, None)]
    rows += [(400, sentence(rnd, 30_000), "en", "s"), (401, "x" * 200_000, "en", "s"), (402, "é漢🙂 " * 50, "xx", "s")]
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return documents()


#: Names that the operators use for columns of their own.
CLASHING = ("component_id", "component", "fp", "lang_pred", "score", "held_out", "n_tokens", "ids", "key", "row", "line", "gone", "_text", "n_bytes", "start", "spans", "base")


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    from pyspark.sql import functions as F

    made = spark.createDataFrame(doc_rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return made.select("*", *(F.lit("clash").alias(c) for c in CLASHING)).repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
