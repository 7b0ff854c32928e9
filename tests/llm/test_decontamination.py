import random

import numpy as np
import pytest

from meridia.llm import decontamination as d


def brute_score(item, passage):
    """Smith-Waterman by its definition."""
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (d.MATCH if a == b else d.MISMATCH), rows[i - 1][j] + d.GAP, rows[i][j - 1] + d.GAP)
    return max(map(max, rows))


@pytest.mark.parametrize("seed", range(5))
def test_alignment(seed):
    rnd = np.random.default_rng(seed)
    for _ in range(30):
        a, b = rnd.integers(0, 5, rnd.integers(1, 12)), rnd.integers(0, 5, rnd.integers(0, 30))
        score, end = d.align(a, b)
        assert score == brute_score(a, b) and (not score or b[end - 1] in a)


def cases(rnd):
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(15, 40)))) for i in range(20)]
    docs = []
    for i in range(120):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))]
        if i % 3 == 0:
            copy = items[i % 20][1].split()
            for _ in range(i % 5):  # edited
                copy[rnd.randrange(len(copy))] = "other"
            at = rnd.randint(0, len(words))
            words[at:at] = copy
        docs.append((i, ", ".join(words).upper()))
    docs += [(500 + i, items[0][1]) for i in range(60)]  # a passage that many documents share
    docs += [docs[0], docs[0], (None, items[1][1]), (900, None), (901, ""), (902, " ".join(items[2][1].split()[:6]))]
    return docs, [*items, (50, None), (51, ""), (52, "w1 w2"), items[3]]


@pytest.mark.parametrize("block", [d.BLOCK_CHARS, 800])
def test_against_brute_force(spark, block):
    docs, items = cases(random.Random(4))
    expected = []
    for doc_id, text in docs:
        for item_id, item in items:
            a, b = d.words(item), d.words(text)
            if len(a) >= d.SEED_WORDS and (s := brute_score(a, b) / (d.MATCH * len(a))) >= d.MIN_SCORE:
                expected.append((doc_id, item_id, round(s, 9)))
    documents = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, score string")
    found = d.contaminated(documents, spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int"), block_chars=block).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    assert sorted(((r.doc_id, r.item_id, round(r.score, 9)) for r in found), key=key) == sorted(expected, key=key)
    texts = dict(docs)
    for r in found:
        assert 0 <= r.start < r.end <= len(d.words(texts[r.doc_id]))


def test_one_edited_passage_in_many_documents(spark):
    """Each window of 6 words has an edit, so the n-grams that are left are in all copies, the others in none."""
    rnd = random.Random(5)
    item = [f"w{i}" for i in range(40)]
    edited = [w if i % 5 else "other" for i, w in enumerate(item)]
    docs = [(i, " ".join([rnd.choice("abcdef") for _ in range(30)] + edited + [rnd.choice("abcdef") for _ in range(30)])) for i in range(50)]
    docs += [(100 + i, f"x w1 w2 w3 y {i}") for i in range(50)]
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    share = brute_score(item, edited) / (d.MATCH * len(item))
    assert share >= d.MIN_SCORE
    assert sorted((r.doc_id, r.item_id, r.score, r.start, r.end) for r in found) == [(i, 7, share, 31, 70) for i in range(50)]


def test_empty_tables(spark, no_docs, docs):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(no_docs, items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("edit", [lambda i, w: ["other"] if i % 3 == 2 else [w], lambda i, w: [w, "other"], lambda i, w: [w, "other", "more"] if i % 2 else [w], lambda i, w: [] if i % 3 == 2 else [w]])
def test_dense_edits_against_brute_force(spark, edit):
    """Words replaced, put in or left out so densely that no three words of the item are left side by side."""
    rnd = random.Random(6)
    items = [(n, " ".join(rnd.sample([f"w{i}" for i in range(2000)], rnd.randint(6, 40)))) for n in range(40)]
    docs = []
    for n, text in items:
        copy = [v for i, w in enumerate(text.split()) for v in edit(i, w)]
        docs.append((n, " ".join([f"a{i}" for i in range(n)] + copy + ["end"])))
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    scores = {n: brute_score(d.words(items[n][1]), d.words(text)) / (d.MATCH * len(d.words(items[n][1]))) for n, text in docs}
    expected = sorted((n, n, s) for n, s in scores.items() if s >= d.MIN_SCORE)
    assert len(expected) > 10 and sorted((r.doc_id, r.item_id, r.score) for r in found) == expected
