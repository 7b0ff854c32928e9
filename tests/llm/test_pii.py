import hashlib
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from meridia.llm import pii

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, *m.span()) for k, e in EXPRESSIONS.items() for m in re.finditer(e, text or "") if valid(k, m[0])]


def told(spans):
    return ",".join("{}:{}:{}".format(*s) for s in spans)


TEXTS = [
    None, "", "nothing here", "mail a.b@c.de, or x@y.z.uk now", "a@b.com_x@c.de", "a@b.c@d.e.f", "@x.y a@ a@b", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.1 0001.02.3.255 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 1 2", "5 5 5", "+49 (30) 1234567, +1-2, +1234567890123456", "++44 20 7946 0958.", "é漢🙂 m@x.org 🙂 +4420 7946 0958",
    "x" * 100_000, "1" * 50_000, "1 " * 20_000, "a." * 30_000 + "@" * 5, "+1" * 20_000, "m@x.org " * 3000,
]


def test_base_spans(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "a@b.cd", 0), (3, TEXTS[3], 0)]
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    expected = Counter()
    for doc_id, text, _ in rows:
        spans = base(text)
        expected[doc_id, *(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(told(spans).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:6] for r in found) == expected


def brute_terms(rows):
    """doc_id: spans of disclosing terms, by the definition."""
    near = defaultdict(set)
    holders, around = defaultdict(set), defaultdict(set)
    for doc_id, text in rows:
        for kind, a, b in base(text):
            entity = (kind, text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b]))
            holders[entity].add(doc_id)
            low, high = max(0, a - pii.NEAR), min(len(text), b + pii.NEAR)
            for m in re.finditer(r"(?:(?<=\s)|^)[^\W\d_]+(?=[.,;:!?)]*(?:\s|$))", text):
                inside = low <= m.start() and m.end() <= a or b <= m.start() and m.end() <= high
                if inside:
                    near[entity, m[0].lower()].add((doc_id, m.start(), m.end()))
                    around[entity, m[0].lower()].add((text[low:a], text[b:high]))
    n = len(rows)
    out = defaultdict(set)
    for (entity, term), places in near.items():
        both, one = len({p[0] for p in places}), len(holders[entity])
        of_term = sum(term in re.split(r"[\s.,;:!?)]+", (t or "").lower()) for _, t in rows)
        if len(around[entity, term]) >= pii.SUPPORT and n > one and math.log2(n * both / (of_term * one)) / math.log2(n / one) >= pii.GENERALISE:
            for doc_id, a, b in places:
                out[doc_id].add((pii.TERM, a, b))
    return out


def test_disclosing_terms(spark):
    rows = [(i, f"plain words of document {i} about the common weather") for i in range(60)]
    rows += [(100, "please ask Zebulon at zeb@mail.org about it today"), (101, "our Zebulon, zeb@mail.org, is away"), (102, "write zeb@mail.org for common weather"), (103, "Quentin wrote to zeb@mail.org once")]
    rows += [(104, "call Brunhilde on +49 30 1234567 now"), (105, "or +49-30-1234567 (Brunhilde)"), (106, "Zebulon has no address here")]
    found = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = brute_terms(rows)
    assert found == {i: told([*base(t), *sorted(terms[i])]) for i, t in rows}
    assert "term" in found[100] and "term" in found[101] and "term" not in found[103] and not found[106]


def test_terms_anywhere_in_the_document(spark):
    """A name far from the entity, standing twice; one footer in many documents; neither shares surroundings."""
    far = " ".join(f"filler{i}" for i in range(40))
    rows = [(i, f"plain words of document {i} about the common weather") for i in range(200)]
    rows += [(300 + i, f"Zebulon came {i}. {far} zeb@mail.org {far} and again Zebulon") for i in range(5)]
    footer = f"Contact Quentin at q@mail.org {far}"
    rows += [(400 + i, f"page {i} {far} {footer}") for i in range(30)]
    found = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        for name in ("Zebulon", "Quentin"):
            for m in re.finditer(name, text):
                assert f"{pii.TERM}:{m.start()}:{m.end()}" in found[doc_id].split(",")
    assert not any("term" in found[i] for i in range(200))


def test_one_plan_counts_terms_at_any_size(spark):
    """Few terms are counted as many are, so disk grows with the input: the terms are joined when they are counted."""
    docs = spark.createDataFrame([(1, "Zebulon and zebulon came"), (2, "zebulon, went"), (3, None)], "doc_id long, text string")
    terms = spark.createDataFrame([("zebulon",), ("went",), ("nowhere",)], "term string")
    found = pii._document_counts(docs, terms, "text")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Aggregate") and "broadcast" not in plan
    assert sorted(map(tuple, found.collect())) == [("went", 1), ("zebulon", 2)]


def test_redaction(spark):
    rows = [(i, f"plain words {i}") for i in range(40)] + [(100, "Ask Zebulon at zeb@mail.org"), (101, "the Zebulon: zeb@mail.org is 🙂 away")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = docs.join(pii.spans(docs).drop("row"), "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("base"), F.col("added")).alias("text"))
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[100] == "Ask  at [EMAIL]" and texts[101] == "the : [EMAIL] is 🙂 away" and texts[3] == "plain words 3"


def test_no_python_in_the_plan(docs, no_docs):
    plan = pii.matches(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.personal_data(no_docs).count() == 0
    assert pii.personal_data(docs).count() == docs.count()
