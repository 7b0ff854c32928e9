"""Personal data by patterns and information-theoretic sanitisation (operator 8).

Base spans are pattern matches: e-mail addresses, IP addresses, card and phone
numbers. The sanitisation asks which other terms give a protected entity (one
such value) away. Over the whole corpus it counts in how many documents a term
occurs, in how many an entity does, and in how many both do, wherever in the
document. From these counts come the entity's information content
``IC(e) = -log2 p(e)`` and the pointwise mutual information of the two,
``PMI(t, e) = log2(p(t, e) / (p(t) p(e)))``, which is at most IC(e). A term
whose PMI is at least the share ``GENERALISE`` of IC(e) is generalised wherever
it stands in documents with the entity, and removed from ``REMOVE`` on.

Pairs are counted by joins of documents' terms and entities. A term that is in so
many documents that its PMI with an entity cannot reach ``GENERALISE`` makes no
pair with it, so common words make none.

Only DataFrame functions are used. Patterns are written without backtracking,
so long runs of matching characters take linear time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, pick

#: Base kinds in the order of results, and the added kind.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?=[0-9][ -]?[0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Characters of context by which the tests' brute force looks for terms; texts of the tests are shorter.
NEAR = 64
#: Documents in which a term and an entity must stand together.
SUPPORT = 2
#: Shares of the entity's information content from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.7, 0.95

_ENDS = ".,;:!?)"
_TERM = rf"(?<=\s)\p{{L}}++(?=[{_ENDS}]*+\s)"
_BETWEEN_TERMS = rf"[\s{_ENDS}]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second one from the right doubled, is divisible by 10."""

    def weight(i: Column) -> Column:
        digit = F.ascii(F.substring(digits, -i, F.lit(1))) - 48
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), weight), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    size = F.length(_digits(value))
    if kind == "card":
        return F.when(size.between(13, 19), _luhn(_digits(value))).otherwise(False)
    return size.between(9, 15)


_PIECE = "array<struct<lead:int,size:int,ok:boolean,entity:string>>"


def _pieces(kind: str) -> Column:
    """Of each match: what precedes it, its size, whether it is valid, and its entity."""

    def piece(x: Column) -> Column:
        value, lead = x["value"], F.coalesce(x["lead"], F.lit(""))
        valid = _valid(kind, value)
        entity = F.concat(F.lit(f"{kind}:"), F.lower(value) if kind in ("email", "ip") else _digits(value))
        return F.struct(
            F.length(lead).alias("lead"),
            F.length(value).alias("size"),
            valid.alias("ok"),
            F.when(valid, entity).alias("entity"),
        )

    found, rest = F.col(f"{kind}_found"), F.col(f"{kind}_rest")
    zipped = F.arrays_zip(found.alias("value"), F.slice(rest, F.lit(1), F.size(found)).alias("lead"))
    return F.when(F.size(found) > 0, F.transform(zipped, piece)).otherwise(F.array()).cast(_PIECE)


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number of its own), doc_id, the pieces of each kind, and the text if one is valid, for every row."""
    text = F.col("text")
    may = {"email": text.contains("@"), "phone": text.contains("+")}
    digit = text.rlike("[0-9]")
    none = F.array().cast("array<string>")
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", *(F.when(may.get(k, digit), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"{k}_found") for k in KINDS))
    rows = rows.select("*", *(F.when(F.size(f"{k}_found") > 0, F.split(text, PATTERNS[k], -1)).otherwise(none).alias(f"{k}_rest") for k in KINDS))
    rows = rows.select("row", "doc_id", "text", *(_pieces(k).alias(k) for k in KINDS))
    holds = reduce(lambda a, b: a | b, (F.exists(k, lambda p: p["ok"]) for k in KINDS))
    return rows.select("row", "doc_id", *KINDS, F.when(holds, F.col("text")).alias("text"))


def occurrences(found: DataFrame) -> DataFrame:
    """row, kind (its place in KINDS), start, end, entity of each valid match."""
    rows = reduce(DataFrame.union, (found.select("row", F.lit(n).alias("kind"), F.posexplode(k).alias("i", "p")) for n, k in enumerate(KINDS)))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("p.lead") + F.col("p.size")).over(upto)
    placed = rows.select("row", "kind", "p", end.alias("end"))
    return placed.where("p.ok").select("row", "kind", (F.col("end") - F.col("p.size")).alias("start"), "end", "p.entity")


def _document_counts(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """term, n: in how many rows each of the terms occurs, over whole texts. Each task counts all its terms first, at any size of either table."""
    tokens = F.array_distinct(F.split(F.lower(F.col("text")), _BETWEEN_TERMS, -1))
    all_terms = pick(docs, text=text_col).where("text IS NOT NULL").select(F.explode(tokens).alias("term"))
    return all_terms.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term", "left_semi")


def _blanked(text: Column, base: Column) -> Column:
    """The text with blanks for base spans (sorted structs of start and end), of the same length."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
        F.struct(s["end"].cast("long").alias("at"), F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")), F.repeat(F.lit(" "), (s["end"] - F.greatest(s["start"].cast("long"), acc["at"])).cast("int"))).alias("out"))
    )
    return F.aggregate(base, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def _texts(found: DataFrame, placed: DataFrame) -> DataFrame:
    """row, text (base spans blanked, a blank at both ends) of the rows with an entity that SUPPORT rows have."""
    shared = placed.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT)
    rows = placed.join(shared, "entity", "left_semi").select("row").distinct()
    base = placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("base")).join(rows, "row", "left_semi")
    return found.select("row", "text").join(base, "row").select("row", F.concat(F.lit(" "), _blanked(F.col("text"), F.col("base")), F.lit(" ")).alias("text"))


def _together(docs: DataFrame, texts: DataFrame, placed: DataFrame, text_col: str, total: int) -> DataFrame:
    """row, entity, term, n_entity, n_term of terms and entities in one row, without those that cannot be disclosing."""
    of_entity = placed.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    holders = placed.select("row", "entity").distinct().join(of_entity, "entity")
    terms = materialise(texts.select("row", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0)))).alias("term")), "terms")
    # the term is in n_both rows at least, and n_both is at most the smaller count, so PMI is at most log2(n / the larger)
    most = F.pow(F.lit(float(max(total, 1))), F.lit(1 - GENERALISE)) * F.pow(F.col("n_entity").cast("double"), F.lit(GENERALISE)) * (1 + 1e-9)
    bound = of_entity.agg(F.max(F.greatest("n_entity", most))).first()[0] or 0
    repeated = terms.groupBy("term").agg(F.count("*").alias("n")).where((F.col("n") >= SUPPORT) & (F.col("n") <= bound)).select("term")
    repeated = materialise(repeated, "repeated")
    of_term = _document_counts(docs, repeated, text_col).withColumnRenamed("n", "n_term").where(F.col("n_term") <= bound)
    # written first: the joins then have shuffles of their own, whose large partitions Spark splits
    of_term = materialise(of_term, "counts")
    return terms.join(of_term, "term").join(materialise(holders, "holders"), "row").where((F.col("n_term") <= F.col("n_entity")) | (F.col("n_term") <= most))


def disclosing(together: DataFrame, total: int) -> DataFrame:
    """entity, term, disclosure (PMI as a share of IC) of terms that give entities away."""
    counted = together.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term")).where(F.col("n_both") >= SUPPORT)
    n = F.lit(float(max(total, 1)))
    content = F.log2(n / F.col("n_entity"))
    mutual = F.log2(n * F.col("n_both") / (F.greatest("n_term", "n_both").cast("double") * F.col("n_entity")))
    share = F.when(content > 0, mutual / content).otherwise(0.0)
    return counted.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def _term_places(texts: DataFrame) -> DataFrame:
    """row, term, start, end of each term of the texts."""
    found, rest = F.regexp_extract_all("text", F.lit(_TERM), F.lit(0)), F.split("text", _TERM, -1)
    zipped = F.arrays_zip(found.alias("term"), F.slice(rest, F.lit(1), F.size(found)).alias("before"))
    each = texts.where(F.size(found) > 0).select("row", F.posexplode(zipped).alias("i", "t")).select("row", "i", F.col("t.term").alias("term"), F.length("t.before").alias("before"))
    upto = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # less the blank that precedes the text
    end = F.sum(F.col("before") + F.length("term")).over(upto) - 1
    return each.select("row", "term", end.alias("end")).select("row", F.lower("term").alias("term"), (F.col("end") - F.length("term")).alias("start"), "end")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return row, doc_id, base, added for every row.

    ``base`` is an array of (kind, start, end) in order, kind being a place in
    KINDS; ``added`` one of (start, end, disclosure, action) of disclosing
    terms. Places count code points, the end excluded.
    """
    found = materialise(matches(docs, id_col, text_col), "matches")
    pieces = found.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, (F.size(k) for k in KINDS))), F.lit(0))).first()[0]
    placed = materialise(occurrences(found), "occurrences", pieces)
    total = docs.count()
    texts = materialise(_texts(found, placed), "texts")
    together = materialise(_together(docs, texts, placed, text_col, total), "together")
    told = together.join(materialise(disclosing(together, total), "disclosing"), ["entity", "term"]).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    told = materialise(told, "told")
    added = _term_places(texts.join(told.select("row").distinct(), "row", "left_semi")).join(told, ["row", "term"])
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    added = added.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure", action.alias("action")))).alias("added"))
    base = placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("base"))
    out = found.select("row", "doc_id").join(base, "row", "left").join(added, "row", "left")
    return out.select("row", "doc_id", F.coalesce("base", F.array()).alias("base"), F.coalesce("added", F.array()).alias("added"))


def redact(text: Column, base: Column, added: Column) -> Column:
    """The text with base spans replaced by their kinds, and disclosing terms generalised or removed."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    marks = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("by"))),
        F.transform(added, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["action"] == "remove", "").otherwise("[TERM]").alias("by"))),
    )
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
        F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), s["by"]).alias("out"))
    )
    return F.aggregate(F.sort_array(marks), begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def _of_kind(base: Column, kind: int) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row.

    Null and empty texts have no spans; repeated rows are documents of their own;
    null ids stay; other columns are ignored; an empty table gives an empty
    result. Terms are whole words of letters between blanks or punctuation, base
    spans counting as blanks, so a term's span overlaps no base span.
    """
    names = F.array(*(F.lit(k) for k in KINDS))
    base, added = F.col("base"), F.col("added")
    told = F.transform(base, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    more = F.transform(added, lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]))
    counts = [_of_kind(base, n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return spans(docs, id_col, text_col).select("doc_id", *counts, F.sha2(F.array_join(told, ","), 256).alias("base_sha256"), F.array_join(F.concat(told, more), ",").alias("spans"))
