"""Language identification by hyperdimensional profiles (operator 6).

Each letter has a random vector of ``DIMENSIONS`` signs. A trigram's vector binds
the vectors of its letters, permuted by their place in it, by multiplication; a
text's vector bundles its trigrams' vectors by addition, and a language's
prototype bundles the texts of that language. A document gets the language whose
prototype has the largest cosine with it.

The letters are folded to ``SYMBOLS`` symbols, so what a task holds is bounded:
the letter vectors and one prototype a language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeing, pick, prepare_python

DIMENSIONS = 1024
GRAM = 3
SYMBOLS = 64
SEED = 42
UNKNOWN = "und"
#: Prototypes are sent to the tasks: more languages than this are refused.
MOST_LANGUAGES = 2000
_TEXTS_AT_ONCE = 32


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """The symbol of each code point: 0 for what is no letter, 1 to 26 for a to z, others folded."""
    table = np.zeros(0x110000, dtype=np.uint8)
    letters = np.array([c for c in range(0x110000) if chr(c).isalpha()], dtype=np.int64)
    table[letters] = 27 + (letters * 2654435761 >> 16) % (SYMBOLS - 27)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


@lru_cache(maxsize=1)
def _letters() -> list[np.ndarray]:
    """The symbols' vectors, permuted for each place in a gram."""
    signs = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS), dtype=np.int8) * 2 - 1
    return [np.roll(signs, GRAM - 1 - place, axis=1) for place in range(GRAM)]


def grams(text: str) -> np.ndarray:
    """The numbers of the text's grams; a run of other characters counts as one space. Empty without letters."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found = _symbols()[points]
    found = found[np.concatenate(([True], (found[1:] != 0) | (found[:-1] != 0)))].astype(np.int32)
    if not found.any():
        return np.empty(0, dtype=np.int32)
    codes = found[: len(found) - GRAM + 1].copy()
    for place in range(1, GRAM):
        codes = codes * SYMBOLS + found[place : len(found) - GRAM + 1 + place]
    return codes


def bind(codes: np.ndarray) -> np.ndarray:
    """The vectors of grams: their letters' permuted vectors multiplied."""
    out = None
    for place, letters in enumerate(_letters()):
        symbol = codes // SYMBOLS ** (GRAM - 1 - place) % SYMBOLS
        out = letters[symbol] if out is None else out * letters[symbol]
    return out


def bundle(texts: list[np.ndarray]) -> np.ndarray:
    """A vector for each text: the sum of its grams' vectors."""
    if not texts:
        return np.empty((0, DIMENSIONS), dtype=np.float32)
    sizes = [len(t) for t in texts]
    distinct, places = np.unique(np.concatenate(texts), return_inverse=True)
    width = max(1, len(distinct))
    rows = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(rows * width + places, minlength=len(texts) * width).reshape(len(texts), width)
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for at in range(0, len(distinct), 4096):
        out += counts[:, at : at + 4096].astype(np.float32) @ bind(distinct[at : at + 4096]).astype(np.float32)
    return out


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as empty text, which is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    profiles: dict[str, np.ndarray] = {}
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            profiles.setdefault(lang, np.zeros(DIMENSIONS))
            for at in range(0, len(texts), 4 * _TEXTS_AT_ONCE):
                profiles[lang] += bundle([np.concatenate([grams(t) for t in texts[at : at + 4 * _TEXTS_AT_ONCE]])])[0]
    for lang, vector in profiles.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS)), pa.array(vector)], ["lang", "at", "x"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of each language, from all rows with a text and a language."""
    prepare_python(docs.sparkSession)
    rows = pick(docs, text=text_col, lang=lang_col).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(freeing(_learn), "lang string, at long, x double").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found = sums.limit(MOST_LANGUAGES * DIMENSIONS + 1).collect()
    if len(found) > MOST_LANGUAGES * DIMENSIONS:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    out: dict[str, np.ndarray] = {}
    for r in found:
        out.setdefault(r.lang, np.zeros(DIMENSIONS))[r.at] = r.x
    return {lang: out[lang] for lang in sorted(out)}


def _predict(langs: list[str], prototypes: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            preds, scores = [], []
            for at in range(0, len(texts), _TEXTS_AT_ONCE):
                vectors = bundle([grams(t or "") for t in texts[at : at + _TEXTS_AT_ONCE]])
                lengths = np.linalg.norm(vectors, axis=1)
                cosines = vectors @ prototypes.T / np.maximum(lengths, 1e-9)[:, None] if langs else np.zeros((len(vectors), 1))
                best = cosines.argmax(axis=1)
                known = (lengths > 0) & bool(langs)
                preds += [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores += np.where(known, np.clip(cosines.max(axis=1), 0, 1), 0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[1:], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", keep: dict[str, str] | None = None) -> DataFrame:
    """Add lang_pred and score to the columns in ``keep`` (name: source column)."""
    prepare_python(docs.sparkSession)
    vectors = np.array([v / max(np.linalg.norm(v), 1e-9) for v in prototypes.values()], dtype=np.float32).reshape(-1, DIMENSIONS)
    rows = pick(docs, **{"_text": text_col}, **(keep or {}))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[1:]), "lang_pred string", "score double"])
    return rows.mapInArrow(freeing(_predict(list(prototypes), vectors)), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Return doc_id, held_out, lang_pred, score (cosine, 0 to 1) of every row.

    Learns from the rows that are not held out. Null texts, texts without
    letters and, if there is nothing to learn from, all texts are ``und`` with
    score 0; ties go to the first language in order; repeated rows and null ids
    stay; other columns are ignored; an empty table gives an empty result.
    """
    prototypes = learn(docs.where(~is_held_out(F.col(f"`{id_col}`"))), text_col, lang_col)
    found = predict(docs, prototypes, text_col, {"doc_id": id_col})
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
