"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment (operator 2).

Seeds are triples of an item's words that follow each other or have up to two
words between them. Every one counts, however many documents hold it: in edited
copies that many documents share, those that the edits left are as frequent as
the copies. Seeds are found in the documents, and the item is aligned with the
passage around them; the score is that of the best local alignment as a share of
the score of the whole item, so edited and paraphrased copies still score high.
A passage that has too few of the item's seeds or words for any alignment to
reach the least score, which common phrases mostly bring up, is not aligned. In
an alignment of m matches and e errors that reaches it, 2 m - e is at least twice
the share ``least`` of the item's L words. Of the m - 2 triples of matches that
follow each other at most 2 e / 3 have three errors or more between them; so (4
least - 1) L / 3 - 2 are seeds at least, wherever words were replaced, put in or
left out.

The benchmark goes to the tasks in blocks of bounded size; a larger benchmark
means more blocks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, materialise, pick, prepare_python

SEED_WORDS = 3
#: Words left out after the first and after the second word of a seed.
SEED_GAPS = ((0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0))
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's full score from which a document counts as contaminated.
MIN_SCORE = 0.5
#: Characters of the benchmark in a block, on average.
BLOCK_CHARS = 8 << 20

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the place in ``passage`` after its end."""
    steps = np.arange(len(passage)) * -GAP
    row, best, end = np.zeros(len(passage) + 1, dtype=np.int64), 0, 0
    for word in item:
        fit = np.where(passage == word, MATCH, MISMATCH)
        open_row = np.maximum(np.maximum(row[:-1] + fit, row[1:] + GAP), 0)
        row = np.concatenate(([0], np.maximum.accumulate(open_row + steps) - steps))
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


class Benchmark:
    """A block of items: their words as numbers, and the seeds looked for."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.numbers: dict[str, int] = {}
        self.items = []
        for item_id, text in items:
            found = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)], dtype=np.int64)
            if len(found) >= SEED_WORDS:
                self.items.append((item_id, found))
        self.bags = [np.unique(found, return_counts=True) for _, found in self.items]
        self.sizes = np.array([len(found) for _, found in self.items], dtype=np.int64)
        places = {(key, i, at) for i, (_, found) in enumerate(self.items) for gaps in SEED_GAPS for at, key in enumerate(self.keys(found, gaps).tolist())}
        self.places = np.array(sorted(places), dtype=np.int64).reshape(-1, 3)
        self.grams, self.first = np.unique(self.places[:, 0], return_index=True)
        self.times = np.diff(np.append(self.first, len(self.places)))

    def number(self, text: str | None) -> np.ndarray:
        """The text's words as numbers; 0 for words that no item has."""
        found = words(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in found), dtype=np.int64, count=len(found))

    def keys(self, numbers: np.ndarray, gaps: tuple[int, int]) -> np.ndarray:
        """A number for each triple of words with these gaps; negative if a word of it is in no item."""
        size = len(numbers) - SEED_WORDS + 1 - sum(gaps)
        if size <= 0:
            return np.empty(0, dtype=np.int64)
        # vocabularies are bounded by BLOCK_CHARS, so three words fit in 63 bits
        bits = max(1, len(self.numbers).bit_length())
        out, known = np.zeros(size, dtype=np.int64), np.ones(size, dtype=bool)
        for k in (0, 1 + gaps[0], 2 + sum(gaps)):
            part = numbers[k : k + size]
            out, known = out << bits | part, known & (part > 0)
        return np.where(known, out, -1)

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers of seeds) at which the document has a seed."""
        places, seeds = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for gaps in SEED_GAPS if len(self.grams) else ():
            keys = self.keys(numbers, gaps)
            at = np.flatnonzero(keys >= 0)
            near = np.minimum(np.searchsorted(self.grams, keys[at]), len(self.grams) - 1)
            found = self.grams[near] == keys[at]
            places.append(at[found])
            seeds.append(near[found])
        return np.concatenate(places), np.concatenate(seeds)

    def passages(self, numbers: np.ndarray, least: float) -> list[tuple[int, int, int]]:
        """(item, begin, end) of the document's passages with enough seeds of an item."""
        at, seeds = self.hits(numbers)
        if not len(at):
            return []
        times = self.times[seeds]
        rows = np.repeat(self.first[seeds] - np.cumsum(times) + times, times) + np.arange(times.sum())
        places, items, offsets = np.repeat(at, times), self.places[rows, 1], self.places[rows, 2]
        size = self.sizes[items]
        slack = size + SEED_WORDS
        order = np.lexsort((places - offsets, items))
        begin, end = np.maximum(0, places - offsets - slack)[order], (places - offsets + size + slack)[order]
        items, places = items[order], places[order]
        fresh = np.ones(len(items), dtype=bool)
        fresh[1:] = (items[1:] != items[:-1]) | (begin[1:] > end[:-1])
        starts, span = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        stops = np.append(starts[1:], len(items)) - 1
        known = np.unique(span * (len(numbers) + 1) + places)
        counts = np.bincount(known // (len(numbers) + 1), minlength=len(starts))
        enough = counts >= np.maximum(1, np.ceil((4 * least - 1) * self.sizes[items[starts]] / 3 - 2 - 1e-9))
        return list(zip(items[starts][enough].tolist(), begin[starts][enough].tolist(), end[stops][enough].tolist(), strict=True))

    def most(self, i: int, passage: np.ndarray) -> float:
        """A bound of the item's share in any alignment with the passage: that of its words that the passage has."""
        known, times = self.bags[i]
        passage = np.sort(passage)
        held = np.searchsorted(passage, known, "right") - np.searchsorted(passage, known, "left")
        return int(np.minimum(held, times).sum()) / len(self.items[i][1])

    def matches(self, text: str | None, least: float) -> list[tuple[int, float, int, int]]:
        """(item_id, score, start, end) of each item found; start and end count words."""
        numbers = self.number(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        for i, begin, end in self.passages(numbers, least):
            spans.setdefault(i, []).append((begin, end))
        out = []
        for i, known in spans.items():
            item_id, item = self.items[i]
            scored = [(align(item, numbers[a:b]), a) for a, b in known if self.most(i, numbers[a:b]) >= least]
            if not scored:
                continue
            (score, end), begin = max(scored, key=lambda x: (x[0][0], -x[1]))
            share = score / (MATCH * len(item))
            if share >= least:
                end += begin
                _, length = align(item[::-1], numbers[begin:end][::-1])
                out.append((item_id, share, end - length, end))
        return out


def _match(benchmark: Benchmark, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, *m) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in benchmark.matches(text, least)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "score", "start", "end"])

    return run


SCHEMA = "doc_id long, item_id long, score double, start long, end long"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = MIN_SCORE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Return doc_id, item_id, score, start, end for each document that holds an item.

    score is the alignment's share of the item's full score, at least ``least``;
    start and end count the document's words. Null and empty texts hold nothing;
    items with fewer than SEED_WORDS words take no part; rows repeated in either
    table give repeated rows; null ids stay; other columns are ignored; empty
    tables give an empty result.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    items = pick(benchmark, item_id=item_col, text=item_text_col).select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    found = []
    for number in range(blocks):
        block = Benchmark(sorted(((r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()), key=str))
        if not block.items:
            continue
        matched = rows.mapInArrow(freeing(_match(block, least)), SCHEMA)
        found.append(matched if blocks == 1 else materialise(matched, "matches"))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], SCHEMA)
