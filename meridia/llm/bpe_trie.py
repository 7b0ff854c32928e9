"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding (operator 5).

The encoding of a prefix is that of a shorter prefix and one last token. A token
may follow another if BPE, run over the bytes of both, leaves the boundary
between them alone; of the tokens that end a prefix exactly one may follow the
last token of what precedes it. So a state, the last token and where it begins,
goes down the trie of the distinct words from each node to its children, and
words with a common prefix share its states; a word's ids are read back from its
end. The trie is walked depth first: in
sorted order, each word leaves the path of the one before at their common prefix.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import freeing, pick, prepare_python
from .words import ENDINGS, LETTERS, NUMBERS, SPACES, WordStore, beyond_latin, byte_letters

#: Words whose ids a process keeps, and texts that are encoded at once: two processes share an executor's memory with its JVM.
WORDS, TEXTS = 300_000, 256

#: Cuts a Latin text into words; the space before a word belongs to it.
WORD = re.compile(f"{ENDINGS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


class ByteBpe:
    """A byte-level BPE vocabulary in the tokenizers library's JSON format."""

    def __init__(self, path: str) -> None:
        told = json.loads(Path(path).read_text(encoding="utf-8"))
        model, letters = told["model"], {c: b for b, c in enumerate(byte_letters())}
        plain = lambda token: bytes(letters[c] for c in token)
        self.ids = {plain(token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, merge in enumerate(model["merges"]):
            left, right = (self.ids[plain(x)] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = rank
            self.halves.setdefault(self.ids[self.bytes_of[left] + self.bytes_of[right]], (left, right, rank))
        self._edges: dict[tuple[int, bool], list[tuple[int, int, int]]] = {}
        self._joins: dict[int, bool] = {}
        self.whole = self._reachable()
        self.code = [i.to_bytes(4, "little") for i in range(size)]
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._path = path
        self._library = None
        self.store = WordStore(self._encode_distinct, WORDS)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """Pieces of a token at its right or left end: (piece, rank that makes it, rank that ends it)."""
        found = self._edges.get((token, right))
        if found is None:
            found, ends, piece = [], len(self.rank), token
            while piece in self.halves:
                left, other, rank = self.halves[piece]
                found.append((piece, rank, ends))
                piece, ends = (other if right else left), rank
            found.append((piece, -1, ends))
            self._edges[token, right] = found
        return found

    def _apart(self, first: int, second: int, before: int) -> bool:
        """Whether no merge of rank below ``before`` crosses the boundary of two tokens.

        A merge of pieces x and y crosses if it comes after both are made and
        before either is used up. Of equal merges the left one comes first.
        """
        for x, made_x, ends_x in self._edge(first, True):
            for y, made_y, ends_y in self._edge(second, False):
                rank = self.rank.get((x, y))
                if rank is not None and rank < before and made_x < rank < ends_x and made_y < rank <= ends_y:
                    return False
        return True

    def _reachable(self) -> set[int]:
        """Tokens that are the encoding of their own bytes."""
        good = {i for i in self.ids.values() if i not in self.halves}
        for token, (left, right, rank) in sorted(self.halves.items(), key=lambda x: x[1][2]):
            if left in good and right in good and self._apart(left, right, rank):
                good.add(token)
        return good

    def may_follow(self, first: int, second: int) -> bool:
        key = first << 32 | second
        found = self._joins.get(key)
        if found is None:
            if len(self._joins) > 2_000_000:
                self._joins.clear()
            found = self._joins[key] = self._apart(first, second, len(self.rank))
        return found

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of each distinct word."""
        ids, whole, code, joins = self.ids, self.whole, self.code, self._joins
        last: list[int] = [0]  # by depth: the state at each node of the path
        begins: list[int] = [0]
        path, out = b"", {}
        for word in sorted(words):
            size, depth = len(word), 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                depth += 1
            del last[depth + 1 :], begins[depth + 1 :]
            for end in range(depth + 1, size + 1):
                for start in range(max(0, end - self.longest), end):
                    token = ids.get(word[start:end])
                    if token is None or token not in whole:
                        continue
                    if start:
                        good = joins.get(last[start] << 32 | token)
                        if not (self.may_follow(last[start], token) if good is None else good):
                            continue
                    last.append(token)
                    begins.append(start)
                    break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            path, found, at = word, [], size
            while at:
                found.append(code[last[at]])
                at = begins[at]
            out[word] = b"".join(reversed(found))
        return out

    def words(self, text: str) -> list[str]:
        """The text cut into words; beyond Latin by the tokenizers library, whose Unicode version counts."""
        if not beyond_latin(text):
            return WORD.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _encode_distinct(self, words: list[str]) -> list[bytes]:
        as_bytes = [w.encode() for w in words]
        return list(map(self.encode_words(as_bytes).__getitem__, as_bytes))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = {i: self._special.split(t) for i, t in enumerate(texts) if self._special and self._special.search(t)}
        out = self.store.join([self.words(t) if i not in cut else [] for i, t in enumerate(texts)])
        for i, parts in cut.items():
            between = self.store.join([self.words(p) for p in parts[::2]])
            marks = [self.code[self.special[p]] for p in parts[1::2]] + [b""]
            out[i] = b"".join(x for pair in zip(between, marks, strict=True) for x in pair)
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


SCHEMA = "doc_id long, ids binary, decoded string"


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, ids (little-endian unsigned 32-bit integers), decoded for every row.

    Null and empty texts have no ids and decode to the empty text. Special
    strings inside texts become their special ids. Repeated rows and null ids
    stay; other columns are ignored; an empty table gives an empty result.
    """
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer_path)
        for batch in batches:
            texts = batch.column(1)
            ids = [x for at in range(0, len(texts), TEXTS) for x in bpe.encode([t or "" for t in texts.slice(at, TEXTS).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(freeing(run), SCHEMA)
