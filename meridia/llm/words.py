"""Encoding texts word by word, each distinct word once per worker process.

Python workers are used again for later tasks, so what a process has encoded
stays. The store is bounded: past ``WORDS`` entries it starts anew, and words
longer than ``LONG`` characters are never kept.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np

#: Words whose encodings a process keeps, and the length from which it keeps none.
WORDS = 1_000_000
LONG = 64

#: Unicode's letters, numbers and white space below U+0250, where texts can be
#: cut without the tokenizers library.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
beyond_latin = re.compile("[^\x00-ɏ]").search

#: Fixed value: what byte-level tokenizers cut off after an apostrophe.
ENDINGS = "'(?:s|t|re|ve|m|ll|d)"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in order.
    """
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordStore(dict):
    """Encodings by word, filled many words at a time by ``encode``."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], most: int = WORDS) -> None:
        super().__init__()
        self.encode, self.most = encode, most

    def add(self, lists: Iterable[list[str]]) -> dict[str, bytes]:
        """Encode the words of ``lists`` that are not held; returns those that are too long to hold."""
        new = set().union(*lists).difference(self)
        if len(self) + len(new) > self.most:
            self.clear()
            new = set().union(*lists)
        words = list(new)
        found = dict(zip(words, self.encode(words), strict=True))
        long = {w: found.pop(w) for w in words if len(w) > LONG}
        self.update(found)
        return long

    def join(self, lists: list[list[str]]) -> list[bytes]:
        """The concatenated encodings of each list of words."""
        long = self.add(lists)
        get = self.__getitem__ if not long else lambda w: long[w] if len(w) > LONG else self[w]
        return [b"".join(map(get, words)) for words in lists]


class OneByOne(dict):
    """Encodings by word, filled as words are asked for."""

    def __init__(self, encode: Callable[[str], bytes], most: int = WORDS) -> None:
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        found = self.encode(word)
        if len(word) <= LONG:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


class SpaceDropping:
    """A byte-level tokenizer that lower-cases, drops white space and marks word ends.

    The ids of a text are those of its words in turn. Words of Latin letters are
    cut here and given to the library's BPE model one by one; any other text,
    and one that may hold special strings, is cut at white space only, and the
    library encodes the pieces.
    """

    #: Characters that str.split() takes for white space and the library doesn't.
    _separators = re.compile("[\x1c-\x1f]")
    _word = re.compile(f"{ENDINGS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")

    def __init__(self, path: str, width: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        model, letters = self.tokenizer.model, byte_letters()
        code = [np.array([i], dtype=width).tobytes() for i in range(self.tokenizer.get_vocab_size())]

        def word(text: str) -> bytes:
            mapped = text if text.isascii() and text.isalnum() else "".join([letters[b] for b in text.encode()])
            return b"".join([code[t.id] for t in model.tokenize(mapped)])

        def pieces(texts: list[str]) -> Iterable[bytes]:
            for at in range(0, len(texts), 1024):
                for found in self.tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False):
                    yield b"".join([code[i] for i in found.ids])

        self.words, self.pieces, self.whole = OneByOne(word), WordStore(pieces, WORDS // 4), pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        get, out, rest = self.words.__getitem__, [], []
        for i, text in enumerate(texts):
            lower = text.lower()
            if "<|" in text or beyond_latin(lower):
                rest.append(i)
                out.append(b"")
            else:
                out.append(b"".join(map(get, self._word.findall(lower))))
        odd = [i for i in rest if self._separators.search(texts[i])]
        rest = [i for i in rest if i not in set(odd)]
        for some, found in ((rest, self.pieces.join([texts[i].split() for i in rest])), (odd, self.whole([texts[i] for i in odd]))):
            for i, ids in zip(some, found, strict=True):
                out[i] = ids
        return out


_loaded: dict[tuple[str, str], SpaceDropping] = {}


def encode_dropping_space(texts: list[str], path: str, width: str = "<u2") -> list[bytes]:
    """Token ids of each text as bytes of the given numpy type."""
    if (path, width) not in _loaded:
        _loaded[path, width] = SpaceDropping(path, width)
    return _loaded[path, width].encode(texts)
