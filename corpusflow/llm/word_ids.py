"""Token ids of many texts, from a word table that fills as words are met.

The vocabulary's rules drop white space and never join across it, so a text's
ids are its words' ids in a row; every word is encoded once per Python worker.
"""
from __future__ import annotations

from array import array

import numpy as np


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordIds(dict):
    """Word (UTF-8 bytes without ASCII white space) -> row in the table of ids."""

    def __init__(self, path: str, max_words: int = 600_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.max_words = self.tokenizer.model, byte_letters(), max_words
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.starts, self.lengths, self.flat = array("q"), array("q"), array("I")

    def encode(self, word: bytes) -> list[int]:
        low = word.lower()
        if b"<|" in word:  # may hold the name of a special token, which is case-sensitive
            return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        if len(low) > 1 and low[-1] in b".,;:!?" and low[-2:-1].isalnum():
            return self.row(low[:-1]) + self.row(low[-1:])
        text = low.decode()
        if text.isalpha() and max(text) < "Ā":
            if not text.isascii():
                text = "".join([self.letters[b] for b in text.lower().encode()])
            return [t.id for t in self.model.tokenize(text)]
        return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids

    def row(self, word: bytes) -> list[int]:
        k = self[word]
        return self.flat[self.starts[k]:self.starts[k] + self.lengths[k]].tolist()

    def __missing__(self, word: bytes) -> int:
        low = word.lower()
        if low != word and b"<|" not in word:
            k = self[low]
        else:
            ids = self.encode(word)
            k = len(self.starts)
            self.starts.append(len(self.flat))
            self.lengths.append(len(ids))
            self.flat.extend(ids)
        self[word] = k
        return k

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the end of each text's ids."""
        if len(self) > self.max_words:
            self.reset()
        words, ends = [], []
        for t in texts:
            words += t.encode("utf-8").split()
            ends.append(len(words))
        rows = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        # The views end with this call: an array that has one cannot grow.
        lengths = np.frombuffer(self.lengths, dtype=np.int64)[rows] if len(words) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(lengths)])
        if not total[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        at = np.repeat(np.frombuffer(self.starts, dtype=np.int64)[rows] - total[:-1], lengths) + np.arange(total[-1])
        return np.frombuffer(self.flat, dtype=np.uint32)[at], total[np.array(ends, dtype=np.int64)]


_TABLES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's table for a vocabulary file."""
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path]
