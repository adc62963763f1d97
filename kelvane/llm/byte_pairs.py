"""Byte-pair encoding with word ends, and decoding, over a vocabulary file."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from kelvane.llm.common import map_batches, picked
from kelvane.llm.merges import Memo, merge

# Fixed values of the vocabulary's format: what it treats as one word.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
MEMO = 400_000  # words, and chunks, whose codes a task remembers
# White space to str.split(), but not to the vocabulary's format.
SEPARATORS = regex.compile("[\x1c-\x1f]")
BLANK = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else
    the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBytePairs:
    """Encodes and decodes texts; lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.strings = {i: s for s, i in {**self.vocab, **special}.items()}
        self.special = special
        self.marks = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.letters = byte_letters()
        self.words = Memo(self._encode_word, MEMO)
        self.chunks = Memo(self._encode_chunk, MEMO)

    def forget(self) -> None:
        """Give back what is remembered of texts."""
        self.words.clear()
        self.chunks.clear()

    def _encode_word(self, word: str) -> bytes:
        """Identifiers, packed."""
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.end
        symbols = [i for i in map(self.vocab.get, letters) if i is not None]
        return array("I", merge(symbols, self.pairs)).tobytes()

    def _encode_chunk(self, chunk: str) -> tuple[bytes, str]:
        """Identifiers, packed, and their strings, of a text without white space."""
        # Each character is lowered on its own: no final form of sigma.
        lowered = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        packed = b"".join(map(self.words.__getitem__, WORD.findall(lowered)))
        return packed, self.decode(memoryview(packed).cast("I"))

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary strings, separated by spaces as the format has no decoder."""
        return " ".join([self.strings[i] for i in ids])

    def _encode_plain(self, text: str) -> list[tuple[bytes, str]]:
        chunks = BLANK.split(text) if SEPARATORS.search(text) else text.split()
        return [x for x in map(self.chunks.__getitem__, chunks) if x[0]]

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Identifiers as little-endian unsigned 32-bit integers, and the decoded text."""
        text = text or ""
        if self.marks is None or not self.marks.search(text):
            found = self._encode_plain(text)
        else:
            found, at = [], 0
            for mark in self.marks.finditer(text):
                found += self._encode_plain(text[at:mark.start()])
                found.append((array("I", [self.special[mark[0]]]).tobytes(), mark[0]))
                at = mark.end()
            found += self._encode_plain(text[at:])
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def ids(self, text: str | None) -> list[int]:
        packed = array("I")
        packed.frombytes(self.encode(text)[0])
        return packed.tolist()


@lru_cache(maxsize=1)
def _coder(path: str) -> WordBytePairs:
    """One for a worker's life, so that its tasks share the vocabulary."""
    return WordBytePairs(path)


def encode_decode(docs: DataFrame, vocabulary_path: str, ids_as: str = "array",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row of ``docs``.

    ``ids`` is an array of integers or, with ``ids_as="binary"``, the same as
    little-endian unsigned 32-bit integers. Whole texts are encoded; a null text
    is empty; strings of special tokens inside a text become those tokens;
    repeated rows are each returned; an empty table gives no rows.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    kind = dict(rows.dtypes)["doc_id"]
    packed = ids_as == "binary"

    def start():
        coder = _coder(vocabulary_path)

        def run(columns):
            coded = []
            for text in columns[1]:
                coder.chunks.trim()
                coder.words.trim()
                coded.append(coder.encode(text))
            ids = [x[0] for x in coded]
            if not packed:
                ids = [memoryview(x).cast("I").tolist() for x in ids]
            return [columns[0], [len(x[0]) // 4 for x in coded], ids, [x[1] for x in coded]]

        return run

    return map_batches(
        rows, f"doc_id {kind}, n_tokens bigint, ids {'binary' if packed else 'array<int>'}, decoded string",
        start, lambda: _coder(vocabulary_path).forget())
