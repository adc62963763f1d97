"""Token counts of a piece vocabulary, without producing the tokens."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvane.llm.common import map_batches, picked
from kelvane.llm.merges import Memo, merge

SPACE = "▁"  # how the vocabulary writes a space
MEMO = 800_000  # words whose counts a worker remembers


class PieceCounter:
    """Counts tokens as initial symbols minus merges.

    A symbol is a character; one outside the vocabulary counts as its UTF-8
    bytes and merges with nothing. No piece holds a space mark behind another
    character, so each run of marks with the characters behind it is merged on
    its own; likewise no piece joins a line break to anything.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (pieces.is_byte, pieces.is_control, pieces.is_unknown)
        self.score = {pieces.id_to_piece(i): pieces.get_score(i)
                      for i in range(pieces.get_piece_size()) if not any(f(i) for f in special)}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p[1:] or p[:1] == "\n" != p
               for p in self.score):
            raise ValueError("pieces reach across words or lines; units cannot be counted alone")
        self.pairs = {
            (p[:i], p[i:]): (-score, p) for p, score in self.score.items() for i in range(1, len(p))
            if all(len(x) == 1 or x in self.score for x in (p[:i], p[i:]))}
        self.unit = Memo(self._count_unit, MEMO)
        self.part = Memo(self._count_symbols, MEMO // 4)

    def _count_symbols(self, text: str) -> int:
        size = sum(1 if c in self.score else len(c.encode()) for c in text)
        return size - (len(text) - len(merge(list(text), self.pairs)))

    def _count_unit(self, unit: str) -> int:
        """``unit``: characters behind a space mark, without the mark."""
        if "\n" not in unit:
            return self._count_symbols(SPACE + unit)
        first, *others = unit.split("\n")
        return self.part[SPACE + first] + sum(
            self.part["\n"] + (self.part[o] if o else 0) for o in others)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        units = text.replace(SPACE, " ").split(" ")
        if "" not in units:
            return sum(map(self.unit.__getitem__, units))
        marked = SPACE + text.replace(" ", SPACE)
        total = 0
        for run in re.findall(f"{SPACE}+[^{SPACE}]*", marked):
            first, *others = run.split("\n")
            total += self.part[first] + sum(
                self.part["\n"] + (self.part[o] if o else 0) for o in others)
        return total

    def __call__(self, columns: list[list]) -> list[list]:
        self.unit.trim()
        self.part.trim()
        return [columns[0], columns[1], [self.count(text) for text in columns[2]]]


@lru_cache(maxsize=1)
def _counter(path: str) -> PieceCounter:
    """One for a worker's life, so that its tasks share what it remembers."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Whole texts are counted; a null text is empty and has no tokens; repeated
    rows are each returned; a null id stays null; an empty table gives no rows.
    Words recur, so a worker remembers the counts of a bounded number of them.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                       "text")
    kind = dict(rows.dtypes)["doc_id"]
    counted = map_batches(rows, f"doc_id {kind}, n_bytes bigint, n_tokens bigint",
                          lambda: _counter(model_path))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
