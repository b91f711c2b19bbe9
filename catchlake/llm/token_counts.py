"""Token counts by heap-and-linked-list byte-pair merging over a sentence-piece vocabulary.

A text becomes symbols (characters; one that the vocabulary lacks counts as its UTF-8 bytes). A heap holds adjacent pairs
whose union is a piece, by rank and then place; a linked list holds the symbols. The lowest pair is popped and merged until
none is left: the count is the initial symbols less the merges. No id is ever made. No piece has a space or certain
marks after another character, so a text falls into words that merge independently; their counts are cached up to a bound.

Cases: null and empty texts have no tokens; a very long text is counted whole; a very long word takes n log n.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.llm.common import TwoAges, with_text_columns

SPACE = "▁"  #: stands for a space in pieces


def opening_marks(ranks: dict[str, float]) -> set[str]:
    """The space, line end and other signs that no piece has after a character that is none of them.

    No merge can then join such a character with a mark after it, so a text may be cut there.
    """
    pairs = {piece[i:i + 2] for piece in ranks for i in range(len(piece) - 1)}
    marks = {"\n", *(c for pair in pairs for c in pair if not c.isalnum())}
    while late := {b for a, b in pairs if b in marks and a not in marks}:
        marks -= late
    return marks


class MergeCounter:
    """Counts of words by a table of pieces and their ranks. Those of short words are kept, up to a bound."""

    SHORT = 64

    def __init__(self, ranks: dict[str, float], words: int = 300_000):
        self.ranks, self.counts = ranks, TwoAges(self.merged, words)
        marks = re.escape("".join(sorted(opening_marks(ranks))))
        self.words = re.compile(f"[{marks}]*[^{marks}]+|[{marks}]+").findall

    def merged(self, word: str) -> int:
        ranks, symbols = self.ranks, list(word)
        count = sum(1 if c in ranks else len(c.encode("utf-8")) for c in symbols)
        end = len(symbols)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(ranks[pair], i, pair) for i in range(end - 1) if (pair := symbols[i] + symbols[i + 1]) in ranks]
        heapify(heap)
        while heap:
            _, left, pair = heappop(heap)
            right = after[left]
            if right >= end or not symbols[left] or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[left] < end:
                before[after[left]] = left
            count -= 1
            for i, j in ((before[left], left), (left, after[left])):
                if i >= 0 and j < end and (union := symbols[i] + symbols[j]) in ranks:
                    heappush(heap, (ranks[union], i, union))
        return count

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a space is put before it, and nothing else is changed."""
        if not text:
            return 0
        words = self.words(SPACE + text.replace(" ", SPACE))
        if max(map(len, words)) > self.SHORT:
            return sum(self.counts[w] if len(w) <= self.SHORT else self.merged(w) for w in words)
        return sum(map(self.counts.__getitem__, words))


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """The counter of a model file, once in each Python worker. Ranks are the pieces' scores, the best lowest."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    own = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    return MergeCounter({model.id_to_piece(i): -model.get_score(i) for i in own})


def _count(path: str):
    own = counter(path)
    return lambda texts: [[own.count(t) for t in texts]]


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether it has more tokens than limit. Rows stay where they are."""
    sized = docs.select(key, text, F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = with_text_columns(sized, text, [T.StructField("n_tokens", T.LongType())], partial(_count, path), [key, "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
