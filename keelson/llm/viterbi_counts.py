"""Token counts of a unigram tokenizer without building tokens.

For each end position an Aho-Corasick automaton of the vocabulary lists every piece that
ends there, and dynamic programming carries the best score and the number of pieces of the
best segmentation; pieces are never materialised. Ties go the tokenizer's way: a segmentation
replaces another of the same end only if its score is strictly higher, candidates coming in
order of their start, so the longest last piece wins. A character that no piece covers
scores ``UNKNOWN_PENALTY`` below the lowest score and counts as its UTF-8 bytes (byte
fallback). No piece but a run of spaces holds a space inside, so a text falls apart at its
spaces, exactly, and each different word is solved once per process.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the unigram tokenizer: the space mark, and the unknown penalty.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words kept per process; others are solved again.
CACHED = 300_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control, unknown and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class _Counts(dict):
    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(self) < CACHED:
            self[word] = n
        return n


class Counter:
    """``tokens(text)``: number of pieces of the best segmentation."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        # pieces with a mark after the first character tie words together
        self.tied = {p for p, _ in pieces if MARK in p[1:]}
        self.runs_only = all(set(p) == {MARK} for p in self.tied)
        self.words = _Counts(lambda word: self.solve(MARK + word))

    def solve(self, text: str) -> int:
        """Count for a text that is already in marks. Matches come in the order of their ends, and a
        piece reaches back no further than the longest one: only that many ends are kept."""
        kept = self.longest + 1
        best, count = [0.0] * kept, [0] * kept
        matches = self.automaton.iter(text)
        last, piece = next(matches, (-1, None))
        for i in range(len(text)):
            end = i + 1
            found = []
            while last == i:
                found.append(piece)
                last, piece = next(matches, (-1, None))
            single = False
            top, pieces = -math.inf, 0
            for length, score in sorted(found, reverse=True) if len(found) > 1 else found:   # by start
                at = (end - length) % kept
                if best[at] + score > top:
                    top, pieces = best[at] + score, count[at] + 1
                single |= length == 1
            at = i % kept
            if not single and best[at] + self.unknown > top:
                top = best[at] + self.unknown
                pieces = count[at] + len(text[i].encode())
            best[end % kept], count[end % kept] = top, pieces
        return count[len(text) % kept]

    def tokens(self, text: str) -> int:
        """Count for a plain text: marks for spaces, and one in front unless one is there."""
        if not text:
            return 0
        if MARK in text or (self.tied and not self.runs_only):
            text = text.replace(" ", MARK)
            return self.solve(text if text[0] == MARK else MARK + text)
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return sum(map(self.words.__getitem__, text.split(" ")))
        # a run of marks is solved with the word after it; no piece reaches over a word
        total, marks = 0, ""
        for part in text.split(" ")[text[0] == " ":]:
            marks += MARK
            if part:
                total += self.solve(marks + part)
                marks = ""
        return total + (self.solve(marks) if marks else 0)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_chars, n_tokens``.

    Null text counts as empty: no tokens. Repeated rows are counted one by one. An empty
    table gives an empty result; extra columns are not read.
    """
    path = path or default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(c.tokens, texts), pa.int64())], schema=_OUT)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        count, "doc_id bigint, n_chars bigint, n_tokens bigint")
