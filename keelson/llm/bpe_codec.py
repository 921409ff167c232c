"""Byte-level BPE by speculate and verify: encoding of whole texts, and decoding.

A text is cut where its pre-tokenizer always cuts (a space between two other characters), so
each different piece is encoded once per process. Encoding all new words of a chunk of texts
takes three steps:

1. *Speculate*: an Aho-Corasick pass over all of them proposes the longest piece of the
   vocabulary at every position.
2. *Verify*: every adjacent pair of proposed ids is tested in one vectorised pass. A sequence of
   valid pieces is the result of merging by rank if and only if no two neighbours could have
   been merged across their border (``Vocabulary.compatible``).
3. Only words with a failing pair are merged exactly, by rank: all of them at once, one merge
   a word and round, and very long words one by one over a heap.

The pre-tokenizer and the special tokens are those of the vocabulary file. Decoding joins the
bytes of the ids and replaces what is not UTF-8. Nothing is dropped, cut off or capped: a word
or text may have any length; the words kept per process are bounded, others are encoded again.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.tokens import _byte_of_char, default_path

#: Pieces of text kept per process with their ids; others are encoded again.
CACHED = 500_000
#: Characters of text that a task encodes at a time.
CHUNK = 1_000_000
#: Words longer than this are merged over a heap, shorter ones all together.
LONG_WORD = 200
# Letters, numbers and blanks among the characters below U+0250, and the byte-level
# pre-tokenizer's pattern for texts of such characters.
LETTER, NUMBER, BLANK = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
LATIN_WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+"
               rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
LATIN_END = "ɐ"
#: A character that no piece of a byte-level vocabulary contains.
BETWEEN = "\0"
NEVER = np.int64(1) << 60


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> list[bytes]:
    """Bytes of every id of a file, special tokens included; all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids, byte = spec["model"]["vocab"], _byte_of_char()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for piece, i in ids.items():
        table[i] = bytes(byte[c] for c in piece) if piece not in special else piece.encode()
    for piece, i in special.items():
        table[i] = piece.encode()
    return table


def text_of(table: list[bytes], ids: np.ndarray) -> str:
    """Text of ``ids``, special tokens included; ids the file does not have are left out."""
    ids = ids[(ids >= 0) & (ids < len(table))]
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Vocabulary:
    """Pieces and merges of a byte-level BPE file, as arrays by id.

    ``left, right``: the two pieces that form a piece; ``rank``: the place of that merge (-1
    for a single byte); ``valid``: merging the bytes of the piece gives the piece itself.
    """

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cutter = spec["pre_tokenizer"] or {}
        if cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True) or spec["normalizer"]:
            raise ValueError("not a byte-level BPE file without prefix space and normaliser")
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _byte_of_char()
        size = max([*ids.values(), *self.special.values()]) + 1
        self.single = {c: ids[c] for c in byte}
        self.char_of = {b: c for c, b in byte.items()}  # of a byte; a table for str.translate
        self.left, self.right = (np.full(size, -1, np.int64) for _ in range(2))
        self.rank = np.full(size, -1, np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        a, b, made = (np.array([ids[f(m)] for m in merges], np.int64).reshape(-1)
                      for f in (lambda m: m[0], lambda m: m[1], lambda m: m[0] + m[1]))
        if len(np.unique(made)) != len(made):
            raise ValueError("a piece is formed by two merges: its parts are not defined")
        self.left[made], self.right[made], self.rank[made] = a, b, np.arange(len(made))
        self.size = size
        key = a * size + b
        order = np.argsort(key)
        self.made = made
        self.pair_key, self.pair_rank = key[order], order.astype(np.int64)
        self.pair_made = dict(zip(key.tolist(), zip(range(len(made)), made.tolist())))
        self.length = np.zeros(size, np.int64)
        for piece, i in ids.items():
            self.length[i] = len(piece)
        self.valid = self._valid(made)
        self.pieces = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in ids.items():
            if piece not in self.special and self.valid[i]:
                self.pieces.add_word(piece, i)
        self.pieces.make_automaton()
        self.pre_tokenize = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.latin_words = re.compile(LATIN_WORDS).findall
        self.at_char = np.zeros(max(map(ord, byte)) + 1, np.int64)
        for c, i in self.single.items():
            self.at_char[ord(c)] = i

    def words_of(self, piece: str) -> list[str]:
        """Words of the pre-tokenizer, a character a byte."""
        if piece.isascii():
            return [w.translate(self.char_of) for w in self.latin_words(piece)]
        if max(piece) < LATIN_END:
            return [w.encode().decode("latin-1").translate(self.char_of) for w in self.latin_words(piece)]
        return [w for w, _ in self.pre_tokenize(piece)]

    def _valid(self, made: np.ndarray) -> np.ndarray:
        valid = np.ones(self.size, bool)
        whole = self.compatible(self.left[made], self.right[made], before=2 * self.rank[made])
        for i, ok in zip(made.tolist(), whole.tolist()):  # parts come before the whole
            valid[i] = ok and valid[self.left[i]] and valid[self.right[i]]
        return valid

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` where there is none."""
        if not len(self.pair_key):
            return np.full(len(a), NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of each pair of valid pieces.

        Seen backwards in time, the border lies between the right edge of ``a`` and the left
        edge of ``b``: first the pieces themselves, then whichever of them was formed last is
        taken apart. A state lasts until the merge that ended it (``limit``); the pair standing
        at the border then would have been merged if its rank came before. Of equal merges the
        leftmost is made first, so a limit on the left excludes its own rank and one on the
        right includes it (hence ranks times two). ``before``: only merges before that limit.
        """
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.copy(), b.copy()
        limit = np.full(len(a), NEVER) if before is None else before.copy()
        while len(at):
            crossed = 2 * self.merge_rank(x, y) < limit
            ok[at[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry, limit = at[go], x[go], y[go], rx[go], ry[go], limit[go]
            cut_x = rx > ry
            limit = np.where(cut_x, 2 * rx, 2 * ry + 1)
            x, y = np.where(cut_x, self.right[x], x), np.where(cut_x, y, self.left[y])
        return ok

    def exact(self, word: str) -> list[int]:
        """Ids of one word by merging: the lowest rank first, of equal ones the leftmost."""
        ids = [self.single[c] for c in word]
        after, prior = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        made, size, heap = self.pair_made, self.size, []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (m := made.get(ids[i] * size + ids[after[i]])):
                heap.append((m[0], i, m[1], ids[i], ids[after[i]]))

        for i in range(len(ids)):
            offer(i)
        heapq.heapify(heap)
        while heap:
            _, i, whole, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two was merged since
            ids[i], ids[j] = whole, -1
            after[i] = after[j]
            if after[i] >= 0:
                prior[after[i]] = i
            for k in (prior[i], i):
                n = len(heap)
                offer(k)
                if len(heap) > n:
                    heapq.heappush(heap, heap.pop())
        return [i for i in ids if i >= 0]

    def exact_together(self, words: list[str]) -> list[bytes]:
        """The same for many short words: in every round each word makes its next merge."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.at_char[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        word = np.repeat(np.arange(len(words)), lengths)
        out = [b""] * len(words)
        wide = np.int64(len(ids) + 1)
        rank = np.full(len(ids), NEVER)  # of the merge of an id and the next one of its word
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.merge_rank(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(np.where(rank < NEVER, rank * wide + np.arange(len(ids)), NEVER), starts)
            done = low == NEVER
            if done.any():
                sizes = np.diff(np.r_[starts, len(ids)])
                packed = ids.astype("<u4").tobytes()
                for w, i, n in zip(word[starts[done]].tolist(), starts[done].tolist(), sizes[done].tolist()):
                    out[w] = packed[4 * i:4 * (i + n)]
            at = low[~done] % wide
            ids[at] = self.made[rank[at]]
            keep = np.repeat(~done, np.diff(np.r_[starts, len(ids)]))
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            ids, word, rank = ids[keep], word[keep], rank[keep]
            touched = np.concatenate([moved, moved[moved > 0] - 1])
            last = np.r_[word[1:] != word[:-1], True][touched]
            rank[touched[last]] = NEVER
            touched = touched[~last]
            rank[touched] = self.merge_rank(ids[touched], ids[touched + 1])
        return out

    def encode_words(self, words: list[str]) -> tuple[list[bytes], int]:
        """Ids (unsigned 32-bit) of every word, and the number of words merged exactly."""
        if not words:
            return [], 0
        found = np.array([v for hit in self.pieces.iter_long(BETWEEN.join(words)) for v in hit], np.int64).reshape(-1, 2)
        ends, ids = found[:, 0], found[:, 1]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        word = np.searchsorted(starts, ends, "right") - 1
        failing = np.bincount(word, self.length[ids], len(words)).astype(np.int64) != lengths
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        bad = ~self.compatible(pairs // self.size, pairs % self.size)[back]
        failing[word[inside[bad]]] = True
        cuts = np.searchsorted(word, np.arange(len(words) + 1))
        packed = ids.astype("<u4").tobytes()
        out = [packed[4 * i:4 * j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        short = np.flatnonzero(failing & (lengths <= LONG_WORD)).tolist()
        for i, merged in zip(short, self.exact_together([words[i] for i in short])):
            out[i] = merged
        for i in np.flatnonzero(failing & (lengths > LONG_WORD)).tolist():
            out[i] = np.array(self.exact(words[i]), "<u4").tobytes()
        return out, int(failing.sum())


class _Known(dict):
    """Ids of pieces of text; those beyond the bound are held for one chunk only."""

    extra: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        return self.extra[key]


def _odd(key: str) -> bool:
    """Whether a key was cut at a space next to another blank, or may have been."""
    return not key.strip() or key[-1].isspace() or key[0].isspace() and (key[0] != " " or key[1].isspace())


class Codec:
    """Encoder and decoder of one vocabulary file, with a bounded store of known pieces.

    The key of a piece that starts with a space is the piece without that space; the first
    piece of a text, which follows no space, has a space before it in its key.
    """

    def __init__(self, path: str, cached: int = CACHED):
        self.path, self.vocabulary = path, Vocabulary(path)
        self.known, self.cached = _Known(), cached
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.cut = re.compile(r"(?<=\S) (?=\S)")

    def _keys(self, text: str, careful: bool) -> Iterator[list[str]]:
        """Keys of the parts of ``text`` that can be encoded one by one, in order, a bounded
        stretch of the text at a time. ``careful``: a space next to a blank is no cut."""
        at, first = 0, True
        while at < len(text):
            found = self.cut.search(text, at + CHUNK) if len(text) - at > CHUNK else None
            stretch = text[at:found.start()] if found else text[at:]
            keys = self.cut.split(stretch) if careful else stretch.split(" ")
            if first:
                keys[0] = " " + keys[0]
            yield keys
            at, first = at + len(stretch) + 1, False

    def keys(self, text: str, careful: bool = False) -> list[list[str] | int]:
        """The same, with the ids of special tokens between them."""
        if not any(map(text.__contains__, self.vocabulary.special)):
            return list(self._keys(text, careful))
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [self.vocabulary.special[part]] if i % 2 else self._keys(part, careful)
        return out

    def learn(self, keys: set[str]) -> None:
        """Store the ids of new pieces, all their words encoded together."""
        v, keys = self.vocabulary, list(keys)
        space = v.char_of[ord(" ")]
        split = [(space + k,) if k.isascii() and k.isalpha() else v.words_of(k[1:] if k[0] == " " else " " + k) for k in keys]
        words = list({w for ws in split for w in ws})
        of = dict(zip(words, v.encode_words(words)[0]))
        new = {k: of[ws[0]] if len(ws) == 1 else b"".join(map(of.__getitem__, ws)) for k, ws in zip(keys, split)}
        odd = {k: new.pop(k) for k in keys if _odd(k)}  # not kept: a cut at every space would find them again
        self.known.extra.update(odd)
        room = len(self.known) + len(new) <= self.cached
        (self.known if room else self.known.extra).update(new)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        self.known.extra = {}
        split = [self.keys(t) for t in texts]
        new = self._new(split)
        # such pieces were cut between two blanks: cut their texts again, with care
        odd = set(filter(_odd, new))
        if odd:
            for i, parts in enumerate(split):
                if any(not isinstance(ks, int) and not odd.isdisjoint(ks) for ks in parts):
                    split[i] = self.keys(texts[i], careful=True)
            new = self._new(split)
        if new:
            self.learn(new)
        ids = lambda ks: (np.array([ks], "<u4").tobytes() if isinstance(ks, int)
                          else b"".join(map(self.known.__getitem__, ks)))
        return [np.frombuffer(b"".join(map(ids, parts)), "<u4") for parts in split]

    def _new(self, split: list) -> set[str]:
        return set().union(*(ks for parts in split for ks in parts if not isinstance(ks, int))).difference(self.known)

    def decode(self, ids: np.ndarray) -> str:
        return text_of(pieces(self.path), ids)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _chunks(batches: Iterator[pa.RecordBatch], size_of) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose ``size_of`` (an array per row) sums up to about ``CHUNK``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.cumsum(size_of(batch)) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(i, j - i)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>`` per row: the ids of the whole text.

    ``path``: a byte-level BPE file of the tokenizers library; strings of its special tokens in
    a text become their ids. Null text counts as empty and has no ids; repeated rows and null
    ids of documents are rows like any other; an empty table gives an empty result; other
    columns are not read.
    """
    path = path or default_path()

    def run(batches):
        import pyarrow.compute as pc
        sizes = lambda b: pc.fill_null(pc.utf8_length(b.column(1)), 0).to_numpy()
        for batch in _chunks(batches, sizes):
            ids = codec(path).encode([t or "" for t in batch.column(1).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                             ["doc_id", "ids"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``ids_col`` replaced by the text of its ids, as ``text_col``;
    the other columns pass through. Null or no ids give an empty text, unknown or null ids are left
    out, bytes that are not UTF-8 become U+FFFD."""
    path = path or default_path()
    others = [c for c in encoded.columns if c != ids_col]
    if text_col in others:
        raise ValueError(f"the table has a column {text_col} already")

    def run(batches):
        import pyarrow.compute as pc
        sizes = lambda b: pc.fill_null(pc.list_value_length(b.column(len(others))), 0).to_numpy()
        for batch in _chunks(batches, sizes):
            lists = batch.column(len(others))
            ends = np.cumsum([0, *sizes(batch).tolist()])
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            texts = [text_of(pieces(path), flat[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(texts, pa.string())], [*others, text_col])

    rows = encoded.select(*others, ids_col)
    kept = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others]
    return rows.mapInArrow(run, ", ".join([*kept, f"`{text_col}` string"]))
