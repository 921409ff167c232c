"""Repeated 200-byte strings against a dictionary of all of them."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from keelson.llm import bwt_dedup as B


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per text."""
    data = [(t or "").encode() for t in texts]
    where = defaultdict(list)
    for d, t in enumerate(data):
        for i in range(len(t) - 199):
            where[t[i:i + 200]].append((d, i))
    gone = [np.zeros(len(t), bool) for t in data]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + 200] = True
    out = []
    for t, g in zip(data, gone):
        rest = bytes(np.frombuffer(t, np.uint8)[~g]) if len(t) else b""
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], g.astype(int)])) == 1))
        out.append((len(t), int(g.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(rnd, n):
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(rnd.randint(20, 90)) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [prose(rnd.randint(1, 60))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(shared)
            cut = rnd.randint(0, len(p) // 2)
            parts += [p[cut:len(p) - rnd.randint(0, len(p) // 2)], prose(rnd.randint(0, 30))]
        texts.append("".join(parts))
    return texts


def check(make_docs, texts, extra=None):
    got = B.remove_repeats(make_docs(list(enumerate(texts)), extra)).collect()
    assert len(got) == len(texts)
    want = brute(texts)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


def test_matches_brute_force(make_docs):
    rnd = random.Random(11)
    texts = corpus(rnd, 60)
    a = "".join(rnd.choice("xyz") for _ in range(199))
    texts += [None, "", a, a, a + "1", "2" + a + "1", "3" + a + "1", texts[0], texts[0], "q" * 5000, "q" * 150, "lol " * 800,
              "lol " * 800 + "!", "ab" * 99 + "c", "line of text\n" * 40 + texts[1], "ñ" * 300]
    check(make_docs, texts, extra=["f", "r", "h", "spans"])


def test_crowded_blocks_take_the_counting_way(make_docs, monkeypatch):
    monkeypatch.setattr(B, "MAX_BLOCK", 3)
    rnd = random.Random(12)
    check(make_docs, corpus(rnd, 40))


def test_merge_of_random_blocks():
    """Interleaving gives exactly the offsets that comparing all strings gives."""
    rnd = random.Random(13)
    block, before, rest = [], [], []
    for b in range(30):
        base = ["".join(rnd.choice("ab") for _ in range(B.REACH)) for _ in range(2)]
        for _ in range(rnd.randint(1, 9)):
            x, y = base[0], base[1]
            i, j = rnd.randint(0, B.REACH), rnd.randint(0, B.REACH)
            x = rnd.choice(["", "c", x[:rnd.randint(0, 3)]]) + x[len(x) - i:]
            y = y[:j] + "".join(rnd.choice("ab") for _ in range(rnd.choice([0, B.REACH - j])))
            block.append(b)
            before.append(x[-B.REACH:].encode())
            rest.append(y.encode())
    lo, hi = B.merge_block(np.array(block), before, rest)
    at = defaultdict(list)
    for i, (b, x, y) in enumerate(zip(block, before, rest)):
        for k in range(max(0, B.REACH - len(y)), min(B.REACH, len(x)) + 1):
            at[b, k, x[len(x) - k:], y[:B.REACH - k]].append(i)
    want = defaultdict(list)
    for (b, k, *_), who in at.items():
        if len(who) > 1:
            for i in who:
                want[i].append(k)
    assert [(int(a), int(b)) for a, b in zip(lo, hi)] == [(min(want[i]), max(want[i])) if want[i] else (-1, -1) for i in range(len(block))]


def test_anchors_do_not_depend_on_slices(monkeypatch):
    rnd = np.random.default_rng(14)
    text = bytes(rnd.integers(97, 100, 5000, dtype=np.uint8)) + b"zy" * 350
    whole = B.anchors(text)
    monkeypatch.setattr(B, "SLICE", 333)
    parts = B.anchors(text)
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert len(whole[0]) < len(text) // 4 and len(set(whole[1].tolist())) > 60   # sparse, and cores differ
    marked = np.zeros(len(text), bool)
    marked[whole[0]] = True
    assert all(marked[i:i + B.WINDOW].any() for i in range(len(text) - B.LENGTH + 1))


def test_empty_table(make_docs):
    assert B.remove_repeats(make_docs([])).count() == 0
