"""Entropy balancing and best-fit packing against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import best_fit, entropy_mix
from keelson.llm.tokens import Encoder, default_path


def brute_targets(size_of, cap=3):
    names = sorted((s for s in size_of if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size_of)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(size_of.values()), set()
    while True:
        rest = total - sum(cap * size_of[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        t = {s: cap * size_of[s] if s in full else weight[s] * rest / w for s in names}
        above = {s for s in names if s not in full and t[s] > cap * size_of[s] + 1e-9}
        if not above:
            return t
        full |= above


def documents(rnd, n=600):
    rows = []
    for i in range(n):
        src = rnd.choice(["src0"] * 10 + [f"src{k}" for k in range(1, 8)] + ["Ünder", "zz", None])
        rows.append((i, " ".join("w" * rnd.randint(1, 5) for _ in range(int(rnd.lognormvariate(4, 1)) + 1)), src))
    return rows + [(10**6, None, "src1"), (10**6 + 1, " \n", "empty"), (5, rows[5][1], rows[5][2]), (None, "a b c", "src2"),
                   (10**6 + 2, "one two", "tiny")]


def test_mix_hits_the_targets(make_docs):
    rows = documents(random.Random(1))
    got = entropy_mix.mix(make_docs(rows, extra=["size", "src", "copies", "target"])).collect()
    assert len(got) == len(rows)
    size_of = defaultdict(int)
    for _, t, s in rows:
        size_of[s] += len((t or "").split())
    target = brute_targets(dict(size_of))
    src_of = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = src_of[r.doc_id]
        assert r.source_size == size_of[s] and r.target == pytest.approx(target[s])
        assert r.size == 0 or (r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size)
        taken[s] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(3, 0.01 * t), (s, taken[s], t)
    again = entropy_mix.mix(make_docs(rows[::-1])).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


@pytest.mark.parametrize("rate, total", [(0.4, 12950), (0.6, 13985)])
def test_mix_of_a_source_with_one_very_long_document(make_docs, rate, total):
    """The long document is rounded to no copy or to one; the others make up for its words."""
    words = lambda n: " ".join(["w"] * n)
    rows = [(0, words(600), "x3")] + [(i, words(1 + i % 19), "x3") for i in range(1, 141)]
    rows += [(1000 + i, words(50), "x1") for i in range(100)]
    size_of = {"x3": sum(len(t.split()) for _, t, s in rows if s == "x3"), "x1": 5000}
    rows += [(2000 + i, words(50), "x2") for i in range((total - sum(size_of.values())) // 50)]
    size_of["x2"] = 50 * sum(s == "x2" for _, _, s in rows)
    got = entropy_mix.mix(make_docs(rows)).collect()
    assert all(r.taken in {0, r["size"], 2 * r["size"], 3 * r["size"]} for r in got)
    target = brute_targets(size_of)
    for s, least in (("x1", 50), ("x2", 50), ("x3", 1)):
        taken = sum(r.taken for r in got if r.source_size == size_of[s])
        assert abs(taken - target[s]) <= least / 2, (s, taken, target[s])


def test_rates_are_an_exponential_tilt(spark, make_docs):
    """The solved rates satisfy the constraint and log rate is linear in size."""
    docs = make_docs(documents(random.Random(2)))
    from pyspark.sql import functions as F
    hist = entropy_mix.sizes(docs, []).groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"))
    targets = entropy_mix.source_targets(hist)
    lam = {r.src: r for r in entropy_mix.multipliers(hist, targets).collect()}
    cells = defaultdict(list)
    for r in hist.collect():
        cells[r.src].append((r["size"], r["n"]))
    for r in targets.collect():
        m = lam[r.src]
        rate = lambda z: 3.0 if m.full else min(3.0, math.exp(m.lam * z / m.scale))
        assert sum(n * z * rate(z) for z, n in cells[r.src]) == pytest.approx(r.target, rel=1e-6, abs=1e-6)


def test_repeated_rows_of_the_mix(make_docs):
    rows = documents(random.Random(3), 200)
    docs = make_docs(rows, extra=["copies", "at", "row"])
    out = entropy_mix.repeat_to_targets(docs)
    assert out.columns == docs.columns
    copies = Counter(r.doc_id for r in out.collect())
    want = Counter()
    for r in entropy_mix.mix(make_docs(rows)).collect():
        want[r.doc_id] += r.taken // r["size"] if r["size"] else 0
    sized = {i for i, t, _ in rows if (t or "").split()}
    assert {i: n for i, n in copies.items() if i in sized} == {i: n for i, n in want.items() if n}


def test_empty_tables(make_docs):
    assert entropy_mix.mix(make_docs([])).count() == 0
    assert entropy_mix.repeat_to_targets(make_docs([])).count() == 0
    assert best_fit.pack_documents(make_docs([])).count() == 0


TEXTS = ["Hello  world", " lead", "trail ", "a\n b", "a \nb", "tab\t x", "", "it's we'll 'd", "nb sp x", "x   y", "émoji 🙂 ok",
         "<|endoftext|>", "a <|endoftext|> b", "1234 5x6 !!! ...", "\n\n\n", "   ", "mixed \x1c control", "a\r\nb \x85 c", "word " * 300]


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer
    return Encoder(default_path()), Tokenizer.from_file(default_path())


def test_ids_are_those_of_the_tokenizer(both):
    enc, ref = both
    for t in TEXTS:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == ref.encode(t, add_special_tokens=False).ids, repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 'é\n\t 　\x1f.1🙂", max_size=30))
def test_ids_property(both, text):
    enc, ref = both
    assert np.frombuffer(enc.ids(text), "<u4").tolist() == ref.encode(text, add_special_tokens=False).ids


def test_packing_is_an_exact_round_trip(make_docs, both):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["the", "naïve", "zqxv", "42"]) for _ in range(int(rnd.lognormvariate(5, 1.3))))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "w " * 9000), (1003, "same"), (1003, "same"), (None, "no id")]
    got = best_fit.pack_documents(make_docs(rows, extra=["length", "offset", "piece"])).collect()
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
    for i, t in rows:
        ids = both[1].encode(t or "", add_special_tokens=False).ids + [0]
        pieces = sorted(of[i], key=lambda r: (r.piece, r.sequence_id))
        if i == 1003:
            assert len(pieces) == 2
            pieces = pieces[:1]
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids) and all(p.length == 2048 for p in pieces[1:])
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 2048) + 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 20))
def test_open_bins_are_best_fit(lengths, most):
    bins, free, n = best_fit.OpenBins(64, most), {}, 0
    for x in lengths:
        fits = [f for f in free.values() if f >= x]
        b, offset = bins.place(x)
        if fits:
            assert free[b] == min(fits) and offset == 64 - free[b]
        else:
            assert b == n and offset == 0
            if len(free) >= most:
                fullest = min(free.values())
                gone = set(free) - {k for s in bins.by_free for k in s} - {b}
                assert len(gone) == 1 and free[gone.pop()] == fullest
            n += 1
            free[b] = 64
        free[b] -= x
        free = {k: f for f, s in enumerate(bins.by_free) for k in s}
        assert len(free) <= most


def test_packing_keeps_the_order_of_the_table_and_closes_the_fullest_bin(spark):
    from keelson.llm.common import stored
    rnd = random.Random(6)
    rows = [(i, 0, 0, rnd.randint(1, 60), 0) for i in range(400)]
    pieces = stored(spark.createDataFrame(rows, best_fit.PIECES).coalesce(1), "pieces")
    got = {r.doc_id: (r.sequence_id, r.offset) for r in best_fit.pack(pieces, 64, open_bins=4).collect()}
    free, made, closed, want = {}, 0, 0, {}
    for i, _, _, n, _ in rows:
        fits = [b for b in free if free[b] >= n]
        if fits:
            b = min(fits, key=lambda b: (free[b], -b))
        else:
            if len(free) == 4:
                free.pop(min(free, key=lambda b: free[b]))
                closed += 1
            b, made = made, made + 1
            free[b] = 64
        want[i] = b, 64 - free[b]
        free[b] -= n
        if not free[b]:
            free.pop(b)
    assert closed > 20 and len({s for s, _ in got.values()}) == made
    assert [o for _, o in got.values()].count(0) == [o for _, o in want.values()].count(0)
    bins = defaultdict(list)
    for i, (s, o) in sorted(got.items()):
        bins[s].append(o)
    assert all(o == sorted(o) for o in bins.values())       # a bin fills in the order of the table
