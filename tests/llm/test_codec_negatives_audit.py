"""op11 against the tokenizers library, op12 and op13 against brute force."""

import hashlib
import random
import re
from itertools import permutations
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm import bond_negatives as B
from keelson.llm import bpe_codec as P
from keelson.llm import filter_audit as A
from keelson.llm.catalog import QUERIES
from tests.llm.conftest import DOCS

TEXTS = [None, "", " ", "word", "Hello world, it's 2024!\n\nNew  line\t\tend ", "  lead", "tail \n", "a \n b", "\x1c \x85 x",
         "naïve Straße 漢字 🙂 ՘ ²³", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "<|endoftext", "\x00\x01\x00",
         "Ththorti ensttion eahe onnthaly ofanattily", "word", "word"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.default_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- op11
def test_codec_query_against_the_library(spark, sf_small, library):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: ids_of(library, d.text) for d in docs}
    got = {r.doc_id: r for r in QUERIES["op11_bpe_codec"](spark, sf_small).collect()}
    assert set(got) == set(want)
    for i, ids in want.items():
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_codec_edge_texts(spark, make_docs, library):
    docs = make_docs(list(enumerate(TEXTS)), extra=["ids", "n_tokens"])
    got = {r.doc_id: r for r in P.decode(P.encode(docs).select("doc_id", "ids", F.col("ids").alias("kept"))).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i].kept == ids_of(library, t)
        assert got[i].text == library.decode(got[i].kept, skip_special_tokens=False) == (t or "")


def test_codec_empty_table_null_ids_and_unknown_ids(spark, make_docs):
    assert P.decode(P.encode(make_docs([]))).collect() == []
    assert [r.ids for r in P.encode(make_docs([(None, "a"), (None, "a")])).collect()] == [[64], [64]]
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 999999, -5, 65]), (4, [162, 98])], "i int, ids array<int>")
    assert {r.i: r.text for r in P.decode(rows).collect()} == {1: "", 2: "", 3: "ab", 4: "�"}
    with pytest.raises(ValueError):
        P.decode(rows.withColumn("text", F.lit("x")))


@pytest.mark.parametrize("text", ["\n" * 2_000_000, " " * 2_000_000 + "a", "ab" * 150_000, "x" * 300_000, "word " * 500_000])
def test_codec_very_long_texts(text, library):
    codec = P.codec(P.default_path())
    ids = codec.encode([text, "a"])[0]
    assert ids.tolist() == ids_of(library, text)
    assert codec.decode(ids) == text


def test_codec_random_texts_one_by_one(library):
    rng, codec = random.Random(5), P.Codec(P.default_path(), cached=200)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "漢", "12", "!", "<|endoftext|>", "\x1c", "\x85", " the", "ation", "ÿ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert codec.encode([text])[0].tolist() == ids_of(library, text)


def test_pair_test_and_exact_merging(library):
    rng, v = random.Random(6), P.codec(P.default_path()).vocabulary
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    want = [ids_of(library, w) for w in words]
    got, exact = v.encode_words(words)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert 0 < exact < len(words)  # some proposals pass, some fail
    assert [v.exact(w) for w in words] == want
    assert [np.frombuffer(g, "<u4").tolist() for g in v.exact_together(words)] == want
    pairs = np.array([[rng.randrange(256, 50256) for _ in range(2)] for _ in range(4000)])
    ok = v.compatible(pairs[:, 0], pairs[:, 1])
    chars = {b: c for b, c in v.char_of.items()}
    for (a, b), o in zip(pairs.tolist(), ok.tolist()):
        both = "".join(chars[x] for x in P.pieces(P.default_path())[a] + P.pieces(P.default_path())[b])
        assert o == (v.exact(both) == [a, b])


# ---------------------------------------------------------------- op12
def brute_negatives(rows):
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [floor(256 * x) for x in v], n) for n, (i, v, lab) in enumerate(rows)
            if i is not None and lab is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    dot = lambda a, b: max(min(sum(x * y for x, y in zip(a, b)), B.LONG[1]), B.LONG[0])
    out = []
    for i, lab, v, n in rows:
        if i % 50:
            continue
        scored = sorted((-dot(v, w), j, m, l2) for j, l2, w, m in rows if m != n)
        for s, p, _, l2 in [x for x in scored if x[3] == lab][:5]:
            hits = [x for x in scored if x[3] != lab and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out += [(i, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hits)]
    return sorted(out)


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def mined(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit("clash"))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in B.mine(df).collect())


def test_negatives_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0.1, 0.2, 20).tolist(), int(rng.integers(0, 4))) for i in range(-50, 500)]
    rows += [rows[60]] * 40 + [rows[50]] * 3                       # copies, of an anchor too
    rows += [(None, [0.1] * 20, 1), (1000, None, 1), (1050, [0.1, None], 1), (1100, [float("nan")] * 20, 1),
             (1150, [float("inf")] * 20, 2), (1200, [0.2] * 20, None), (1250, [], 1), (1300, [0.5] * 3, 1), (1350, [0.3] * 30, 2)]
    want = brute_negatives(rows)
    assert len(want) > 100
    assert mined(spark, rows, ["r", "anchor", "score", "v", "cell"]) == want
    monkeypatch.setattr(B, "grid", lambda *a: (3, 2))              # few groups, each anchor in one lane
    monkeypatch.setattr(B, "GROUP_BYTES", 1 << 10)
    assert mined(spark, rows) == want


def test_negatives_of_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), (rng.normal(0.2, 0.2, 4) * 10.0 ** (i % 5 * 4)).tolist(), i % 2) for i in range(0, 300, 5)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_scan_shrinks_its_candidates():
    """Columns are read in the anchor's order and most candidates leave before the last one."""
    rng = np.random.default_rng(5)
    vectors = list(np.floor(256 * rng.normal(0, 0.2, (5000, 64)) * np.linspace(2, 0.05, 64)))
    group = B.Group(np.arange(5000), np.arange(5000), np.zeros(5000, np.int64), vectors)
    seen = []
    more = B.Scan.more
    B.Scan.more = lambda self, n: (seen.append(len(self.score)), more(self, n))[1]
    try:
        at, scores = B.positives(group, vectors[7], 0, 7)
    finally:
        B.Scan.more = more
    exact = np.array(vectors) @ vectors[7]
    exact[7] = -np.inf
    assert scores.tolist() == [int(x) for x in np.sort(exact)[::-1][:5]]
    assert seen[0] == 5000 and min(seen) < 500 and len(seen) < 8


def test_negatives_of_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [0.1], 1), (4, [0.1], 2)]) == []      # no anchor
    assert mined(spark, [(50, [0.1], 1), (51, [0.2], 2)]) == []    # no positive


def test_grid_is_bounded():
    groups, lanes = B.grid(75_000_000, 1_500_000, 64, 4000)
    assert 75_000_000 / groups * 64 * 4 <= B.GROUP_BYTES and groups * lanes >= 8000
    assert B.grid(0, 0, 0, 1)[0] >= 1


# ---------------------------------------------------------------- op13
def brute_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    parts = {}
    for i, text, lang in rows:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        caps = sum("A" <= c <= "Z" for c in t)
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 3 * len(t), any(c in "#$%&*|" for c in t),
            i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows))) if bad}
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        runs = {}
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                runs["".join(order), step + 1] = (f, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                                                  sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
        shapley = {f: sum(r[2] for r in runs.values() if r[0] == f) for f in "ABCDE"}
        out += [(part, o, s, *r[1:], shapley[r[0]]) for (o, s), r in runs.items()]
    return sorted(out)


def audited(docs, labels):
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r[c] for c in names) for r in A.filter_audit(docs, labels).collect())


def test_audit_against_brute_force(spark):
    rng = random.Random(8)
    base = ["plain words here " * 90, " ".join(f"w{i}" for i in range(250)), " ".join(f"W{i}" for i in range(250)),
            " ".join(f"w{i}" for i in range(300)) + " #", "", None, "SHORT $ TEXT", "tab\tnew\nline\x0bvt\x0cff\rcr\xa0nb", " "]
    rows = [(rng.randrange(60), rng.choice(base), rng.choice(["en", "de", None, ""])) for _ in range(200)]
    rows += [(None, base[0], "en"), (None, base[0], "en"), (None, "only null", "fr"), (70, "only null", "fr")]
    labels = [(rng.randrange(80), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(60)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCS)
    for c in ("part", "mask", "n", "good", "toxic", "sha"):
        docs = docs.withColumn(c, F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(docs, marks) == brute_audit(rows, labels)
    assert audited(docs, marks.limit(0)) == brute_audit(rows, [])
    assert audited(docs.limit(0), marks) == []


def test_intervals_are_lexicographic_and_cover_every_order():
    rows, orders = A.intervals(5)
    assert ["".join("ABCDE"[f] for f in o) for o in orders] == ["".join(p) for p in permutations("ABCDE")]
    for before, last, step, start, end in rows.tolist():
        for rank, o in enumerate(orders.tolist()):
            inside = o[step] == last and sum(1 << f for f in o[:step]) == before
            assert not (start <= rank < end) or inside
    for step in range(5):
        assert sum(e - s for _, _, k, s, e in rows.tolist() if k == step) == 120
