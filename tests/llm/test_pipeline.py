"""The corpus pipeline, stage by stage, against brute force; odd rows and empty tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from keelson.llm import entropy_mix, simhash_gray
from keelson.llm.common import stored
from tests.llm.test_quality_and_exact import brute_features
from tests.llm.test_simhash import brute_components

STAGES = dict(corpus_pipeline.STAGES)


def odd_documents():
    rnd = random.Random(41)
    text = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    rows = [(i, text(rnd.randint(60, 200)), f"src{i % 4}") for i in range(80)]
    rows += [(200 + i, rows[i][1], "src9") for i in range(20)]                                   # exact copies
    for i in range(20, 40):                                                                       # near copies
        w = rows[i][1].split()
        w[len(w) // 2] = "changed"
        rows.append((300 + i, " ".join(w), "src1"))
    rows += [(400, None, "src1"), (401, "", None), (402, "short text", "src1"), (403, "again and again " * 40, "src2"),
             (404, text(30000), None), (5, rows[5][1], "src1"), (5, rows[5][1], "src1"), (None, text(80), "src1"), (None, text(80), None)]
    return rows


def rows_of(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def check_stages(spark, docs):
    """Run the stages one after another, each held against what it was given."""
    given = stored(docs, "given")
    seen = rows_of(given)
    # quality: documents that fail the base rules go; no host here fails as a whole
    good = stored(STAGES["quality rules"](spark, given, ""), "good")
    def fails(t):
        n, _, _, _, rep = brute_features(t)
        return n < 50 or 100 * rep > 50 * n
    assert rows_of(good) == Counter({k: n for k, n in seen.items() if not fails(k[1])})
    # exact copies: the largest id of each text
    single = stored(STAGES["exact dedup"](spark, good, ""), "single")
    best = {}
    for i, t, s in rows_of(good):
        if t not in best or (-1 if i is None else i) > (-1 if best[t] is None else best[t]):
            best[t] = i
    got = rows_of(single)
    assert all(n == 1 for n in got.values()) and {t: i for i, t, _ in got} == best
    # near copies: the smallest id of each component
    apart = stored(STAGES["near dedup"](spark, single, ""), "apart")
    items = sorted(got, key=lambda k: (k[0] is None, k[0] or 0))
    label = brute_components([simhash_gray.fingerprint(t) for _, t, _ in items])
    keep = {}
    for k, c in zip(items, label):
        keep.setdefault(c, k)
    kept = rows_of(apart)
    assert sum(kept.values()) == len(keep)
    assert {k for k in kept if k[0] is not None} == {k for k in keep.values() if k[0] is not None}
    # mix: every row as often as the operator says, copies of whole rows
    mixed = stored(STAGES["source mix"](spark, apart, ""), "mixed")
    want = Counter()
    for r in entropy_mix.mix(apart).collect():
        want[r.doc_id] += r.taken // r["size"] if r["size"] else 1
    out = Counter()
    for (i, _, _), n in rows_of(mixed).items():
        out[i] += n
    assert out == +want and set(rows_of(mixed)) <= set(kept)
    for stage in (good, single, apart, mixed):
        assert stage.columns == docs.columns
    # packing: every id of every row, gapless sequences
    packed = stored(STAGES["packing"](spark, mixed, ""), "packed").collect()
    from tokenizers import Tokenizer
    from keelson.llm.tokens import default_path
    tok = Tokenizer.from_file(default_path())
    pieces = Counter()
    for (i, t, _), n in rows_of(mixed).items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048
        starts = ([0] if first else []) + list(range(first, len(ids), 2048))
        for k, a in enumerate(starts):
            b = first if a == 0 and first else a + 2048
            pieces[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048
    assert len(bins) <= 1.05 * math.ceil(sum(r.length for r in packed) / 2048) + 1
    return packed


def test_stages_on_odd_documents(spark, make_docs):
    assert check_stages(spark, make_docs(odd_documents(), extra=["row", "size", "copies", "base_failed"]))


def test_stages_on_the_given_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    packed = check_stages(spark, docs)
    run = corpus_pipeline.run(spark, sf_small)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, run.collect())) == Counter(map(key, packed))


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_an_empty_table(spark, make_docs, name):
    assert STAGES[name](spark, stored(make_docs([]), "empty"), "").count() == 0


def test_stages_are_registered():
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is corpus_pipeline.run
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in E.queries()) == 1
