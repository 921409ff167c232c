"""SimHash fingerprints, the Gray index and components against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from keelson.llm import simhash_gray as S
from keelson.llm.components import components
from keelson.llm.simhash_gray import LEAF, MAX_BITS


def brute_components(fps):
    """Label of each fingerprint: union of all pairs within the distance."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    x = np.array(fps, np.int64)
    for i in range(len(x)):
        for j in np.nonzero(np.bitwise_count((x ^ x[i]).view(np.uint64)) <= MAX_BITS)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def reference_fingerprint(text):
    import xxhash
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def near_texts(rnd, n, groups, change):
    vocab = [f"wörd{i}" for i in range(500)]
    out = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(300)]
        for _ in range(n):
            w = list(base)
            for _ in range(rnd.randint(0, change)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append(" ".join(w))
    return out


def test_groups_match_brute_force(make_docs):
    rnd = random.Random(3)
    texts = near_texts(rnd, 12, 15, 4) + [None, "", "  \n", "one", "One", "a b c", "A B  C", "x " * 50000, "x y z x"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, "all alone and no id")]
    got = S.near_groups(make_docs(rows, extra=["fp", "root", "id", "component_id"])).collect()
    fps = [S.fingerprint(t) for _, t in rows]
    assert [f & (2 ** 64 - 1) for f in fps] == [reference_fingerprint(t) for _, t in rows]
    label = brute_components(fps)
    least = {}
    for (i, _), k in zip(rows, label):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    want = sorted(((i, f"{f & (2 ** 64 - 1):016x}", least.get(k)) for (i, _), f, k in zip(rows, fps, label)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert len(set(label)) < len(set(fps))
    kept = S.drop_near_copies(make_docs(rows, extra=["row", "at"]))
    assert kept.columns == [*make_docs(rows).columns, "row", "at"]
    assert kept.count() == len(set(label))


def test_index_with_crowded_nodes(spark):
    """Far more near fingerprints in one node than a leaf holds, over several partitions."""
    rnd = random.Random(7)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 9))) for _ in range(5 * LEAF)}
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    label = brute_components(signed)
    want = {signed[i]: signed[k] for i, k in enumerate(label)}
    got = {r.fp: r.root for r in S.link_components(df).collect()}
    groups, wanted = {}, {}
    for f in signed:
        groups.setdefault(got.get(f, f), []).append(f)
        wanted.setdefault(want[f], []).append(f)
    assert sorted(groups.values()) == sorted(wanted.values())


def test_gray_rank_inverts_the_gray_code(spark):
    df = spark.range(64).select(S.gray_rank(F.col("id").bitwiseXOR(F.shiftrightunsigned(F.col("id"), 1))).alias("r"), "id")
    assert all(r.r == r.id for r in df.collect())


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(400, 401), (401, 402), (402, 400), (500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)} | {i: 400 for i in (400, 401, 402)}
    assert got == want


def test_empty_table(make_docs):
    assert S.near_groups(make_docs([])).count() == 0
    assert S.drop_near_copies(make_docs([])).count() == 0
