"""Host quality rules and exact dedup against brute force, with the odd cases."""

import hashlib
import random
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keelson.llm import chunk_recipes, host_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_features(text):
    text = text or ""
    w = WORD.findall(text)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(g)
    cov = {i + k for i, x in enumerate(g) if n[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cov))


CASES = [(1, "a b c " * 30, "h1"), (2, None, "h1"), (3, "", "h2"), (4, "x\n\nx\n \ny\tx", None),
         (5, " ".join(f"w{i}" for i in range(80)), "h3"), (5, " ".join(f"w{i}" for i in range(80)), "h3"),
         (6, "#tag $5 | <b> é ü 𝒳𝒴", "h3"), (None, "a a a a b a a a", "h3"),
         (7, " ".join(f"v{i}" for i in range(30000)), "h3")]


def test_features_match_brute_force(make_docs):
    got = host_quality.quality(make_docs(CASES, extra=["n_words", "kept", "host"])).collect()
    want = Counter((i, *brute_features(t)) for i, t, _ in CASES)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n#é", max_size=60), min_size=1, max_size=20))
def test_features_property(make_docs, texts):
    got = host_quality.quality(make_docs(list(enumerate(texts)))).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {
        i: brute_features(t) for i, t in enumerate(texts)}


def test_bad_host_is_rejected_and_small_host_is_not(make_docs):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, "short", "bad") for i in range(100)]
    rows += [(2000, good, "bad"), (3000, "short", "tiny"), (3001, good, "tiny")]
    rows += [(4000 + i, good, f"h{i % 20}") for i in range(400)]
    kept = {r.doc_id for r in host_quality.keep_good(make_docs(rows, extra=["row", "kept", "base_failed"])).collect()}
    assert 2000 not in kept and 3000 not in kept
    assert 3001 in kept and set(range(200)) <= kept


def test_empty_table(make_docs):
    assert host_quality.quality(make_docs([])).count() == 0
    assert host_quality.keep_good(make_docs([])).count() == 0
    assert chunk_recipes.exact_groups(make_docs([])).count() == 0
    assert chunk_recipes.drop_copies(make_docs([])).count() == 0


LONG = "Sentence of some words. " * 4000
EXACT = [(1, LONG), (2, LONG), (3, LONG + "!"), (4, None), (5, ""), (6, "a"), (6, "a"), (7, "a "),
         (None, "a"), (8, "x" * 10000), (9, "x" * 10000), (10, "x" * 10001), (None, "alone")]


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        stays = [i == keep for i in ids]
        if sum(stays) > 1:
            stays[stays.index(True)] = False
        out += [(i, keep, len(ids), s, sha) for i, s in zip(ids, stays)]
    return Counter(out)


def test_exact_groups(make_docs):
    got = chunk_recipes.exact_groups(make_docs(EXACT, extra=["keep_id", "parts", "row", "recipe"])).collect()
    assert Counter(tuple(r) for r in got) == brute_exact(EXACT)


def test_drop_copies_keeps_one_row_of_each_text(make_docs):
    docs = make_docs(EXACT, extra=["id", "sha", "row"])
    got = chunk_recipes.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.text or "" for r in got.collect()) == sorted({t or "" for _, t in EXACT})


def test_chunks_cover_the_text_and_follow_content():
    pattern = re.compile(chunk_recipes.chunk_pattern().replace("(?s)", ""), re.S)
    rnd = random.Random(5)
    text = " ".join(" ".join("w" * rnd.randint(1, 9) for _ in range(rnd.randint(1, 40))) + "." for _ in range(800))
    assert "".join(pattern.findall(text)) == text
    edited = "Something new in front. " + text
    assert len(set(pattern.findall(text)) & set(pattern.findall(edited))) > 0.8 * len(pattern.findall(text))


def test_collided_identifiers_fall_back_to_digests(spark, make_docs):
    parts = spark.sql("select * from values (array(named_struct('h', 1L, 's', X'01'))), "
                      "(array(named_struct('h', 1L, 's', X'02'))), (array(named_struct('h', 2L, 's', X'03'))) t(parts)")
    assert [r.h for r in chunk_recipes.unverified_ids(parts).collect()] == [1]
