"""Viterbi counts, page extraction and dated URL lists against references."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import block_extract as X
from keelson.llm import url_asof as U
from keelson.llm import viterbi_counts as V


def tokenizer(pieces):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocab = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + pieces
    t = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return t


@pytest.fixture(scope="module")
def both():
    pieces = V.vocabulary(V.default_path())
    return V.Counter(pieces), tokenizer(pieces)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abthe ing é▁x\n\t🙂ß", max_size=40))
def test_counts_are_the_tokenizers(both, text):
    assert both[0].tokens(text) == len(both[1].encode(text, add_special_tokens=False).ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab", min_size=1, max_size=4), st.integers(-6, -1)), max_size=12),
       st.text(alphabet="abc ", max_size=25))
def test_ties_in_small_vocabularies(pieces, text):
    table = {"▁": -3.0, "a": -4.0, "▁a": -5.0} | {p: float(s) for p, s in pieces}
    c = V.Counter(list(table.items()))
    assert c.tokens(text) == len(tokenizer(list(table.items())).encode(text, add_special_tokens=False).ids)


def test_pieces_that_reach_over_spaces():
    table = [("▁a", -5.0), ("▁a▁b", -6.0), ("▁b", -4.0), ("a", -3.0), ("b", -3.0), ("▁", -2.0)]
    c, t = V.Counter(table), tokenizer(table)
    for s in ("a b", "a b a b", "b a  b", " a b "):
        assert c.tokens(s) == len(t.encode(s, add_special_tokens=False).ids)


def test_counts_of_a_table(make_docs, both):
    rows = [(1, "The quick brown fox"), (2, None), (3, ""), (4, "x" * 20000), (4, "x" * 20000), (None, "a  b "), (5, "é 🙂")]
    got = V.token_counts(make_docs(rows, extra=["n_tokens"])).collect()
    want = Counter((i, len(t or ""), len(both[1].encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert V.token_counts(make_docs([])).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies and the site is better with them for all of you.</div>
<form><label>Search</label><input name=q><button>Go</button></form>
<main><article><h1>Title &amp; more</h1><p><b>First&nbsp;paragraph<br>with the words that it has for us all, and some more of them.<p>Second
 one   &lt;here&gt;.</p><aside>Related things</aside><ul><li>an item</li><li><a href=x>A link alone that leads to another page</a></li></ul>
<p>%s</p></article><section id="comments"><p>I think that this is the best article of all that I have read in my life, and it is so on.</p></section></main>
<div class="sidebar"><p>Popular now</p></div><!-- <p>hidden</p> --><div class="ad">Buy!</div><footer>&copy; 2024 all rights</footer></body></html>"""


def test_page_extraction():
    long = "The end of the story is that it was as it is. " * 8
    want = ("Title & more First paragraph with the words that it has for us all, and some more of them. Second one <here>. an item "
            + long.strip())
    assert " ".join(X.main_blocks(PAGE % long)) == want
    assert " ".join(X.main_blocks((PAGE % long).split("</article>")[0])) == want       # cut off


def test_pages_without_an_article_element():
    text = "This is the text of the page and it has all the words that are in such a text as this. " * 4
    html = f"<div><a href=1>one</a> <a href=2>two</a></div><div><h2>Short head</h2><p>{text}</p><p>By us.</p><p>{text}</p></div><p>xqz vrk plm " + "zzkt " * 30
    assert X.main_blocks(html) == ["Short head", text.strip(), "By us.", text.strip()]


@pytest.mark.parametrize("open_, close", [
    ("<form id=aspnetForm>", "</form>"), ("<div class='content-sidebar-wrap'>", "</div>"), ("<div class='no-sidebar'>", "</div>"),
    ("<div class='page has-sidebar'>", "</div>"), ("<div class='widget'>", "</div>")])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrappers_around_the_text(open_, close, tag):
    text = "This is the text of the page and it has all the words that are in such a text as this. " * 4
    page = f"{open_}<nav><p>{text}</p></nav><{tag}><p>{text}</p></{tag}><div class=sidebar><p>By the side of it.</p></div>{close}"
    assert X.main_blocks(page) == [text.strip()]


def test_pages_of_divs_in_other_languages():
    finnish = "Talvella järvi jäätyy nopeasti, jolloin kalastajat kairaavat reikiä paksuun jäähän saadakseen ahvenia. " * 3
    chinese = "湖面在冬天很快结冰渔民们在厚厚的冰上钻孔捕鱼傍晚他们带着收获回到村庄" * 4
    for text in (finnish.strip(), chinese):
        page = f"<div class=sidebar><p>{text}</p></div><div><a href=1>x</a></div><div><h2>Otsikko</h2><p>{text}</p><p>{text}</p></div>"
        assert X.main_blocks(page) == ["Otsikko", text, text]


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text without any tag"), (4, "u", "<p>" * 3000 + "x"), (5, "u", "<a <b> &#x41; &bogus; <![CDATA["),
            (6, "u", "<article>" + "<p>word and the " * 20000), (6, "u", "<article><p>Kept.</p></article>"), (6, "u", "<article><p>Kept.</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as text", "1 as n_chars")
    got = X.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert Counter(r.text for r in got)["Kept."] == 2 and {r.page_id: r.text for r in got}[1] == ""
    assert X.extract(df.limit(0)).count() == 0


def test_template_of_the_given_pages(spark, sf_small):
    """The article's text and nothing else, on every page."""
    import html
    import re
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    got = {r.page_id: r.text for r in X.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def stamp(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def test_lists_at_the_time_of_the_fetch(spark):
    rnd = random.Random(31)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "other.org", "x.other.org", "lone"]
    entries = [(rnd.choice(hosts), stamp(rnd.randint(0, 100)), i, rnd.random() < 0.6) for i in range(120)]
    entries += [(None, stamp(1), 900, True), ("lone", None, 901, True)]
    caps = [(i, f"https://u:p@{rnd.choice(hosts).upper()}:80/x?y", stamp(rnd.randint(-5, 110))) for i in range(300)]
    caps += [(1000, None, stamp(5)), (1001, "not a url", stamp(5)), (1002, "http://lone/", None), (5, *caps[5][1:]), (None, "http://lone./", stamp(200))]
    cap_df = spark.createDataFrame(caps, "page_id bigint, url string, fetched timestamp_ntz").selectExpr("*", "'clash' as host", "2 as at")
    ent_df = spark.createDataFrame(entries, "pattern string, ts timestamp_ntz, entry_id bigint, listed boolean")

    def active(host, t):
        labels = host.split(".")
        hit = []
        for k in range(max(1, len(labels) - 1)):
            p = ".".join(labels[k:])
            past = [e for e in entries if e[0] == p and e[1] is not None and e[1] <= t]
            if past:
                last = max(past, key=lambda e: (e[1], e[2]))
                if last[3]:
                    hit.append(last[1])
        return hit
    want = Counter()
    for i, u, t in caps:
        host = u.split("@")[1].split(":")[0].lower() if u and "@" in u else "lone" if u and "lone" in u else ""
        hit = active(host, t) if host and t else []
        want[i, u, t, host, len(hit), min(hit, default=None), bool(hit)] += 1
    got = U.filter_captures(cap_df, ent_df)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert U.filter_captures(cap_df.limit(0), ent_df).count() == 0
    none = U.filter_captures(cap_df, ent_df.limit(0)).collect()
    assert len(none) == len(caps) and not any(r.blocked for r in none)
