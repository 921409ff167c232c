"""The corpus queries and their DuckDB SQL, one per operator; parameters are production values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6_SQL = rf"""
with d as (select doc_id, row_number() over () as r, coalesce('=' || source, '') as host,
                  coalesce(text, '') as t, {SQL_WORDS} as w from documents),
win as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
        from (select r, w, unnest(generate_series(1, len(w) - 2)) as i from d)),
hit as (select r, i from win qualify count(*) over (partition by r, g) > 1),
cov as (select r, count(distinct i + k) as n from hit, (values (0), (1), (2)) s(k) group by r),
ln as (select r, count(*) - count(distinct l) as n from
       (select r, unnest(string_split(t, chr(10))) as l from d)
       where regexp_matches(l, '[^\x20\x09-\x0D]') group by r),
b as (select d.r, doc_id, host, cast(len(w) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(coalesce(ln.n, 0) as bigint) as n_dup_lines,
        cast(coalesce(cov.n, 0) as bigint) as n_repeat_words
      from d left join cov on d.r = cov.r left join ln on d.r = ln.r),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b),
h as (select host, count(*) as n, count(*) filter (where base_failed) as k from f group by host),
p as (select avg(k / n) as m, var_pop(k / n) as v from h),
q as (select m, case when v > 0 and m * (1 - m) / v - 1 > 0 then m * (1 - m) / v - 1 else 20.0 end as s from p),
ok as (select host, (k + m * s) / (n + s) <= 0.5 as host_ok from h, q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and host_ok as kept
from f join ok using (host)
"""


@register("op6_host_quality", OP6_SQL)
def op6_host_quality(spark, sf_dir):
    from keelson.llm.host_quality import quality
    return quality(table(spark, sf_dir, "documents"))


OP10_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""


@register("op10_chunk_recipes", OP10_SQL)
def op10_chunk_recipes(spark, sf_dir):
    from keelson.llm.chunk_recipes import exact_groups
    return exact_groups(table(spark, sf_dir, "documents"))


@register("op1_simhash_gray")
def op1_simhash_gray(spark, sf_dir):
    from keelson.llm.simhash_gray import near_groups
    return near_groups(table(spark, sf_dir, "documents"))


@register("op3_entropy_mix")
def op3_entropy_mix(spark, sf_dir):
    from keelson.llm.entropy_mix import mix
    return mix(table(spark, sf_dir, "documents"))


@register("op8_best_fit")
def op8_best_fit(spark, sf_dir):
    from keelson.llm.best_fit import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@register("op2_bwt_dedup")
def op2_bwt_dedup(spark, sf_dir):
    from keelson.llm.bwt_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


@register("op4_viterbi_counts")
def op4_viterbi_counts(spark, sf_dir):
    from keelson.llm.viterbi_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"))


@register("op5_block_extract")
def op5_block_extract(spark, sf_dir):
    from keelson.llm.block_extract import extract
    return extract(table(spark, sf_dir, "pages"))


def capture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures and dated list entries, derived from ``pages`` and ``events``.

    A page was fetched when the event of the same number happened. An event is a list entry
    for the host of the page that its user's number names: ``error`` lists the host and
    ``purchase`` delists it, ``signup`` lists and ``view`` delists its parent domain.
    """
    from pyspark.sql import functions as F

    from keelson.llm.url_asof import host_of
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events")
    captures = (pages.join(events.select(F.col("event_id").alias("page_id"), F.col("ts").alias("fetched")), "page_id", "left"))
    host = host_of(F.col("url"))
    parent = F.when(F.size(F.split(host, r"\.")) > 3, F.regexp_replace(host, r"^[^.]*\.", "")).otherwise(host)
    named = events.where("event_type <> 'click'").join(pages, events["user_id"] == pages["page_id"])
    entries = named.select(
        F.when(F.col("event_type").isin("error", "purchase"), host).otherwise(parent).alias("pattern"),
        "ts", F.col("event_id").alias("entry_id"), F.col("event_type").isin("error", "signup").alias("listed"))
    return captures, entries


OP7_SQL = r"""
with p as (select page_id, url, row_number() over () as r, lower(regexp_replace(regexp_replace(regexp_replace(
             regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.+$', '')) as host
           from pages),
cap as (select p.*, e.ts as fetched from p left join events e on e.event_id = p.page_id),
ent as (select case when event_type in ('error', 'purchase') or len(string_split(host, '.')) <= 3 then host
               else regexp_replace(host, '^[^.]*\.', '') end as pattern,
               ts, event_id as entry_id, event_type in ('error', 'signup') as listed
        from events e join p on e.user_id = p.page_id where event_type <> 'click'),
iv as (select *, lead(ts) over (partition by pattern order by ts, entry_id) as until from ent),
pat as (select r, fetched, array_to_string(l[i:], '.') as pattern from
        (select r, fetched, l, unnest(generate_series(1, greatest(len(l) - 1, 1))) as i from
         (select r, fetched, string_split(host, '.') as l from cap where host <> '' and fetched is not null))),
hit as (select r, count(*) as n, min(iv.ts) as since from pat join iv using (pattern)
        where listed and ts <= fetched and (until is null or fetched < until) group by r)
select page_id, url, fetched, host, cast(coalesce(n, 0) as bigint) as n_listed, since as listed_since, n is not null as blocked
from cap left join hit on cap.r = hit.r
"""


@register("op7_url_asof", OP7_SQL)
def op7_url_asof(spark, sf_dir):
    from keelson.llm.url_asof import filter_captures
    return filter_captures(*capture_tables(spark, sf_dir))


@register("op9_bloom_lm")
def op9_bloom_lm(spark, sf_dir):
    from keelson.llm.bloom_lm import score
    return score(table(spark, sf_dir, "documents"))


@register("op11_bpe_codec")
def op11_bpe_codec(spark, sf_dir):
    from pyspark.sql import functions as F

    from keelson.llm.bpe_codec import decode, encode
    ids = encode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    return decode(ids).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


OP13_SQL = rf"""
with l as (select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic from labels group by doc_id),
d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {SQL_WORDS} as w from documents),
m as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
         regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) over (partition by t), false)] as f
      from d left join l using (doc_id)),
c as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
x as (select unnest([1, 2, 3, 4, 5]) as i),
o as (select [a.i, b.i, g.i, h.i, k.i] as p from x a, x b, x g, x h, x k
      where len(list_distinct([a.i, b.i, g.i, h.i, k.i])) = 5),
r as (select part, p, i as step, p[i] as f_at, n, good, toxic, f,
        f[p[i]] as fails, len(list_filter(p[1:i - 1], lambda y: f[y])) > 0 as gone from c, o, x),
s as (select part, p, step, f_at,
        sum(case when not gone and not fails then n else 0 end) as kept,
        sum(case when fails and not gone then n else 0 end) as removed,
        sum(case when fails and gone then n else 0 end) as redundant,
        sum(case when fails and len(list_filter(f, lambda y: y)) = 1 then n else 0 end) as unique_fails,
        sum(case when fails and not gone then good else 0 end) as good_lost,
        sum(case when fails and not gone then toxic else 0 end) as toxic_lost
      from r group by all)
select part, array_to_string(list_transform(p, lambda y: substr('ABCDE', y, 1)), '') as filter_order, cast(step as int) as step,
  cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f_at) as bigint) as shapley
from s
"""


@register("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark, sf_dir):
    from keelson.llm.filter_audit import filter_audit
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = """
with e as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
           from embeddings where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as ar, a.vec_id as anchor_id, a.label = b.label as same, b.r as br, b.vec_id as bid,
        cast(list_inner_product(a.v, b.v) as bigint) as score
      from e a join e b on a.r <> b.r where a.vec_id % 50 = 0),
p as (select * from s where same qualify row_number() over (partition by ar order by score desc, bid, br) <= 5)
select p.anchor_id, p.bid as positive_id,
  cast(row_number() over (partition by p.ar, p.br order by s.score desc, s.bid, s.br) as int) as rank,
  s.bid as negative_id, p.score as positive_score, s.score as negative_score
from p join s on p.ar = s.ar
where not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""


@register("op12_bond_negatives", OP12_SQL)
def op12_bond_negatives(spark, sf_dir):
    from keelson.llm.bond_negatives import mine
    return mine(table(spark, sf_dir, "embeddings"))
