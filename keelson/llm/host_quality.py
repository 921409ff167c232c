"""Quality rules with host-level verdicts (DataFrame functions only).

Document rules are computed from the whole text. Their failures are aggregated by host
(the ``source`` of a document); the failure rate of every host is shrunk towards the mean
of all hosts with a beta prior fitted to the hosts by the method of moments, so that a
host with few documents is not condemned by them. A host whose shrunk rate is above
``HOST_LIMIT`` is rejected with all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import BLANKS, row_keys, stored, text_or_empty, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_LIMIT = 0.5
#: Documents that the prior weighs when the hosts do not differ measurably.
DEFAULT_STRENGTH = 20.0


def repeated_words(at: Column) -> Column:
    """Number of words covered by three-word windows that occur at least twice. ``at``: the
    windows of a text as (hash ``h``, position ``i``), sorted; it must be a plain column, as
    it is looked up for every element."""
    def position(x, j):
        before, after = F.get(at, j - 1)["h"], F.get(at, j + 1)["h"]
        same = F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))
        return F.when(same, x["i"])

    # positions of the windows whose neighbour in hash order is equal
    hit = F.sort_array(F.filter(F.transform(at, position), lambda i: i.isNotNull()))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        hit, start,
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"].cast("long"))


def with_features(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` plus the document rules: ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed``. Null text has no words and fails."""
    t = docs.select(*keep, text_or_empty().alias("__t"))
    lines = F.filter(F.split(F.col("__t"), "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    t = t.select(*[c for c in t.columns if c != "__t"], words(F.col("__t")).alias("__w"),
                 F.length(F.translate("__t", BLANKS, "")).cast("long").alias("word_chars"),
                 F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 lines.alias("__l"))
    kept = [c for c in t.columns if not c.startswith("__")]
    w = F.col("__w")
    windows = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    t = t.select(*kept, F.size("__w").cast("long").alias("n_words"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 windows.alias("__g"))
    kept = [c for c in t.columns if not c.startswith("__")]
    sites = F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    t = t.select(*kept, F.when(F.size(F.array_distinct("__g")) < F.size("__g"), F.sort_array(sites))
                 .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("__s"))
    t = t.select(*kept, repeated_words(F.col("__s")).alias("n_repeat_words"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return t.withColumn("base_failed", failed)


def host_verdicts(flags: DataFrame, host: str = "host", failed: str = "base_failed",
                  limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: ``host, n_docs, n_failed, rate`` (shrunk) and ``host_ok``."""
    hosts = stored(flags.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"),
                                           F.sum(F.col(failed).cast("long")).alias("n_failed")), "hosts")
    share = F.col("n_failed") / F.col("n_docs")
    m, v = hosts.agg(F.avg(share), F.var_pop(share)).first()
    m, v = m or 0.0, v or 0.0
    strength = m * (1 - m) / v - 1 if v > 0 else DEFAULT_STRENGTH
    strength = strength if strength > 0 else DEFAULT_STRENGTH
    rate = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", rate).withColumn("host_ok", F.col("rate") <= limit)


def _host() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def judge(flags: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``flags`` (with ``host`` and ``base_failed``) plus ``kept``."""
    return (flags.join(verdicts.select("host", "host_ok"), "host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).drop("host", "host_ok"))


def quality(docs: DataFrame) -> DataFrame:
    """Rules and verdict per row of ``docs``.

    Columns: ``doc_id``, the figures of :func:`with_features` and ``kept``. Null text counts
    as empty; a null ``source`` is a host of its own; repeated rows are judged one by one;
    an empty table gives an empty result; extra columns are not read.
    """
    rows = stored(with_features(docs, [F.col("doc_id"), _host().alias("host")]), "quality")
    return judge(rows, host_verdicts(rows))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the rules and whose host passes, columns unchanged."""
    rows = row_keys(docs.select(F.struct(*docs.columns).alias("row"), "text", "source"))
    flags = stored(with_features(rows, [F.col("f"), F.col("r"), _host().alias("host")])
                   .select("f", "r", "host", "base_failed"), "flags")
    good = judge(flags, host_verdicts(flags)).where("kept").select("f", "r")
    return rows.join(good, ["f", "r"], "left_semi").select("row.*")
