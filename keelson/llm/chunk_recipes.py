"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut where its content says so: a chunk ends at the first line or sentence end
after ``MIN_CHUNK`` characters, or at ``MAX_CHUNK`` characters when there is none. Equal
texts get equal cuts. Every chunk is reduced once, in the scan, to a 64-bit identifier and
its SHA-256; the chunk dictionary (one row per identifier) verifies that all chunks of an
identifier have one SHA-256. A text is then its recipe, the ordered list of identifiers,
and texts are equal when their recipes are. Only recipes move between machines, 8 bytes per
chunk; a document is never shuffled. Where an identifier fails verification, the recipes
that hold it are compared by the ordered SHA-256 list instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import row_keys, spread_join, stored, text_or_empty

MIN_CHUNK = 256
MAX_CHUNK = 4096


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """Regular expression of one chunk; matched again and again it covers the whole text."""
    return rf"((?s).{{{least - 1},{most - 1}}}?[.!?\n]|.{{{most}}}|.+)"


def with_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, text_sha256, parts`` with ``parts`` the ordered
    chunk identifiers and digests. Null text counts as empty and has no parts."""
    text = text_or_empty(text_col)
    chunks = F.regexp_extract_all(text, F.lit(chunk_pattern()))
    parts = F.transform(chunks, lambda c: F.struct(
        F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("s")))
    return docs.select(F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep or []],
                       F.sha2(text, 256).alias("text_sha256"), parts.alias("parts"))


def unverified_ids(parts: DataFrame) -> DataFrame:
    """Chunk identifiers that stand for more than one content (column ``h``); normally none."""
    seen = parts.select(F.explode("parts").alias("p")).select("p.h", "p.s")
    return (seen.groupBy("h").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
            .where(F.col("lo") != F.col("hi")).select("h"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents with identical text.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``. The
    row with the largest id of a group stays. Null text equals empty text. A null id is
    smaller than any other. Rows that repeat an id and a text are members of their group
    like any other, and one of them stays. An empty table gives an empty result; other
    columns are not read.
    """
    base = stored(with_recipes(docs, id_col, text_col)
                  .withColumn("row", F.monotonically_increasing_id()), "recipes")
    return grouped(base).drop("row")


def grouped(base: DataFrame) -> DataFrame:
    """Groups of equal texts from stored recipes (``doc_id, text_sha256, parts`` and ``row``, which
    tells rows apart); the result has ``row``, too."""
    recipe = F.transform("parts", lambda p: p["h"])
    base = base.withColumn("recipe", recipe)
    bad = unverified_ids(base)
    doubtful = (base.select("row", F.explode("recipe").alias("h")).join(bad, "h", "left_semi")
                .select("row").distinct().withColumn("doubt", F.lit(True)))
    proof = F.when(F.col("doubt"), F.transform("parts", lambda p: p["s"]))
    rows = (base.join(doubtful, "row", "left")
            .select("doc_id", "row", "text_sha256", "recipe",
                    F.coalesce(proof, F.array().cast("array<binary>")).alias("proof")))
    groups = rows.groupBy("recipe", "proof").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    return (spread_join(rows, groups, ["recipe", "proof"])
            .select("row", "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts, the one with the largest
    ``doc_id``. Columns and rows that stay are unchanged. Recipes tell which rows stay; those
    are found again by file and row."""
    rows = row_keys(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"))
    base = stored(with_recipes(rows, keep=["f", "r"]).withColumn("row", F.struct("f", "r")).drop("f", "r"), "recipes")
    stay = grouped(base).where("kept").select("row.f", "row.r")
    return rows.join(stay, ["f", "r"], "left_semi").select("row.*")
