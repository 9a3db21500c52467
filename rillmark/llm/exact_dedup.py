"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut at places that its own characters name, so equal texts are cut
alike wherever they lie. Each chunk stands for a 64-bit identifier, and a text
for the ordered list of its chunks' identifiers. Chunk texts move once, already
reduced to the distinct chunks of each task, to prove that an identifier stands
for one chunk; after that only identifier lists move, never documents.

Cases: a null text counts as empty and has an empty recipe; texts of any length
are cut at 4,096 characters at the latest; null ids sort before all others, so
they stay only where a group has no other; of rows that repeat id and text, one
stays. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch, fresh

#: A chunk ends after one of some letters and a white space, 512 to 4,096 characters from its start.
CHUNK = r"(?s).{512,4096}?(?:(?<=[aiqyAIQY19áéíäüö]\s)|\z)|.{512,4096}|.{1,511}"


def chunks_of(text: Column) -> Column:
    """A text's chunks in order; joined they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(0))


def text_recipes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    identifier: Callable[[Column], Column] = F.xxhash64,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Row number, id, SHA-256 and verified recipe of each row.

    ``recipe`` lists the chunks' identifiers. Where different chunks share one
    (about one pair in 2**64), ``variants`` says for each such place which of
    them it holds, so two rows agree in both columns only if their texts agree.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact_dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("row_no"))
    recipes = scratch.keep(
        "recipes",
        rows.select(
            "row_no",
            "id",
            F.sha2("text", 256).alias("sha256"),
            F.transform(chunks_of(F.col("text")), lambda c: identifier(c)).alias("recipe"),
        ),
    )
    distinct = rows.select(F.explode(chunks_of(F.col("text"))).alias("chunk")).select(identifier(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = scratch.keep("shared", distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    none = F.array().cast("array<struct<pos:int,chunk:string>>")
    if shared.isEmpty():
        return recipes.withColumn("variants", none)
    places = (
        rows.select("id", F.sha2("text", 256).alias("sha256"), F.posexplode(chunks_of(F.col("text"))).alias("pos", "chunk"))
        .withColumn("h", identifier(F.col("chunk")))
        .join(shared, "h", "left_semi")
        .groupBy(F.col("id").alias("_id"), F.col("sha256").alias("_sha256"))
        .agg(F.sort_array(F.collect_set(F.struct("pos", "chunk"))).alias("variants"))
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha256") == F.col("_sha256"))
    return scratch.keep("verified", recipes.join(places, same, "left").drop("_id", "_sha256").withColumn("variants", F.coalesce("variants", none)))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    identifier: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Of equal texts the row with the largest id stays. The groups are summed
    within each task before they are dealt out; rows meet their group's result
    in a join of small rows whose large partitions Spark may split.
    """
    recipes = text_recipes(docs, id_col, text_col, identifier)
    groups = recipes.groupBy("recipe", "variants").agg(F.max(F.struct("id", "row_no")).alias("last"), F.count("*").alias("group_size"))
    key = F.xxhash64("recipe")
    return (
        recipes.withColumn("key", key)
        .join(groups.withColumn("key", key), ["key", "recipe", "variants"])
        .select(
            F.col("id").alias(id_col),
            F.col("last.id").alias("keep_id"),
            "group_size",
            (F.col("row_no") == F.col("last.row_no")).alias("kept"),
            F.col("sha256").alias("text_sha256"),
            F.size("recipe").alias("n_chunks"),
        )
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; each document moves once."""
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    recipes = text_recipes(docs, id_col, text_col, scratch=scratch)
    groups = recipes.groupBy("recipe", "variants").agg(F.max(F.struct("id", "sha256")).alias("last"))
    digest, keep_id, keep_digest = fresh(docs, "digest", "keep_id", "keep_digest")
    keep = scratch.keep("keep", groups.select(F.col("last.id").alias(keep_id), F.col("last.sha256").alias(keep_digest)))
    digested = docs.withColumn(digest, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    kept = digested.join(keep, F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(digest) == F.col(keep_digest)), "left_semi")
    if not recipes.groupBy("id", "sha256").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)
