"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Each document has a fixed 30-bit hash of its id. A source takes whole passes over
its documents and, for what is left of its target, the documents whose hash lies
below a threshold. The threshold comes from histograms of words by source and
hash bucket: 1,024 buckets first, then 1,024 inside the one bucket where the
budget runs out, then 1,024 inside that one. No document is ever sorted. What
the threshold leaves over, less than the one document at it, is offered to the
documents that are small enough for it, in the same way, for a few rounds.

Cases: null texts have no words; a null source is a source, last in order; a
source without words has target 0 and takes nothing; rows that repeat an id
share its hash and are taken together; an empty table gives an empty result.
Ties in hash are one unit. Columns besides id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS, LEVELS, ROUNDS = 10, 3, 3
HASH_BITS = LEVEL_BITS * LEVELS
#: Sources whose rows, of some hundred bytes, are broadcast; salts beyond.
BROADCAST_SOURCES, SALTS = 20_000, 64


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_hash(doc_id: Column) -> Column:
    """30 bits of the MD5 of the id, the same on any cluster and in any run."""
    digest = F.md5(F.concat(F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - HASH_BITS)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Targets of ``sources(source, source_size)``: shares by weight of all words, at most ``most`` times the size.

    With caps c and weights w, the shares that remain after all resharing are
    min(c, w * level) for the one level at which they sum to all words. The
    capped sources are those of smallest c / w; one window over the sources
    (a row each) finds how many.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy("ratio", "place")
    all_rows = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    ranked = (
        sources.withColumn("place", F.row_number().over(by_name).cast("long"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_from", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("free", (F.col("total") - F.col("capped_before")) * F.col("weight") <= F.col("cap") * F.col("weight_from"))
    )
    level = F.min(F.when(F.col("free"), F.struct("ratio", "place", (F.col("total") - F.col("capped_before")).alias("left"), "weight_from"))).over(all_rows)
    share = (F.col("level.left") * F.col("weight")).cast("double") / F.col("level.weight_from")
    below = F.struct("ratio", "place") < F.struct("level.ratio", "level.place")
    return ranked.withColumn("level", level).select("source", "source_size", F.when(below, F.col("cap").cast("double")).otherwise(share).alias("target"))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def _by_source(rows: DataFrame, table: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row for each source.

    A counted number of sources is broadcast. Beyond it the table is repeated
    for each of some salts, so that the rows of a large source are dealt out.
    """
    if few:
        return rows.join(F.broadcast(table), "key")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"]).drop("salt")


def _thresholds(scratch: Scratch, name: str, candidates: DataFrame, budgets: DataFrame, last: bool) -> DataFrame:
    """``key, threshold, left`` for ``candidates(key, size, h)`` and ``budgets(key, left)``: what lies below the threshold fits.

    Nested: the histogram of a level covers only the bucket at which the level
    before ran out. Histograms are summed in each task first, so a source of any
    size reaches a task as at most 1,024 rows. With ``last``, the documents at
    the threshold itself are taken too where that comes nearer to the budget.
    """
    state = budgets.select("key", "left", F.lit(0).cast("long").alias("threshold"))
    inside = candidates
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("h", shift)
        histogram = inside.groupBy("key", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        along = Window.partitionBy("key").orderBy("bucket")
        at = (
            histogram.join(state, "key")
            .withColumn("upto", F.sum("words").over(along))
            .where(F.col("upto") > F.col("left"))
            .groupBy("key", "left", "threshold")
            .agg(F.min(F.struct("bucket", "upto", "words")).alias("first"))
            .select(
                "key",
                (F.col("left") - F.col("first.upto") + F.col("first.words")).alias("left"),
                F.shiftleft(F.col("first.bucket"), shift).alias("threshold"),
                F.col("first.bucket").alias("bucket"),
                F.col("first.words").alias("words"),
            )
        )
        at = scratch.keep(f"{name}-at{level}", at)
        if level + 1 < LEVELS:
            inside = scratch.keep(f"{name}-in{level}", inside.withColumn("bucket", bucket).join(at.select("key", "bucket"), ["key", "bucket"]).drop("bucket"))
        state = at.select("key", "left", "threshold")
    nearer = F.lit(last) & (F.col("words") - F.col("left") < F.col("left"))
    found = at.select("key", (F.col("threshold") + nearer.cast("long")).alias("threshold"), F.when(nearer, F.lit(0)).otherwise(F.col("left")).alias("left"))
    #: Sources whose candidates all fit have no boundary bucket.
    fit = budgets.select("key", F.col("left").alias("budget")).join(found, "key", "left")
    used = candidates.groupBy("key").agg(F.sum("size").alias("all"))
    return fit.join(used, "key", "left").select(
        "key",
        F.coalesce("threshold", F.lit(1 << HASH_BITS)).alias("threshold"),
        F.coalesce("left", F.col("budget") - F.coalesce("all", F.lit(0))).alias("left"),
    )


def _limits(sized: DataFrame, scratch: Scratch, weights: tuple[int, ...], most: int, rounds: int, broadcast_sources: int | None) -> tuple[DataFrame, Column, bool]:
    """A table with a row for each source, how often a row of a size and hash is taken by it, and whether the sources are few."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    plan = source_targets(sources, weights, most).withColumn("passes", passes).withColumn("key", _key(F.col("source")))
    plan = scratch.keep("plan", plan.withColumn("left", F.col("target") - F.col("passes") * F.col("source_size")).drop("source"))
    budgets, chosen = plan.select("key", "left"), plan.select("key", "source_size", "target", "passes")
    few = plan.count() <= (BROADCAST_SOURCES if broadcast_sources is None else broadcast_sources)
    taken = F.lit(False)
    for k in range(rounds):
        open_rows = _by_source(sized, chosen.join(budgets, "key"), few).where((F.col("size") > 0) & (F.col("size") <= F.col("left") + F.lit(k == 0).cast("int") * F.col("size")) & ~taken).select("key", "size", "h")
        if k:
            open_rows = scratch.keep(f"open{k}", open_rows)
        found = _thresholds(scratch, f"round{k}", open_rows, budgets, k == rounds - 1)
        limits = budgets.select("key", F.col("left").alias(f"most{k}")).join(found.select("key", F.col("threshold").alias(f"below{k}"), "left"), "key")
        limits = scratch.keep(f"limits{k}", limits)
        chosen = scratch.keep(f"chosen{k}", chosen.join(limits.drop("left"), "key"))
        fits = F.lit(True) if k == 0 else F.col("size") <= F.col(f"most{k}")
        taken = taken | (fits & (F.col("h") < F.col(f"below{k}")))
        budgets = limits.select("key", "left")
    copies = F.least(F.col("passes") + taken.cast("long"), F.lit(most)).cast("int")
    return chosen, F.when(F.col("size") > 0, copies).otherwise(0), few


def _sized(id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [_key(F.col(source_col)).alias("key"), word_count(F.col(text_col)).alias("size"), draw_hash(F.col(id_col)).alias("h")]


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    rounds: int = ROUNDS,
    broadcast_sources: int | None = None,
) -> DataFrame:
    """``id, size, source_size, target, taken, copies`` for each input row; ``taken`` is size times copies."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.keep("sized", docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), *_sized(id_col, text_col, source_col)))
    chosen, copies, few = _limits(sized, scratch, weights, most, rounds, broadcast_sources)
    return _by_source(sized, chosen, few).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    rounds: int = ROUNDS,
    broadcast_sources: int | None = None,
) -> DataFrame:
    """The documents of the mix with all their columns, a row for each copy that is taken.

    Each row is judged where it lies, by its source's row; none moves for it
    while the sources are few.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.keep("sized", docs.select(F.col(source_col).alias("source"), *_sized(id_col, text_col, source_col)))
    chosen, copies, few = _limits(sized, scratch, weights, most, rounds, broadcast_sources)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *_sized(id_col, text_col, source_col))
    return _by_source(rows, chosen, few).where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select("row.*")
