"""From raw documents to token ids: the stages of a training corpus, each over all that the one before kept.

Every stage but the last returns the columns it was given, whatever else they
hold and however they are named. Null and empty texts are documents without
words, in every stage; an empty table stays empty; whole texts of any length
count. What a stage does with repeated ids and ties stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillmark.llm import exact_dedup, mixing, near_copies, sentencepiece_bpe, toxicity
from rillmark.llm.queries import table, tokenizer_path
from rillmark.llm.store import Scratch, clean, free_finished, tables_so_far


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is more likely above 0 go.

    Rows that repeat are judged alike; texts without words stay. Where the labels
    hold one class only, or none, nothing goes.
    """
    free_finished(spark)
    return toxicity.drop_toxic(docs, toxicity.fit_severity(docs, table(spark, sf_dir, "labels")))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of largest id stays.

    Null and empty texts are equal; a null id gives way to any other; of rows that
    repeat id and text one stays.
    """
    free_finished(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose five-word shingles are similar to 0.8 or more the document of smallest id stays.

    SimHash fingerprints in BK-trees propose the pairs; whole sets decide them, and
    what may be similar beyond the trees' radius is compared too. Texts without words are similar; of rows that repeat an id that stays one stays.
    """
    free_finished(spark)
    return near_copies.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times.

    Documents without words are never taken; a null source is a source; rows that
    repeat an id share its hash and so their fate where their sizes are alike.
    """
    free_finished(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids and the decoded text of each row that the mix holds, copies included."""
    free_finished(spark)
    return sentencepiece_bpe.encode_texts(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", dedup_exact),
    ("simhash_near_dedup", dedup_near),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

#: No SQL: the first stage is a fitted model, the last a tokenizer. The tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again as the next one's documents; what a stage wrote on its way goes."""
    scratch = Scratch(spark, "pipeline")
    docs, begun = table(spark, sf_dir, "documents"), tables_so_far(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(f"{i}-{name}", stage(spark, docs, sf_dir))
        clean(spark, begun)
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
