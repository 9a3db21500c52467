"""Registered queries of the training-data operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language_id, main_text, mixing, nearest, sentencepiece_bpe, simhash, substring_dedup, token_counts, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed package keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.fit_severity(docs, table(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.section_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("copies")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit_filters(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    own = (op1_exact_dedup, op2_toxicity, op3_token_counts, op4_simhash_near_dedup, op5_source_mixing, op6_substring_dedup, op7_sentencepiece, op8_nearest_neighbours, op9_html_extraction, op10_language_id, pipeline)
    return {f.__name__: f for f in own}


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op5_sql(rounds: int = mixing.ROUNDS) -> str:
    """Each round takes the longest run of hashes from the bottom that fits into what is left of the source's budget."""
    parts = [
        r"""sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || md5('mix' || coalesce(doc_id::VARCHAR, 'null'))[1:8])::BIGINT >> 2) AS h
  FROM documents)""",
        "sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)",
        "weighed AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sources)",
        """levels AS (
  SELECT *, cap / weight AS ratio, sum(source_size) OVER ()::BIGINT AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights
  FROM weighed)""",
        "numbered AS (SELECT *, row_number() OVER (ORDER BY ratio, source IS NULL, source) AS place, (total - before) * weight <= cap * weights AS free FROM levels)",
        "stop AS (SELECT place AS first_free, total - before AS rest, weights AS among FROM numbered WHERE free ORDER BY place LIMIT 1)",
        """targets AS (
  SELECT source, source_size, CASE WHEN place < first_free THEN cap::DOUBLE ELSE (rest * weight)::DOUBLE / among END AS target
  FROM numbered, stop)""",
        "passes AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS passes FROM targets)",
        """r0 AS (
  SELECT s.doc_id, s.source, s.size, s.h, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS budget, false AS taken
  FROM sized s JOIN passes p ON s.source IS NOT DISTINCT FROM p.source)""",
    ]
    for k in range(rounds):
        fits = "NOT taken AND size > 0" + (" AND size <= budget" if k else "")
        parts.append(f"c{k} AS (SELECT *, {fits} AS may, sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto FROM r{k})")
        parts.append(f"e{k} AS (SELECT *, min(CASE WHEN may AND upto > budget THEN h END) OVER (PARTITION BY source) AS edge FROM c{k})")
        parts.append(f"t{k} AS (SELECT *, sum(CASE WHEN may AND (edge IS NULL OR h < edge) THEN size ELSE 0 END) OVER (PARTITION BY source) AS fit, sum(CASE WHEN may AND h = edge THEN size ELSE 0 END) OVER (PARTITION BY source) AS more FROM e{k})")
        nearer = "more - (budget - fit) < budget - fit" if k == rounds - 1 else "false"
        parts.append(f"r{k + 1} AS (SELECT doc_id, source, size, h, source_size, target, passes, budget - fit AS budget, taken OR (may AND (edge IS NULL OR h < edge OR (h = edge AND {nearer}))) AS taken FROM t{k})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, size, source_size, target, (CASE WHEN size > 0 THEN size * least(passes + taken::INT, 3) ELSE 0 END)::BIGINT AS taken FROM r{rounds}"


OP6_SQL = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i:i + 19], ' ') ORDER BY doc_id NULLS FIRST, i) AS k FROM places) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS at FROM later),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM split),
kept AS (SELECT e.doc_id, count(g.at) AS n_removed, string_agg(e.word, ' ' ORDER BY e.at) FILTER (g.at IS NULL) AS kept FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.at = g.at GROUP BY e.doc_id)
SELECT s.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op5_source_mixing": op5_sql(), "op6_substring_dedup": OP6_SQL}
