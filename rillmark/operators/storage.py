"""Versioned tables: newest row per key, batches that replace themselves.

A batch is visible as a whole or not at all: it is a folder named by the batch,
which Spark's commit protocol fills at once. The stream's checkpoint names the
batches that are complete; one that failed is written again under its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .observe import profile


def final_view(rows: DataFrame, keys: list[str], version: str = "version", tie: str = "inserted_at_ms") -> DataFrame:
    """The newest version of each key, by partial maxima."""
    rest = [c for c in rows.columns if c not in keys]
    order = [version, *([tie] if tie in rest else [])]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)


def write_batch(rows: DataFrame, path: str, batch_id: int, version: int | None = None) -> None:
    """A micro-batch as a folder of its own: written again, it replaces itself. Aggregates carry the batch as version, details 1."""
    stamped = rows.withColumn("version", F.lit(batch_id if version is None else version).cast("long")).withColumn("inserted_at", F.current_timestamp())
    stamped.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_table(rows_path: str, spark) -> DataFrame:
    return spark.read.parquet(rows_path)


def delete_run(rows: DataFrame, run_id: str) -> DataFrame:
    """What stays of a table when a run is deleted."""
    return rows.where(~F.col("run_id").eqNullSafe(run_id))


def json_rows(rows: DataFrame) -> DataFrame:
    """One JSON object a row, fields in column order, null texts empty."""
    texts = [F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    return rows.select(F.to_json(F.struct(*texts)).alias("value"))


def write_csv(rows: DataFrame, path: str) -> None:
    """A small result as one file with a header."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def reload(rows: DataFrame, path: str) -> None:
    """Full refresh of a table."""
    rows.write.mode("overwrite").parquet(path)


def write_dataset(events: DataFrame, dim: DataFrame, folder: str) -> DataFrame:
    """A sample for replays: events by time and id, their items, and ``meta``, one row that describes them.

    Files are as many as the sample needs and hold stretches of the order; the
    description lists each with its size and SHA-256, taken where the file is read.
    """
    spark = events.sparkSession
    facts = events.select("event_id", "user_id", "item_id", "behavior", "event_time_ms")
    facts.orderBy("event_time_ms", "event_id").write.mode("overwrite").option("header", True).csv(f"{folder}/events")
    dim.select("item_id", "category_id", "category_code").orderBy("item_id").write.mode("overwrite").option("header", True).csv(f"{folder}/dim")
    files = [spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{folder}/{name}").select(F.lit(name).alias("part"), "path", "length", F.sha2("content", 256).alias("sha256")) for name in ("events", "dim")]
    named = files[0].unionByName(files[1]).select(F.concat_ws("/", "part", F.element_at(F.split("path", "/"), -1)).alias("file"), "length", "sha256")
    listed = named.agg(F.sort_array(F.collect_list(F.struct("file", "length", "sha256"))).alias("files"))
    meta = profile(facts).crossJoin(dim.agg(F.count("*").alias("dim_rows"))).crossJoin(listed)  # a row each
    meta.coalesce(1).write.mode("overwrite").json(f"{folder}/meta")
    return spark.read.schema(meta.schema).json(f"{folder}/meta")


def topic_records(rows: DataFrame, key: Column | str = "user_id") -> DataFrame:
    """``key, value`` of a topic: rows of one key keep their order, the value is JSON."""
    return rows.select(F.col(key).cast("string").alias("key") if isinstance(key, str) else key.cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def write_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Append to a topic that acknowledges on all replicas, without repeats by retries; needs the connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true"}
    records.write.format("kafka").options(**options).save()
