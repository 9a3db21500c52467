"""The driver's tables as events and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clickstream import Config, map_behavior, wall_ms

#: Window of six hours and valid times that leave some events out and the kicks in, for tables of January 2024.
PROFILE = Config(run_id="run1", window_ms=21_600_000, watermark_ms=7_200_000, valid_from=1_704_200_000_000, valid_to=1_709_000_000_000)


def canonical(rows: DataFrame, run_id: str = PROFILE.run_id) -> DataFrame:
    """Events in the model's columns; works on a stream too."""
    ms = F.unix_millis("ts") if rows.schema["ts"].dataType.simpleString() == "timestamp" else wall_ms(F.col("ts"))
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"), F.lit(run_id).alias("run_id"), "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("item_id"), map_behavior(F.col("event_type"), {"signup": "cart"}).alias("behavior"),
        ms.alias("event_time_ms"), (ms + 50 + F.pmod("event_id", F.lit(200))).alias("produce_time_ms"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark.read.parquet(f"{sf_dir}/events.parquet"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items from parts; some are absent and some have a blank code, so both kinds of miss occur."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    code = F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type"))
    return part.where("p_partkey % 7 <> 0").select(F.col("p_partkey").cast("long").alias("item_id"), F.col("p_size").cast("long").alias("category_id"), code.alias("category_code"))
