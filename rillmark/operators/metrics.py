"""Windowed metrics over events with ``window_start_ms`` and a category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clickstream import NATURAL_KEY, Config


def is_(behavior: str) -> Column:
    return F.col("behavior") == behavior


def with_end(rows: DataFrame, config: Config, *columns: str) -> DataFrame:
    return rows.select("window_start_ms", (F.col("window_start_ms") + config.window_ms).alias("window_end_ms"), *columns)


def user_partials(rows: DataFrame) -> DataFrame:
    """A user's window: counts, first time of each step, last produce time. Mergeable."""
    first = lambda b: F.min(F.when(is_(b), F.col("event_time_ms"))).alias(f"min_{b}_ms")
    return rows.groupBy("window_start_ms", "user_id").agg(
        F.count_if(is_("pv")).alias("pv"), F.count_if(is_("cart")).alias("cart_cnt"), F.count_if(is_("buy")).alias("buy_cnt"), F.count("*").alias("events"),
        F.count_if(F.col("dim_miss")).alias("dim_miss"), F.max("produce_time_ms").alias("max_produce_time_ms"), first("pv"), first("cart"), first("buy"),
    )


SUMS = ("pv", "cart_cnt", "buy_cnt", "events", "dim_miss")
FUNNEL = ("pv_users", "cart_users", "buy_users", "pv_to_cart_users", "cart_to_buy_users", "pv_to_buy_users")


def of_windows(partials: DataFrame, config: Config) -> DataFrame:
    """All counts of each window from its users' partials: views, viewers, step counts and the funnel."""
    pv, cart, buy = (F.col(f"min_{b}_ms") for b in ("pv", "cart", "buy"))
    total = partials.groupBy("window_start_ms").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.count_if(F.col("pv") > 0).alias("uv"), F.max("max_produce_time_ms").alias("max_produce_time_ms"),
        F.count(pv).alias("pv_users"), F.count(cart).alias("cart_users"), F.count(buy).alias("buy_users"),
        F.count_if(cart >= pv).alias("pv_to_cart_users"), F.count_if(buy >= cart).alias("cart_to_buy_users"), F.count_if(buy >= pv).alias("pv_to_buy_users"),
    )
    return with_end(total, config, "pv", "uv", "cart_cnt", "buy_cnt", "events", "dim_miss", "max_produce_time_ms", *FUNNEL)


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial a user and window from several."""
    lowest = [F.min(f"min_{b}_ms").alias(f"min_{b}_ms") for b in ("pv", "cart", "buy")]
    return partials.groupBy("window_start_ms", "user_id").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("max_produce_time_ms").alias("max_produce_time_ms"), *lowest)


def pv_uv(rows: DataFrame, config: Config) -> DataFrame:
    """Views, viewers and step counts by window. Users are counted from partials, which two exchanges of partial sums reach."""
    return of_windows(user_partials(rows), config).drop(*FUNNEL)


def pv_uv_single(rows: DataFrame, config: Config) -> DataFrame:
    """The same in one aggregation with a distinct count."""
    total = rows.groupBy("window_start_ms").agg(
        F.count_if(is_("pv")).alias("pv"), F.count_distinct(F.when(is_("pv"), F.col("user_id"))).alias("uv"), F.count_if(is_("cart")).alias("cart_cnt"), F.count_if(is_("buy")).alias("buy_cnt"),
        F.count("*").alias("events"), F.count_if(F.col("dim_miss")).alias("dim_miss"), F.max("produce_time_ms").alias("max_produce_time_ms"),
    )
    return with_end(total, config, "pv", "uv", "cart_cnt", "buy_cnt", "events", "dim_miss", "max_produce_time_ms")


def funnel(rows: DataFrame, config: Config) -> DataFrame:
    """Users by step and by ordered pair of steps; a pair's second step is not before its first."""
    return of_windows(user_partials(rows), config).select("window_start_ms", "window_end_ms", *FUNNEL)


def rank_items(counts: DataFrame, config: Config) -> DataFrame:
    """Most viewed items of each window from ``counts(window_start_ms, item_id, category_code, pv)``, ties by item; ranks beyond N are cut before the exchange."""
    order = Window.partitionBy("window_start_ms").orderBy(F.col("pv").desc(), "item_id")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.top_n)
    return with_end(ranked.withColumn("rank", F.col("rank").cast("long")), config, "rank", "item_id", "category_code", "pv")


def top_items(rows: DataFrame, config: Config) -> DataFrame:
    return rank_items(rows.where(is_("pv")).groupBy("window_start_ms", "item_id", "category_code").agg(F.count("*").alias("pv")), config)


def category_pv(rows: DataFrame, config: Config) -> DataFrame:
    return with_end(rows.where(is_("pv")).groupBy("window_start_ms", "category_code").agg(F.count("*").alias("pv")), config, "category_code", "pv")


def duplicate_count(rows: DataFrame) -> DataFrame:
    """Events beyond the first of their natural key."""
    return rows.groupBy(*NATURAL_KEY).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_events"))
