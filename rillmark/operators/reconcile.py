"""Realtime results against batch results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clickstream import NATURAL_KEY

SUMMED = ("pv", "uv", "cart_cnt", "buy_cnt")
STEPS = ("pv_users", "pv_to_cart_users", "cart_to_buy_users", "pv_to_buy_users")
COMPARED = {"pv_uv": (*SUMMED, "dim_miss"), "funnel": (*STEPS, "cart_users", "buy_users")}


def long_form(rows: DataFrame, metrics: tuple[str, ...], name: str) -> DataFrame:
    """A row per window and metric."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias(name)) for m in metrics])
    return rows.select("window_start_ms", F.explode(pairs).alias("p")).select("window_start_ms", "p.metric", f"p.{name}")


def compare(realtime: DataFrame, batch: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Per metric: windows compared, windows one side lacks, windows that differ, size of the differences, sums."""
    both = long_form(realtime, metrics, "rt").join(long_form(batch, metrics, "batch"), ["window_start_ms", "metric"], "full_outer")
    one = F.col("rt").isNull() | F.col("batch").isNull()
    off = F.when(~one, F.abs(F.col("rt") - F.col("batch")))
    return both.groupBy("metric").agg(
        F.count_if(~one).alias("windows_compared"), F.count_if(one).alias("missing_one_side"), F.count_if(off > 0).alias("with_diff"),
        F.coalesce(F.sum(off), F.lit(0)).alias("sum_abs_diff"), F.coalesce(F.max(off), F.lit(0)).alias("max_abs_diff"),
        F.coalesce(F.sum(F.when(~one, F.col("rt"))), F.lit(0)).alias("rt_sum"), F.coalesce(F.sum(F.when(~one, F.col("batch"))), F.lit(0)).alias("batch_sum"),
    )


def compare_top(realtime: DataFrame, batch: DataFrame) -> DataFrame:
    """Ranked items by window and rank."""
    pick = lambda d, s: d.select("window_start_ms", "rank", F.col("item_id").alias(f"item_{s}"), F.col("pv").alias(f"pv_{s}"))
    both = pick(realtime, "rt").join(pick(batch, "batch"), ["window_start_ms", "rank"], "full_outer")
    rt, other = F.col("item_rt").isNotNull(), F.col("item_batch").isNotNull()
    differs = rt & other & ((F.col("item_rt") != F.col("item_batch")) | (F.col("pv_rt") != F.col("pv_batch")))
    return both.agg(F.count_if(rt).alias("rt_pairs"), F.count_if(other).alias("batch_pairs"), F.count_if(rt != other).alias("missing"), F.count_if(differs).alias("mismatch"))


def reconcile_rows(pairs: list[tuple[DataFrame, DataFrame, tuple[str, ...]]], run_id: str) -> DataFrame:
    """Rows to store: windows on both sides, a row per metric."""
    parts = [long_form(rt, m, "rt_value").join(long_form(batch, m, "batch_value"), ["window_start_ms", "metric"]) for rt, batch, m in pairs]
    rows = reduce(DataFrame.unionByName, parts)
    value = lambda c: F.col(c).cast("double").alias(c)
    return rows.select(F.lit(run_id).alias("run_id"), "metric", "window_start_ms", value("rt_value"), value("batch_value"), F.abs(F.col("rt_value") - F.col("batch_value")).cast("double").alias("abs_diff"))


def summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("metric").agg(F.count("*").alias("windows"), F.round(F.sum("abs_diff"), 2).alias("sum_abs_diff"), F.round(F.max("abs_diff"), 2).alias("max_abs_diff"))


def pv_identity(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """On-time views and late views without repeated views are the file's views without its own repeats.

    ``stored(behavior, is_late, is_dup)`` holds a run's valid events, ``batch`` the file's.
    """
    pv = F.col("behavior") == "pv"
    found = stored.agg(F.count_if(pv & ~F.col("is_late")).alias("ads_pv"), F.count_if(pv & F.col("is_late")).alias("late_pv"), F.count_if(pv & F.col("is_dup")).alias("duplicate_pv"))
    times = batch.where(pv).groupBy(*NATURAL_KEY).agg(F.count("*").alias("n"))
    file = times.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("batch_pv"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("file_duplicate_pv"))
    gap = F.col("ads_pv") + F.col("late_pv") - F.col("duplicate_pv") - F.col("batch_pv") + F.col("file_duplicate_pv")
    return found.crossJoin(file).withColumn("gap", gap).withColumn("exact", gap == 0)  # a row each


def contaminated(duplicates: int, produced: int, most: float = 0.05) -> bool:
    """Whether a run holds more repeats than its own replay can explain."""
    return duplicates > most * produced


def settled(signatures: list[tuple], produced: int, polls: int = 3) -> bool:
    """Whether the last ``polls`` + 1 readings (events, windows, late) agree, with all events and some window there."""
    last = signatures[-(polls + 1) :]
    return len(last) == polls + 1 and len(set(last)) == 1 and last[0][0] >= produced and last[0][1] > 0


def accepted(rate: float, before: float, least: float = 1.05) -> bool:
    """Whether a change of the job is kept: its rate is at least so many times the one before."""
    return before > 0 and rate >= least * before
