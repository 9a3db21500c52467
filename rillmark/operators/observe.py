"""Latency, throughput and disorder of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clickstream import utc_hour
from .events import running_before


def exact(p: float, column: str) -> Column:
    """A value of the column: the smallest that at least share ``p`` of the values don't exceed."""
    return F.expr(f"cast(percentile_disc({p}) within group (order by {column}) as bigint)")


def latency(rows: DataFrame, column: str = "latency_ms") -> DataFrame:
    return rows.agg(F.count(column).alias("n"), F.min(column).alias("min_ms"), exact(0.5, column).alias("p50_ms"), exact(0.99, column).alias("p99_ms"), F.max(column).alias("max_ms"))


def latency_approximate(rows: DataFrame, column: str = "latency_ms", accuracy: int = 10_000) -> DataFrame:
    q = lambda p: F.percentile_approx(column, p, accuracy)
    return rows.agg(F.count(column).alias("n"), q(0.5).alias("p50_ms"), q(0.99).alias("p99_ms"))


def per_second(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.floor(F.col("inserted_at_ms") / 1000).alias("second")).agg(F.count("*").alias("n"))


def ingest_rate(rows: DataFrame) -> DataFrame:
    return per_second(rows).agg(F.count("*").alias("seconds"), exact(0.5, "n").alias("p50"), F.round(F.avg("n"), 2).alias("avg"), F.max("n").alias("max"))


def burst_and_quiet(rows: DataFrame, bucket_ms: int = 1000) -> DataFrame:
    """Latency overall, in the busiest tenth of the buckets of time and in the quieter half."""
    bucket = F.floor(F.col("inserted_at_ms") / bucket_ms)
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    marks = counts.agg(exact(0.9, "n").alias("p90"), exact(0.5, "n").alias("p50"))
    judged = counts.crossJoin(marks)  # one row
    rows = rows.withColumn("bucket", bucket)
    part = lambda name, d: latency(d).select(F.lit(name).alias("part"), "*")
    burst = rows.join(judged.where("n >= p90").select("bucket"), "bucket", "left_semi")
    quiet = rows.join(judged.where("n <= p50").select("bucket"), "bucket", "left_semi")
    return part("overall", rows).unionByName(part("burst", burst)).unionByName(part("quiet", quiet))


def disorder(rows: DataFrame) -> DataFrame:
    """Rows, rows behind an earlier one, and the farthest behind, in arrival order."""
    seen = running_before(rows, {"top": F.col("event_time_ms")})
    behind = F.col("top") - F.col("event_time_ms")
    return seen.agg(F.count("*").alias("events"), F.count_if(behind > 0).alias("inversions"), F.greatest(F.coalesce(F.max(behind), F.lit(0)), F.lit(0)).cast("long").alias("max_lateness_ms"))


def profile(rows: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("behavior") == b).alias(f"n_{b}") for b in ("pv", "cart", "buy", "fav", "remove")]
    t = F.col("event_time_ms")
    return rows.agg(F.count("*").alias("rows"), F.count_distinct("user_id").alias("unique_users"), F.count_distinct("item_id").alias("unique_items"), *counts, F.min(t).alias("min_event_time_ms"), F.max(t).alias("max_event_time_ms"), (F.max(t) - F.min(t)).alias("span_ms"))


def by_hour(rows: DataFrame, column: str, *sums: Column) -> DataFrame:
    """Sums by hour of the day in UTC."""
    return rows.groupBy(utc_hour(F.col(column)).alias("hour")).agg(*sums)


def progress_summary(progress: list[dict]) -> dict[str, float]:
    """Peaks and rates of a stream's recent micro-batches, from what the query itself reports."""
    seconds = [p.get("durationMs", {}).get("triggerExecution", 0) / 1000 for p in progress]
    rows = [p.get("numInputRows", 0) for p in progress]
    rates = [n / s for n, s in zip(rows, seconds) if s > 0]
    return {"batches": len(progress), "rows": sum(rows), "max_batch_s": max(seconds, default=0.0), "max_rows_per_s": max(rates, default=0.0), "rows_per_s": sum(rows) / sum(seconds) if sum(seconds) else 0.0}
