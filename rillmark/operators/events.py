"""Quality, enrichment, arrival order, event time and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clickstream import BEHAVIORS, NATURAL_KEY, NO_CATEGORY, UNKNOWN, Config, category_or_unknown, invalid_reason, window_start

#: Milliseconds of arrivals that one task orders.
CHUNK_MS = 60_000


def scope_run(rows: DataFrame, run_id: str) -> DataFrame:
    """Kicks, unreadable rows and the run's own; unreadable rows without a run join this one."""
    adopted = F.when(F.col("parse_reason").isNotNull() & (F.col("run_id") == ""), run_id).otherwise(F.col("run_id"))
    return rows.withColumn("run_id", adopted).where(F.col("watermark_kick") | F.col("parse_reason").isNotNull() | (F.col("run_id") == run_id))


def is_kick(rows: DataFrame) -> Column:
    """Control records; rows without the mark have none."""
    return F.coalesce(F.col("watermark_kick"), F.lit(False)) if "watermark_kick" in rows.columns else F.lit(False)


def with_reason(rows: DataFrame, config: Config) -> DataFrame:
    """The first rule that an event breaks. Kicks pass unjudged."""
    parsed = "parse_reason" if "parse_reason" in rows.columns else None
    return rows.withColumn("reason", F.when(~is_kick(rows), invalid_reason(config, parsed)))


def drop_kicks(rows: DataFrame) -> DataFrame:
    return rows.where(~is_kick(rows))


def shard(rows: DataFrame, index: int, count: int, number: Column) -> DataFrame:
    """One of ``count`` senders' rows, dealt by a number."""
    if not 0 <= index < count:
        raise ValueError("index must lie in [0, count)")
    return rows.where(F.pmod(number, F.lit(count)) == index)


def first_rows(rows: DataFrame, most: int, *order: Column) -> DataFrame:
    """At most so many rows from the start of an order; each task hands on no more than that."""
    return rows.orderBy(*order).limit(most)


def enrich(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Category of each item. A miss and an unknown code both count as missing; Spark broadcasts the items where they are small."""
    known = dim.select("item_id", F.col("category_id").alias("_id"), F.col("category_code").alias("_code"))
    joined = rows.join(known, "item_id", "left")
    code = category_or_unknown(F.col("_code"))
    out = joined.withColumn("category_id", F.coalesce("_id", F.lit(NO_CATEGORY)).cast("long")).withColumn("category_code", code)
    return out.withColumn("dim_miss", F.col("category_code") == UNKNOWN).drop("_id", "_code")


def build_items(rows: DataFrame) -> DataFrame:
    """One category per item: the most frequent code, of equals the smallest; its most frequent id, of equals the first seen.

    ``rows(item_id, category_id, category_code, row_idx)``. Counts come first, so an item of any size reaches a task as one row per category.
    """
    counts = rows.groupBy("item_id", "category_code", "category_id").agg(F.count("*").alias("n"), F.min("row_idx").alias("seen"))
    codes = counts.groupBy("item_id", "category_code").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("n"), "seen", "category_id")).alias("id"))
    best = codes.groupBy("item_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "category_code", "id")).alias("b"))
    return best.select("item_id", F.col("b.id.category_id").alias("category_id"), F.col("b.category_code").alias("category_code"))


def arrivals(rows: DataFrame, held_ms: int = 10_800_000, hold_every: int = 4, duplicate_every: int = 50) -> DataFrame:
    """Arrival order of a disordered replay with repeats: ``arrival``, ``seq`` and ``kind``. A rule on the id replaces chance."""
    number = F.col("event_id").cast("long")
    held = F.pmod(number, F.lit(hold_every)) == 2
    base = rows.withColumn("seq", number * 2).withColumn("arrival", F.col("event_time_ms") + F.when(held, held_ms).otherwise(0)).withColumn("kind", F.when(held, "late").otherwise("data"))
    again = base.where(F.pmod(number, F.lit(duplicate_every)) == 0).withColumn("event_id", F.concat("event_id", F.lit("d"))).withColumn("seq", F.col("seq") + 1).withColumn("kind", F.lit("duplicate"))
    return base.unionByName(again)


def running_before(rows: DataFrame, values: dict[str, Column], chunk_ms: int = CHUNK_MS) -> DataFrame:
    """The largest of each of ``values`` among rows that arrived earlier, by (arrival, seq).

    In two levels: the largest of each chunk of arrival time, then of all chunks
    before (a row each), then within a chunk. No task orders all rows.
    """
    names = list(values)
    rows = rows.withColumns({"_chunk": F.floor(F.col("arrival") / chunk_ms), **{f"_v{i}": values[n] for i, n in enumerate(names)}})
    tops = rows.groupBy("_chunk").agg(*[F.max(f"_v{i}").alias(f"_t{i}") for i in range(len(names))])
    past = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = tops.select("_chunk", *[F.max(f"_t{i}").over(past).alias(f"_b{i}") for i in range(len(names))])
    inside = Window.partitionBy("_chunk").orderBy("arrival", "seq").rowsBetween(Window.unboundedPreceding, -1)
    met = rows.withColumns({f"_i{i}": F.max(f"_v{i}").over(inside) for i in range(len(names))}).join(before, "_chunk")
    return met.withColumns({n: F.greatest(f"_i{i}", f"_b{i}") for i, n in enumerate(names)}).drop("_chunk", *[f"_{k}{i}" for k in "vib" for i in range(len(names))])


def in_range(config: Config) -> Column:
    return F.col("event_time_ms").between(config.valid_from, config.valid_to)


def advances(config: Config) -> Column:
    """Whose time moves the watermark: by scope any event of a valid time, or valid events; kicks do in both."""
    return in_range(config) if config.watermark_scope == "source" else F.col("reason").isNull() & in_range(config)


def with_watermark(rows: DataFrame, config: Config) -> DataFrame:
    """``wm_before``: the watermark an event meets, advanced by each event that came before it, or by period."""
    if config.watermark_mode == "periodic":
        return with_periodic_watermark(rows, config, config.watermark_interval_ms, advances(config))
    out = running_before(rows, {"_max": F.when(advances(config), F.col("event_time_ms"))})
    return out.withColumn("wm_before", F.col("_max") - config.watermark_ms - 1).drop("_max")


def with_periodic_watermark(rows: DataFrame, config: Config, period_ms: int, counts: Column | None = None) -> DataFrame:
    """The watermark moves only at the ends of periods of arrival time: rows meet the maximum of earlier periods."""
    period = F.floor(F.col("arrival") / period_ms)
    counted = F.when(in_range(config) if counts is None else counts, F.col("event_time_ms"))
    tops = rows.groupBy(period.alias("_p")).agg(F.max(counted).alias("_top"))
    known = tops.select("_p", (F.max("_top").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)) - config.watermark_ms - 1).alias("wm_before"))
    return rows.withColumn("_p", period).join(known, "_p").drop("_p")


def with_partition_watermark(rows: DataFrame, config: Config, partitions: int, idle_ms: int | None = None) -> DataFrame:
    """The least of the partitions' watermarks, all of them kept in one pass; none until every partition has had an event.

    With ``idle_ms``, the configuration's unless given and 0 for never, a partition from which nothing arrived for longer holds no
    longer back, one that never sent anything from that time after the first
    arrival; where all are idle the largest is left.
    """
    idle_ms = config.idle_ms if idle_ms is None else idle_ms
    mine = [F.pmod("user_id", F.lit(partitions)) == p for p in range(partitions)]
    values = {f"_max{p}": F.when(in_range(config) & m, F.col("event_time_ms")) for p, m in enumerate(mine)}
    if idle_ms:
        values |= {f"_at{p}": F.when(m, F.col("arrival")) for p, m in enumerate(mine)} | {"_begun": -F.col("arrival")}
    out = running_before(rows, values)
    tops = [F.col(f"_max{p}") for p in range(partitions)]
    waits = [F.coalesce(F.col("arrival") - F.coalesce(F.col(f"_at{p}"), -F.col("_begun")) <= idle_ms, F.lit(True)) if idle_ms else F.lit(True) for p in range(partitions)]
    seen = F.array(*[F.struct(w.alias("waits"), t.alias("top")) for w, t in zip(waits, tops)])
    held = F.filter(seen, lambda x: x.waits)
    least = F.when(F.exists(held, lambda x: x.top.isNull()), F.lit(None).cast("long")).when(F.size(held) == 0, F.array_max(F.transform(seen, lambda x: x.top))).otherwise(F.array_min(F.transform(held, lambda x: x.top)))
    return out.withColumn("wm_before", least - config.watermark_ms - 1).drop(*values)


def with_late(rows: DataFrame, config: Config) -> DataFrame:
    """An event is late if its window's last millisecond is not above the watermark it meets."""
    start = window_start(F.col("event_time_ms"), config.window_ms)
    return rows.withColumn("window_start_ms", start).withColumn("is_late", F.coalesce(start + config.window_ms - 1 <= F.col("wm_before"), F.lit(False)))


def with_duplicates(rows: DataFrame) -> DataFrame:
    """``is_dup``: a valid event of the same natural key arrived earlier.

    The first of each key is found by partial minima and joined back, so a key
    that repeats without end reaches no task as one group.
    """
    valid = ~is_kick(rows) & F.col("reason").isNull() if "reason" in rows.columns else ~is_kick(rows)
    keys = {f"_{c}": F.col(c) for c in NATURAL_KEY}
    firsts = rows.where(valid).groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.min(F.struct("arrival", "seq")).alias("_first"))
    same = [F.col(c) == F.col(n) for n, c in zip(keys, NATURAL_KEY)]
    later = valid & F.coalesce(F.struct("arrival", "seq") > F.col("_first"), F.lit(False))
    return rows.join(firsts, same, "left").withColumn("is_dup", later).drop("_first", *keys)


def classify(rows: DataFrame, config: Config) -> DataFrame:
    """Every arrival with its outcome in one pass: ``reason`` (null if valid), ``is_dup``, ``is_late``."""
    judged = with_late(with_watermark(with_reason(rows, config), config), config)
    return with_duplicates(judged.withColumn("is_late", F.col("is_late") & F.col("reason").isNull() & ~is_kick(judged)))


def outputs(rows: DataFrame, config: Config) -> dict[str, DataFrame]:
    """The job's streams by name, each from no more than it needs; ``quality`` mode has no windows and so no late events."""
    judged = with_reason(rows, config)
    valid = judged.where("reason is null")
    once = lambda d: d if config.forward_duplicates else with_duplicates(d).where("not is_dup")
    found = {"events": drop_kicks(once(valid)), "invalid": judged.where("reason is not null"), "duplicates": with_duplicates(valid).where("is_dup")}
    if config.mode == "full":
        timed = with_late(with_watermark(judged if config.watermark_scope == "source" else valid, config).where("reason is null"), config)
        main = drop_kicks(once(timed))
        found |= {"late": main.where("is_late"), "on_time": main.where("not is_late")}
    return found


def kicks(last_ms: int, config: Config, partitions: int) -> list[dict]:
    """Control records that close the last windows, one a partition."""
    ms = last_ms + config.window_ms + config.watermark_ms + 60_000
    return [{"event_id": f"kick-{config.run_id}-{p}", "run_id": config.run_id, "user_id": 0, "item_id": 0, "behavior": "kick", "event_time_ms": ms, "produce_time_ms": ms, "watermark_kick": True} for p in range(partitions)]


def known_behaviors(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("behavior").isin(*BEHAVIORS))
