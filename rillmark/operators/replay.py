"""Replays of a file of events: held-back events, jitter, repeats and malformed payloads.

Chance is a hash of the event's id, so a replay is the same on any cluster and
in any run, and no generator's state has to travel with the rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the replay.
MALFORMED_KINDS = ("bad_json", "bad_user", "bad_behavior", "bad_time", "empty")


def draw(number: Column, name: str) -> Column:
    """A number in [0, 1) from an event's number, another one for each name."""
    digest = F.md5(F.concat(F.lit(f"{name}-"), number.cast("string")))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") / F.lit(float(1 << 28))


def disordered(rows: DataFrame, ratio: float, span_ms: int, chunk_ms: int = 60_000) -> DataFrame:
    """A share of the events held back until an event that is sent is ``span_ms`` later than they.

    ``rows(event_time_ms, number)`` in the order of time, then number. An event
    that is not held goes at its own place; a held one right after the first
    event sent whose time reaches its own and the span. ``held``, ``after_time``
    and ``after_number`` name that place; what no event releases goes last, by
    time, and has none. Sort by ``place`` for the order itself. Nothing waits in
    a buffer, so none can overflow.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must lie in [0, 1]")
    if span_ms < 0:
        raise ValueError("span_ms must be 0 or more")
    held = draw(F.col("number"), "hold") < ratio if ratio and span_ms else F.lit(False)
    rows = rows.withColumn("held", held).withColumn("_due", F.col("event_time_ms") + F.when(F.col("held"), span_ms).otherwise(0))
    #: The next event sent after each moment: in chunks of time, then over the chunks that follow (a row each).
    rows = rows.withColumn("_chunk", F.floor(F.col("_due") / chunk_ms)).withColumn("_sent", F.when(~F.col("held"), F.struct("event_time_ms", "number")))
    follows = Window.partitionBy("_chunk").orderBy("_due", F.col("held").desc(), "number").rowsBetween(0, Window.unboundedFollowing)
    tops = rows.groupBy("_chunk").agg(F.min("_sent").alias("_first"))
    later = Window.orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_chunk", F.min("_first").over(later).alias("_later"))
    met = rows.withColumn("_inside", F.min("_sent").over(follows)).join(tops, "_chunk").withColumn("_at", F.coalesce("_inside", "_later"))
    place = F.struct(F.col("_at").isNull().alias("tail"), F.col("_at.event_time_ms").alias("time"), F.col("_at.number").alias("number"), "held", F.col("_due").alias("due"), F.col("number").alias("own"))
    return met.withColumn("place", place).withColumn("after_time", F.col("_at.event_time_ms")).withColumn("after_number", F.col("_at.number")).drop("_due", "_chunk", "_sent", "_inside", "_at", "_later")


def plan_sends(
    rows: DataFrame,
    speedup: float,
    jitter_ratio: float = 0.05,
    jitter_ms: float = 30_000,
    late_ratio: float = 0.005,
    late_min_ms: float = 180_000,
    late_max_ms: float = 600_000,
    duplicate_ratio: float = 0.002,
    malformed: int = 50,
) -> DataFrame:
    """``release_s, seq, kind, event_id, malform`` for ``rows(event_id, number, event_time_ms)``, sorted by release and seq.

    Jitter and lateness put off the sending and leave the event's time. Malformed
    payloads lie evenly over the time. No rows plan nothing.
    """
    if speedup <= 0:
        raise ValueError("speedup must be above 0")
    if late_min_ms > late_max_ms:
        raise ValueError("late_min_ms must not exceed late_max_ms")
    span = rows.agg(F.min("event_time_ms").alias("origin"), F.max("event_time_ms").alias("end"), F.max("number").alias("last")).where("origin is not null")
    roll, number = draw(F.col("number"), "roll"), F.col("number")
    kind = F.when(roll < late_ratio, "late").when(roll < late_ratio + jitter_ratio, "jitter").otherwise("data")
    extra = F.when(roll < late_ratio, late_min_ms + draw(number, "late") * (late_max_ms - late_min_ms)).when(roll < late_ratio + jitter_ratio, draw(number, "jitter") * jitter_ms).otherwise(0.0)
    base = rows.crossJoin(span)  # one row
    release = ((F.col("event_time_ms") - F.col("origin")) + extra) / speedup / 1000
    sent = base.select(release.alias("release_s"), (number * 2).alias("seq"), kind.alias("kind"), "event_id", F.lit(None).cast("string").alias("malform"), number.alias("number"))
    again = sent.where(draw(number, "again") < duplicate_ratio).withColumn("seq", F.col("seq") + 1).withColumn("kind", F.lit("duplicate")).withColumn("event_id", F.concat("event_id", F.lit("d")))
    count = max(0, int(malformed))
    step = span.select("origin", "end", "last", F.explode(F.sequence(F.lit(0), F.lit(count - 1)) if count else F.array().cast("array<int>")).alias("i"))
    names = F.array(*map(F.lit, MALFORMED_KINDS))
    broken = step.select(
        ((F.col("end") - F.col("origin")) / speedup / 1000 * (F.col("i") + 0.5) / max(1, count)).alias("release_s"), (F.col("last") * 2 + 2 + F.col("i")).alias("seq"), F.lit("malformed").alias("kind"),
        F.lit(None).cast("string").alias("event_id"), names[F.col("i") % len(MALFORMED_KINDS)].alias("malform"),
    )
    return sent.drop("number").unionByName(again.drop("number")).unionByName(broken).orderBy("release_s", "seq")


def injected(planned: DataFrame) -> DataFrame:
    """Rows of a plan by kind, malformed ones by theirs."""
    return planned.groupBy("kind", "malform").agg(F.count("*").alias("n"))


def malformed_payload(kind: Column, run_id: str, seq: Column, now_ms: Column) -> Column:
    """The JSON text of a malformed record."""
    good = lambda **change: F.to_json(F.struct(*[(change.get(n, c)).alias(n) for n, c in fields.items()]))
    fields = {
        "event_id": F.concat(F.lit("malformed-"), seq.cast("string")), "run_id": F.lit(run_id), "user_id": F.lit(1), "item_id": F.lit(1), "behavior": F.lit("pv"),
        "event_time_ms": now_ms, "produce_time_ms": now_ms, "watermark_kick": F.lit(False),
    }
    return (
        F.when(kind == "bad_json", F.concat(F.lit("{not-json-"), seq.cast("string")))
        .when(kind == "bad_user", good(user_id=F.lit(0)))
        .when(kind == "bad_behavior", good(behavior=F.lit("hover")))
        .when(kind == "bad_time", good(event_time_ms=F.lit(1)))
        .otherwise("")
    )


def play(planned: DataFrame, send: Callable[[DataFrame], None], tick_s: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> float:
    """Send a plan's rows tick by tick, none before its time; how many seconds the farthest tick was behind.

    The driver waits and names the ticks; the rows of a tick go from the tasks.
    """
    if tick_s <= 0:
        raise ValueError("tick_s must be above 0")
    tick = F.floor(F.col("release_s") / tick_s)
    last = planned.agg(F.max(tick)).first()[0]
    began, behind = clock(), 0.0
    for k in range(0 if last is None else last + 1):
        late = clock() - began - k * tick_s
        if late < 0:
            sleep(-late)
        behind = max(behind, late)
        send(planned.where(tick == k))
    return behind
