"""The job under Structured Streaming, with the operators of the batch path.

``foreachBatch`` takes a micro-batch through the whole job and writes every
output and every piece of state as a folder named by the batch. A batch that is
repeated after a failure reads the state of the batches before it and writes the
same folders again, so results have no gap and no surplus.

State between batches:

* the largest event time so far, which moves the watermark event by event,
* natural keys with the time of the job's clock at which they were first seen,
  left out of a batch once ``dedup_ttl_ms`` have passed, and deleted,
* partial counts of windows by user, item and category. A window is closed once
  the watermark passes it, and is then counted from its partials and written
  once; events that come later are an output of their own and change nothing.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clickstream import NATURAL_KEY, Config
from ..operators import events as ev
from ..operators import metrics
from ..sources.readers import parse_json_events

_own: dict[str, str] = {}
KEYS = "user_id long, item_id long, behavior string, event_time_ms long"
EVENT = f"event_id string, run_id string, {KEYS}, produce_time_ms long"
COUNTS = "window_start_ms long, window_end_ms long"
#: Outputs of the job.
OUTPUTS = {
    "events": f"{EVENT}, category_id long, category_code string, dim_miss boolean",
    "invalid": f"{EVENT}, reason string",
    "duplicates": EVENT,
    "late": f"{EVENT}, window_start_ms long",
    "pv_uv": f"{COUNTS}, pv long, uv long, cart_cnt long, buy_cnt long, events long, dim_miss long, max_produce_time_ms long",
    "funnel": f"{COUNTS}, " + ", ".join(f"{c} long" for c in metrics.FUNNEL),
    "top_items": f"{COUNTS}, rank long, item_id long, category_code string, pv long",
    "category_pv": f"{COUNTS}, category_code string, pv long",
}
STATE = {
    "judged": f"{EVENT}, watermark_kick boolean, reason string, arrival long, seq long, window_start_ms long, is_late boolean, is_dup boolean, category_id long, category_code string, dim_miss boolean",
    "seen": f"{KEYS}, at_ms long",
    "progress": "top long, closed_to long, at_ms long",
    "users": "window_start_ms long, user_id long, pv long, cart_cnt long, buy_cnt long, events long, dim_miss long, max_produce_time_ms long, min_pv_ms long, min_cart_ms long, min_buy_ms long",
    "items": "window_start_ms long, item_id long, category_code string, pv long",
}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared one; in a local one only where none is set and the master is local too."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own.setdefault(context.applicationId, f"file://{tempfile.mkdtemp(prefix='rillmark-stream-')}")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Parts:
    """Tables below a folder, each a folder for every batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str, batch_id: int | None = None):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" + ("" if batch_id is None else f"/batch_id={batch_id}"))

    def write(self, name: str, batch_id: int, rows: DataFrame) -> DataFrame:
        """Write a batch's part and return it as read back."""
        schema = (STATE | OUTPUTS)[name]
        columns = [c.split()[0] for c in schema.split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.folder}/{name}/batch_id={batch_id}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/batch_id={batch_id}")

    def write_all(self, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """Write parts that don't depend on each other at once, so that small ones don't wait for each other's jobs."""
        with ThreadPoolExecutor(len(tables)) as pool:
            for part in [pool.submit(self.write, name, batch_id, rows) for name, rows in tables.items()]:
                part.result()

    def read(self, name: str, below: int | None = None) -> DataFrame:
        """All parts, or those of the batches below one; empty where there are none."""
        path = self._path(name)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"{(STATE | OUTPUTS)[name]}, batch_id long")
        rows = self.spark.read.schema(f"{(STATE | OUTPUTS)[name]}, batch_id long").parquet(f"{self.folder}/{name}")
        return rows if below is None else rows.where(F.col("batch_id") < below)

    def delete(self, name: str, batch_id: int) -> None:
        path = self._path(name, batch_id)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def process(batch: DataFrame, batch_id: int, dim: DataFrame, config: Config, folder: str, now_ms: Callable[[], int]) -> None:
    """One micro-batch of ``(value, arrival, seq)`` through the job."""
    parts, now = Parts(batch.sparkSession, folder), now_ms()
    past = parts.read("progress", batch_id).agg(F.max("top").alias("top"), F.max("closed_to").alias("closed_to")).first()
    #: Read and parsed once; the watermark and the repeats look at the rows several times.
    rows = ev.with_reason(ev.scope_run(parse_json_events(batch, keep=("arrival", "seq")), config.run_id), config).persist()
    met = ev.with_watermark(rows, config)
    if past["top"] is not None:
        met = met.withColumn("wm_before", F.greatest("wm_before", F.lit(past["top"] - config.watermark_ms - 1)))
    alive = parts.read("seen", batch_id).where(F.col("at_ms") > now - config.dedup_ttl_ms).select(*NATURAL_KEY).distinct().withColumn("_known", F.lit(True))
    marked = ev.with_duplicates(ev.with_late(met, config)).join(alive, list(NATURAL_KEY), "left")
    data = F.col("reason").isNull() & ~F.col("watermark_kick")
    marked = marked.withColumn("is_dup", F.col("is_dup") | (data & F.coalesce("_known", F.lit(False)))).withColumn("is_late", F.col("is_late") & data)
    try:
        judged = parts.write("judged", batch_id, ev.enrich(marked, dim))
    finally:
        rows.unpersist()

    events = ev.drop_kicks(judged.where("reason is null"))
    main = events if config.forward_duplicates else events.where("not is_dup")
    tables = {"seen": events.where("not is_dup").withColumn("at_ms", F.lit(now)), "events": main, "invalid": judged.where("reason is not null"), "duplicates": events.where("is_dup")}
    if config.mode == "full":
        on_time = main.where("not is_late")
        views = on_time.where("behavior = 'pv'").groupBy("window_start_ms", "item_id", "category_code").agg(F.count("*").alias("pv"))
        tables |= {"late": main.where("is_late"), "users": metrics.user_partials(on_time), "items": views}
    parts.write_all(batch_id, tables)
    top = judged.where(ev.advances(config)).agg(F.max("event_time_ms")).first()[0]
    top = max((t for t in (top, past["top"]) if t is not None), default=None)
    closed = past["closed_to"] or 0
    if config.mode == "full" and top is not None:
        closed = _close(parts, batch_id, closed, top - config.watermark_ms - 1, config)
    parts.write("progress", batch_id, batch.sparkSession.createDataFrame([(top, closed, now)], STATE["progress"]))
    parts.delete("judged", batch_id)
    for r in parts.read("progress", batch_id).where(F.col("at_ms") <= now - config.dedup_ttl_ms).select("batch_id").collect():
        parts.delete("seen", r["batch_id"])


def _close(parts: Parts, batch_id: int, closed: int, watermark: int, config: Config) -> int:
    """Count and write the windows that a watermark passes; the time up to which windows are closed."""
    until = (watermark + 1) // config.window_ms * config.window_ms
    if until <= closed:
        return closed
    due = lambda name: parts.read(name, batch_id + 1).where(F.col("window_start_ms").between(closed, until - 1))
    windows = metrics.of_windows(metrics.merge_partials(due("users")), config)
    items = due("items").groupBy("window_start_ms", "item_id", "category_code").agg(F.sum("pv").alias("pv"))
    categories = metrics.with_end(items.groupBy("window_start_ms", "category_code").agg(F.sum("pv").alias("pv")), config, "category_code", "pv")
    parts.write_all(batch_id, {"pv_uv": windows, "funnel": windows, "top_items": metrics.rank_items(items, config), "category_pv": categories})
    return until


def wall_clock() -> int:
    return int(time.time() * 1000)


def start_job(stream: DataFrame, dim: DataFrame, config: Config, folder: str, all_there_is: bool = False, now_ms: Callable[[], int] = wall_clock) -> StreamingQuery:
    """Run the job over a stream of ``(value, arrival, seq)``; the same folder goes on where it stopped."""
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(lambda batch, i: process(batch, i, dim, config, folder, now_ms))
    return (writer.trigger(availableNow=True) if all_there_is else writer.trigger(processingTime=f"{config.checkpoint_ms} milliseconds")).start()


def run_job(stream: DataFrame, dim: DataFrame, config: Config, folder: str, now_ms: Callable[[], int] = wall_clock) -> dict[str, DataFrame]:
    """Process all there is and return the outputs by name, with the batch that wrote each row."""
    start_job(stream, dim, config, folder, True, now_ms).awaitTermination()
    names = [n for n in OUTPUTS if config.mode == "full" or n in ("events", "invalid", "duplicates")]
    return {n: Parts(stream.sparkSession, folder).read(n) for n in names}


def keep_running(start: Callable[[], StreamingQuery], restarts: int = 30, delay_s: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Start a query again each time that it fails, so many times at most; how often it was. It goes on from its checkpoint."""
    for failed in range(restarts + 1):
        try:
            start().awaitTermination()
            return failed
        except StreamingQueryException:
            if failed == restarts:
                raise
            sleep(delay_s)
    return restarts


def closed_windows(rows: DataFrame, config: Config) -> DataFrame:
    """Append-mode counts by native event-time windows: late rows are dropped and a window is emitted once, when the watermark passes it."""
    timed = rows.withColumn("event_time", F.timestamp_millis("event_time_ms")).withWatermark("event_time", f"{config.watermark_ms} milliseconds")
    counts = timed.groupBy(F.window("event_time", f"{config.window_ms} milliseconds"), "user_id").agg(F.count_if(F.col("behavior") == "pv").alias("pv"), F.count("*").alias("events"))
    total = counts.groupBy("window").agg(F.sum("pv").alias("pv"), F.count_if(F.col("pv") > 0).alias("uv"), F.sum("events").alias("events"))
    return total.select(F.unix_millis("window.start").alias("window_start_ms"), "pv", "uv", "events")


def first_events(rows: DataFrame, config: Config) -> DataFrame:
    """First events by natural key within the watermark: the native form, whose state expires with event time."""
    timed = rows.withColumn("event_time", F.timestamp_millis("event_time_ms")).withWatermark("event_time", f"{config.dedup_ttl_ms} milliseconds")
    return timed.dropDuplicatesWithinWatermark(list(NATURAL_KEY)).drop("event_time")
