"""Registered clickstream queries, each with SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clickstream import NATURAL_KEY, category_or_unknown, map_behavior, parse_event_time, utc_text, window_start
from ..operators import events as ev
from ..operators import metrics, observe, reconcile, replay, storage
from ..sources import readers, tables
from ..streaming import jobs
from . import sql

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = tables.PROFILE
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(text: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if text:
            _sql[f.__name__] = sql.WITH + text
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def offline(spark: SparkSession, d: str) -> DataFrame:
    """The batch side: known behaviors with category and window."""
    rows = ev.enrich(ev.known_behaviors(tables.events(spark, d)), tables.items(spark, d))
    return rows.withColumn("window_start_ms", window_start(F.col("event_time_ms"), CONFIG.window_ms))


def valid_file(spark: SparkSession, d: str) -> DataFrame:
    """The file's valid events with category and window."""
    rows = ev.with_reason(tables.events(spark, d), CONFIG).where("reason is null")
    return ev.enrich(rows, tables.items(spark, d)).withColumn("window_start_ms", window_start(F.col("event_time_ms"), CONFIG.window_ms))


def arrived(spark: SparkSession, d: str) -> DataFrame:
    return ev.arrivals(tables.events(spark, d))


def classified(spark: SparkSession, d: str) -> DataFrame:
    return ev.classify(arrived(spark, d), CONFIG)


def part(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One of the job's streams; those that the metrics and the store read carry a category."""
    found = ev.outputs(arrived(spark, d), CONFIG)[name]
    return ev.enrich(found, tables.items(spark, d)) if name in ("events", "on_time") else found


# Batch metrics


@query(sql.PV_UV.format(rows="offline"))
def pv_uv(spark, d):
    return metrics.pv_uv_single(offline(spark, d), CONFIG)


@query(sql.PV_UV.format(rows="offline"))
def pv_uv_two_stage(spark, d):
    return metrics.pv_uv(offline(spark, d), CONFIG)


@query(sql.PARTIALS)
def user_partials(spark, d):
    return metrics.user_partials(offline(spark, d))


@query(sql.FUNNEL.format(rows="offline"))
def funnel(spark, d):
    return metrics.funnel(offline(spark, d), CONFIG)


@query(sql.TOP.format(rows="offline"))
def top_items(spark, d):
    return metrics.top_items(offline(spark, d), CONFIG)


@query(sql.CATEGORY.format(rows="offline"))
def category_pv(spark, d):
    return metrics.category_pv(offline(spark, d), CONFIG)


@query("SELECT (count(*) - count(DISTINCT (user_id, item_id, behavior, event_time_ms)))::BIGINT AS duplicate_events FROM arr")
def duplicate_count(spark, d):
    return metrics.duplicate_count(arrived(spark, d))


# Projections


@query("SELECT event_id, run_id, user_id, item_id, behavior, event_time_ms, produce_time_ms FROM ev")
def canonical_events(spark, d):
    return tables.events(spark, d)


RAW = [" View", "pv", "CLICK", "cart", "add_to_cart", "purchase", "buy", "order", "fav", "favorite", "remove_from_cart", "remove", "Hover", ""]


@query("SELECT raw, CASE lower(trim(raw)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sql.RAW_BEHAVIORS.items()) + " ELSE lower(trim(raw)) END AS behavior FROM (VALUES " + ", ".join(f"('{r}')" for r in RAW) + ") t(raw)")
def behavior_map(spark, d):
    return spark.createDataFrame([(r,) for r in RAW], "raw string").select("raw", map_behavior(F.col("raw")).alias("behavior"))


#: Raw times and the milliseconds they mean.
TIMES = {"2019-11-01T00:00:00.000Z": 1572566400000, "2019-11-01 00:00:00": 1572566400000, "2019-11-01": 1572566400000, "2019-11-01T02:00:00+02:00": 1572566400000, "1511539200": 1511539200000, "1572566400000": 1572566400000, "": "NULL", "soon": "NULL"}


@query("SELECT raw, event_time_ms::BIGINT AS event_time_ms FROM (VALUES " + ", ".join(f"('{t}', {ms})" for t, ms in TIMES.items()) + ") t(raw, event_time_ms)")
def event_time_parse(spark, d):
    return spark.createDataFrame([(t,) for t in TIMES], "raw string").select("raw", parse_event_time(F.col("raw")).alias("event_time_ms"))


@query("SELECT event_id, item_id, category_id, category_code, dim_miss FROM enriched")
def dim_enrich(spark, d):
    return ev.enrich(tables.events(spark, d), tables.items(spark, d)).select("event_id", "item_id", "category_id", "category_code", "dim_miss")


MOMENTS = [1572566400000, 1572566999999, 1572567000000, 0, -1, -600000, -600001]


@query("SELECT ms, ms - ((ms % 600000) + 600000) % 600000 AS window_start_ms FROM (VALUES " + ", ".join(f"({m}::BIGINT)" for m in MOMENTS) + ") t(ms)")
def window_alignment(spark, d):
    return spark.createDataFrame([(m,) for m in MOMENTS], "ms long").select("ms", window_start(F.col("ms"), 600_000).alias("window_start_ms"))


@query("SELECT event_id, event_time_ms, strftime(make_timestamp(event_time_ms * 1000), '%Y-%m-%d %H:%M:%S') AS window_text FROM ev")
def utc_texts(spark, d):
    return tables.events(spark, d).select("event_id", "event_time_ms", utc_text(F.col("event_time_ms"), False).alias("window_text"))


# Quality


@query("SELECT event_id, run_id, reason, user_id, item_id, behavior, event_time_ms FROM cls WHERE reason IS NOT NULL")
def invalid_events(spark, d):
    return part(spark, d, "invalid").select("event_id", "run_id", "reason", "user_id", "item_id", "behavior", "event_time_ms")


@query("SELECT reason, count(*) AS n FROM cls WHERE reason IS NOT NULL GROUP BY reason")
def invalid_by_reason(spark, d):
    return part(spark, d, "invalid").groupBy("reason").agg(F.count("*").alias("n"))


def payloads(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON, some of them broken by a rule on the id."""
    number = F.col("event_id").cast("long")
    good = F.to_json(F.struct("event_id", "run_id", "user_id", "item_id", "behavior", "event_time_ms", "produce_time_ms"))
    text = F.when(number % 101 == 0, "").when(number % 103 == 0, F.concat(F.lit("{not-json"), "event_id")).when(number % 107 == 0, F.lit("null")).otherwise(good)
    return tables.events(spark, d).select(text.alias("value"))


@query("""SELECT CASE WHEN parse_reason IS NULL THEN event_id END AS event_id, parse_reason, CASE WHEN parse_reason IS NULL THEN user_id ELSE 0 END AS user_id,
  CASE WHEN parse_reason IS NULL THEN behavior ELSE '' END AS behavior, CASE WHEN parse_reason IS NULL THEN event_time_ms ELSE 0 END AS event_time_ms
  FROM (SELECT *, CASE WHEN eid % 101 = 0 THEN 'empty' WHEN eid % 103 = 0 OR eid % 107 = 0 THEN 'unparseable' END AS parse_reason FROM ev)""")
def json_events_parse(spark, d):
    rows = readers.parse_json_events(payloads(spark, d))
    return rows.select(F.when(F.col("parse_reason").isNull(), F.col("event_id")).alias("event_id"), "parse_reason", "user_id", "behavior", "event_time_ms")


@query("""SELECT 'bad-' || md5(parse_reason || '|' || payload)[1:8] AS event_id, parse_reason FROM (SELECT CASE WHEN eid % 101 = 0 THEN 'empty' WHEN eid % 103 = 0 OR eid % 107 = 0 THEN 'unparseable' END AS parse_reason,
  CASE WHEN eid % 101 = 0 THEN '' WHEN eid % 103 = 0 THEN '{not-json' || event_id ELSE 'null' END AS payload FROM ev) WHERE parse_reason IS NOT NULL""")
def bad_payload_ids(spark, d):
    return readers.parse_json_events(payloads(spark, d)).where("parse_reason is not null").select("event_id", "parse_reason")


#: A value of user_id in a payload, and the user it gives; none where it makes the payload unparseable.
USERS = {"7": 7, '"12"': 12, '""': 0, '" 5 "': 5, "null": 0, "1.9": 1, "-3": -3, '"abc"': None, "true": None, "[1]": None}


@query("SELECT raw, user_id::BIGINT AS user_id, parse_reason FROM (VALUES " + ", ".join(f"('{r}', {0 if u is None else u}, " + ("'unparseable'" if u is None else "NULL::VARCHAR") + ")" for r, u in USERS.items()) + ") t(raw, user_id, parse_reason)")
def json_types(spark, d):
    rows = spark.createDataFrame([(r, f'{{"event_id":"e","run_id":"r","user_id":{r}}}') for r in USERS], "raw string, value string")
    return readers.parse_json_events(rows, keep=("raw",)).select("raw", "user_id", "parse_reason")


@query("SELECT event_id, run_id FROM (SELECT event_id, CASE WHEN eid % 3 = 0 THEN 'other' ELSE 'run1' END AS run_id FROM ev) WHERE run_id = 'run1'")
def scope_run(spark, d):
    run = F.when(F.col("event_id").cast("long") % 3 == 0, "other").otherwise("run1")
    rows = tables.events(spark, d).withColumn("run_id", run).withColumn("parse_reason", F.lit(None).cast("string")).withColumn("watermark_kick", F.lit(False))
    return ev.scope_run(rows, "run1").select("event_id", "run_id")


@query("SELECT 'events' AS output, count(*) AS n FROM cls WHERE reason IS NULL UNION ALL SELECT 'invalid', count(*) FROM cls WHERE reason IS NOT NULL UNION ALL SELECT 'duplicates', count(*) FROM cls WHERE is_dup")
def quality_mode(spark, d):
    from dataclasses import replace

    found = ev.outputs(arrived(spark, d), replace(CONFIG, mode="quality"))
    parts = [f.agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n") for name, f in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Duplicates, arrival, event time


@query("SELECT event_id, user_id, item_id, behavior, event_time_ms FROM cls WHERE reason IS NULL AND NOT is_dup")
def dedup_first(spark, d):
    from dataclasses import replace

    return ev.outputs(arrived(spark, d), replace(CONFIG, forward_duplicates=False))["events"].select("event_id", *NATURAL_KEY)


@query("SELECT event_id, run_id, 'duplicate' AS reason, user_id, item_id, behavior, event_time_ms FROM cls WHERE is_dup")
def duplicate_events(spark, d):
    return part(spark, d, "duplicates").select("event_id", "run_id", F.lit("duplicate").alias("reason"), *NATURAL_KEY)


DRAW = "('0x' || md5('{}-' || eid)[1:7])::BIGINT / 268435456.0"


@query(f"""SELECT event_id, held, CASE WHEN held THEN s.event_time_ms ELSE h.event_time_ms END AS after_time, CASE WHEN held THEN s.eid ELSE h.eid END AS after_number
  FROM (SELECT *, {DRAW.format('hold')} < 0.25 AS held, event_time_ms + 10800000 AS due FROM ev) h
  ASOF LEFT JOIN (SELECT event_time_ms, min(eid) AS eid FROM ev WHERE {DRAW.format('hold')} >= 0.25 GROUP BY event_time_ms) s ON s.event_time_ms >= h.due""")
def disordered_replay(spark, d):
    rows = tables.events(spark, d).withColumn("number", F.col("event_id").cast("long"))
    return replay.disordered(rows, 0.25, 10_800_000).select("event_id", "held", "after_time", "after_number")


def planned(spark: SparkSession, d: str) -> DataFrame:
    return replay.plan_sends(tables.events(spark, d).withColumn("number", F.col("event_id").cast("long")), 432.0)


PLAN = f"""rolled AS (SELECT *, (SELECT min(event_time_ms) FROM ev) AS origin, {DRAW.format('roll')} AS roll FROM ev),
  sent AS (SELECT *, CASE WHEN roll < 0.005 THEN 'late' WHEN roll < 0.055 THEN 'jitter' ELSE 'data' END AS kind,
    (event_time_ms - origin + CASE WHEN roll < 0.005 THEN 180000 + {DRAW.format('late')} * 420000 WHEN roll < 0.055 THEN {DRAW.format('jitter')} * 30000.0 ELSE 0.0::DOUBLE END) / 432.0::DOUBLE / 1000 AS release_s FROM rolled),
  plan AS (SELECT release_s, 2 * eid AS seq, kind, event_id, NULL::VARCHAR AS malform FROM sent UNION ALL SELECT release_s, 2 * eid + 1, 'duplicate', event_id || 'd', NULL FROM sent WHERE {DRAW.format('again')} < 0.002
    UNION ALL SELECT ((SELECT max(event_time_ms) FROM ev) - (SELECT min(event_time_ms) FROM ev)) / 432.0::DOUBLE / 1000 * (i + 0.5::DOUBLE) / 50, (SELECT max(eid) FROM ev) * 2 + 2 + i, 'malformed', NULL, (['bad_json', 'bad_user', 'bad_behavior', 'bad_time', 'empty'])[i % 5 + 1] FROM range(50) r(i))"""


@query(f", {PLAN} SELECT seq, kind, event_id, malform, release_s FROM plan")
def planned_sends(spark, d):
    return planned(spark, d).select("seq", "kind", "event_id", "malform", "release_s")


@query(f", {PLAN} SELECT kind, malform, count(*) AS n FROM plan GROUP BY kind, malform")
def planned_kinds(spark, d):
    return replay.injected(planned(spark, d))


@query("SELECT reason, 10::BIGINT AS n FROM (VALUES ('unparseable'), ('bad_user'), ('bad_behavior'), ('bad_time'), ('empty')) t(reason)")
def malformed_reasons(spark, d):
    payload = replay.malformed_payload(F.col("malform"), CONFIG.run_id, F.col("seq"), F.lit(CONFIG.valid_from + 1))
    rows = ev.scope_run(readers.parse_json_events(planned(spark, d).where("kind = 'malformed'").select(payload.alias("value"))), CONFIG.run_id)
    return ev.with_reason(rows, CONFIG).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT event_id, event_time_ms, arrival, seq, kind FROM arr")
def arrival_plan(spark, d):
    return arrived(spark, d).select("event_id", "event_time_ms", "arrival", "seq", "kind")


@query("SELECT event_id, kind, seq, (arrival - (SELECT min(event_time_ms) FROM ev)) / 1000.0::DOUBLE / 432 AS release_s FROM arr")
def paced_plan(spark, d):
    origin = tables.events(spark, d).agg(F.min("event_time_ms").alias("origin"))
    return arrived(spark, d).crossJoin(origin).select("event_id", "kind", "seq", ((F.col("arrival") - F.col("origin")) / F.lit(1000.0) / 432).alias("release_s"))


@query("SELECT count(*) AS events, count(*) FILTER (event_time_ms < top) AS inversions, greatest(coalesce(max(top - event_time_ms), 0), 0)::BIGINT AS max_lateness_ms FROM (SELECT event_time_ms, max(event_time_ms) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM arr)")
def disorder_stats(spark, d):
    return observe.disorder(arrived(spark, d))


@query("SELECT kind, count(*) AS n FROM arr GROUP BY kind")
def injection_summary(spark, d):
    return arrived(spark, d).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT event_id, wm_before FROM cls")
def watermark_trace(spark, d):
    return ev.with_watermark(ev.with_reason(arrived(spark, d), CONFIG), CONFIG).select("event_id", "wm_before")


@query(f"SELECT event_id, max(CASE WHEN {sql.IN_RANGE} THEN event_time_ms END) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200001 AS wm_before FROM arr")
def watermark_source_scope(spark, d):
    from dataclasses import replace

    config = replace(CONFIG, watermark_scope="source")
    return ev.with_watermark(ev.with_reason(arrived(spark, d), config), config).select("event_id", "wm_before")


@query(f"SELECT event_id, max(CASE WHEN {sql.IN_RANGE} THEN event_time_ms END) OVER (ORDER BY arrival // 3600000 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200001 AS wm_before FROM arr")
def watermark_periodic(spark, d):
    return ev.with_periodic_watermark(arrived(spark, d), CONFIG, 3_600_000).select("event_id", "wm_before")


@query("SELECT event_id, CASE WHEN m0 IS NOT NULL AND m1 IS NOT NULL AND m2 IS NOT NULL THEN least(m0, m1, m2) - 7200001 END AS wm_before FROM (SELECT event_id, " + ", ".join(f"max(CASE WHEN {sql.IN_RANGE} AND user_id % 3 = {p} THEN event_time_ms END) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m{p}" for p in range(3)) + " FROM arr)")
def watermark_per_partition(spark, d):
    return ev.with_partition_watermark(arrived(spark, d), CONFIG, 3, 0).select("event_id", "wm_before")


IDLE_MS = 1_800_000
PRIOR = "OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("SELECT event_id, CASE WHEN " + " OR ".join(f"w{p} AND m{p} IS NULL" for p in range(3)) + " THEN NULL WHEN NOT (w0 OR w1 OR w2) THEN greatest(m0, m1, m2) ELSE least(" + ", ".join(f"CASE WHEN w{p} THEN m{p} END" for p in range(3)) + ") END - 7200001 AS wm_before FROM (SELECT *, "
  + ", ".join(f"coalesce(arrival - coalesce(a{p}, begun) <= {IDLE_MS}, true) AS w{p}" for p in range(3)) + " FROM (SELECT event_id, arrival, min(arrival) " + PRIOR + " AS begun, "
  + ", ".join(f"max(CASE WHEN {sql.IN_RANGE} AND user_id % 3 = {p} THEN event_time_ms END) {PRIOR} AS m{p}, max(CASE WHEN user_id % 3 = {p} THEN arrival END) {PRIOR} AS a{p}" for p in range(3)) + " FROM arr))")
def watermark_idle(spark, d):
    return ev.with_partition_watermark(arrived(spark, d), CONFIG, 3, IDLE_MS).select("event_id", "wm_before")


@query("SELECT event_id, run_id, user_id, item_id, behavior, event_time_ms, window_start_ms, 'window_closed' AS reason FROM cls WHERE is_late")
def late_events(spark, d):
    return part(spark, d, "late").select("event_id", "run_id", *NATURAL_KEY, "window_start_ms", F.lit("window_closed").alias("reason"))


@query("SELECT count(*) AS late_events, count(*) FILTER (behavior = 'pv') AS late_pv FROM cls WHERE is_late")
def late_summary(spark, d):
    return part(spark, d, "late").agg(F.count("*").alias("late_events"), F.count_if(F.col("behavior") == "pv").alias("late_pv"))


@query(f"SELECT 'kick-run1-' || p AS event_id, 0::BIGINT AS user_id, 0::BIGINT AS item_id, 'kick' AS behavior, (SELECT max(event_time_ms) FROM ev) + {CONFIG.window_ms + CONFIG.watermark_ms + 60_000} AS event_time_ms, true AS watermark_kick FROM range(3) t(p)")
def kick_rows(spark, d):
    return kick_frame(spark, d).select("event_id", "user_id", "item_id", "behavior", "event_time_ms", "watermark_kick")


def kick_frame(spark: SparkSession, d: str) -> DataFrame:
    """The kicks after a file's last event; none after an empty file."""
    last = tables.events(spark, d).agg(F.max("event_time_ms")).first()[0]
    rows = [] if last is None else [tuple(k.values()) for k in ev.kicks(last, CONFIG, 3)]
    return spark.createDataFrame(rows, "event_id string, run_id string, user_id long, item_id long, behavior string, event_time_ms long, produce_time_ms long, watermark_kick boolean")


@query(f"SELECT 0::BIGINT AS invalid_kicks, 0::BIGINT AS event_kicks, (SELECT max(event_time_ms) FROM ev) + {CONFIG.window_ms + 60_000 - 1} AS last_watermark")
def kick_passage(spark, d):
    """Kicks among the arrivals: they are not judged, reach no output and move the watermark."""
    kicks = kick_frame(spark, d).withColumn("seq", F.lit(1 << 60)).withColumn("arrival", F.col("event_time_ms")).withColumn("kind", F.lit("kick"))
    rows = arrived(spark, d).withColumn("watermark_kick", F.lit(False)).unionByName(kicks)
    found = ev.outputs(rows, CONFIG)
    counts = [found[n].agg(F.count_if(F.col("behavior") == "kick").alias(c)) for n, c in (("invalid", "invalid_kicks"), ("events", "event_kicks"))]
    top = ev.with_reason(rows, CONFIG).where(ev.advances(CONFIG)).agg((F.max("event_time_ms") - CONFIG.watermark_ms - 1).alias("last_watermark"))
    return counts[0].crossJoin(counts[1]).crossJoin(top)  # a row each


@query("SELECT event_id, event_time_ms FROM ev ORDER BY event_time_ms, eid LIMIT 500")
def row_cap(spark, d):
    return ev.first_rows(tables.events(spark, d), 500, F.col("event_time_ms"), F.col("event_id").cast("long")).select("event_id", "event_time_ms")


@query("SELECT event_id FROM ev WHERE eid % 4 = 1")
def shard_events(spark, d):
    return ev.shard(tables.events(spark, d), 1, 4, F.col("event_id").cast("long")).select("event_id")


# Realtime results


def on_time(spark: SparkSession, d: str) -> DataFrame:
    return part(spark, d, "on_time")


@query(sql.PV_UV.format(rows="ontime"))
def rt_pv_uv(spark, d):
    return metrics.pv_uv(on_time(spark, d), CONFIG)


@query(sql.FUNNEL.format(rows="ontime"))
def rt_funnel(spark, d):
    return metrics.funnel(on_time(spark, d), CONFIG)


@query(sql.TOP.format(rows="ontime"))
def rt_top_items(spark, d):
    return metrics.top_items(on_time(spark, d), CONFIG)


@query(sql.CATEGORY.format(rows="ontime"))
def rt_category_pv(spark, d):
    return metrics.category_pv(on_time(spark, d), CONFIG)


ODS = ("run_id", "event_id", "user_id", "item_id", "behavior", "category_id", "category_code", "event_time_ms", "produce_time_ms")


def detail(spark: SparkSession, d: str) -> DataFrame:
    """Stored events; ``inserted_at_ms`` stands for the store's clock."""
    number = F.regexp_replace("event_id", "d$", "").cast("long")
    return part(spark, d, "events").select(*ODS, F.col("dim_miss").cast("int").alias("dim_miss"), (F.col("produce_time_ms") + 20 + F.pmod(number * 7, F.lit(400))).alias("inserted_at_ms"))


def physical(spark: SparkSession, d: str) -> DataFrame:
    """Stored rows with the repeats of a sink that wrote some batches twice."""
    rows = detail(spark, d).withColumn("version", F.lit(1).cast("long"))
    again = rows.where("crc32(event_id) % 10 = 0").withColumn("inserted_at_ms", F.col("inserted_at_ms") + 5000)
    return rows.unionByName(again)


@query("SELECT " + ", ".join(ODS) + ", dim_miss::INT AS dim_miss FROM cls WHERE reason IS NULL")
def ods_events(spark, d):
    return detail(spark, d).drop("inserted_at_ms")


@query("SELECT run_id, event_id, behavior, event_time_ms FROM cls WHERE reason IS NULL")
def ods_final(spark, d):
    return storage.final_view(physical(spark, d), ["run_id", "event_id"]).select("run_id", "event_id", "behavior", "event_time_ms")


def with_stale(rows: DataFrame, column: str) -> DataFrame:
    """A results table with older versions of a third of its rows."""
    new = rows.withColumn("version", F.lit(2).cast("long"))
    old = rows.where(F.pmod(F.col("window_start_ms") / CONFIG.window_ms, F.lit(3)) == 0).withColumn(column, F.col(column) + 1).withColumn("version", F.lit(1).cast("long"))
    return new.unionByName(old).withColumn("run_id", F.lit(CONFIG.run_id))


@query("SELECT (count(*) + count(*) FILTER ((window_start_ms // 21600000) % 3 = 0))::BIGINT AS physical_rows, count(*)::BIGINT AS final_rows FROM (SELECT DISTINCT window_start_ms FROM ontime)")
def physical_vs_final(spark, d):
    stored = with_stale(rt_pv_uv(spark, d), "pv")
    final = storage.final_view(stored, ["run_id", "window_start_ms"])
    return stored.agg(F.count("*").alias("physical_rows")).crossJoin(final.agg(F.count("*").alias("final_rows")))


@query("SELECT event_id FROM ev WHERE eid % 3 <> 0")
def run_delete(spark, d):
    run = F.when(F.col("event_id").cast("long") % 3 == 0, "old").otherwise("run1")
    return storage.delete_run(tables.events(spark, d).withColumn("run_id", run), "old").select("event_id")


# Accounting


@query("""SELECT *, ads_pv + late_pv - duplicate_pv - batch_pv + file_duplicate_pv AS gap, ads_pv + late_pv - duplicate_pv - batch_pv + file_duplicate_pv = 0 AS exact FROM (SELECT
  (SELECT count(*) FROM ontime WHERE behavior = 'pv') AS ads_pv, (SELECT count(*) FROM cls WHERE is_late AND behavior = 'pv') AS late_pv, (SELECT count(*) FROM cls WHERE is_dup AND behavior = 'pv') AS duplicate_pv,
  (SELECT count(*) FROM vfile WHERE behavior = 'pv') AS batch_pv, (SELECT count(*) - count(DISTINCT (user_id, item_id, event_time_ms)) FROM vfile WHERE behavior = 'pv') AS file_duplicate_pv)""")
def pv_identity(spark, d):
    """The outcomes are stored first and counted from the store, as a job's tables would be."""
    folder = jobs.work_folder(spark, "identity")
    classified(spark, d).where("reason is null").select("behavior", "is_late", "is_dup").write.parquet(f"{folder}/outcomes")
    return reconcile.pv_identity(spark.read.parquet(f"{folder}/outcomes"), ev.with_reason(tables.events(spark, d), CONFIG).where("reason is null"))


def both_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All counts of the realtime and the batch windows, from one pass over users' partials a side."""
    return tuple(metrics.of_windows(metrics.user_partials(rows), CONFIG) for rows in (on_time(spark, d), valid_file(spark, d)))


def stored_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.reconcile_rows([(*both_sides(spark, d), (*reconcile.SUMMED, *reconcile.STEPS))], CONFIG.run_id)


@query(f"SELECT 'run1' AS run_id, metric, window_start_ms, rt::DOUBLE AS rt_value, batch::DOUBLE AS batch_value, abs(rt - batch)::DOUBLE AS abs_diff FROM ({sql.SIDES}) WHERE rt IS NOT NULL AND batch IS NOT NULL AND metric NOT IN ('dim_miss', 'cart_users', 'buy_users')")
def reconcile_rows(spark, d):
    return stored_reconcile(spark, d)


@query(f"SELECT 'run1' AS run_id, metric, window_start_ms, abs(rt - batch)::DOUBLE AS abs_diff, 2::BIGINT AS version FROM ({sql.SIDES}) WHERE rt IS NOT NULL AND batch IS NOT NULL AND metric NOT IN ('dim_miss', 'cart_users', 'buy_users')")
def reconcile_stored(spark, d):
    """Stored twice, the first time with other values; the newest version counts."""
    folder, rows = jobs.work_folder(spark, "reconcile"), stored_reconcile(spark, d)
    storage.write_batch(rows, folder, 2)
    storage.write_batch(spark.read.parquet(f"{folder}/batch_id=2").select(*rows.columns).withColumn("abs_diff", F.lit(-1.0)), folder, 1)
    final = storage.final_view(storage.read_table(folder, spark).drop("batch_id"), ["run_id", "metric", "window_start_ms"], tie="inserted_at")
    return final.select("run_id", "metric", "window_start_ms", "abs_diff", "version")


@query(f"""SELECT metric, count(*) FILTER (rt IS NOT NULL AND batch IS NOT NULL) AS windows_compared, count(*) FILTER (rt IS NULL OR batch IS NULL) AS missing_one_side, count(*) FILTER (rt <> batch) AS with_diff,
  coalesce(sum(abs(rt - batch)), 0)::BIGINT AS sum_abs_diff, coalesce(max(abs(rt - batch)), 0)::BIGINT AS max_abs_diff, coalesce(sum(rt) FILTER (batch IS NOT NULL), 0)::BIGINT AS rt_sum, coalesce(sum(batch) FILTER (rt IS NOT NULL), 0)::BIGINT AS batch_sum
  FROM ({sql.SIDES}) GROUP BY metric""")
def reconcile_diff(spark, d):
    return reconcile.compare(*both_sides(spark, d), (*reconcile.COMPARED["pv_uv"], *reconcile.COMPARED["funnel"]))


@query(f"""SELECT count(r.item_id) AS rt_pairs, count(b.item_id) AS batch_pairs, count(*) FILTER ((r.item_id IS NULL) <> (b.item_id IS NULL)) AS missing, count(*) FILTER (r.item_id <> b.item_id OR r.pv <> b.pv) AS mismatch
  FROM ({sql.TOP.format(rows="ontime")}) r FULL JOIN ({sql.TOP.format(rows="vfile")}) b ON r.window_start_ms = b.window_start_ms AND r.rank = b.rank""")
def reconcile_topn(spark, d):
    return reconcile.compare_top(metrics.top_items(on_time(spark, d), CONFIG), metrics.top_items(valid_file(spark, d), CONFIG))


RECONCILE_SUMMARY = f"SELECT metric, count(*) AS windows, round(sum(abs(rt - batch)::DOUBLE), 2) AS sum_abs_diff, round(max(abs(rt - batch)::DOUBLE), 2) AS max_abs_diff FROM ({sql.SIDES}) WHERE rt IS NOT NULL AND batch IS NOT NULL AND metric NOT IN ('dim_miss', 'cart_users', 'buy_users') GROUP BY metric"


@query(RECONCILE_SUMMARY)
def reconcile_summary(spark, d):
    return reconcile.summary(stored_reconcile(spark, d))


@query("SELECT (SELECT count(*) FROM cls WHERE is_dup) AS duplicates, (SELECT count(*) FROM arr) AS produced, (SELECT count(*) FROM cls WHERE is_dup) > 0.05 * (SELECT count(*) FROM arr) AS contaminated")
def contamination_check(spark, d):
    counts = part(spark, d, "duplicates").agg(F.count("*").alias("duplicates")).crossJoin(arrived(spark, d).agg(F.count("*").alias("produced")))
    return counts.withColumn("contaminated", reconcile.contaminated(F.col("duplicates"), F.col("produced")))


# Dashboards: SQL over the newest rows of the results


def view(spark: SparkSession, name: str, rows: DataFrame, text: str) -> DataFrame:
    return spark.sql(text, t=rows) if name is None else spark.sql(text, **{name: rows})


def final_pv_uv(spark, d):
    return storage.final_view(with_stale(rt_pv_uv(spark, d), "pv"), ["run_id", "window_start_ms"])


def final_top(spark, d):
    return storage.final_view(with_stale(rt_top_items(spark, d), "pv"), ["run_id", "window_start_ms", "rank"])


def final_category(spark, d):
    return storage.final_view(with_stale(rt_category_pv(spark, d), "pv"), ["run_id", "window_start_ms", "category_code"])


@query("SELECT DISTINCT run_id FROM ev")
def dash_runs(spark, d):
    return view(spark, "t", final_pv_uv(spark, d), "SELECT DISTINCT run_id FROM {t}")


@query(f"SELECT window_start_ms, pv, uv FROM ({sql.PV_UV.format(rows='ontime')})")
def dash_pv_uv(spark, d):
    return view(spark, "t", final_pv_uv(spark, d), "SELECT window_start_ms, pv, uv FROM {t} WHERE run_id = 'run1' ORDER BY window_start_ms")


@query("SELECT count(*) FILTER (behavior = 'pv') AS late_pv FROM cls WHERE is_late")
def dash_late_pv(spark, d):
    return view(spark, "t", late_events(spark, d), "SELECT count_if(behavior = 'pv') AS late_pv FROM {t} WHERE run_id = 'run1'")


@query("SELECT count(*) AS duplicate_events FROM cls WHERE is_dup")
def dash_duplicates(spark, d):
    return view(spark, "t", duplicate_events(spark, d), "SELECT count(*) AS duplicate_events FROM {t} WHERE run_id = 'run1'")


@query("SELECT ord, step, users FROM (SELECT unnest([1, 2, 3]) AS ord, unnest(['views', 'cart not before view', 'buy not before view']) AS step, unnest([pv_users, pv_to_cart_users, pv_to_buy_users]) AS users FROM (SELECT * FROM (" + sql.FUNNEL.format(rows="ontime") + ") f ORDER BY window_start_ms DESC LIMIT 1) l)")
def dash_latest_funnel(spark, d):
    text = """WITH l AS (SELECT * FROM {t} ORDER BY window_start_ms DESC LIMIT 1)
      SELECT 1 AS ord, 'views' AS step, pv_users AS users FROM l UNION ALL SELECT 2, 'cart not before view', pv_to_cart_users FROM l UNION ALL SELECT 3, 'buy not before view', pv_to_buy_users FROM l"""
    return view(spark, "t", rt_funnel(spark, d), text)


@query("SELECT rank, item_id, category_code, pv FROM (" + sql.TOP.format(rows="ontime") + ") t WHERE window_start_ms = (SELECT max(window_start_ms) FROM ontime WHERE behavior = 'pv')")
def dash_latest_top(spark, d):
    return view(spark, "t", final_top(spark, d), "SELECT rank, item_id, category_code, pv FROM {t} WHERE window_start_ms = (SELECT max(window_start_ms) FROM {t}) ORDER BY rank")


@query("SELECT window_start_ms, category_code, pv FROM (" + sql.CATEGORY.format(rows="ontime") + ") c WHERE category_code IN (SELECT category_code FROM ontime WHERE behavior = 'pv' GROUP BY category_code ORDER BY count(*) DESC, category_code LIMIT 6)")
def dash_top_categories(spark, d):
    text = "SELECT window_start_ms, category_code, pv FROM {t} WHERE category_code IN (SELECT category_code FROM {t} GROUP BY category_code ORDER BY sum(pv) DESC, category_code LIMIT 6)"
    return view(spark, "t", final_category(spark, d), text)


APPROXIMATE = "SELECT count(*) AS n, quantile_disc(latency_ms, 0.5) AS p50_ms, quantile_disc(latency_ms, 0.99) AS p99_ms FROM stored"


@query(APPROXIMATE)
def dash_latency(spark, d):
    return latency_approx(spark, d)


@query(RECONCILE_SUMMARY)
def dash_reconcile(spark, d):
    return view(spark, "t", stored_reconcile(spark, d), "SELECT metric, count(*) AS windows, round(sum(abs_diff), 2) AS sum_abs_diff, round(max(abs_diff), 2) AS max_abs_diff FROM {t} GROUP BY metric ORDER BY metric")


# Observation


def delays(spark: SparkSession, d: str) -> DataFrame:
    return detail(spark, d).withColumn("latency_ms", F.col("inserted_at_ms") - F.col("produce_time_ms"))


LATENCY = "SELECT count(*) AS n, min(latency_ms) AS min_ms, quantile_disc(latency_ms, 0.5) AS p50_ms, quantile_disc(latency_ms, 0.99) AS p99_ms, max(latency_ms) AS max_ms FROM "


@query(LATENCY + "stored")
def latency_exact(spark, d):
    return observe.latency(delays(spark, d))


@query(APPROXIMATE)
def latency_approx(spark, d):
    return observe.latency_approximate(delays(spark, d))


@query(LATENCY + "(SELECT window_start_ms + 21600000 + 500 - max(produce_time_ms) AS latency_ms FROM ontime GROUP BY window_start_ms)")
def freshness(spark, d):
    rows = rt_pv_uv(spark, d)
    return observe.latency(rows.withColumn("latency_ms", F.col("window_end_ms") + 500 - F.col("max_produce_time_ms")))


@query("SELECT count(*) AS seconds, quantile_disc(n, 0.5) AS p50, round(avg(n), 2) AS avg, max(n) AS max FROM (SELECT inserted_at_ms // 1000 AS second, count(*) AS n FROM stored GROUP BY 1)")
def ingest_per_second(spark, d):
    return observe.ingest_rate(detail(spark, d))


BUCKETS = "(SELECT inserted_at_ms // 3600000 AS bucket, count(*) AS n FROM stored GROUP BY 1)"


@query("SELECT 'overall' AS part, * FROM (" + LATENCY + "stored) UNION ALL SELECT 'burst', * FROM (" + LATENCY + f"stored WHERE inserted_at_ms // 3600000 IN (SELECT bucket FROM {BUCKETS} WHERE n >= (SELECT quantile_disc(n, 0.9) FROM {BUCKETS}))) UNION ALL SELECT 'quiet', * FROM (" + LATENCY + f"stored WHERE inserted_at_ms // 3600000 IN (SELECT bucket FROM {BUCKETS} WHERE n <= (SELECT quantile_disc(n, 0.5) FROM {BUCKETS})))")
def burst_quiet_latency(spark, d):
    return observe.burst_and_quiet(delays(spark, d), 3_600_000)


@query("SELECT hour(make_timestamp(event_time_ms * 1000))::BIGINT AS hour, count(*) AS n FROM ev GROUP BY 1")
def hourly_events(spark, d):
    return observe.by_hour(tables.events(spark, d), "event_time_ms", F.count("*").alias("n"))


@query(f"SELECT hour(make_timestamp(window_start_ms * 1000))::BIGINT AS hour, sum(pv)::BIGINT AS pv, sum(events)::BIGINT AS events, sum(uv)::BIGINT AS uv_sum FROM ({sql.PV_UV.format(rows='ontime')}) GROUP BY 1")
def hourly_pv(spark, d):
    return observe.by_hour(rt_pv_uv(spark, d), "window_start_ms", F.sum("pv").alias("pv"), F.sum("events").alias("events"), F.sum("uv").alias("uv_sum"))


@query("""SELECT count(*) AS rows, count(DISTINCT user_id) AS unique_users, count(DISTINCT item_id) AS unique_items, count(*) FILTER (behavior = 'pv') AS n_pv, count(*) FILTER (behavior = 'cart') AS n_cart, count(*) FILTER (behavior = 'buy') AS n_buy,
  count(*) FILTER (behavior = 'fav') AS n_fav, count(*) FILTER (behavior = 'remove') AS n_remove, min(event_time_ms) AS min_event_time_ms, max(event_time_ms) AS max_event_time_ms, max(event_time_ms) - min(event_time_ms) AS span_ms FROM ev""")
def dataset_profile(spark, d):
    return observe.profile(tables.events(spark, d))


@query("""SELECT item_id, category_id, category_code FROM (SELECT item_id, category_code, category_id, row_number() OVER (PARTITION BY item_id ORDER BY codes DESC, category_code, n DESC, seen) AS place
  FROM (SELECT *, sum(n) OVER (PARTITION BY item_id, category_code) AS codes FROM (SELECT item_id, 'c' || (user_id % 5) AS category_code, user_id % 7 AS category_id, count(*) AS n, min(eid) AS seen FROM ev GROUP BY 1, 2, 3))) WHERE place = 1""")
def build_dim(spark, d):
    rows = tables.events(spark, d).select("item_id", F.concat(F.lit("c"), F.col("user_id") % 5).alias("category_code"), (F.col("user_id") % 7).alias("category_id"), F.col("event_id").cast("long").alias("row_idx"))
    return ev.build_items(rows)


@query("""SELECT user_id, item_id, item_id % 9 AS category_id, 'cat-' || (item_id % 9) AS category_code, CASE behavior WHEN 'cart' THEN 'signup' ELSE behavior END AS behavior, (event_time_ms // 1000) * 1000 AS event_time_ms FROM ev WHERE eid % 11 <> 0""")
def plain_log_adapter(spark, d):
    raw = spark.read.parquet(f"{d}/events.parquet")
    item = F.get_json_object("props", "$.k")
    seconds = F.floor(tables.wall_ms(F.col("ts")) / 1000)
    line = F.concat_ws(",", "user_id", item, item.cast("long") % 9, "event_type", seconds)
    return readers.plain_log(raw.select(F.when(F.col("event_id") % 11 == 0, F.concat_ws(",", "user_id", item)).otherwise(line).alias("value")))


@query("""SELECT user_id, item_id, CASE WHEN eid % 5 = 0 THEN -1 ELSE item_id % 9 END AS category_id, CASE WHEN eid % 4 = 0 THEN 'UNKNOWN' ELSE 'code' || (item_id % 9) END AS category_code, CASE behavior WHEN 'cart' THEN 'signup' ELSE behavior END AS behavior, event_time_ms FROM ev WHERE eid % 13 <> 0""")
def header_log_adapter(spark, d):
    raw = spark.read.parquet(f"{d}/events.parquet")
    item = F.get_json_object("props", "$.k")
    text = lambda c: c.cast("string")
    rows = raw.select(
        F.concat(F.regexp_replace(utc_text(tables.wall_ms(F.col("ts"))), " ", "T"), F.lit("Z")).alias("event_time"), "event_type", F.when(F.col("event_id") % 13 == 0, "none").otherwise(item).alias("product_id"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(text(item.cast("long") % 9)).alias("category_id"), F.when(F.col("event_id") % 4 == 0, " ").otherwise(F.concat(F.lit("code"), text(item.cast("long") % 9))).alias("category_code"), text(F.col("user_id")).alias("user_id"),
    )
    return readers.header_log(rows)


@query("SELECT code, coalesce(nullif(trim(code), ''), 'UNKNOWN') AS category_code FROM (VALUES ('a'), (' b '), (''), ('  '), (NULL)) t(code)")
def category_default(spark, d):
    return spark.createDataFrame([("a",), (" b ",), ("",), ("  ",), (None,)], "code string").select("code", category_or_unknown(F.col("code")).alias("category_code"))


# The job over a stream of the arrivals as JSON


_streamed: dict[tuple[str, str], dict[str, DataFrame]] = {}


def streamed(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The job's outputs over the arrivals in three batches and the kicks in a fourth, run once for all queries of a session."""
    key = spark.sparkContext.applicationId, d
    if key not in _streamed:
        folder = jobs.work_folder(spark, "stream")
        columns = ("event_id", "run_id", "user_id", "item_id", "behavior", "event_time_ms", "produce_time_ms")
        rows = arrived(spark, d)
        span = rows.agg(F.min("arrival").alias("a"), (F.max("arrival") + 1).alias("b")).first()
        for k in range(3):
            if span["a"] is not None:
                a, b = (span["a"] + (span["b"] - span["a"]) * i // 3 for i in (k, k + 1))
                mine = rows.where(F.col("arrival").between(a, b - 1)).select(F.to_json(F.struct(*columns)).alias("value"), "arrival", "seq")
                mine.coalesce(1).write.parquet(f"{folder}/topic/{k}")  # a file is a batch of the stream
        kicks = kick_frame(spark, d).select(F.to_json(F.struct(*columns, "watermark_kick")).alias("value"), F.col("event_time_ms").alias("arrival"), F.lit(1 << 60).alias("seq"))
        kicks.coalesce(1).write.parquet(f"{folder}/topic/3")
        stream = readers.event_stream(spark, "parquet", path=f"{folder}/topic/*")
        _streamed[key] = jobs.run_job(stream, tables.items(spark, d), CONFIG, f"{folder}/job")
    return _streamed[key]


@query(sql.PV_UV.format(rows="ontime"))
def stream_pv_uv(spark, d):
    return streamed(spark, d)["pv_uv"].drop("batch_id")


@query(sql.FUNNEL.format(rows="ontime"))
def stream_funnel(spark, d):
    return streamed(spark, d)["funnel"].drop("batch_id")


@query(sql.TOP.format(rows="ontime"))
def stream_top_items(spark, d):
    return streamed(spark, d)["top_items"].drop("batch_id")


@query(sql.CATEGORY.format(rows="ontime"))
def stream_category(spark, d):
    return streamed(spark, d)["category_pv"].drop("batch_id")


@query("SELECT event_id, run_id, user_id, item_id, behavior, event_time_ms, window_start_ms FROM cls WHERE is_late")
def stream_late(spark, d):
    return streamed(spark, d)["late"].select("event_id", "run_id", *NATURAL_KEY, "window_start_ms")


@query("SELECT event_id, run_id, user_id, item_id, behavior, event_time_ms FROM cls WHERE is_dup")
def stream_dedup(spark, d):
    return streamed(spark, d)["duplicates"].select("event_id", "run_id", *NATURAL_KEY)


@query("SELECT event_id, reason, user_id, item_id, behavior, event_time_ms FROM cls WHERE reason IS NOT NULL")
def stream_invalid(spark, d):
    return streamed(spark, d)["invalid"].select("event_id", "reason", *NATURAL_KEY)


@query("SELECT " + ", ".join(ODS) + ", dim_miss FROM cls WHERE reason IS NULL")
def stream_events(spark, d):
    return streamed(spark, d)["events"].select(*ODS, "dim_miss")


@query(f"SELECT DISTINCT window_start_ms FROM ontime WHERE window_start_ms >= ((SELECT max(event_time_ms) FROM cls WHERE reason IS NULL) - {CONFIG.watermark_ms}) // {CONFIG.window_ms} * {CONFIG.window_ms}")
def stream_kick(spark, d):
    """Windows that only the kicks close."""
    return streamed(spark, d)["pv_uv"].where("batch_id = 3").select("window_start_ms")
