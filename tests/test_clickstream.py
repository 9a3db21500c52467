"""Operators of the clickstream over small rows, with results worked out by hand."""

import hashlib
import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rillmark.functions.clickstream import Config, invalid_reason, map_behavior, parse_arguments, parse_event_time, utc_hour, utc_text, wall_ms, window_start
from rillmark.operators import events as ev
from rillmark.operators import metrics, observe, reconcile, replay, storage
from rillmark.sources import readers
from rillmark.streaming import jobs

BASE = 1_572_566_400_000


def one(frame):
    return [r.asDict() for r in frame.collect()]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, category_id long, category_code string")


#: A window of a minute and a delay of five seconds: id, user, item, behavior, milliseconds, produced at.
ROWS = [
    ("a", 1, 7, "pv", 5_000, 10),
    ("b", 1, 7, "pv", 5_000, 20),  # repeats a
    ("c", 2, 8, "cart", 30_000, 30),
    ("d", 1, 7, "buy", 40_000, 40),
    ("e", 3, 55, "pv", 59_999, 50),  # an unknown item
    ("f", -1, 7, "pv", 6_000, 55),  # no user
    ("g", 2, 8, "pv", 64_999, 60),  # the watermark stands at 59,998: the first minute is open
    ("h", 2, 8, "pv", 45_000, 70),
    ("i", 4, 7, "pv", 65_000, 80),  # 59,999: it is closed
    ("j", 4, 7, "cart", 50_000, 90),  # late
]
DIM = [(7, 1, "book"), (8, 2, "lamp")]
MINUTE = Config(run_id="test", window_ms=60_000, watermark_ms=5000, top_n=2)
FIRST = {"pv": 4, "uv": 3, "cart_cnt": 1, "buy_cnt": 1, "events": 6, "dim_miss": 1, "max_produce_time_ms": 70}
#: User 2 put into the cart before viewing; user 1 bought after viewing.
STEPS = {"pv_users": 3, "cart_users": 1, "buy_users": 1, "pv_to_cart_users": 0, "cart_to_buy_users": 0, "pv_to_buy_users": 1}


def picked(row, want):
    return {k: row[k] for k in want}


def test_job_over_a_minute(spark):
    rows = [(i, "test", u, k, b, BASE + t, p, n, n) for n, (i, u, k, b, t, p) in enumerate(ROWS)]
    frame = spark.createDataFrame(rows, "event_id string, run_id string, user_id long, item_id long, behavior string, event_time_ms long, produce_time_ms long, arrival long, seq long")
    found = ev.outputs(frame, MINUTE)
    ids = {n: sorted(r["event_id"] for r in f.collect()) for n, f in found.items()}
    assert (ids["late"], ids["invalid"], ids["duplicates"], ids["events"]) == (["j"], ["f"], ["b"], list("abcdeghij"))
    assert sorted(r["event_id"] for r in ev.outputs(frame, replace(MINUTE, forward_duplicates=False))["events"].collect()) == list("acdeghij")
    on_time = ev.enrich(found["on_time"], items(spark, DIM))
    for query in (metrics.pv_uv, metrics.pv_uv_single):
        w = {(r["window_start_ms"] - BASE) // 60_000: r for r in one(query(on_time, MINUTE))}
        assert picked(w[0], FIRST) == FIRST and (w[1]["pv"], w[1]["uv"], w[1]["events"]) == (2, 2, 2)
    assert picked(next(r for r in one(metrics.funnel(on_time, MINUTE)) if r["window_start_ms"] == BASE), STEPS) == STEPS
    assert one(metrics.duplicate_count(found["events"])) == [{"duplicate_events": 1}]
    top = sorted((r["rank"], r["item_id"], r["pv"], r["category_code"]) for r in one(metrics.top_items(on_time, MINUTE)) if r["window_start_ms"] == BASE)
    assert top == [(1, 7, 2, "book"), (2, 8, 1, "lamp")]
    flags = {r["event_id"]: (r["reason"], r["is_dup"], r["is_late"]) for r in one(ev.classify(frame, MINUTE))}
    assert flags["b"] == (None, True, False) and flags["f"] == ("bad_user", False, False) and flags["j"] == (None, False, True) and flags["a"] == (None, False, False)


def topic(spark, folder, batches):
    """A file of payloads for each batch, in order."""
    n = 0
    for k, rows in enumerate(batches):
        lines = []
        for row in rows:
            lines.append((row if isinstance(row, str) else json.dumps(row), n, n))
            n += 1
        spark.createDataFrame(lines, "value string, arrival long, seq long").coalesce(1).write.mode("append").parquet(f"{folder}/{k:02d}")
    return spark.readStream.schema("value string, arrival long, seq long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def payload(row, **change):
    i, u, k, b, t, p = row
    return {"event_id": i, "run_id": "test", "user_id": u, "item_id": k, "behavior": b, "event_time_ms": BASE + t, "produce_time_ms": p} | change


KICK = {"event_id": "kick", "run_id": "test", "user_id": 0, "item_id": 0, "behavior": "kick", "event_time_ms": BASE + 300_000, "produce_time_ms": 0, "watermark_kick": True}


def test_job_over_a_stream(spark, tmp_path):
    """Batches, a restart between them, unreadable and foreign payloads, and a kick; results as over the whole."""
    batches = [[payload(r) for r in ROWS[:1]], [payload(r) for r in ROWS[1:6]] + ["{broken", payload(ROWS[0], run_id="other")], [payload(r) for r in ROWS[6:]]]
    dim, work = items(spark, DIM), str(tmp_path / "job")
    found = jobs.run_job(topic(spark, f"{tmp_path}/in", batches), dim, MINUTE, work)
    assert [r["window_start_ms"] - BASE for r in found["pv_uv"].collect()] == [0]
    spark.createDataFrame([(json.dumps(KICK), 99, 99)], "value string, arrival long, seq long").coalesce(1).write.parquet(f"{tmp_path}/in/03")
    stream = spark.readStream.schema("value string, arrival long, seq long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    found = jobs.run_job(stream, dim, MINUTE, work)
    rows = {n: one(f) for n, f in found.items()}
    ids = {n: sorted(r["event_id"] for r in rows[n]) for n in ("late", "duplicates", "events")}
    assert ids == {"late": ["j"], "duplicates": ["b"], "events": list("abcdeghij")}
    assert sorted(r["reason"] for r in rows["invalid"]) == ["bad_user", "unparseable"] and {r["run_id"] for r in rows["invalid"]} == {"test"}
    w = {(r["window_start_ms"] - BASE) // 60_000: r for r in rows["pv_uv"]}
    assert picked(w[0], FIRST) == FIRST and w.keys() == {0, 1} and w[1]["batch_id"] == 3
    assert picked(next(r for r in rows["funnel"] if r["window_start_ms"] == BASE), STEPS) == STEPS
    assert sorted((r["rank"], r["item_id"]) for r in rows["top_items"] if r["window_start_ms"] == BASE) == [(1, 7), (2, 8)]
    assert {r["category_code"]: r["pv"] for r in rows["category_pv"] if r["window_start_ms"] == BASE} == {"book": 2, "lamp": 1, "UNKNOWN": 1}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    frames = [spark.createDataFrame([(json.dumps(payload(r)), n, n) for n, r in part], "value string, arrival long, seq long") for part in (list(enumerate(ROWS))[:5], list(enumerate(ROWS))[5:])]
    read = lambda n: sorted(map(str, jobs.Parts(spark, str(tmp_path)).read(n).collect()))
    seen = []
    for i in (0, 1, 1, 1):
        jobs.process(frames[i], i, items(spark, DIM), MINUTE, str(tmp_path), lambda: 5)
        seen.append({n: read(n) for n in jobs.OUTPUTS})
    assert seen[1] == seen[2] == seen[3] and seen[0] != seen[1] and len(seen[1]["events"]) == 9


def test_keys_expire_by_the_job_s_clock(spark, tmp_path):
    row, clock = payload(ROWS[0]), iter([0, 1000, 8_000_000])
    stream = topic(spark, f"{tmp_path}/in", [[row], [row | {"event_id": "again"}], [row | {"event_id": "later"}]])
    config = replace(MINUTE, mode="quality", forward_duplicates=False)
    found = jobs.run_job(stream, items(spark, DIM), config, str(tmp_path / "job"), lambda: next(clock))
    assert found.keys() == {"events", "invalid", "duplicates"}
    assert [[r["event_id"] for r in found[n].orderBy("batch_id").collect()] for n in ("events", "duplicates")] == [["a", "later"], ["again"]]
    assert {r["batch_id"] for r in jobs.Parts(spark, str(tmp_path / "job")).read("seen").collect()} == {2}


def test_first_events_by_the_native_operator(spark, tmp_path):
    schema = "user_id long, item_id long, behavior string, event_time_ms long"
    spark.createDataFrame([(1, 1, "pv", BASE), (1, 1, "pv", BASE), (2, 1, "pv", BASE)], schema).write.parquet(str(tmp_path / "in"))
    stream = jobs.first_events(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), MINUTE)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_kicks_are_not_judged(spark):
    schema = "event_id string, run_id string, user_id long, item_id long, behavior string, event_time_ms long, produce_time_ms long, watermark_kick boolean, arrival long, seq long"
    rows = [("x", "test", 1, 7, "pv", BASE, 0, False, 0, 0), ("kick", "test", 0, 0, "kick", BASE + 300_000, 0, True, 1, 1), ("y", "test", 1, 8, "pv", BASE + 1, 0, False, 2, 2)]
    found = ev.outputs(spark.createDataFrame(rows, schema), MINUTE)
    ids = {n: sorted(r["event_id"] for r in f.collect()) for n, f in found.items()}
    assert ids == {"events": ["x", "y"], "invalid": [], "duplicates": [], "late": ["y"], "on_time": ["x"]}
    assert ev.kicks(BASE, MINUTE, 2)[1]["event_time_ms"] == BASE + 60_000 + 5000 + 60_000


@pytest.mark.parametrize("ahead, late", [(0, False), (1, True)])
def test_one_millisecond_decides_lateness(spark, ahead, late):
    config = Config(window_ms=60_000, watermark_ms=5000)
    rows = [("a", BASE + 65_000 - 1 + ahead, 1), ("b", BASE, 2)]
    frame = spark.createDataFrame([(i, "r", 1, 1, "pv", t, 0, s, s) for i, t, s in rows], "event_id string, run_id string, user_id long, item_id long, behavior string, event_time_ms long, produce_time_ms long, arrival long, seq long")
    got = {r["event_id"]: r["is_late"] for r in ev.with_late(ev.with_watermark(ev.with_reason(frame, config), config), config).collect()}
    assert got == {"a": False, "b": late}


def test_partition_without_events_holds_the_watermark(spark):
    config = Config()
    frame = spark.createDataFrame([("a", 0, BASE, 0, 0), ("b", 0, BASE + 5, 1, 1), ("c", 1, BASE + 9, 2, 2), ("d", 0, BASE, 3, 3)], "event_id string, user_id long, event_time_ms long, arrival long, seq long")
    got = {r["event_id"]: r["wm_before"] for r in ev.with_partition_watermark(frame, config, 2).collect()}
    assert got == {"a": None, "b": None, "c": None, "d": BASE + 5 - config.watermark_ms - 1}


def test_a_silent_partition_holds_nothing_back(spark):
    config = Config()
    rows = [("a", 0, BASE, 0), ("b", 1, BASE + 9, 10), ("c", 0, BASE + 50, 40), ("d", 0, BASE + 60, 60), ("e", 0, BASE + 70, 500)]
    frame = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "event_id string, user_id long, event_time_ms long, arrival long, seq long")
    got = {r["event_id"]: r["wm_before"] for r in ev.with_partition_watermark(frame, config, 2, 30).collect()}
    offset = BASE - config.watermark_ms - 1
    #: At 40 partition 0 is silent since 0 and partition 1 counts alone; at 60 it is the other way round; at 500 all are silent.
    assert got == {"a": None, "b": None, "c": offset + 9, "d": offset + 50, "e": offset + 60}
    alone = spark.createDataFrame([("a", 0, BASE, 0, 0), ("b", 0, BASE + 5, 20, 1), ("c", 0, BASE + 6, 31, 2)], "event_id string, user_id long, event_time_ms long, arrival long, seq long")
    assert [r["wm_before"] for r in ev.with_partition_watermark(alone, config, 2, 30).orderBy("seq").collect()] == [None, None, offset + 5]


@pytest.mark.parametrize("change, reason", [({}, None), ({"user_id": 0}, "bad_user"), ({"item_id": -1}, "bad_item"), ({"behavior": "hover"}, "bad_behavior"), ({"event_time_ms": 1}, "bad_time"), ({"event_time_ms": 1_609_459_200_000}, None), ({"event_time_ms": 1_609_459_200_001}, "bad_time"), ({"event_id": ""}, "missing_event_id"), ({"run_id": None}, "missing_run_id"), ({"user_id": None, "behavior": None}, "bad_user")])
def test_quality_rules(spark, change, reason):
    row = {"event_id": "e", "run_id": "r", "user_id": 5, "item_id": 9, "behavior": "pv", "event_time_ms": BASE} | change
    frame = spark.createDataFrame([tuple(row.values())], "event_id string, run_id string, user_id long, item_id long, behavior string, event_time_ms long")
    assert frame.select(invalid_reason(Config())).first()[0] == reason


def test_json_payloads(spark):
    good = '{"event_id":"e1","run_id":"r","user_id":1,"item_id":2,"behavior":"pv","event_time_ms":3,"produce_time_ms":4,"other":5}'
    rows = one(readers.parse_json_events(spark.createDataFrame([(v,) for v in (good, "{not-json", "{also-not", "", None, "null", "{}")], "value string")))
    assert (rows[0]["event_id"], rows[0]["event_time_ms"], rows[0]["watermark_kick"], rows[0]["parse_reason"]) == ("e1", 3, False, None)
    assert [r["parse_reason"] for r in rows[1:]] == ["unparseable", "unparseable", "empty", "empty", "unparseable", None]
    kinds = {'"12"': 12, '" 5 "': 5, '""': 0, "null": 0, "1.7": 1, '"x"': None, "false": None, "{}": None}
    lines = spark.createDataFrame([(k, f'{{"event_id":"e","user_id":{k},"watermark_kick":"true"}}') for k in kinds], "raw string, value string")
    got = {r["raw"]: r for r in readers.parse_json_events(lines, keep=("raw",)).collect()}
    assert {k: r["user_id"] if r["parse_reason"] is None else None for k, r in got.items()} == kinds and got["null"]["watermark_kick"] is True
    assert readers.parse_json_events(spark.createDataFrame([('{"watermark_kick":"maybe"}',)], "value string")).first()["parse_reason"] == "unparseable"
    assert rows[1]["event_id"] != rows[2]["event_id"] and rows[3]["event_id"] == rows[4]["event_id"] and rows[1]["event_id"].startswith("bad-")


def test_loose_dimension_lines_and_logs(spark, tmp_path):
    (tmp_path / "dim").write_text("item_id,category_id,category_code\n1,5,a\n\n2,6\n 1 , 7 , b \n3,8,\n")
    got = {r["item_id"]: (r["category_id"], r["category_code"]) for r in readers.read_dim_lines(spark, str(tmp_path / "dim")).collect()}
    assert got == {1: (7, "b"), 3: (8, "UNKNOWN")}
    (tmp_path / "plain").write_text("1,2,3,buy,1511539200\n1,2,3\nx,2,3,pv,1\n")
    assert [tuple(r) for r in readers.read_log(spark, str(tmp_path / "plain")).collect()] == [(1, 2, 3, "cat-3", "buy", 1_511_539_200_000)]
    (tmp_path / "named").write_text("event_time,event_type,product_id,category_id,category_code,user_id\n2019-11-01T00:00:00.000Z,view,1,,,7\n2019-11-01T00:00:00Z,view,,1,c,7\n")
    assert [tuple(r) for r in readers.read_log(spark, str(tmp_path / "named")).collect()] == [(7, 1, -1, "UNKNOWN", "pv", BASE)]
    storage.write_csv(spark.createDataFrame([("1", 2, 3, "pv", 4)], readers.EVENT_CSV), str(tmp_path / "out"))
    assert [tuple(r) for r in readers.read_events_csv(spark, str(tmp_path / "out")).collect()] == [("1", 2, 3, "pv", 4)]


def test_build_items_ties(spark):
    rows = [(1, 9, "b", 0), (1, 8, "a", 1), (1, 7, "b", 2), (1, 8, "a", 3), (2, 4, "x", 4), (2, 3, "x", 5)]
    got = {r["item_id"]: (r["category_code"], r["category_id"]) for r in ev.build_items(spark.createDataFrame(rows, "item_id long, category_id long, category_code string, row_idx long")).collect()}
    assert got == {1: ("a", 8), 2: ("x", 4)}


def test_disorder(spark):
    times = [0, 20, 40, 10, 30]
    frame = spark.createDataFrame([(t, i, i) for i, t in enumerate(times)], "event_time_ms long, arrival long, seq long")
    assert one(observe.disorder(frame)) == [{"events": 5, "inversions": 2, "max_lateness_ms": 30}]
    chunked = ev.running_before(frame, {"top": F.col("event_time_ms")}, chunk_ms=2)
    assert [r["top"] for r in chunked.orderBy("seq").collect()] == [None, 0, 20, 40, 40]


def test_final_view_and_json(spark, tmp_path):
    rows = spark.createDataFrame([("r", 1, "old", 1, 5), ("r", 1, "new", 2, 1), ("r", 2, "x", 1, 1), ("r", 2, "y", 1, 2)], "run_id string, k long, v string, version long, inserted_at_ms long")
    assert sorted(r["v"] for r in storage.final_view(rows, ["run_id", "k"]).collect()) == ["new", "y"]
    assert storage.json_rows(rows.select("k", F.lit(None).cast("string").alias("s")).limit(1)).first()[0] == '{"k":1,"s":""}'
    for _ in range(2):
        storage.write_batch(rows.select("k"), str(tmp_path / "t"), 7)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 4 and {r["version"] for r in stored.collect()} == {7} and "inserted_at" in stored.columns


def test_decisions():
    assert reconcile.contaminated(6, 100) and not reconcile.contaminated(5, 100)
    assert reconcile.settled([(9, 2, 0)] * 4, 9) and not reconcile.settled([(9, 2, 0)] * 3, 9) and not reconcile.settled([(8, 2, 0)] * 4, 9)
    assert parse_arguments(["--run-id", "x", "stray", "--kick", "--n", "3"]) == {"run-id": "x", "kick": "true", "n": "3"}
    with pytest.raises(ValueError):
        window_start(F.lit(1), 0)


def test_expressions(spark):
    f = lambda c: spark.range(1).select(c).first()[0]
    assert f(map_behavior(F.lit(" View "))) == "pv" and f(map_behavior(F.lit("Hover"))) == "hover"
    assert [f(parse_event_time(F.lit(t))) for t in ("2019-11-01T00:00:00.000Z", "1511539200", str(BASE), "", "x")] == [BASE, 1_511_539_200_000, BASE, None, None]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_any_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        f = lambda c: spark.range(1).select(c).first()[0]
        texts = ("2019-11-01 00:00:00", "2019-11-01T00:00", "2019-11-01", "2019-11-01T05:30:00+05:30", "2019-10-31T20:00:00.000-0400")
        assert [f(parse_event_time(F.lit(t))) for t in texts] == [BASE] * 5
        #: The last is an hour that New York's clocks skip.
        for ms, text in ((BASE, "2019-11-01 00:00:00.000"), (-1, "1969-12-31 23:59:59.999"), (1_552_185_000_005, "2019-03-10 02:30:00.005")):
            assert f(utc_text(F.lit(ms))) == text and f(utc_text(F.lit(ms), False)) == text[:-4] and f(utc_hour(F.lit(ms))) == int(text[11:13])
            assert f(wall_ms(F.lit(text).cast("timestamp_ntz"))) == ms
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def by_hand(rows, ratio, span):
    """Events one by one: held ones wait until an event sent is late enough."""
    out, waiting, top = [], [], None
    for t, n, held in rows:
        if held:
            waiting.append((t + span, n))
            continue
        top = t if top is None else max(top, t)
        out.append(n)
        for due, m in sorted(w for w in waiting if w[0] <= top):
            out.append(m)
            waiting.remove((due, m))
    return out + [m for _, m in sorted(waiting)]


@pytest.mark.parametrize("ratio, span", [(0.4, 50), (0.0, 50), (0.4, 0), (1.0, 10)])
def test_held_events_follow_a_later_one(spark, ratio, span):
    times = sorted(i * i % 400 for i in range(120))
    frame = spark.createDataFrame(list(zip(times, range(120))), "event_time_ms long, number long").repartition(3)
    got = replay.disordered(frame, ratio, span, chunk_ms=30).orderBy("place").collect()
    rows = sorted((r["event_time_ms"], r["number"], r["held"]) for r in got)
    assert [r["number"] for r in got] == by_hand(rows, ratio, span)
    assert (sum(r["held"] for r in got) > 0) == bool(ratio and span)
    for bad in ({"ratio": 1.1, "span_ms": 1}, {"ratio": 0.5, "span_ms": -1}):
        with pytest.raises(ValueError):
            replay.disordered(frame, **bad)


def test_plan_of_a_replay(spark):
    frame = spark.createDataFrame([(str(i), i, BASE + 1000 * i) for i in range(4000)], "event_id string, number long, event_time_ms long")
    rows = replay.plan_sends(frame, 10.0, malformed=7).collect()
    assert [(r["release_s"], r["seq"]) for r in rows] == sorted((r["release_s"], r["seq"]) for r in rows)
    kinds = Counter(r["kind"] for r in rows)
    assert kinds["data"] + kinds["late"] + kinds["jitter"] == 4000 and 5 <= kinds["late"] <= 40 and 140 <= kinds["jitter"] <= 260 and 2 <= kinds["duplicate"] <= 20
    assert [r["malform"] for r in rows if r["kind"] == "malformed"] == [*replay.MALFORMED_KINDS, "bad_json", "bad_user"]
    for r in rows:
        if r["kind"] in ("data", "late", "jitter"):
            put_off = (r["release_s"] - int(r["event_id"]) / 10) * 10
            assert {"data": abs(put_off) < 1e-6, "late": 179 < put_off < 601, "jitter": -1e-6 < put_off < 31}[r["kind"]]
    assert replay.plan_sends(frame.limit(0), 10.0).count() == 0
    for bad in ({"speedup": 0}, {"speedup": 1, "late_min_ms": 2, "late_max_ms": 1}):
        with pytest.raises(ValueError):
            replay.plan_sends(frame, **bad)


def test_rows_go_tick_by_tick(spark):
    frame = spark.createDataFrame([(0.2,), (0.9,), (3.1,)], "release_s double")
    now, sent = [100.0], []

    def send(rows):
        sent.append((now[0] - 100, rows.count()))
        now[0] += 1.5 if len(sent) == 1 else 0.0

    behind = replay.play(frame, send, 1.0, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    assert sent == [(0, 2), (1.5, 0), (2, 0), (3, 1)] and behind == 0.5
    assert replay.play(frame.limit(0), send) == 0
    with pytest.raises(ValueError):
        replay.play(frame, send, 0)


def test_a_sample_and_its_description(spark, tmp_path):
    events = spark.createDataFrame([(str(i), i % 3, i % 2, "pv" if i % 4 else "buy", 100 - i) for i in range(40)], readers.EVENT_CSV)
    [meta] = storage.write_dataset(events, items(spark, DIM), str(tmp_path / "set")).collect()
    assert (meta["rows"], meta["unique_users"], meta["unique_items"], meta["n_buy"], meta["span_ms"], meta["dim_rows"]) == (40, 3, 2, 10, 39, 2)
    for f in meta["files"]:
        content = (tmp_path / "set" / f["file"]).read_bytes()
        assert (f["length"], f["sha256"]) == (len(content), hashlib.sha256(content).hexdigest())
    assert {f["file"].split("/")[0] for f in meta["files"]} == {"events", "dim"}
    assert sorted(map(tuple, readers.read_events_csv(spark, str(tmp_path / "set/events")).collect())) == sorted(map(tuple, events.collect()))
    storage.reload(events.limit(3), str(tmp_path / "table"))
    storage.reload(events.limit(2), str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_topics(spark):
    rows = spark.createDataFrame([(7, "pv")], "user_id long, behavior string")
    assert tuple(storage.topic_records(rows).first()) == ("7", '{"user_id":7,"behavior":"pv"}')
    raw = spark.createDataFrame([(bytearray(b"{}"), 5, 2)], "value binary, offset long, partition int").withColumn("timestamp", F.timestamp_millis(F.lit(9)))
    assert tuple(readers.topic_payloads(raw).first()) == ("{}", 9, 5 * 65_536 + 2)
    with pytest.raises(AnalysisException):  # no connector on the class path
        readers.event_stream(spark, "kafka", subscribe="events")


def test_a_failing_query_is_started_again(spark, tmp_path):
    stream, waits, tries = topic(spark, f"{tmp_path}/in", [[payload(r) for r in ROWS]]), [], []

    def start():
        tries.append(1)
        late = lambda: 1 // (len(tries) - 1)  # noqa: E731  fails the first time
        return jobs.start_job(stream, items(spark, DIM), MINUTE, str(tmp_path / "job"), True, late)

    assert jobs.keep_running(start, 2, 0.5, waits.append) == 1 and waits == [0.5]
    assert jobs.Parts(spark, str(tmp_path / "job")).read("events").count() == 9
    query = jobs.start_job(stream, items(spark, DIM), MINUTE, str(tmp_path / "other"), True)
    query.awaitTermination()
    found = observe.progress_summary(query.recentProgress)
    assert found["rows"] == 10 and found["batches"] >= 1 and found["max_rows_per_s"] >= found["rows_per_s"] > 0
    assert observe.progress_summary([])["rows_per_s"] == 0 and reconcile.accepted(105, 100) and not reconcile.accepted(104, 100)


def test_settings_are_checked():
    for bad in ({"window_ms": 0}, {"mode": "half"}, {"watermark_mode": "never"}, {"watermark_scope": "all"}):
        with pytest.raises(ValueError):
            Config(**bad)


def test_native_windows_drop_late_rows(spark, tmp_path):
    config, schema = Config(window_ms=1000, watermark_ms=500), "user_id long, behavior string, event_time_ms long"
    for i, rows in enumerate([[(1, "pv", 100)], [(2, "pv", 5000)], [(3, "pv", 200)], [(4, "pv", 9000)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = []
        stream = jobs.closed_windows(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), config)
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/{n}")
        stream.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "work")).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    rows = [tuple(r) for r in spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out")).collect()]
    assert sorted(r for r in rows if r[0] == 0) == [(0, 1, 1, 1)]
