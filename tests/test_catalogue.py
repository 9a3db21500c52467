"""Queries against their SQL; the driver does the same for all of them at a larger size."""

import math

import duckdb
import pytest

import __spark_entry__
from rillmark.plans import catalogue

TABLES = ("events", "part", "documents")
NAMES = ("json_types", "bad_payload_ids", "event_time_parse", "utc_texts", "invalid_by_reason", "dedup_first", "duplicate_events", "kick_rows", "kick_passage", "watermark_trace", "watermark_source_scope", "watermark_idle", "disordered_replay", "planned_sends", "planned_kinds", "malformed_reasons", "reconcile_rows", "reconcile_stored", "hourly_events", "latency_approx", "stream_funnel", "stream_category", "stream_late", "stream_invalid", "stream_events", "stream_kick", "pv_uv", "pv_uv_two_stage", "funnel", "top_items", "late_events", "watermark_periodic", "watermark_per_partition", "pv_identity", "reconcile_diff", "burst_quiet_latency", "build_dim", "dash_latest_funnel", "stream_pv_uv", "stream_dedup", "stream_top_items")


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    return f"{value:.9g}" if isinstance(value, float) and not math.isnan(value) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    found = catalogue.queries()[name](spark, small)
    columns = sorted(found.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.oracle_sql()[name]}) q").fetchall()
    got = found.select(*columns).collect()
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in want)


def test_counts_of_the_profile(spark, small):
    rows = catalogue.classified(spark, small).select("reason", "is_late", "is_dup").collect()
    assert len(rows) == 1020 and sum(r["reason"] is None for r in rows) == 715
    assert sum(r["is_late"] for r in rows) == 6 and sum(r["is_dup"] for r in rows) == 14 and sum(r["is_dup"] and r["is_late"] for r in rows) == 1


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
