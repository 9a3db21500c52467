"""Configuration and column expressions of the clickstream model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the event model.
BEHAVIORS = ("pv", "cart", "buy", "fav", "remove")
RAW_BEHAVIORS = {
    "view": "pv", "pv": "pv", "click": "pv",
    "cart": "cart", "add_to_cart": "cart",
    "purchase": "buy", "buy": "buy", "order": "buy",
    "fav": "fav", "favorite": "fav",
    "remove_from_cart": "remove", "remove": "remove",
}
UNKNOWN, NO_CATEGORY = "UNKNOWN", -1
NATURAL_KEY = ("user_id", "item_id", "behavior", "event_time_ms")
#: Every field as text, so that a value of a wrong kind is told from a missing one; what is no JSON lands in the last.
JSON_SCHEMA = "event_id string, run_id string, user_id string, item_id string, behavior string, event_time_ms string, produce_time_ms string, watermark_kick string, unread string"


@dataclass(frozen=True)
class Config:
    """A job's settings; the defaults are the model's own."""

    run_id: str = "run"
    window_ms: int = 600_000
    watermark_ms: int = 120_000
    #: A partition silent for so long holds no watermark back; 0 for never.
    idle_ms: int = 20_000
    top_n: int = 10
    valid_from: int = 1_483_228_800_000
    valid_to: int = 1_609_459_200_000
    forward_duplicates: bool = True
    mode: str = "full"
    watermark_scope: str = "validated"
    #: How long a natural key is remembered after its first event, by the job's clock.
    dedup_ttl_ms: int = 7_200_000
    #: Time from one micro-batch, and so one commit, to the next.
    checkpoint_ms: int = 10_000
    watermark_mode: str = "punctuated"
    watermark_interval_ms: int = 200

    def __post_init__(self) -> None:
        if self.window_ms <= 0:
            raise ValueError("window_ms must be positive")
        if self.mode not in ("full", "quality"):
            raise ValueError("mode is full or quality")
        if self.watermark_mode not in ("punctuated", "periodic"):
            raise ValueError("watermark_mode is punctuated or periodic")
        if self.watermark_scope not in ("validated", "source"):
            raise ValueError("watermark_scope is validated or source")


def parse_arguments(arguments: list[str]) -> dict[str, str]:
    """``--key value`` pairs; a key before another key or at the end is "true"; stray words are skipped."""
    found: dict[str, str] = {}
    for i, word in enumerate(arguments):
        if word.startswith("--"):
            after = arguments[i + 1] if i + 1 < len(arguments) else "--"
            found[word[2:]] = "true" if after.startswith("--") else after
    return found


def window_start(ms: Column, window_ms: int) -> Column:
    """Start of the epoch-aligned window, for times before 1970 too."""
    if window_ms <= 0:
        raise ValueError("window_ms must be positive")
    return ms - F.pmod(ms, F.lit(window_ms))


def map_behavior(raw: Column, extra: dict[str, str] | None = None) -> Column:
    """The model's behavior; unknown ones stay, in lower case."""
    name = F.lower(F.trim(raw))
    known = RAW_BEHAVIORS | (extra or {})
    pairs = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(F.element_at(pairs, name), name)


def parse_event_time(raw: Column) -> Column:
    """Milliseconds from seconds, milliseconds or ISO text (UTC if it names no zone, whatever the session's); null if none of these."""
    text = F.regexp_replace(F.trim(raw), r"([ T]\d{1,2}:\d{2})(?=$|[zZ+-])", "$1:00")  # minutes alone
    number = text.try_cast("long")
    timed, zoned = text.rlike(r"\d:\d"), text.rlike(r"\d:\d.*(?:[zZ]|UTC|GMT|[+-]\d{1,2}(?::?\d{2})?)$")
    utc = F.when(zoned, text).when(timed, F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))
    return F.when(text.rlike("^[0-9]+$"), F.when(number < 10_000_000_000, number * 1000).otherwise(number)).when(text != "", F.unix_millis(utc.try_cast("timestamp")))


def wall_ms(moment: Column) -> Column:
    """Milliseconds of a timestamp without zone, read as UTC."""
    day = F.unix_date(moment.cast("date")).cast("long")
    return ((day * 24 + F.hour(moment)) * 60 + F.minute(moment)) * 60_000 + F.floor(F.date_part(F.lit("SECONDS"), moment) * 1000).cast("long")


def category_or_unknown(code: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(code), F.lit("")), F.lit(UNKNOWN))


def invalid_reason(config: Config, parse_reason: str | None = None) -> Column:
    """The first rule an event breaks; null for a valid event."""
    rules = [
        (F.coalesce(F.col("event_id"), F.lit("")) == "", "missing_event_id"),
        (F.coalesce(F.col("run_id"), F.lit("")) == "", "missing_run_id"),
        (F.coalesce(F.col("user_id"), F.lit(0)) <= 0, "bad_user"),
        (F.coalesce(F.col("item_id"), F.lit(0)) <= 0, "bad_item"),
        (~F.coalesce(F.col("behavior").isin(*BEHAVIORS), F.lit(False)), "bad_behavior"),
        (~F.coalesce(F.col("event_time_ms").between(config.valid_from, config.valid_to), F.lit(False)), "bad_time"),
    ]
    chain = F.when(F.col(parse_reason).isNotNull(), F.col(parse_reason)) if parse_reason else F.when(F.lit(False), F.lit(""))
    for broken, reason in rules:
        chain = chain.when(broken, F.lit(reason))
    return chain


def bad_payload_id(payload: Column, reason: Column) -> Column:
    """An id that tells unreadable payloads apart; empty ones share one per reason."""
    return F.concat(F.lit("bad-"), F.substring(F.md5(F.concat_ws("|", reason, F.coalesce(payload, F.lit("")))), 1, 8))


def utc_text(ms: Column, with_ms: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` in UTC, whatever the session's zone."""
    rest = F.pmod(ms, F.lit(86_400_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int")).cast("string")
    parts = [F.floor(rest / 3_600_000), F.floor(rest / 60_000) % 60, F.floor(rest / 1000) % 60, rest % 1000]
    text = F.format_string("%s %02d:%02d:%02d", day, *parts[:3])
    return F.concat(text, F.format_string(".%03d", parts[3])) if with_ms else text


def utc_hour(ms: Column) -> Column:
    return F.pmod(F.floor(ms / 3_600_000), F.lit(24))
