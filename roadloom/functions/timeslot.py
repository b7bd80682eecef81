"""Times and weekly slots. Times are TIMESTAMP_NTZ (wall clock); the weekly grid starts on Sunday 00:00."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom.params import SLOT_MINUTES, SLOTS_PER_DAY

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall-clock time; no session time zone is involved."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)


def epoch_seconds(ts: Column) -> Column:
    return F.floor(micros(ts) / 1_000_000).cast("long")


def time_value(ts: Column, reference: str, shift_s: int) -> Column:
    """Whole seconds (half to even) since a reference, shifted to local time."""
    since = F.timestamp_diff("MICROSECOND", F.expr(f"timestamp_ntz'{reference}'"), ts)
    return F.rint(since / F.lit(1e6) + F.lit(float(shift_s))).cast("long")


def slot(ts: Column) -> Column:
    """0..2015: five-minute slot of the week."""
    return ((F.dayofweek(ts) - 1) * SLOTS_PER_DAY + F.hour(ts) * (60 // SLOT_MINUTES) + F.floor(F.minute(ts) / SLOT_MINUTES)).cast("int")


def slot_of_epoch(seconds: Column) -> Column:
    """The same from seconds since 1970 (a Thursday)."""
    days = F.floor(seconds / 86_400)
    weekday = F.pmod(days + 4, F.lit(7))
    return (weekday * SLOTS_PER_DAY + F.floor(F.pmod(seconds, F.lit(86_400)) / (60 * SLOT_MINUTES))).cast("int")


def slot_hour(s: Column) -> Column:
    return F.floor(s % SLOTS_PER_DAY / (60 // SLOT_MINUTES)).cast("int")


def iso_utc(seconds: Column) -> Column:
    """Seconds since 1970 as an ISO text; null stays null."""
    day = F.date_add(F.expr("date'1970-01-01'"), F.floor(seconds / 86_400).cast("int"))
    rest = F.pmod(seconds, F.lit(86_400))
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(rest / 3600)), two(F.floor(rest % 3600 / 60)), two(rest % 60))
    return F.when(seconds.isNotNull(), F.concat(day.cast("string"), F.lit("T"), clock, F.lit("Z")))


def parse_time(c: Column) -> Column:
    """TIMESTAMP_NTZ of texts like 2025-02-28 16:00:01[.5][ UTC] or ISO with T and Z; null if none."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(c), r"( UTC|Z)$", ""), "T", " ")
    return clean.try_cast("timestamp_ntz")
