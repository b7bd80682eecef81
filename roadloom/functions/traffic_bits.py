"""The 64-bit live speed record: 7-bit speeds (2 km/h units), 8-bit breakpoints, 6-bit congestion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom.params import INVALID_RECORD, MAX_CONGESTION, UNKNOWN_RAW_SPEED

# Fixed values: (field, first bit, width).
FIELDS = [
    ("overall", 0, 7), ("speed1", 7, 7), ("speed2", 14, 7), ("speed3", 21, 7),
    ("breakpoint1", 28, 8), ("breakpoint2", 36, 8),
    ("congestion1", 44, 6), ("congestion2", 50, 6), ("congestion3", 56, 6),
    ("incidents", 62, 1), ("spare", 63, 1),
]
# Upper speeds of the congestion bands, and the bands' levels.
BANDS, FREE = [(10, 51), (20, 31), (40, 16)], 6


def encode_speed(kph: Column, most: int = 126) -> Column:
    """Two km/h a step, cut off; ``most`` 126 keeps 127 for unknown, 127 doesn't."""
    return F.least(F.floor(kph / 2), F.lit(most)).cast("int")


def decode_speed(raw: Column) -> Column:
    return raw * 2


def clamp_congestion(c: Column, least: int = 0) -> Column:
    return F.greatest(F.least(c, F.lit(MAX_CONGESTION)), F.lit(least)).cast("int")


def congestion_band(kph: Column, offset: int = 0) -> Column:
    out = None
    for top, value in BANDS:
        out = F.when(kph < top, value + offset) if out is None else out.when(kph < top, value + offset)
    return out.otherwise(FREE + offset).cast("int")


def pack(**values: Column | int) -> Column:
    """A record from fields; those not given are 0."""
    at = {name: (bit, width) for name, bit, width in FIELDS}
    out = F.lit(0).cast("long")
    for name, v in values.items():
        bit, width = at[name]
        c = v if isinstance(v, Column) else F.lit(v)
        out = out.bitwiseOR(F.shiftleft(c.cast("long").bitwiseAND(F.lit((1 << width) - 1).cast("long")), bit))
    return out


def record(raw_speed: Column, congestion: Column) -> Column:
    """One speed and congestion over the whole edge."""
    return pack(overall=raw_speed, speed1=raw_speed, speed2=raw_speed, speed3=raw_speed, breakpoint1=255, breakpoint2=255, congestion1=congestion, congestion2=congestion, congestion3=congestion)


def unpack(r: Column, name: str) -> Column:
    bit, width = next((b, w) for n, b, w in FIELDS if n == name)
    return F.shiftrightunsigned(r, bit).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def invalid() -> Column:
    return F.lit(INVALID_RECORD).cast("long")


def speed_valid(r: Column) -> Column:
    return (unpack(r, "breakpoint1") != 0) & (unpack(r, "overall") != UNKNOWN_RAW_SPEED)


def closed(r: Column) -> Column:
    return speed_valid(r) & (unpack(r, "overall") == 0)


def with_speed(r: Column, raw_speed: Column) -> Column:
    """Sets the overall speed and breakpoint1 and leaves the rest."""
    mask = ~(0x7F | (0xFF << 28))
    return r.bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(raw_speed.cast("long")).bitwiseOR(F.lit(255 << 28).cast("long"))
