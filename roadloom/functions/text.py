"""Parsing of points, numbers, times and names: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TEXTS = ["nan", "none", "inf", "-inf", "+inf", "na", ""]


def try_double(c: Column) -> Column:
    return c.try_cast("double")


def wkt_point(c: Column) -> Column:
    """struct<lon,lat> of the first POINT(lon lat) anywhere in a text; nulls if there is none."""
    pattern = r"POINT\((\S+) (\S+)\)"
    part = lambda i: try_double(F.nullif(F.regexp_extract(c, pattern, i), F.lit("")))
    return F.struct(part(1).alias("lon"), part(2).alias("lat"))


def wkt_tokens(c: Column) -> Column:
    """struct<lon,lat> of a text that is POINT( and ) around exactly two tokens; null otherwise."""
    bare = F.trim(F.replace(F.replace(c, F.lit("POINT("), F.lit("")), F.lit(")"), F.lit("")))
    parts = F.split(bare, r"\s+")
    two = F.size(parts) == 2
    return F.when(two, F.struct(try_double(F.get(parts, F.lit(0))).alias("lon"), try_double(F.get(parts, F.lit(1))).alias("lat")))


def to_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def number_or_zero(c: Column) -> Column:
    """Empty is zero; a text that is no number is null."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0.0)).otherwise(try_double(c))


def is_missing(c: Column, numeric: bool = False) -> Column:
    """Null, NaN, or a text that, in either case and as it is (not trimmed), stands for a missing value. Infinite numbers are numbers."""
    return c.isNull() | (F.isnan(c) if numeric else F.lower(c.cast("string")).isin(NULL_TEXTS))


def first_number(c: Column) -> Column:
    """The first run of digits as int; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("int")


def pad_milliseconds(c: Column) -> Column:
    """Times that end in seconds and UTC get .000; fractions of one or two digits are padded to three."""
    fraction = F.regexp_extract(c, r":\d{2}(?:\.(\d{1,2}))? UTC$", 1)
    head = F.regexp_extract(c, r"^(.*:\d{2})(?:\.\d{1,2})? UTC$", 1)
    return F.when(c.rlike(r":\d{2}(\.\d{1,2})? UTC$"), F.concat(head, F.lit("."), F.rpad(fraction, 3, "0"), F.lit(" UTC"))).otherwise(c)


def name_tail(c: Column, parts: int = 3) -> Column:
    """The last tokens, split by underscores, of a file name without its extension."""
    stem = F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    tokens = F.split(stem, "_")
    return F.array_join(F.slice(tokens, F.greatest(F.size(tokens) - parts + 1, F.lit(1)), F.lit(parts)), "_")


def contains_folded(c: Column, needle: str) -> Column:
    """Case-insensitive containment; null counts as no."""
    return F.coalesce(F.contains(F.lower(c), F.lit(needle.lower())), F.lit(False))
