"""64-bit graph ids: level (3 bits), tile (22 bits), index in the tile (21 bits); names and paths of tiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL_BITS, TILE_BITS, INDEX_BITS = 3, 22, 21


def pack(level: Column, tile: Column, index: Column) -> Column:
    return level.cast("long").bitwiseOR(F.shiftleft(tile.cast("long"), LEVEL_BITS)).bitwiseOR(F.shiftleft(index.cast("long"), LEVEL_BITS + TILE_BITS))


def level(g: Column) -> Column:
    return g.bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int")


def tile(g: Column) -> Column:
    return F.shiftright(g, LEVEL_BITS).bitwiseAND(F.lit((1 << TILE_BITS) - 1)).cast("int")


def index(g: Column, masked: bool = True) -> Column:
    shifted = F.shiftright(g, LEVEL_BITS + TILE_BITS)
    return shifted.bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).cast("long") if masked else shifted


def tile_base(g: Column) -> Column:
    """The id of the tile: index bits cleared."""
    return g.bitwiseAND(F.lit((1 << (LEVEL_BITS + TILE_BITS)) - 1))


def name(g: Column, masked: bool = False) -> Column:
    return F.concat_ws("/", level(g).cast("string"), tile(g).cast("string"), index(g, masked).cast("string"))


def parse_base(c: Column) -> Column:
    """Tile id from level/tile/anything, or from a plain number; null if neither."""
    part = lambda i: F.get(F.split(c, "/"), F.lit(i)).try_cast("long")
    return F.when(F.contains(c, F.lit("/")), pack(part(0), part(1), F.lit(0))).otherwise(F.trim(c).try_cast("long"))


def tile_path(level_no: Column, tile_no: Column, extension: str = ".csv") -> Column:
    """level/ddd/ddd...: the tile number padded to a multiple of three digits, cut into threes."""
    digits = tile_no.cast("string")
    width = (F.ceil(F.length(digits) / 3) * 3).cast("int")
    padded = F.lpad(digits, width, F.lit("0"))
    return F.concat(level_no.cast("string"), F.lit("/"), F.regexp_replace(padded, r"(\d{3})(?=\d)", r"$1/"), F.lit(extension))


def pseudo_edge(lat: Column, lon: Column, most: int = 10_000) -> Column:
    """Offline stand-in for snapping: an edge number from the coordinates alone."""
    return ((F.abs(lat) * 1e5 + F.abs(lon) * 1e5).cast("long") % most).cast("int")


def pseudo_edge_single(lat: Column, lon: Column, most: int = 100_000) -> Column:
    """The same with each term in single precision."""
    term = lambda c: F.floor((F.abs(c).cast("float") * F.lit(1e5).cast("float")).cast("double")).cast("long")
    return ((term(lat) + term(lon)) % most).cast("int")


def tile_of_pseudo(edge: Column, per_tile: int = 1000) -> tuple[Column, Column]:
    return F.floor(edge / per_tile).cast("int"), (edge % per_tile).cast("int")


def member_name(tile_no: Column) -> Column:
    digits = tile_no.cast("string")
    return F.concat(F.when(F.length(digits) >= 5, digits).otherwise(F.lpad(digits, 5, "0")), F.lit(".gph"))
