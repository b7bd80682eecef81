"""Writers of traces, profiles, tiles and reports."""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions.graphid import member_name
from roadloom.sources.tiles import encode_tile, write_tar


def write_traces(points: DataFrame, path: str) -> None:
    """Parquet (snappy) of (trip_id, t, lat, lon), sorted within files; points that don't parse are left out."""
    good = points.select(F.col("trip_id").cast("string").alias("trip_id"), F.col("t").cast("long").alias("t"), "lat", "lon").dropna()
    good.repartition("trip_id").sortWithinPartitions("trip_id", "t").write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_ndjson(points: DataFrame, path: str) -> None:
    """One gzip JSON line a trip."""
    rows = points.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("t", "lat", "lon"))).alias("points"))
    rows.select(F.col("trip_id").cast("string").alias("trip_id"), "points").write.mode("overwrite").option("compression", "gzip").json(path)


def write_by_vehicle(rows: DataFrame, vehicle: str, order: list[str], path: str) -> None:
    """CSV with a header, in vehicle order over the files: one range of vehicles a file."""
    rows.orderBy(vehicle, *order).write.mode("overwrite").option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def edge_csv_lines(speeds: DataFrame) -> DataFrame:
    """(value) lines level/tile/0,edge,speed,congestion of (level, tile, edge_index, speed_kph, congestion)."""
    key = F.concat_ws("/", F.col("level").cast("string"), F.col("tile").cast("string"), F.lit("0"))
    return speeds.select(F.concat_ws(",", key, F.col("edge_index").cast("string"), F.col("speed_kph").cast("string"), F.col("congestion").cast("string")).alias("value"))


HEAD_LINES = ["# edge speeds", "# tile,edge_index,speed_kph,congestion", "# speeds in km/h", "# congestion 1..63"]


def _write_paths(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, lines in zip(batch.column("file_path").to_pylist(), batch.column("lines").to_pylist(), strict=True):
            full = os.path.join(root, path)
            os.makedirs(os.path.dirname(full), exist_ok=True)
            half = f"{full}.{os.getpid()}.tmp"
            with open(half, "w") as f:
                f.write("\n".join(lines) + "\n")
            os.replace(half, full)
        yield pa.RecordBatch.from_arrays([batch.column("file_path"), pa.array([len(x) for x in batch.column("lines").to_pylist()], pa.int64())], names=["file_path", "n"])


def write_tile_csv(rows: DataFrame, root: str) -> DataFrame:
    """Files level/ddd/ddd.csv under a shared folder; returns (file_path, n). A file holds one tile, whose edges are bounded; a retried task replaces it whole."""
    files = rows.groupBy("file_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("edge_in_tile", "line"))), lambda x: x["line"]).alias("lines"))
    local = root.removeprefix("file://").removeprefix("file:")
    from functools import partial

    return files.mapInArrow(partial(_write_paths, local), "file_path string, n long")


def _blobs(updated: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = [encode_tile(t, updated, np.array(r, dtype=np.int64).view(np.uint64)) for t, r in zip(batch.column("tile").to_pylist(), batch.column("records").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("tile"), batch.column("member"), pa.array(blobs, pa.binary())], names=["tile", "member", "blob"])


def tile_blobs(dense: DataFrame, updated: int | None = None) -> DataFrame:
    """(tile, member, blob) of (tile, edge_index, record); a tile's edges are bounded by its 21 index bits."""
    from functools import partial

    rows = dense.groupBy("tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("edge_index", "record"))), lambda x: x["record"]).alias("records"))
    stamp = int(time.time()) if updated is None else updated
    return rows.select(F.col("tile").cast("long").alias("tile"), member_name(F.col("tile")).alias("member"), "records").mapInArrow(partial(_blobs, stamp), "tile long, member string, blob binary")


def write_archive(dense: DataFrame, path: str, updated: int | None = None) -> int:
    """One tar of all tiles, members in tile order, streamed through the driver a partition at a time."""
    blobs = tile_blobs(dense, updated).orderBy("tile")
    return write_tar(path, ((r["member"], bytes(r["blob"])) for r in blobs.toLocalIterator()))


class Busy(RuntimeError):
    """Somebody else publishes to the folder."""


@contextmanager
def single_writer(folder: str, stale_s: float = 3600.0) -> Iterator[None]:
    """Holds the folder's lock file, which only one writer can make; one that is older than ``stale_s`` was left by a writer that died."""
    lock = os.path.join(folder, "writer.lock")
    with suppress(FileNotFoundError):
        if time.time() - os.stat(lock).st_mtime > stale_s:
            os.remove(lock)
    try:
        os.close(os.open(lock, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
    except FileExistsError:
        raise Busy(f"{lock} is held by another writer") from None
    try:
        yield
    finally:
        with suppress(FileNotFoundError):
            os.remove(lock)


def publish(dense: DataFrame, folder: str, updated: int | None = None, least_bytes: int = 512) -> str | None:
    """Double buffer: builds beside the standby file, checks it, puts it in its place and turns ``current`` to it. Readers see the old archive or the new one; one writer at a time. None if the check fails."""
    os.makedirs(folder, exist_ok=True)
    with single_writer(folder):
        return _swap(dense, folder, updated, least_bytes)


def _swap(dense: DataFrame, folder: str, updated: int | None, least_bytes: int) -> str | None:
    current = os.path.join(folder, "current")
    active = os.path.basename(os.readlink(current)) if os.path.islink(current) else "b.tar"
    standby = "a.tar" if active == "b.tar" else "b.tar"
    half = os.path.join(folder, f"{standby}.new")
    n = write_archive(dense, half, updated)
    if n < 1 or os.path.getsize(half) < least_bytes:
        os.remove(half)
        return None
    os.replace(half, os.path.join(folder, standby))
    link = os.path.join(folder, "current.new")
    if os.path.lexists(link):
        os.remove(link)
    os.symlink(standby, link)
    os.replace(link, current)
    return os.path.join(folder, standby)
