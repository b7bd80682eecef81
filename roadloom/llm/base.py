"""What the training-data operators share: written intermediates, Arrow batches, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.session import is_small, scratch, ship


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: short lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table. A small one in few files often is a single row group, which one task would read and work on; its rows are dealt out over the cores first."""
    df = ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if is_small(df) and len(df.inputFiles()) < cores else df


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows by a hash of ``cols`` over as many partitions as the session's shuffles have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


class Lean:
    """A function of Arrow batches (after fixed arguments) whose worker gives memory back when a partition ends: workers are kept for later tasks."""

    def __init__(self, f: Callable[..., Iterator[pa.RecordBatch]], *fixed: object):
        self.f, self.fixed = f, fixed

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from self.f(*self.fixed, batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each (one row at least), so that memory stays bounded."""
    sizes = np.asarray(batch.column(text).cast(pa.binary()).to_pandas().map(lambda x: 0 if x is None else len(x)), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in batches that are sorted by it, across batch borders."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        at = 0
        for edge in [*edges.tolist(), batch.num_rows]:
            part = batch.slice(at, edge - at)
            if rest and keys[at] != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(part)
            last = keys[at]
            at = edge
    if rest:
        yield pa.Table.from_batches(rest)


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, root), one row per node that has an edge.

    Each round sends a node to its least neighbour (or itself), follows that
    pointer once more and contracts the graph. The first two rounds order
    nodes by id, which ends star-like groups at once; later ones by a hash, so
    that long chains shrink by a constant share too. All steps are partial
    aggregations and equi joins: a node with a third of all edges is
    pre-aggregated, and its join partition is one that adaptive execution splits.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    maps: list[DataFrame] = []
    while True:
        e = cut(e, name)
        if e.isEmpty():
            break
        order = (lambda c: F.col(c)) if len(maps) < 2 else (lambda c: F.xxhash64(c))
        both = e.union(e.select("b", "a"))
        near = both.groupBy("a").agg(F.min(F.struct(order("b").alias("k"), F.col("b").alias("v"))).alias("n"))
        own = F.struct(order("a").alias("k"), F.col("a").alias("v"))
        m = cut(near.select(F.col("a").alias("node"), F.least("n", own)["v"].alias("to")), name)
        up = m.select(F.col("node").alias("to"), F.col("to").alias("to2"))
        m = cut(m.join(up, "to").select("node", F.col("to2").alias("to")), name)
        maps.append(m)
        ma = m.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        mb = m.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = e.join(ma, "a").join(mb, "b").filter("ta != tb")
        e = moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[-1].select("node", F.col("to").alias("root"))
    for m in reversed(maps[:-1]):
        top = found.select(F.col("node").alias("to"), "root")
        found = m.join(top, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return found
