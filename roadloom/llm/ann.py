"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut into two halves, each quantised to one of K centroids; the
pair is its cell. A query walks the pairs by the sum of its two half distances
with a heap (multi-sequence order) until the cells visited hold ``visit``
vectors, and all vectors of those cells are reranked by exact Euclidean
distance in double precision.

The codebooks are fitted on at most ``FIT_ROWS`` vectors (those with the least
hash of vec_id); every vector is indexed. ``visit`` is measured, not guessed:
for ``TRIAL`` queries the true neighbours come from one pass over all vectors,
and ``visit`` is what it takes to meet the share ``RECALL`` of them (vectors
without structure need many visits, clustered ones few). K grows with the
square root of the number of vectors, up to ``MOST_K`` (the sample has 39
vectors for each centroid then); the table of cell sizes has K x K rows at
most and goes with the tasks.

Cells are dealt out in units of 2,000 to 50,000 vectors, and a query goes to a
unit once, with the list of its cells there. A cell with more vectors than
that is cut into several units. So one vector that is repeated over a third of
all rows neither lands in one task nor drops out.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; a distance is defined between vectors of equal length
only, so each length has an index of its own; rows that repeat a vec_id count once; fewer than ``top`` candidates
return all of them; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import cut, grouped, Lean, mix64, spread

FIT_ROWS, MOST_K, SEED = 20_000, 512, 5
# Vectors in a unit of work: the table over UNITS, within these bounds.
UNITS, LEAST_UNIT, MOST_UNIT = 128, 2_000, 50_000
TRIAL, RECALL, LEAST_VISIT = 64, 0.97, 1_000


def valid(v: Column) -> Column:
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(broken, F.lit(True)) & F.exists(v, lambda x: x != 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centers = distinct[rng.choice(len(distinct), k, replace=False)].astype(np.float64)
    for _ in range(rounds):
        label = nearest(x, centers)
        order = np.argsort(label, kind="stable")
        n = np.bincount(label, minlength=k)
        sums = np.zeros_like(centers)
        sums[n > 0] = np.add.reduceat(x[order], (np.cumsum(n) - n)[n > 0], axis=0)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    for a in range(0, len(x), 4096):
        part = x[a : a + 4096]
        out[a : a + 4096] = ((centers**2).sum(axis=1) - 2 * part @ centers.T).argmin(axis=1)
    return out


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, size)


def fit(vectors: DataFrame, size: int, n: int, rows: int = FIT_ROWS, most_k: int = MOST_K) -> dict:
    """The two codebooks of ``n`` vectors of length ``size``, from a bounded sample."""
    x = np.array(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("v").toPandas()["v"].tolist(), dtype=np.float64)
    half = max(1, size // 2)
    k = int(min(most_k, max(4, np.ceil(np.sqrt(n / 4)))))
    return {"size": size, "half": half, "books": [kmeans(x[:, :half], k), kmeans(x[:, half:], k)] if size > 1 else [kmeans(x, k), np.zeros((1, 0))]}


def _assign(index: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = len(index["books"][1])
    for batch in batches:
        x = matrix(batch.column("v"), index["size"])
        cell = nearest(x[:, : index["half"]], index["books"][0]) * k
        if index["size"] > 1:
            cell += nearest(x[:, index["half"] :], index["books"][1])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cell)], names=["vec_id", "v", "cell"])


def half_distances(index: dict, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = index["half"]
    first = ((index["books"][0] - v[:half]) ** 2).sum(axis=1)
    return first, (((index["books"][1] - v[half:]) ** 2).sum(axis=1) if index["size"] > 1 else np.zeros(1))


def walk(first: np.ndarray, second: np.ndarray, sizes: dict[int, int], visit: int) -> list[int]:
    """Non-empty cells in order of first[i] + second[j], until they hold ``visit`` vectors."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, a, b = first[a].tolist(), second[b].tolist(), a.tolist(), b.tolist()
    width, out, held = len(y), [], 0
    # Row i is in the heap with its next column; row i + 1 joins when row i gives its first.
    heap = [(x[0] + y[0], 0, 0)]
    while heap and held < visit:
        _, i, j = heap[0]
        cell = a[i] * width + b[j]
        n = sizes.get(cell)
        if n:
            out.append(cell)
            held += n
        if j + 1 < width:
            heapq.heapreplace(heap, (x[i] + y[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return out


def _true(queries: list[tuple[int, np.ndarray]], size: int, top: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of a part of the vectors, with their cells, for a few queries."""
    for batch in batches:
        if not batch.num_rows:
            continue
        e, ids, cells = matrix(batch.column("v"), size), batch.column("vec_id").to_numpy(), batch.column("cell").to_numpy()
        q_out, v_out, d_out, c_out = [], [], [], []
        for q_id, q in queries:
            d = np.sqrt(((e - q) ** 2).sum(axis=1))
            d[ids == q_id] = np.inf
            near = np.argsort(d, kind="stable")[:top]
            near = near[np.isfinite(d[near])]
            q_out += [q_id] * len(near)
            v_out += ids[near].tolist()
            d_out += d[near].tolist()
            c_out += cells[near].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(d_out, pa.float64()), pa.array(v_out, pa.int64()), pa.array(c_out, pa.int64())], names=["query_id", "d", "vec_id", "cell"])


def visits(index: dict, entries: DataFrame, asked: DataFrame, sizes: dict[int, int], top: int, recall: float = RECALL) -> int:
    """How many vectors a query must visit to meet the share ``recall`` of true neighbours, from ``TRIAL`` queries."""
    trial = [(int(r[0]), np.array(r[1], dtype=np.float64)) for r in asked.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(TRIAL).collect()]
    near = entries.mapInArrow(Lean(_true, trial, index["size"], top), "query_id long, d double, vec_id long, cell long")
    best = lambda df, *keys: df.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_set(F.struct("d", "vec_id", "cell"))), 1, top).alias("t")).select("query_id", F.explode("t").alias("x")).select("query_id", "x.*")
    salted = near.withColumn("_salt", F.spark_partition_id() % 64)
    found: dict[int, list[int]] = {}
    for r in best(best(salted, "query_id", "_salt"), "query_id").collect():
        found.setdefault(r["query_id"], []).append(r["cell"])
    depth = []
    for q_id, v in trial:
        order = walk(*half_distances(index, v), sizes, 1 << 60)
        reached = dict(zip(order, np.cumsum([sizes[c] for c in order]).tolist(), strict=True))
        depth += [reached[c] for c in found.get(q_id, [])]
    return max(LEAST_VISIT, int(np.quantile(depth, recall))) if depth else LEAST_VISIT


def units_of(sizes: dict[int, int], unit: int) -> dict[int, tuple[int, int]]:
    """For each cell its first unit and how many units it has; small cells share one."""
    out, now, held = {}, 0, 0
    for cell in sorted(sizes):
        n = sizes[cell]
        parts = -(-n // unit)
        if held and (held + n > unit or parts > 1):
            now, held = now + 1, 0
        out[cell] = (now, parts)
        if parts > 1:
            now += parts
        else:
            held += n
    return out


def _store(units: dict[int, tuple[int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells, ids = batch.column("cell").to_numpy(), batch.column("vec_id").to_numpy()
        first, parts = (np.array([units[c][i] for c in cells.tolist()], dtype=np.int64) for i in range(2))
        unit = first + (mix64(ids.astype(np.uint64)) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(unit), pa.array([[c] for c in cells.tolist()], pa.list_(pa.int64())), pa.array(np.zeros(n, dtype=bool))], names=["vec_id", "v", "unit", "cells", "asks"])


def _route(index: dict, sizes: dict[int, int], units: dict[int, tuple[int, int]], visit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("v"), index["size"])
        rows, to, lists = [], [], []
        for r, v in enumerate(x):
            mine: dict[int, list[int]] = {}
            for cell in walk(*half_distances(index, v), sizes, visit):
                first, parts = units[cell]
                for p in range(parts):
                    mine.setdefault(first + p, []).append(cell)
            rows += [r] * len(mine)
            to += mine.keys()
            lists += mine.values()
        at = pa.array(rows, pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("v").take(at), pa.array(to, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array([True] * len(rows), pa.bool_())], names=["vec_id", "v", "unit", "cells", "asks"])


def _rerank(size: int, top: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit in grouped(batches, "unit"):
        unit = unit.combine_chunks()
        asks = unit.column("asks").to_numpy()
        ids = unit.column("vec_id").to_numpy()
        if not asks.any() or asks.all():
            continue
        x = matrix(unit.column("v").combine_chunks(), size)
        lists = unit.column("cells").to_pylist()
        # Sorted by cell: a query's candidates are a few stretches.
        stored = np.flatnonzero(~asks)
        e_cells = np.array([lists[i][0] for i in stored])
        order = np.argsort(e_cells, kind="stable")
        e, e_ids, e_cells = x[stored[order]], ids[stored[order]], e_cells[order]
        out_q, out_v, out_d = [], [], []
        for i in np.flatnonzero(asks):
            cells = np.array(lists[i])
            first = np.searchsorted(e_cells, cells)
            held = np.searchsorted(e_cells, cells, side="right") - first
            at = np.arange(held.sum()) + np.repeat(first - np.cumsum(held) + held, held)
            at = at[e_ids[at] != ids[i]]
            d, cand = np.sqrt(((e[at] - x[i]) ** 2).sum(axis=1)), e_ids[at]
            if len(d) > top:
                near = np.flatnonzero(d <= np.partition(d, top - 1)[top - 1])
                d, cand = d[near], cand[near]
            order = np.lexsort((cand, d))
            kept = order[np.unique(cand[order], return_index=True)[1]] if len(np.unique(cand)) < len(cand) else order
            order = kept[np.lexsort((cand[kept], d[kept]))][:top]
            out_q += [ids[i]] * len(order)
            out_v += cand[order].tolist()
            out_d += d[order].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_d, pa.float64())], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries: DataFrame, top: int = 10, visit: int | None = None, unit: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs have (vec_id, embedding). ``visit`` overrides the measured number of visits."""
    shape = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id is not null").filter(valid(F.col("v")))
    base, asked = shape(vectors), shape(queries)
    out = None
    # One row for each length that vectors have; a table of embeddings has one.
    lengths = base.groupBy(F.size("v").alias("size")).count()
    for size, n in lengths.join(asked.select(F.size("v").alias("size")).distinct(), "size", "left_semi").orderBy("size").collect():
        sized = lambda df, size=size: df.filter(F.size("v") == size)
        found = _search(sized(base), sized(asked), size, n, top, visit, unit)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return base.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return out


def _search(base: DataFrame, asked: DataFrame, size: int, n: int, top: int, visit: int | None, unit: int | None) -> DataFrame:
    """The same for ``n`` vectors (vec_id, v) of one length."""
    index = fit(base, size, n)
    entries = cut(base.mapInArrow(Lean(_assign, index), "vec_id long, v array<double>, cell long"), "imi")
    # Bounded: K x K cells at most.
    sizes = {int(c): int(n) for c, n in entries.groupBy("cell").count().collect()}
    units = units_of(sizes, unit or min(MOST_UNIT, max(LEAST_UNIT, sum(sizes.values()) // UNITS)))
    visit = visits(index, entries, asked, sizes, top) if visit is None else visit
    kind = "vec_id long, v array<double>, unit long, cells array<long>, asks boolean"
    stored = entries.mapInArrow(Lean(_store, units), kind)
    routed = spread(asked, "vec_id").mapInArrow(Lean(_route, index, sizes, units, visit), kind)
    work = spread(stored.unionByName(routed), "unit").sortWithinPartitions("unit")
    near = work.mapInArrow(Lean(_rerank, size, top), "query_id long, vec_id long, score double")
    # A query has ``top`` rows a visited unit; sets drop what repeated queries repeat.
    best = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id"))), 1, top).alias("t"))
    out = best.select("query_id", F.posexplode("t").alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
