"""Global orders without a single task: numbers, runs and exact quantiles.

Rows are dealt out by ranges of the order and written once (range limits come
from a sample, so the dealing must not be repeated); a small table with a row
for each range then carries counts or borders from one range to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.session import is_small, scratch


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``_range``, numbered in the order of ``order``; rows that are equal in it share a range."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "ranges")
    df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _before(ranges: DataFrame, value: str) -> DataFrame:
    """(_range, _lift): the sum of ``value`` over earlier ranges; as many rows as ranges."""
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("_range", F.coalesce(F.sum(value).over(w), F.lit(0)).alias("_lift"))


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Adds 1, 2, 3, ... in a global order that has no ties (with ties: in any order among them)."""
    rows = in_ranges(df, order)
    lifts = _before(rows.groupBy("_range").agg(F.count("*").alias("_n")), "_n")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_in", inside).join(F.broadcast(lifts), "_range").withColumn(name, (F.col("_in") + F.col("_lift")).cast("long")).drop("_range", "_in", "_lift")


def runs(df: DataFrame, key: str, order: str, name: str = "run") -> DataFrame:
    """Numbers contiguous runs of equal keys in a global order without ties."""
    rows = in_ranges(df, [order])
    w = Window.partitionBy("_range").orderBy(order)
    ends = rows.groupBy("_range").agg(F.max_by(F.struct(key), order).alias("_last"))
    border = ends.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_prev"))
    marked = rows.withColumns({"_own": F.struct(key), "_left": F.lag(F.struct(key)).over(w)}).join(F.broadcast(border), "_range")
    new = marked.withColumn("_new", (~F.col("_own").eqNullSafe(F.coalesce("_left", "_prev"))).cast("int"))
    lifts = _before(new.groupBy("_range").agg(F.sum("_new").alias("_n")), "_n")
    total = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return new.withColumn("_in", total).join(F.broadcast(lifts), "_range").withColumn(name, F.col("_in") + F.col("_lift")).drop("_range", "_own", "_left", "_prev", "_new", "_in", "_lift")


def quantiles(df: DataFrame, column: str, at: list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation of the non-null values.

    Equal values are counted first; then the distinct values are ordered in
    ranges, and only those that hold a needed rank come to the driver (two for
    each quantile). A small input is aggregated at once.
    """
    if is_small(df):
        got = df.agg(F.percentile(F.col(column).cast("double"), F.array(*[F.lit(q) for q in at]))).first()[0]
        return got if got is not None else [None] * len(at)
    return ranged_quantiles(df, column, at)


def ranged_quantiles(df: DataFrame, column: str, at: list[float]) -> list[float | None]:
    """The quantiles of an input of any size."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("c"))
    rows = in_ranges(counted, ["v"])
    sizes = rows.groupBy("_range").agg(F.sum("c").alias("_n"))
    n = sizes.agg(F.sum("_n")).first()[0]
    if not n:
        return [None] * len(at)
    upto = F.sum("c").over(Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("_upto", upto).join(F.broadcast(_before(sizes, "_n")), "_range").withColumn("_end", F.col("_upto") + F.col("_lift"))
    exact = [q * (n - 1) for q in at]
    ranks = sorted({int(x) for x in exact} | {min(int(x) + 1, n - 1) for x in exact})
    wanted = F.exists(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("c")))
    got = [(r["v"], r["_end"] - r["c"], r["_end"]) for r in placed.filter(wanted).collect()]
    value = {r: next(v for v, a, b in got if a <= r < b) for r in ranks}
    return [value[int(x)] + (value[min(int(x) + 1, n - 1)] - value[int(x)]) * (x - int(x)) for x in exact]
