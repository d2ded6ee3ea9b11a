"""Dense surrogate keys (1, 2, 3, ...) in a total order, without a single-task window.

A global ``row_number() OVER (ORDER BY ...)`` moves every row into one task.
``dense_key`` numbers rows the way a distributed sort does:

1. range-partition on the full order (the sampled bounds split even a day or a
   region that holds a third of all rows over many tasks, because the order is
   total) and sort inside each partition;
2. checkpoint that once into the session's reliable checkpoint folder, so the
   partition contents and the row positions are fixed even if an executor is lost
   and a stage is recomputed;
3. count rows per partition; the counts (one number per partition, a bound set
   by the caller) reach the driver, and each row's key is its partition's
   running offset plus its position inside the partition: a narrow projection,
   no join and no second shuffle.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from .sizing import small_side


# Where rows come in groups that are small by nature (an hour holds a row per region and
# type), ``grouped_key`` does without the range sort: it counts rows per group, turns the
# counts into offsets, and numbers rows inside their group.


def _order_column(c: str | Column, descending: bool = False) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last() if descending else col.asc_nulls_first()


def dense_key_counted(
    df: DataFrame,
    order: list[str | Column],
    name: str = "key",
    partitions: int | None = None,
    descending: bool = False,
) -> tuple[DataFrame, int]:
    """``dense_key`` plus the number of rows (known for free from the offsets)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [_order_column(c, descending) for c in order]
    # Without an explicit count the range exchange has spark.sql.shuffle.partitions
    # partitions and AQE may merge neighbours; merged ranges stay contiguous, so
    # the order across partitions holds either way.
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ordered = spread.sortWithinPartitions(*keys).checkpoint(eager=True)
    sizes = dict(
        (r[0], r[1])
        for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1))).collect()
    )
    parts = ordered.rdd.getNumPartitions()
    counts = [sizes.get(p, 0) for p in range(parts)]
    starts = [0, *accumulate(counts)][:-1]
    pid = F.spark_partition_id()
    # monotonically_increasing_id = (partition id << 33) + row index inside the partition;
    # the offsets are one array literal indexed by partition id (O(1) per row).
    within = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    if parts:
        offsets = F.lit(starts).cast("array<bigint>")
        key = (F.element_at(offsets, pid + 1) + within + 1).cast("long")
    else:
        key = F.lit(None).cast("long")
    return ordered.select(key.alias(name), *[F.col(c) for c in df.columns]), sum(counts)


def dense_key(
    df: DataFrame,
    order: list[str | Column],
    name: str = "key",
    partitions: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``name`` (bigint) = position of the row in ``order`` (ascending, nulls first).

    ``order`` must be a total order (add tie-break columns); with ties the
    numbering among equal rows is arbitrary, as with any row_number.
    """
    return dense_key_counted(df, order, name, partitions, descending)[0]


def group_offsets(counts: DataFrame, group: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(group, before): rows in all earlier groups, from (group, n_rows); ``group`` is a timestamp.
    Columns to ``keep`` are carried along.

    Running sums inside each day, plus the running sum of the days' totals: the
    rows that meet in one task are one per day.
    """
    days = counts.select(group, "n_rows", F.to_date(group).alias("_day"), *keep)
    until = (Window.unboundedPreceding, 0)
    within = F.sum("n_rows").over(Window.partitionBy("_day").orderBy(group).rowsBetween(*until)) - F.col("n_rows")
    totals = days.groupBy("_day").agg(F.sum("n_rows").alias("_n"))
    starts = totals.select("_day", (F.sum("_n").over(Window.orderBy("_day").rowsBetween(*until)) - F.col("_n")).alias("_start"))
    return days.withColumn("_within", within).join(starts, "_day").select(group, (F.col("_start") + F.col("_within")).alias("before"), *keep)


def number_in_group(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``name`` (bigint): 1, 2, ... inside each value of ``group`` by ``order`` (nulls first)."""
    by = Window.partitionBy(group).orderBy(*[_order_column(c) for c in order])
    return df.withColumn(name, F.row_number().over(by).cast("long"))


def grouped_key(df: DataFrame, group: str, order: list[str], name: str = "key") -> DataFrame:
    """``dense_key`` by (``group``, ``order``) for groups that are small by nature.

    ``df`` is evaluated once: its rows are stored in the shared scratch folder. The counts
    read one column of them, the result numbers them inside their group and adds the
    offsets, a row per group. ``group`` must not be null.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "grouped")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    counts = stored.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
    offsets = small_side(group_offsets(counts, group))
    numbered = number_in_group(stored, group, order, "_seq")
    key = (F.col("before") + F.col("_seq")).cast("long")
    return numbered.join(offsets, group).select(key.alias(name), *[F.col(c) for c in df.columns])
