"""Distributed global ordering helpers.

``row_number()`` over a window without ``partitionBy`` moves every row into
one task.  These helpers give the same answers with the work spread out:
the rows are range-partitioned on the order key (a sampled ``RangePartitioner``,
as ``orderBy`` uses), each range is numbered locally, and only one row per
range (a table whose size is bounded by the partition count) is combined into
offsets.  The ranged table is checkpointed to the shared checkpoint folder
so that a lost executor cannot re-sample different range bounds between the
branches that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engage.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _ranged(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """Range-partition on ``order``, sort inside each range, tag each row with
    its range id and local index, and checkpoint the result."""
    ensure_checkpoint_dir(df.sparkSession)
    out = (df.repartitionByRange(_parts(df, n), *order)
             .sortWithinPartitions(*order)
             .withColumns({
                 "_rid": F.spark_partition_id(),
                 # monotonically_increasing_id = (partition id << 33) + record number
                 "_loc": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)),
             }))
    return out.checkpoint(eager=True)


def with_global_position(df: DataFrame, order: list[Column], name: str = "pos",
                         n: int | None = None) -> DataFrame:
    """Add a 1-based position in ``order`` (ties broken by the sort, so the
    caller passes a total order).  Equivalent to ``row_number() over (order
    by ...)`` without a single-task window."""
    r = _ranged(df, order, n)
    sizes = r.groupBy("_rid").agg(F.count("*").alias("_n"))
    offs = sizes.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # ``offs`` has one row per range partition: a bounded broadcast.
    return (r.join(F.broadcast(offs.select("_rid", "_off")), "_rid")
             .withColumn(name, (F.col("_off") + F.col("_loc") + 1).cast("long"))
             .drop("_rid", "_loc", "_off"))


def with_prefix_sums(df: DataFrame, order_col: str, cols: list[str],
                     n: int | None = None) -> DataFrame:
    """For each row add ``<c>_before``: the sum of ``c`` over all rows that
    come strictly earlier in ``order_col`` order (``order_col`` unique)."""
    r = _ranged(df, [F.col(order_col)], n)
    sums = r.groupBy("_rid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    prev = Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select("_rid", *[F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0))
                                 .alias(f"_o_{c}") for c in cols])
    local = Window.partitionBy("_rid").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, -1)
    out = r.join(F.broadcast(offs), "_rid")
    for c in cols:
        out = out.withColumn(f"{c}_before",
                             F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(local), F.lit(0)))
    return out.drop("_rid", "_loc", *[f"_o_{c}" for c in cols])
