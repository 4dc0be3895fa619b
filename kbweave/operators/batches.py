"""Numbering of rows in a global order, and batches of a fixed size, without one task for all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbered(rows: DataFrame, order: list[str], keep: Callable[[DataFrame], DataFrame], out: str = "place") -> DataFrame:
    """rows with their place (from 0) in the order of some columns, which should decide it fully.

    Rows are dealt out by ranges of the order and stored by `keep`; a range's rows are numbered where they lie, after the number of rows in the ranges before it.
    """
    dealt = keep(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("n"))
    before = sizes.select("__range", F.coalesce(F.sum("n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return dealt.join(F.broadcast(before), "__range").withColumn(out, F.col("__before") + own - 1).drop("__range", "__before")


def batched(rows: DataFrame, order: list[str], size: int, keep: Callable[[DataFrame], DataFrame], usual: int = 200, out: str = "batch") -> DataFrame:
    """rows with the number of their batch of `size` rows in order; a size below one is replaced by the usual one."""
    return numbered(rows, order, keep, "__place").withColumn(out, F.floor(F.col("__place") / (size if size > 0 else usual))).drop("__place")
