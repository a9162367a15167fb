"""Whole-table positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skilltide.session import saved

_ROW_BITS = 33  # monotonically_increasing_id keeps the row of a partition in the low 33 bits


def global_position(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Add the 1-based rank of each row in ``order``, which must be a total order.

    Rows are range-partitioned and sorted, then saved with their partition and row number:
    range bounds come from a sample, so both uses below must read the same split. Only the
    row count per partition is ranked in one task. Columns of ``df`` are saved with it, so pass
    keys and join wide columns back.
    """
    mid = F.col("_mid")
    placed = saved(
        df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "positions"
    )
    placed = placed.withColumns(
        {
            "_part": F.shiftright(mid, _ROW_BITS),
            "_row": mid.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    # One row per partition of the sort: bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_mid", "_part", "_row", "_before")
    )
