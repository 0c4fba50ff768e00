"""Exact ranking totals without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.measures import divide

# Slices per doubling of the value: a slice spans about one percent.
_SLICES = 64


def top_shares(frame: DataFrame, value: str, shares: dict[str, float]) -> DataFrame:
    """Share of the total held by the top ceil(p * n) rows (at least one), for each p.

    Equal values are counted together, values are grouped into narrow slices,
    the slices (a few thousand at most) are ranked first, and rows are ranked
    only inside their slice.  Ties cannot change a sum, so the result is exact.
    """
    values = (
        frame.where(F.col(value) > 0)
        .groupBy(F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slice", F.floor(F.log2(F.col("_value").cast("double")) * _SLICES))
    )
    everything = Window.partitionBy()
    above = Window.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        values.groupBy("_slice")
        .agg(F.sum("_n").alias("_rows"), F.sum(F.col("_value") * F.col("_n")).alias("_sum"))
        .select(
            "_slice",
            F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows_above"),
            F.sum("_rows").over(everything).alias("_all_rows"),
            F.sum("_sum").over(everything).alias("_total"),
        )
    )
    inside = (
        Window.partitionBy("_slice").orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = values.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(slices, "_slice")
    before = F.col("_rows_above") + F.col("_before")

    def held(p: float):
        wanted = F.greatest(F.lit(1), F.ceil(F.col("_all_rows") * F.lit(p).cast("decimal(9,6)")))
        taken = F.greatest(F.lit(0), F.least(F.col("_n"), wanted.cast("bigint") - before))
        return F.sum(F.col("_value") * taken)

    return placed.agg(
        *(divide(held(p), F.max("_total")).alias(name) for name, p in shares.items()),
        F.max("_total").alias("total"),
    )


def rank_in_slices(frame: DataFrame, group: list[str], piece: Column, order: list[str]) -> DataFrame:
    """Add ``_rank`` (1-based position in the group) and ``_group_rows``.

    ``piece`` cuts a group into bounded many slices that follow ``order``.  Only
    slice sizes are ranked across a group; rows are ranked inside their slice.
    """
    sliced = frame.withColumn("_slice", piece)
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        sliced.groupBy(*group, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *group,
            "_slice",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_n").over(whole).alias("_group_rows"),
        )
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    return (
        sliced.join(sizes, [*group, "_slice"])
        .withColumn("_rank", F.col("_offset") + F.row_number().over(inside))
        .drop("_offset", "_slice")
    )
