"""Products that make up most of a group's expenditure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _leading(x: Column) -> Column:
    """``x`` to its 40 leading bits: what differs by the order of additions only becomes equal."""
    wide = x * float(2**13 + 1)
    return wide - (wide - x)


def expenditure(df: DataFrame, group_cols: Sequence[str], max_cumsum_share: float) -> DataFrame:
    """Sales, group sales, share, running share and filtered (0: stays).

    Shares run from the largest, ties by product; shares are ties if 40 bits agree, as the order in which a product's
    rows are added mustn't decide. A product stays if the running share isn't over the limit, or if its
    own share reaches it; the one that crosses the limit goes.
    """
    whole = Window.partitionBy(*group_cols)
    running = whole.orderBy(_leading(F.col("share")).desc(), "product_id").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("sales", F.col("price") * F.col("quantity")).withColumn("sum_sales", F.sum("sales").over(whole))
    df = df.withColumn("share", F.try_divide(F.col("sales"), F.col("sum_sales"))).withColumn("cumsum_share", F.sum("share").over(running))
    stays = (F.col("cumsum_share") <= max_cumsum_share) | (F.col("share") >= max_cumsum_share)
    return df.withColumn("filtered", F.when(stays, 0).otherwise(1))


def filter_expenditure(df: DataFrame, group_cols: Sequence[str], active: bool, max_cumsum_share: float) -> tuple[DataFrame, DataFrame]:
    """(all rows with figures, rows that stay). Inactive: figures are there, all rows stay."""
    info = expenditure(df, group_cols, max_cumsum_share)
    if not active:
        info = info.withColumn("filtered", F.lit(0))
    return info, info.where("filtered = 0").drop("sales", "sum_sales", "share", "cumsum_share", "filtered")
