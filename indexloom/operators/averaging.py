"""One price and quantity per group, and products grouped into broader ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import exp, ln


def _weighted(x: Column) -> Column:
    return F.try_divide(F.sum(x * F.col("quantity")), F.sum("quantity"))


def weighted_arithmetic(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(_weighted(F.col("price")).alias("price"), F.sum("quantity").cast("double").alias("quantity"))


def weighted_geometric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(_weighted(ln("price")).alias("price"), F.sum("quantity").cast("double").alias("quantity")).withColumn("price", exp("price"))


def unweighted_arithmetic(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quantities become 1."""
    return df.groupBy(*keys).agg(F.avg("price").alias("price")).withColumn("quantity", F.lit(1.0))


def unweighted_geometric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quantities become 1."""
    return df.groupBy(*keys).agg(F.avg(ln("price")).alias("price")).withColumn("price", exp("price")).withColumn("quantity", F.lit(1.0))


METHODS = {
    "weighted_arithmetic": weighted_arithmetic,
    "weighted_geometric": weighted_geometric,
    "unweighted_arithmetic": unweighted_arithmetic,
    "unweighted_geometric": unweighted_geometric,
}


def average(df: DataFrame, group_cols: Sequence[str], method: str) -> DataFrame:
    """By group, month and product."""
    if method not in METHODS:
        raise ValueError(f"unknown averaging method {method}")
    return METHODS[method](df, [*group_cols, "month", "product_id"])


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join, also of a table with one made from it; null keys never match."""
    return left.join(right.select([F.col(c).alias(c) for c in right.columns]), list(keys), "left")


def add_grouped(df: DataFrame, group_cols: Sequence[str], mapper: DataFrame, method: str) -> DataFrame:
    """``df`` and, for products in ``mapper`` (product_id, group_id), averages over each group under item + "_grouped"."""
    known = mapper.select("product_id", "group_id").dropna()
    merged = df.join(known, "product_id").withColumn("product_id", F.col("group_id")).withColumn("item", F.concat("item", F.lit("_grouped")))
    columns = [*group_cols, "month", "product_id", "price", "quantity"]
    return df.select(columns).unionByName(average(merged, group_cols, method).dropna().select(columns))
