"""Indices above the group: items, the hierarchy of weights, and chain linking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schema import cols
from ..sources import tables


def weights_table(spark: SparkSession, weights: Mapping) -> DataFrame:
    """supplier -> item -> retailer -> weight as a table for web-scraped data."""
    rows = [("web_scraped", s, i, r, float(w)) for s, items in weights.items() for i, retailers in items.items() for r, w in (retailers or {}).items()]
    return spark.createDataFrame(rows, "data_source string, supplier string, item string, retailer string, weight double")


def item_indices(indices: DataFrame, group_cols: Sequence[str], weights: DataFrame | None = None, normalise: bool = False) -> DataFrame:
    """Weighted sum of group indices by item, method and month; groups without a weight count with 1.

    With ``normalise`` divided by the sum of the weights that have an index. Months without any index are null.
    """
    if weights is None:
        rows = indices.withColumn("weight", F.lit(1.0))
    else:
        rows = indices.join(weights, list(group_cols), "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    total = F.sum(F.col("weight") * F.col("index_value"))
    if normalise:
        total = F.try_divide(total, F.sum(F.when(F.col("index_value").isNotNull(), F.col("weight"))))
    return rows.groupBy("item", "index_method", "month").agg(total.alias("index_value"))


def node_id(*parts: str):
    return F.concat_ws("/", *parts)


def with_old_weights(weights: DataFrame) -> DataFrame:
    """Weights of the month under kind "raw", and those of the month before under "oldwgts" (null in a pair's first period).

    ``weights``: period, parent_level, parent_id, child_level, child_id, weight.
    """
    w = Window.partitionBy("parent_id", "child_id").orderBy("period")
    old = weights.withColumn("weight", F.lag("weight").over(w))
    return weights.withColumn("kind", F.lit("raw")).unionByName(old.withColumn("kind", F.lit("oldwgts")))


def hierarchy_inputs(index_weights: DataFrame, items: DataFrame, items_old: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(weights, values, levels) of a hierarchy whose nodes go by indicator, basis and cpa21, and whose items by item_no.

    ``index_weights``: period, parent_level, parent_indicator, parent_basis, parent_cpa21, the same of the child, weight.
    ``items``: period, indicator, basis, cpa21 of the node above, item_no, imputed_price_relative, rescaled_weight;
    ``items_old``: the same with imputed_price_relative_oldwgts, by the weights of the month before. Items are level 0
    under level 1. Weights and values have kind "raw" or "oldwgts", so each later step runs once for both.
    """
    above = [f"{side}_{c}" for side in ("parent", "child") for c in ("indicator", "basis", "cpa21")]
    upper = index_weights.select("period", "parent_level", node_id(*above[:3]).alias("parent_id"), "child_level", node_id(*above[3:]).alias("child_id"), "weight")
    lower = items.select("period", F.lit(1).alias("parent_level"), node_id("indicator", "basis", "cpa21").alias("parent_id"), F.lit(0).alias("child_level"), F.col("item_no").alias("child_id"), F.col("rescaled_weight").alias("weight"))
    weights = with_old_weights(upper.unionByName(lower))
    of = lambda df, column, kind: df.select(F.lit(kind).alias("kind"), "period", F.col("item_no").alias("child_id"), F.col(column).alias("value"))
    values = of(items, "imputed_price_relative", "raw").unionByName(of(items_old, "imputed_price_relative_oldwgts", "oldwgts"))
    return weights, values, levels(weights)


def levels(weights: DataFrame) -> DataFrame:
    """Each node and its level."""
    parents = weights.select(F.col("parent_level").alias("level"), F.col("parent_id").alias("node"))
    return parents.union(weights.select("child_level", "child_id")).distinct()


def level_values(values: DataFrame, weights: DataFrame, level: int) -> DataFrame:
    """Values of the nodes of one level: weighted sum of their children over 100."""
    down = weights.where(F.col("parent_level") == level).select("kind", "period", "parent_id", "child_id", "weight")
    joined = down.join(values, ["kind", "period", "child_id"])
    return joined.groupBy("kind", "period", F.col("parent_id").alias("child_id")).agg((F.sum(F.col("value") * F.col("weight")) / 100).alias("value"))


def aggregate_hierarchy(values: DataFrame, weights: DataFrame, n_levels: int) -> DataFrame:
    """``values`` (kind, period, child_id, value) of items and of all nodes above them, level by level.

    A level-1 node without any item has 0. The loop is over the levels of the hierarchy, a handful; each adds a join and
    an aggregation to one lazy plan. The inputs and each level's nodes are read by all levels above, as a node's children
    may be of any, so they are kept once computed; ``spark.catalog.clearCache()`` gives them back.
    """
    values, weights = values.persist(StorageLevel.MEMORY_AND_DISK), weights.persist(StorageLevel.MEMORY_AND_DISK)
    have = level_values(values, weights, 1)
    nodes = weights.where("parent_level = 1").select("kind", "period", F.col("parent_id").alias("child_id")).distinct()
    have = nodes.join(have, ["kind", "period", "child_id"], "left").select("kind", "period", "child_id", F.coalesce("value", F.lit(0.0)).alias("value"))
    every = [values, have.persist(StorageLevel.MEMORY_AND_DISK)]
    for level in range(2, n_levels + 1):
        below = reduce(DataFrame.unionByName, every)
        every.append(level_values(below, weights, level).persist(StorageLevel.MEMORY_AND_DISK))
    return reduce(DataFrame.unionByName, every)


def aggregate_tables(spark: SparkSession, index_weights: str, items: str, items_old: str, output: str, n_levels: int = 7) -> DataFrame:
    """The hierarchy from tables of the metastore to one: inputs, aggregation level by level, output with node parts.

    Returns the output table: level, node, indicator, basis, cpa21 (null for items), period, raw, oldwgts.
    """
    weights, values, node_levels = hierarchy_inputs(*(tables.read_table(spark, t) for t in (index_weights, items, items_old)))
    out = hierarchy_output(aggregate_hierarchy(values, weights, n_levels), node_levels)
    part = lambda i: F.when(F.col("level") > 0, F.get(F.split("node", "/"), F.lit(i)))
    out = out.select("level", "node", part(0).alias("indicator"), part(1).alias("basis"), part(2).alias("cpa21"), "period", "raw", "oldwgts")
    tables.save_table(out, output)
    return tables.read_table(spark, output)


def hierarchy_output(values: DataFrame, node_levels: DataFrame) -> DataFrame:
    """One row per node and period with raw and oldwgts beside each other and the node's level."""
    wide = values.groupBy("child_id", "period").pivot("kind", ["raw", "oldwgts"]).agg(F.first("value"))
    return wide.join(node_levels.withColumnRenamed("node", "child_id"), "child_id", "left").select("level", F.col("child_id").alias("node"), "period", "raw", "oldwgts")


def cumulative_product(df: DataFrame, partition: Sequence[str], order: str, column: str, into: str) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(into, F.product(column).over(w))


def chain_linking(df: DataFrame, keys: Sequence[str], seed: float = 1.0) -> DataFrame:
    """``df`` (keys, period, raw, oldwgts) with linking_factor and linked = raw * linking_factor.

    The factor is ``seed`` in the first period of the table and grows by oldwgts / raw; where that ratio is missing (a
    null or zero) the chain starts again from 1.
    """
    first = df.agg(F.min("period")).scalar()
    nonzero = lambda c: F.when(F.col(c) != 0, F.col(c))
    df = df.withColumn("_r", F.when(F.col("period") == first, F.lit(seed)).otherwise(nonzero("oldwgts") / nonzero("raw")))
    df = cumulative_product(df.withColumn("_f", F.coalesce("_r", F.lit(1.0))), keys, "period", "_f", "_c")
    w = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    at_gap = F.last(F.when(F.col("_r").isNull(), F.col("_c")), ignorenulls=True).over(w)
    df = df.withColumn("linking_factor", F.col("_c") / F.coalesce(at_gap, F.lit(1.0)))
    return df.withColumn("linked", F.col("raw") * F.col("linking_factor")).select(*cols(keys), "period", "raw", "oldwgts", "linking_factor", "linked")
