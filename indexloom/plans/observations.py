"""The driver's tables as price observations.

A line item is a quote: price = extended price / quantity, item = part type, retailer = supplier's nation. Products are
parts, or part brands within a type where denser series are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ["item"]

SQL = """
quotes AS (
  SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part, p_name AS product_name, p_type AS item, n_name AS retailer, p_brand || '_' || p_type AS product_id,
    CAST(l_shipdate AS DATE) AS date, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_extendedprice / nullif(l_quantity, 0) AS price, l_quantity AS quantity, l_extendedprice AS sales,
    CAST(n_regionkey AS VARCHAR) AS department, CAST(n_nationkey AS VARCHAR) AS section, CAST(p_size AS VARCHAR) AS sub_section
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
series AS (
  SELECT item, product_id, month, sum(price * quantity) / sum(quantity) AS price, sum(quantity) AS quantity FROM quotes GROUP BY ALL),
parts AS (
  SELECT item, part AS product_id, month, sum(price * quantity) / sum(quantity) AS price, sum(quantity) AS quantity FROM quotes GROUP BY ALL)
"""


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item. Parts are joined plainly, and their join deals line items out by ``part``.

    Suppliers are broadcast with their nation's number alone, some 24 bytes each, and the nations by themselves: shuffling all
    line items by supplier too would write them to disk once more.
    """
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part"), F.col("p_name").alias("product_name"), F.col("p_type").alias("item"), F.concat_ws("_", "p_brand", "p_type").alias("product_id"), F.col("p_size").cast("string").alias("sub_section"))
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("retailer"), F.col("n_regionkey").cast("string").alias("department"), F.col("n_nationkey").cast("string").alias("section"))
    shop = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    line = _read(spark, sf_dir, "lineitem").withColumn("part", F.col("l_partkey").cast("string")).join(part, "part")
    line = line.join(F.broadcast(shop), F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return line.select(
        "l_orderkey", "l_linenumber", "part", "product_name", "item", "retailer", "product_id", F.col("l_shipdate").cast("date").alias("date"),
        F.trunc("l_shipdate", "month").alias("month"), F.try_divide("l_extendedprice", "l_quantity").alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("sales"), "department", "section", "sub_section",
    )


def _averaged(df: DataFrame, product: str) -> DataFrame:
    from ..operators.averaging import weighted_arithmetic

    return weighted_arithmetic(df.withColumn("product_id", F.col(product)), ["item", "month", "product_id"])


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands within a type by month: nearly every cell is there."""
    return _averaged(quotes(spark, sf_dir), "product_id")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by month: sparse series."""
    return _averaged(quotes(spark, sf_dir), "part")


def web_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes(spark, sf_dir)
    return q.select(F.col("part").alias("remotekey"), "retailer", F.col("sales").alias("price"), F.col("price").alias("price_inc_offer"), F.col("date").cast("string").alias("collection_date_of_price"), "product_name", "item")


def scanner_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes(spark, sf_dir)
    return q.select(
        F.col("department").alias("department_code"), F.col("section").alias("section_code"), F.col("sub_section").alias("sub_section_code"), F.col("part").alias("consumer_unit_id"),
        F.col("sales").alias("sales_value_vat_excl_markdowns"), F.col("quantity").alias("number_sold"), F.date_trunc("week", "date").cast("date").cast("string").alias("week_commencing_date"),
    )
