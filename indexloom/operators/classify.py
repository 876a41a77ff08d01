"""Which observations are of which item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import CLASSIFIED, cols


def keyword_flag(name: Column, keywords: Column) -> Column:
    """1 if the name is *not* the item: it is null, has no word, or has one of the keywords as a whole word; else 0.

    Words are runs of letters, digits and underscores, lower-cased; keywords must be lower-cased. Without keywords only null
    and wordless names are flagged. No lambdas: Spark doesn't run equal plans with them only once.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(name, F.lit(""))), r"\W+"), "")
    return F.when((F.size(words) == 0) | F.coalesce(F.arrays_overlap(words, keywords), F.lit(False)), 1).otherwise(0)


def classify_names(df: DataFrame, keywords: Sequence[str], name: str = "product_name") -> DataFrame:
    words = F.array(*[F.lower(F.lit(k)) for k in keywords]) if keywords else F.array().cast("array<string>")
    return df.withColumn("classified", keyword_flag(F.col(name), words))


def classify_web(tables: Mapping[str, DataFrame], mapper: DataFrame, active: bool, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(all rows with flags, rows of the item). ``tables``: item -> observations; ``mapper``: (item, keyword)."""
    every = reduce(DataFrame.unionByName, [t.withColumn("item", F.lit(item)) for item, t in tables.items()])
    if not active:
        flagged = every.withColumn("classified", F.lit(0))
    else:
        # Keywords are a list by item typed in by hand; one array per item is small.
        words = mapper.where("keyword IS NOT NULL AND keyword <> ''").groupBy("item").agg(F.collect_set(F.lower("keyword")).alias("keywords"))
        none = F.array().cast("array<string>")
        flagged = every.join(F.broadcast(words), "item", "left").withColumn("classified", keyword_flag(F.col("product_name"), F.coalesce("keywords", none))).drop("keywords")
    return flagged, flagged.where("classified = 0").select(*cols(columns))


def classify_scanner(df: DataFrame, mapper: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Items by retailer category. A category of several items gives a row for each; categories without one go.

    The mapper is broadcast: it is bounded by the retailers' categories, and observations stay where they are.
    """
    known = mapper.select("retailer_category_id", "item").dropna().dropDuplicates()
    return df.join(F.broadcast(known), "retailer_category_id").select(*cols(columns))


def for_analysis(spark: SparkSession, flagged: DataFrame | None, group_cols: Sequence[str]) -> DataFrame:
    """Group columns, month and flag of web-scraped rows, or an empty table."""
    if flagged is None:
        return spark.createDataFrame([], CLASSIFIED).select(*group_cols, "month", "classified")
    return flagged.select(*group_cols, "month", "classified")


def classify(spark: SparkSession, preprocessed: Mapping, keywords: DataFrame | None, categories: DataFrame | None, active: bool, group_cols: Sequence[str], more: Sequence[str] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(flags for analysis, observations by data source, with the columns ``more`` too)."""
    columns = [*group_cols, "month", "product_id", "price", "quantity", *more]
    items: dict[str, DataFrame] = {}
    flagged = None
    for source, suppliers in preprocessed.items():
        if source == "web_scraped":
            parts = [classify_web(tables, keywords, active, columns) for tables in suppliers.values()]
            flagged = reduce(DataFrame.unionByName, [f.select(*group_cols, "month", "classified") for f, _ in parts])
            items[source] = reduce(DataFrame.unionByName, [x for _, x in parts])
        elif source == "scanner":
            items[source] = reduce(DataFrame.unionByName, [classify_scanner(t, categories, columns) for t in suppliers.values()])
        else:
            raise ValueError(f"data source {source} can't be classified")
    return for_analysis(spark, flagged, group_cols), items
