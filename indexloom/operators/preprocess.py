"""Staged supplier tables to price observations."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import month_of


def _within(df: DataFrame, date: Column, start: str, end: str) -> DataFrame:
    """Rows whose month lies from ``start``'s to ``end``'s month. A plain range on the date, so that scans can skip by it."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where((date >= first) & (date <= F.last_day(last)) & (month_of(date) >= first) & (month_of(date) <= last))


def web_scraped(df: DataFrame, start: str, end: str, *, unit: str | None = None) -> DataFrame:
    """Web-scraped quotes: offer price, quantity 1, one row per product, retailer, date and price.

    The product is remotekey and retailer together (null if either is). Prices that are no number or not above 0 go, as
    do rows with a null in any column that stays. ``unit`` names a column that keeps remotekey.
    """
    # Product and retailer tell the remotekey; with it, rows dealt out by remotekey are where they need to be.
    more = ["remotekey"] if unit else []
    date = F.col("collection_date_of_price").try_cast("date")
    out = _within(df.withColumn("date", date), F.col("date"), start, end).select(
        "retailer",
        F.concat("remotekey", F.lit("_item_"), "retailer").alias("product_id"),
        "product_name",
        "date",
        F.col("price_inc_offer").try_cast("double").alias("price"),
        F.lit(1.0).alias("quantity"),
        *more,
    )
    out = out.where("price > 0").dropna(subset=["retailer", "product_id", "date", "price"]).dropDuplicates([*more, "product_id", "retailer", "date", "price"])
    out = out.withColumn("month", month_of(F.col("date"))).drop("date")
    return out.withColumnRenamed("remotekey", unit) if unit else out


def scanner(df: DataFrame, start: str, end: str, retailer: str = "retailer_1", week_days: int = 7, *, unit: str | None = None) -> DataFrame:
    """Weekly scanner sales: unit price, weeks that straddle two months left out.

    A week counts if the day ``week_days`` after its first lies in the same month. Rows with nothing sold, a price or
    quantity not above 0, or a null in any column that stays go. ``unit`` names a column that keeps consumer_unit_id.
    """
    date = F.col("week_commencing_date").try_cast("date")
    category = F.concat("department_code", "section_code", "sub_section_code")
    out = _within(df.withColumn("date", date), F.col("date"), start, end).where(month_of(F.col("date")) == month_of(F.date_add("date", week_days)))
    out = out.withColumn("retailer", F.lit(retailer)).withColumn("retailer_category_id", category)
    out = (
        out.select(
            "retailer",
            "retailer_category_id",
            F.concat_ws("_", "consumer_unit_id", "retailer_category_id", "retailer").alias("product_id"),
            F.try_divide(F.col("sales_value_vat_excl_markdowns").try_cast("double"), F.col("number_sold").try_cast("double")).alias("price"),
            F.col("number_sold").try_cast("double").alias("quantity"),
            month_of(F.col("date")).alias("month"),
            F.col("consumer_unit_id").alias(unit or "unit"),
        )
        .where("price > 0 AND quantity > 0")
        .dropna()
    )
    return out if unit else out.drop("unit")


#: By supplier; the web-scraped ones are staged per item.
SUPPLIERS: dict[str, Callable[..., DataFrame]] = {"supplier_1": web_scraped, "supplier_2": scanner}


def preprocess(staged: Mapping, start: str, end: str, weights: Mapping | None = None, drop_retailers: bool = False, unit: str | None = None) -> dict:
    """Applies each supplier's function to ``staged``: data source -> supplier [-> item] -> table.

    With ``drop_retailers``, web-scraped retailers of weight 0 (``weights``: supplier -> item -> retailer) go.
    ``unit`` names a column for the supplier's own product key, by which a product's rows can be dealt out once.
    """
    out: dict = {}
    for source, suppliers in staged.items():
        out[source] = {}
        for supplier, tables in suppliers.items():
            if supplier not in SUPPLIERS:
                raise ValueError(f"no preprocessing for {supplier}")
            tag = {"data_source": F.lit(source), "supplier": F.lit(supplier)}
            if not isinstance(tables, Mapping):
                out[source][supplier] = SUPPLIERS[supplier](tables, start, end, unit=unit).withColumns(tag)
                continue
            out[source][supplier] = {}
            for item, table in tables.items():
                done = SUPPLIERS[supplier](table, start, end, unit=unit)
                if drop_retailers:
                    none = [r for r, w in ((weights or {}).get(supplier, {}).get(item) or {}).items() if w == 0]
                    done = done.where(~F.col("retailer").isin(none)) if none else done
                out[source][supplier][item] = done.withColumns(tag)
    return out
