"""Canonical schemas and small column helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

# Schemas as DDL, which readers and createDataFrame take.

OBSERVATION = "data_source string, supplier string, item string, retailer string, product_id string, month date, price double, quantity double"
WEB_STAGED = "remotekey string, retailer string, price string, price_inc_offer string, collection_date_of_price string, product_name string"
SCANNER_STAGED = "department_code string, section_code string, sub_section_code string, consumer_unit_id string, sales_value_vat_excl_markdowns double, number_sold double, week_commencing_date string"
CLASSIFIED = "data_source string, supplier string, item string, retailer string, month date, classified int"
INDEX = "data_source string, supplier string, item string, retailer string, index_method string, month date, index_value double"
ITEM_INDEX = "item string, index_method string, month date, index_value double"
CONFIGURATION = "stage string, params string"

GROUP_COLS = ("data_source", "supplier", "item", "retailer")


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


# Geometric means of single prices with a 5 in the seventh place are rounded by their last bits, and so are prices that lie
# on a fence told apart. Java's logarithm differs there from the C library's, which SQL and Arrow use (numpy has its own).


def ln(x: Column | str) -> Column:
    """Null for what isn't above 0, like Spark's."""

    def ln(x: pa.Array) -> pa.Array:
        return pc.ln(pc.if_else(pc.less_equal(x, 0.0), None, x))

    return F.arrow_udf(ln, "double")(x)


def exp(x: Column | str) -> Column:
    def exp(x: pa.Array) -> pa.Array:
        return pc.exp(x)

    return F.arrow_udf(exp, "double")(x)


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def month_index(df: DataFrame, *names: str) -> DataFrame:
    """(month, t): the observed months, numbered from 0 in order. Months are few by the calendar, so one row gathers them."""
    names = names or ("month",)
    every = df.select(F.explode(F.array_distinct(F.array(*names))).alias("month")) if len(names) > 1 else df.select(F.col(names[0]).alias("month"))
    ordered = every.agg(F.array_sort(F.collect_set("month")).alias("months"))
    return ordered.select(F.posexplode("months").alias("t", "month"))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with t, its month's place among the observed months."""
    return df.join(F.broadcast(month_index(df)), "month")


def on_every_month(groups: DataFrame, months: DataFrame) -> DataFrame:
    """Each group (one row each) with each month: the grid that keeps unmatched months."""
    every = months.agg(F.array_sort(F.collect_set(F.struct("t", "month"))).alias("m"))
    return groups.select("*", F.explode(every.scalar()).alias("m")).select(*groups.columns, "m.t", "m.month")


def one_row_per_product(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Price and quantity summed by group, product and month, dealt out by product.

    Partitioning by (group, product) first serves this aggregation and every later join or window on those keys.
    """
    keys = [*group_cols, "product_id"]
    return df.repartition(*cols(keys)).groupBy(*keys, "month").agg(F.sum("price").alias("price"), F.sum("quantity").alias("quantity"))


def with_group_figures(df: DataFrame, group_cols: Sequence[str], **figures: Column) -> DataFrame:
    """``df`` with each group's aggregates as columns.

    Figures are aggregated before they are shuffled and joined back, so no group is gathered or sorted in one task; they
    are few, one row per group, and are broadcast, so the rows stay where they are. A null key is a group like others.
    """
    return _beside(df, group_cols, _grouped(df, group_cols).agg(*[f.alias(n) for n, f in figures.items()]))


def with_group_quantiles(df: DataFrame, group_cols: Sequence[str], column: str, fractions: Sequence[float], into: str) -> DataFrame:
    """``df`` with the array ``into`` of each group's quantiles: the least value that at least that share of the values reaches.

    They are exact, unlike percentile_approx, which is off by ranks once a group has some 5,000 rows. Values are shuffled once,
    by group, and counted there, so of a group only the distinct values and their counts are sorted in one task. Counting
    them before would shuffle twice, and takes away few rows where prices hardly repeat within a task's share of a group.
    Nulls aren't counted; a group without values has a null.
    """
    values = df.where(F.col(column).isNotNull()).select(*[F.col(c).alias(k) for k, c in zip(_keys(group_cols), group_cols, strict=True)], F.col(column).alias("_x"))
    counted = values.repartition(*cols(_keys(group_cols))).groupBy(*_keys(group_cols), "_x").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*_keys(group_cols))
    upto = whole.orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.select("*", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(whole).alias("_all"))
    reached = [F.min(F.when(F.col("_upto") >= F.col("_all") * F.lit(p), F.col("_x"))) for p in fractions]
    return _beside(df, group_cols, ranked.groupBy(*_keys(group_cols)).agg(F.array(*reached).alias(into)))


def _keys(group_cols: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(group_cols))]


def _grouped(df: DataFrame, group_cols: Sequence[str]) -> GroupedData:
    """``df`` by group, with keys of other names than its own."""
    return df.groupBy(*[F.col(c).alias(k) for k, c in zip(_keys(group_cols), group_cols, strict=True)])


def _beside(df: DataFrame, group_cols: Sequence[str], few: DataFrame) -> DataFrame:
    """``df`` with the other columns of ``few``, one row per group under ``_keys``."""
    keys = _keys(group_cols)
    return df.join(F.broadcast(few), reduce(and_, [F.col(c).eqNullSafe(F.col(k)) for k, c in zip(keys, group_cols, strict=True)]), "left").drop(*keys)


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide to long; null cells stay."""
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def product_by_month(df: DataFrame, group_cols: Sequence[str], column: str, months: Sequence[str] | None = None) -> DataFrame:
    """One row per group and product, one column per month with the sum of ``column``. For display: the engine stays long."""
    pivot = df.withColumn("month", F.date_format("month", "yyyy-MM-dd")).groupBy(*group_cols, "product_id")
    return (pivot.pivot("month", list(months)) if months else pivot.pivot("month")).sum(column)


def find(key: str, nested) -> list:
    """All values of ``key`` in nested dicts and lists, in order."""
    out = []
    if isinstance(nested, dict):
        for k, v in nested.items():
            if k == key:
                out.append(v)
            else:
                out += find(key, v)
    elif isinstance(nested, (list, tuple)):
        for v in nested:
            out += find(key, v)
    return out


def nested_values(nested) -> list:
    """The leaves of nested dicts, in order."""
    if not isinstance(nested, dict):
        return [nested]
    return [x for v in nested.values() for x in nested_values(v)]
