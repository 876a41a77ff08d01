"""Indices against the first observed month and chains of month-to-month links.

All take long observations (group columns, product_id, month, price, quantity) and return group columns, month,
index_value. The base is the first month of the whole table; links join consecutive observed months of the table.
Products are matched: only those of both months count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import cols, exp, ln, month_index, numbered, on_every_month, one_row_per_product


def _input(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return numbered(one_row_per_product(df, group_cols))


def _matched(df: DataFrame, group_cols: Sequence[str], chained: bool) -> DataFrame:
    """Rows with their product's price and quantity in the base month, or in the observed month before, as p0 and q0."""
    keys = [*group_cols, "product_id"]
    if chained:
        before = df.select(*cols(keys), (F.col("t") + 1).alias("t"), F.col("price").alias("p0"), F.col("quantity").alias("q0"))
        return df.join(before, [*keys, "t"])
    base = df.where("t = 0").select(*cols(keys), F.col("price").alias("p0"), F.col("quantity").alias("q0"))
    return df.join(base, keys)


def _by_month(matched: DataFrame, group_cols: Sequence[str], value: Column, extra: Sequence[str] = ()) -> DataFrame:
    return matched.groupBy(*group_cols, "month", *extra).agg(value.alias("index_value"))


def _carli() -> Column:
    return F.avg(F.try_divide(F.col("price"), F.col("p0")))


def _dutot() -> Column:
    return F.try_divide(F.sum(F.when(F.col("p0").isNotNull(), F.col("price"))), F.sum(F.when(F.col("price").isNotNull(), F.col("p0"))))


def _jevons() -> Column:
    return exp(F.avg(ln(F.try_divide(F.col("price"), F.col("p0")))))


def _laspeyres() -> Column:
    return F.try_divide(F.sum(F.col("price") * F.col("q0")), F.sum(F.col("p0") * F.col("q0")))


def _chain(links: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Running product of links; a null link has no value but doesn't stop the chain."""
    w = Window.partitionBy(*group_cols).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return links.withColumn("index_value", F.when(F.col("index_value").isNotNull(), F.product("index_value").over(w)))


def _fixed(df: DataFrame, group_cols: Sequence[str], value: Column) -> DataFrame:
    """No row for a month without matched products."""
    return _by_month(_matched(_input(df, group_cols), group_cols, False), group_cols, value).where("index_value IS NOT NULL")


def _fixed_on_grid(df: DataFrame, group_cols: Sequence[str], value: Column) -> DataFrame:
    """A null for a month without matched products, 1 in the base month; groups without a base product are left out."""
    rows = _input(df, group_cols)
    months = month_index(df)
    grid = on_every_month(rows.where("t = 0").select(*cols(group_cols)).distinct(), months)
    values = _by_month(_matched(rows, group_cols, False), group_cols, value)
    return grid.join(values, [*group_cols, "month"], "left").select(*cols(group_cols), "month", F.when(F.col("t") == 0, 1.0).otherwise(F.col("index_value")).alias("index_value"))


def _chained(df: DataFrame, group_cols: Sequence[str], value: Column) -> DataFrame:
    """1 in the first month for groups that have a link; no row for a month without one."""
    links = _by_month(_matched(_input(df, group_cols), group_cols, True), group_cols, value).where("index_value IS NOT NULL")
    first = month_index(df).where("t = 0").select("month")
    start = links.select(*cols(group_cols)).distinct().select(*cols(group_cols), first.scalar().alias("month"), F.lit(1.0).alias("index_value"))
    return _chain(start.unionByName(links), group_cols).select(*cols(group_cols), "month", "index_value")


def carli_fixed_base(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Mean of price relatives to the base month."""
    return _fixed(df, group_cols, _carli())


def carli_chained(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Product of means of price relatives to the month before."""
    return _chained(df, group_cols, _carli())


def dutot_fixed_base(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Sum of prices over sum of base prices."""
    return _fixed_on_grid(df, group_cols, _dutot())


def dutot_chained(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Product of ratios of price sums to the month before, for all groups and months."""
    rows = _input(df, group_cols)
    links = _by_month(_matched(rows, group_cols, True), group_cols, _dutot())
    grid = on_every_month(rows.select(*cols(group_cols)).distinct(), month_index(df))
    every = grid.join(links, [*group_cols, "month"], "left").withColumn("index_value", F.when(F.col("t") == 0, 1.0).otherwise(F.col("index_value")))
    return _chain(every, group_cols).select(*cols(group_cols), "month", "index_value")


def jevons_fixed_base(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Geometric mean of price relatives to the base month."""
    return _fixed(df, group_cols, _jevons())


def jevons_chained(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Product of geometric means of price relatives to the month before."""
    return _chained(df, group_cols, _jevons())


def laspeyres_fixed_base(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Cost of the base month's quantities at the month's prices over their cost at base prices."""
    return _fixed_on_grid(df, group_cols, _laspeyres())


def tornqvist_fixed_base(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Geometric mean of price relatives by the mean of both months' expenditure shares among the matched products."""
    matched = _matched(_input(df, group_cols), group_cols, False)
    v0, v1 = F.col("p0") * F.col("q0"), F.col("price") * F.col("quantity")
    log = F.log(F.try_divide(F.col("price"), F.col("p0")))
    # Shares are taken after matching, so sums of v and of v * log suffice: no window over the matched rows.
    value = F.exp(0.5 * (F.try_divide(F.sum(v0 * log), F.sum(v0)) + F.try_divide(F.sum(v1 * log), F.sum(v1))))
    return _by_month(matched, group_cols, value).where("index_value IS NOT NULL")
