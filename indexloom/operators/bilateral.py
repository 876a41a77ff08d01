"""Indices between all pairs of months, and the multilateral methods made of them.

Bilateral tables have group columns, base_month, month, index_value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import cols, month_index, on_every_month, one_row_per_product


def _ratio(x: Column, y: Column) -> Column:
    return F.try_divide(F.sum(x), F.sum(y))


def _formulas() -> dict[str, Column]:
    p0, q0, p1, q1 = (F.col(c) for c in ("p0", "q0", "p1", "q1"))
    ln, v0, v1 = F.log(F.try_divide(p1, p0)), p0 * q0, p1 * q1
    laspeyres, paasche = _ratio(p1 * q0, p0 * q0), _ratio(p1 * q1, p0 * q1)
    return {
        "jevons": F.exp(F.avg(ln)),
        "laspeyres": laspeyres,
        "paasche": paasche,
        "fisher": F.sqrt(laspeyres * paasche),
        "tornqvist": F.exp(0.5 * (_ratio(v0 * ln, v0) + _ratio(v1 * ln, v1))),
    }


def bilateral(df: DataFrame, group_cols: Sequence[str], *formulas: str, forward: bool = False) -> DataFrame:
    """One column per formula for each pair of months with matched products, from one self-join by product.

    Both sides of the join and the aggregation before it share one partitioning by (group, product). With ``forward``
    only pairs whose base isn't the later month, which is all that multilateral methods read and half the rows.
    """
    rows = one_row_per_product(df, group_cols)
    keys = [*group_cols, "product_id"]
    left = rows.select(*cols(keys), F.col("month").alias("base_month"), F.col("price").alias("p0"), F.col("quantity").alias("q0"))
    right = rows.select(*cols(keys), "month", F.col("price").alias("p1"), F.col("quantity").alias("q1"))
    known = _formulas()
    pairs = left.join(right, keys)
    if forward:
        pairs = pairs.where("base_month <= month")
    return pairs.groupBy(*group_cols, "base_month", "month").agg(*[known[f].alias(f) for f in formulas])


def _one(df: DataFrame, group_cols: Sequence[str], formula: str, same: bool, forward: bool) -> DataFrame:
    out = bilateral(df, group_cols, formula, forward=forward).withColumnRenamed(formula, "index_value").where("index_value IS NOT NULL")
    return out if same else out.where("base_month <> month")


def jevons_bilateral(df: DataFrame, group_cols: Sequence[str], forward: bool = False) -> DataFrame:
    """Geometric mean of price relatives, for months that differ."""
    return _one(df, group_cols, "jevons", False, forward)


def laspeyres_bilateral(df: DataFrame, group_cols: Sequence[str], forward: bool = False) -> DataFrame:
    return _one(df, group_cols, "laspeyres", True, forward)


def paasche_bilateral(df: DataFrame, group_cols: Sequence[str], forward: bool = False) -> DataFrame:
    return _one(df, group_cols, "paasche", True, forward)


def fisher_bilateral(df: DataFrame, group_cols: Sequence[str], forward: bool = False) -> DataFrame:
    return _one(df, group_cols, "fisher", True, forward)


def tornqvist_bilateral(df: DataFrame, group_cols: Sequence[str], forward: bool = False) -> DataFrame:
    return _one(df, group_cols, "tornqvist", True, forward)


def _numbered_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs with a and b, the months' numbers, and ln; the months).

    Pairs are a small table (groups times months squared) that is read several times from here on, so it is kept once it
    is computed; ``spark.catalog.clearCache()`` or its owner's end gives it back.
    """
    pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
    months = month_index(pairs, "base_month", "month")
    a = months.select(F.col("t").alias("a"), F.col("month").alias("base_month"))
    b = months.select(F.col("t").alias("b"), "month")
    return pairs.join(F.broadcast(a), "base_month").join(F.broadcast(b), "month").withColumn("ln", F.log("index_value")), months


def geks(pairs: DataFrame, group_cols: Sequence[str], strict: bool = False) -> DataFrame:
    """Expanding-window GEKS: the geometric mean of direct and indirect comparisons with the first month over earlier months.

    GEKS(t) = [prod_{l=1..t} P(0,l) * prod_{l=0..t-1} P(l,t)]^(1/(t+1)), GEKS(0) = 1. A missing comparison counts as 1;
    with ``strict`` the month is null instead.
    """
    rows, months = _numbered_pairs(pairs)
    grid = on_every_month(rows.select(*cols(group_cols)).distinct(), months)
    from_first = rows.where("a = 0 AND b > 0").select(*cols(group_cols), F.col("b").alias("t"), F.col("ln").alias("first"))
    to_month = rows.where("a < b").groupBy(*group_cols, F.col("b").alias("t")).agg(F.sum("ln").alias("to_month"), F.count("ln").alias("n"))
    every = grid.join(from_first, [*group_cols, "t"], "left").join(to_month, [*group_cols, "t"], "left")
    w = Window.partitionBy(*group_cols).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.sum("first").over(w), F.lit(0.0)) + F.coalesce("to_month", F.lit(0.0))
    value = F.exp(total / (F.col("t") + 1))
    if strict:
        value = F.when((F.count("first").over(w) == F.col("t")) & (F.coalesce("n", F.lit(0)) == F.col("t")), value)
    return every.select(*cols(group_cols), "month", value.alias("index_value"))


def rygeks(pairs: DataFrame, group_cols: Sequence[str], window: int, exponent: int | None = None, strict: bool = False) -> DataFrame:
    """Rolling-window GEKS: GEKS over the first ``window`` months, then linked on month by month.

    The link at t is [prod_{l=t-window+1..t-2} P(l,t)/P(l,t-1) * P(t-1,t)^2]^(1/exponent); ``exponent`` is the window
    unless given. A missing comparison counts as 1; with ``strict`` a month with one, and all after it, are null.
    """
    if window < 2:
        raise ValueError("the window needs two months at least")
    rows, months = _numbered_pairs(pairs)
    start = geks(pairs, group_cols, strict).join(F.broadcast(months), "month").where(F.col("t") < window)
    terms = rows.where("a < b").select(
        *cols(group_cols),
        F.explode(
            F.array(
                F.struct(F.col("b").alias("t"), F.when(F.col("a") == F.col("b") - 1, 2 * F.col("ln")).otherwise(F.col("ln")).alias("x"), F.lit(0).alias("near")),
                F.struct((F.col("b") + 1).alias("t"), (-F.col("ln")).alias("x"), F.lit(1).alias("near")),
            )
        ).alias("s"),
        "a",
    )
    # P(l,t) for l from t-window+1 to t-1, and P(l,t-1) for l from t-window+1 to t-2
    inside = terms.where((F.col("a") >= F.col("s.t") - (window - 1)) & (F.col("a") <= F.col("s.t") - 1 - F.col("s.near")) & (F.col("s.t") >= window))
    links = inside.groupBy(*group_cols, F.col("s.t").alias("t")).agg(F.sum("s.x").alias("x"), F.count("s.x").alias("n"))
    grid = on_every_month(rows.select(*cols(group_cols)).distinct(), months.where(F.col("t") >= window))
    power = F.lit(exponent or window)
    x = F.coalesce(F.col("x"), F.lit(0.0)) / power
    if strict:
        x = F.when(F.coalesce("n", F.lit(0)) == 2 * window - 3, x)
    later = grid.join(links, [*group_cols, "t"], "left").select(*cols(group_cols), "month", "t", x.alias("x"))
    splice = start.where(F.col("t") == window - 1).select(*cols(group_cols), "month", "t", F.log("index_value").alias("x"))
    w = Window.partitionBy(*group_cols).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    whole = splice.unionByName(later).withColumn("sum", F.sum("x").over(w)).withColumn("gaps", F.count_if(F.col("x").isNull()).over(w))
    rest = whole.where(F.col("t") >= window).select(*cols(group_cols), "month", F.when(F.col("gaps") == 0, F.exp("sum")).alias("index_value"))
    return start.select(*cols(group_cols), "month", "index_value").unionByName(rest)
