"""Outlier flags: 1 outside the fences of the group, 0 inside or on them, null if undecidable."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import ln, with_group_figures, with_group_quantiles


def _flag(x: Column, low: Column, high: Column) -> Column:
    return F.when((x < low) | (x > high), 1).when((x >= low) & (x <= high), 0).cast("int")


def ksigma(df: DataFrame, group_cols: Sequence[str], column: str = "price", k: float = 2.0, into: str = "outlier") -> DataFrame:
    """Mean of the group plus and minus k sample standard deviations; null for groups of one."""
    m, s = F.col("_f.m"), F.col("_f.s")
    figures = with_group_figures(df, group_cols, _f=F.struct(F.mean(column).alias("m"), F.stddev(column).alias("s")))
    return figures.withColumn(into, _flag(F.col(column), m - k * s, m + k * s)).drop("_f")


def _by_quartiles(df: DataFrame, group_cols: Sequence[str], column: str, fences: Callable[[Column, Column, Column], tuple[Column, Column]], into: str) -> DataFrame:
    """Flags by the fences that ``fences`` makes of each group's exact quartiles."""
    low, high = fences(*[F.col("_f")[i] for i in range(3)])
    return with_group_quantiles(df, group_cols, column, [0.25, 0.5, 0.75], "_f").withColumn(into, _flag(F.col(column), low, high)).drop("_f")


def tukey(df: DataFrame, group_cols: Sequence[str], column: str = "price", k: float = 1.5, into: str = "outlier") -> DataFrame:
    """k interquartile ranges below the first and above the third quartile."""
    return _by_quartiles(df, group_cols, column, lambda q1, _, q3: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)), into)


def kimber(df: DataFrame, group_cols: Sequence[str], column: str = "price", k: float = 1.5, into: str = "outlier") -> DataFrame:
    """k half ranges: median less first quartile below it, third quartile less median above that."""
    return _by_quartiles(df, group_cols, column, lambda q1, q2, q3: (q1 - k * (q2 - q1), q3 + k * (q3 - q2)), into)


def fences_table(spark: SparkSession, fences: Mapping[str, Sequence[float]]) -> DataFrame:
    return spark.createDataFrame([(item, float(a), float(b)) for item, (a, b) in fences.items()], "item string, low double, high double")


def fixed_fences(df: DataFrame, fences: DataFrame, column: str = "price", into: str = "outlier") -> DataFrame:
    """Fences given by item; null for items without."""
    return df.join(fences, "item", "left").withColumn(into, _flag(F.col(column), F.col("low"), F.col("high"))).drop("low", "high")


METHODS = {"ksigma": ksigma, "tukey": tukey, "kimber": kimber}


def find_outliers(df: DataFrame, group_cols: Sequence[str], method: str, k: float = 1.5, fences: DataFrame | None = None, log_transform: bool = False, active: bool = True) -> DataFrame:
    """``df`` with outlier. ``log_transform`` compares logarithms of prices, except with given fences."""
    if not active:
        return df.withColumn("outlier", F.lit(0))
    if method == "udf_fences":
        return fixed_fences(df, fences)
    if method not in METHODS:
        raise ValueError(f"unknown outlier method {method}")
    if not log_transform:
        return METHODS[method](df, group_cols, "price", k)
    return METHODS[method](df.withColumn("_log", ln("price")), group_cols, "_log", k).drop("_log")


def split_outliers(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all flagged rows, inliers). Rows that couldn't be decided are no inliers."""
    return df, df.where("outlier = 0").drop("outlier")
