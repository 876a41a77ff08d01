"""Geary-Khamis multilateral indices."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schema import cols, one_row_per_product
from ..sources import tables

#: Moves below this share of the largest index are rounding, whatever the tolerance.
ROUNDING = 1e-13


def fixed_point(p: np.ndarray, q: np.ndarray, month: np.ndarray, product: np.ndarray, tolerance: float) -> np.ndarray:
    """Index by month number of one group's observations, whose first month is 0.

    Reference prices v_i = sum_t q_it / q_i * p_it / P_t and P_t = (V_t / V_0) / (Q_t / Q_0) with Q_t = sum_i v_i q_it,
    from P = 1 until no index moves by more than ``tolerance``, however many rounds that takes. 1/P is multiplied by one
    matrix with a positive diagonal, so that ends; values that overflow are an error.
    """
    n_months, n_products = month.max() + 1, product.max() + 1
    share = q / np.bincount(product, q, n_products)[product]
    value = np.bincount(month, p * q, n_months)
    index = np.ones(n_months)
    while True:
        v = np.bincount(product, share * p / index[month], n_products)
        volume = np.bincount(month, v[product] * q, n_months)
        new = value / value[0] / (volume / volume[0])
        if not np.isfinite(new).all():
            raise ArithmeticError("Geary-Khamis: an index is not finite")
        done = np.abs(new - index).max() <= max(tolerance, ROUNDING * new.max())
        index = new
        if done:
            return index


def _schema(df: DataFrame, group_cols: Sequence[str], *more: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {types[c]}" for c in group_cols), *more])


def geary_khamis(df: DataFrame, group_cols: Sequence[str], all_periods: bool = True, tolerance: float = 1e-5) -> DataFrame:
    """Group columns, month, index_value; the base is each group's own first month.

    With ``all_periods`` a month's index is the last of the run over the months up to it, so it is never revised; else
    one run over all months. A group's observations (months times products) are one pandas frame: groups are what one
    index is for, so they are bounded by its sample, and iteration needs them together.
    """
    rows = one_row_per_product(df, group_cols).where("price > 0 AND quantity > 0")

    def run(g: pd.DataFrame) -> pd.DataFrame:
        months, t = np.unique(g["month"].to_numpy(), return_inverse=True)
        p, q = g["price"].to_numpy(float), g["quantity"].to_numpy(float)
        i = pd.factorize(g["product_id"])[0]
        if all_periods:
            index = [fixed_point(p[m], q[m], t[m], pd.factorize(i[m])[0], tolerance)[-1] for m in (t <= k for k in range(len(months)))]
        else:
            index = fixed_point(p, q, t, i, tolerance)
        out = pd.DataFrame({"month": months, "index_value": index})
        for c in group_cols:
            out.insert(0, c, g[c].iloc[0])
        return out[[*group_cols, "month", "index_value"]]

    return rows.groupBy(*group_cols).applyInPandas(run, _schema(df, group_cols, "month date", "index_value double"))


def append_back_series(new: DataFrame, back: DataFrame | None, group_cols: Sequence[str]) -> DataFrame:
    """Each group's last index of ``new`` put into the series so far; of one month the new value stays."""
    w = Window.partitionBy(*group_cols).orderBy(F.desc("month"))
    last = new.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    if back is None:
        return last
    keys = [*group_cols, "month"]
    return back.join(last.select(*cols(keys)), keys, "left_anti").unionByName(last)


def update_back_series(spark: SparkSession, new: DataFrame, path: str, group_cols: Sequence[str]) -> DataFrame:
    """The back series stored as CSV under ``path`` (none yet: empty), with each group's last index of ``new``, stored again.

    The merged series is written beside the old one and takes its place when it is whole.
    """
    back = tables.read_series(spark, path, _schema(new, group_cols, "month date", "index_value double"))
    tables.replace_series(spark, append_back_series(new.select(*group_cols, "month", "index_value"), back, group_cols), path)
    return tables.read_series(spark, path, _schema(new, group_cols, "month date", "index_value double"))
