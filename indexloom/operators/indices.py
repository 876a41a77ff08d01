"""Index methods by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bilateral, fixed_base, geary_khamis


def _geks(pairs: Callable, df: DataFrame, group_cols: Sequence[str], **_) -> DataFrame:
    return bilateral.geks(pairs(df, group_cols, forward=True), group_cols)


def _rygeks(pairs: Callable, df: DataFrame, group_cols: Sequence[str], window: int = 13, exponent: int | None = None, **_) -> DataFrame:
    return bilateral.rygeks(pairs(df, group_cols, forward=True), group_cols, window, exponent)


def _plain(method: Callable, df: DataFrame, group_cols: Sequence[str], **_) -> DataFrame:
    return method(df, group_cols)


def _gk(df: DataFrame, group_cols: Sequence[str], all_periods: bool = True, tolerance: float = 1e-5, **_) -> DataFrame:
    return geary_khamis.geary_khamis(df, group_cols, all_periods, tolerance)


METHODS: dict[str, Callable[..., DataFrame]] = {
    "carli_fixed_base": partial(_plain, fixed_base.carli_fixed_base),
    "carli_chained": partial(_plain, fixed_base.carli_chained),
    "dutot_fixed_base": partial(_plain, fixed_base.dutot_fixed_base),
    "dutot_chained": partial(_plain, fixed_base.dutot_chained),
    "jevons_fixed_base": partial(_plain, fixed_base.jevons_fixed_base),
    "jevons_chained": partial(_plain, fixed_base.jevons_chained),
    "geks_jevons": partial(_geks, bilateral.jevons_bilateral),
    "rygeks_jevons": partial(_rygeks, bilateral.jevons_bilateral),
    "laspeyres_fixed_base": partial(_plain, fixed_base.laspeyres_fixed_base),
    "geks_laspeyres": partial(_geks, bilateral.laspeyres_bilateral),
    "rygeks_laspeyres": partial(_rygeks, bilateral.laspeyres_bilateral),
    "geks_paasche": partial(_geks, bilateral.paasche_bilateral),
    "rygeks_paasche": partial(_rygeks, bilateral.paasche_bilateral),
    "rygeks_fisher": partial(_rygeks, bilateral.fisher_bilateral),
    "tornqvist_fixed_base": partial(_plain, fixed_base.tornqvist_fixed_base),
    "geks_tornqvist": partial(_geks, bilateral.tornqvist_bilateral),
    "rygeks_tornqvist": partial(_rygeks, bilateral.tornqvist_bilateral),
    "geary_khamis": _gk,
}


def indices(df: DataFrame, group_cols: Sequence[str], methods: Sequence[str], **params) -> DataFrame:
    """Group columns, index_method, month, index_value of the chosen methods, in long form.

    ``params``: window and exponent of rolling windows, all_periods and tolerance of Geary-Khamis.
    """
    for m in methods:
        if m not in METHODS:
            raise ValueError(f"unknown index method {m}")
    parts = [METHODS[m](df, group_cols, **params).select(*group_cols, F.lit(m).alias("index_method"), "month", "index_value") for m in methods]
    return reduce(DataFrame.unionByName, parts)
