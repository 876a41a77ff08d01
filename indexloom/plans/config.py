"""Scenario parameters and their checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from ..operators import averaging, indices, outliers


class ConfigError(ValueError):
    """A parameter is missing or out of range."""


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigError(what)


@dataclass(frozen=True)
class Outliers:
    active: bool = True
    method: str = "tukey"
    k: float = 1.5
    log_transform: bool = False
    fences: Mapping[str, tuple[float, float]] = field(default_factory=dict)


@dataclass(frozen=True)
class Indices:
    methods: tuple[str, ...] = ("jevons_chained",)
    splice_window_length: int = 13
    splice_exponent: int | None = None
    geary_khamis_all_periods: bool = True
    geary_khamis_convergence_tolerance: float = 1e-5


@dataclass(frozen=True)
class Scenario:
    """All parameters of one run. ``staged_data``: data source -> supplier -> item -> retailer -> weight (web-scraped) or
    data source -> supplier."""

    staged_data: Mapping
    start_date: str
    end_date: str
    drop_retailers: bool = False
    classify: bool = True
    outliers: Outliers = Outliers()
    averaging: Mapping[str, str] = field(default_factory=lambda: {"web_scraped": "weighted_arithmetic", "scanner": "unweighted_arithmetic"})
    grouping: bool = False
    grouping_averaging: Mapping[str, str] = field(default_factory=lambda: {"web_scraped": "weighted_arithmetic", "scanner": "unweighted_arithmetic"})
    impute: bool = True
    ffill_limit: int = 3
    filter: bool = True
    max_cumsum_share: float = 0.8
    indices: Indices = Indices()

    def check(self) -> Scenario:
        """Raises ConfigError at the first parameter that won't do; returns the scenario."""
        _need(bool(self.staged_data), "staged_data is empty")
        for source in self.staged_data:
            _need(source in ("web_scraped", "scanner"), f"data source {source} isn't supported")
        for name in ("start_date", "end_date"):
            try:
                date.fromisoformat(getattr(self, name))
            except (TypeError, ValueError):
                raise ConfigError(f"{name} must be a date as YYYY-MM-DD") from None
        _need(self.start_date <= self.end_date, "start_date is after end_date")
        for name in ("drop_retailers", "classify", "grouping", "impute", "filter"):
            _need(isinstance(getattr(self, name), bool), f"{name} must be True or False")
        o = self.outliers
        _need(isinstance(o.active, bool) and isinstance(o.log_transform, bool), "outliers: active and log_transform must be True or False")
        if o.active:
            _need(o.method in (*outliers.METHODS, "udf_fences"), f"unknown outlier method {o.method}")
            if o.method == "udf_fences":
                _need(bool(o.fences) and all(len(f) == 2 and f[0] <= f[1] for f in o.fences.values()), "fences must be pairs of a lower and an upper price")
            else:
                _need(isinstance(o.k, float) and 1 <= o.k <= 4, "k must be a float from 1 to 4")
        for methods in (self.averaging, self.grouping_averaging):
            for source in self.staged_data:
                _need(methods.get(source) in averaging.METHODS, f"unknown averaging method {methods.get(source)} for {source}")
        if self.impute:
            _need(type(self.ffill_limit) is int and self.ffill_limit > 0, "ffill_limit must be an integer above 0")
        if self.filter:
            _need(isinstance(self.max_cumsum_share, float) and 0 <= self.max_cumsum_share <= 1, "max_cumsum_share must be a float from 0 to 1")
        i = self.indices
        _need(bool(i.methods) and all(m in indices.METHODS for m in i.methods), "unknown index method")
        rolling = any(m.startswith("rygeks") for m in i.methods)
        _need(type(i.splice_window_length) is int and i.splice_window_length > (1 if rolling else 0), "splice_window_length must be an integer above 0, above 1 for rolling windows")
        _need(isinstance(i.geary_khamis_convergence_tolerance, float) and i.geary_khamis_convergence_tolerance > 0, "the tolerance must be a float above 0")
        return self
