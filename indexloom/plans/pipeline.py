"""The chain of stages for one scenario, and runs of several scenarios."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import GROUP_COLS
from ..operators import aggregation, analysis, averaging, classify, filtering, imputation, indices, outliers, preprocess
from ..sources import tables
from .config import Scenario


#: Column of a supplier's own product key: a product's rows meet where rows are dealt out by it, and stay there until they are filled.
_UNIT = "_unit"


def run_scenario(
    spark: SparkSession, staged: Mapping, scenario: Scenario, keywords: DataFrame | None = None, categories: DataFrame | None = None, groups: DataFrame | None = None, group_cols: Sequence[str] = GROUP_COLS
) -> dict[str, DataFrame]:
    """The eight tables of a scenario, lazily: configuration, classified, inliers_outliers, imputed_flagged, expenditure,
    filtered, low_level_indices, item_indices.

    Only the filtered observations are persisted: every index method reads them.
    """
    scenario.check()
    by = list(group_cols)
    clean = preprocess.preprocess(staged, scenario.start_date, scenario.end_date, scenario.staged_data.get("web_scraped"), scenario.drop_retailers, _UNIT)
    classified, items = classify.classify(spark, clean, keywords, categories, scenario.classify, by, [_UNIT])
    o = scenario.outliers
    fences = outliers.fences_table(spark, o.fences) if o.method == "udf_fences" else None
    flagged, averaged = [], []
    for source, df in items.items():
        with_flags, inliers = outliers.split_outliers(outliers.find_outliers(df, [*by, "month"], o.method, o.k, fences, o.log_transform, o.active))
        # Grouped products have rows of several units.
        if scenario.grouping:
            one = averaging.average(inliers, by, scenario.averaging[source])
            averaged.append(averaging.add_grouped(one, by, groups, scenario.grouping_averaging[source]))
        else:
            averaged.append(averaging.average(inliers, [*by, _UNIT], scenario.averaging[source]))
        flagged.append(with_flags.drop(_UNIT))
    inliers_outliers = reduce(DataFrame.unionByName, flagged)
    rows = reduce(DataFrame.unionByName, averaged)
    dealt = ["_stretch"] if scenario.impute else []
    imputed, rows = imputation.impute(rows, by, scenario.impute, scenario.ffill_limit, [] if scenario.grouping else [_UNIT], *dealt)
    expenditure, filtered = (t.drop(*dealt) for t in filtering.filter_expenditure(rows, [*by, *dealt, "month"], scenario.filter, scenario.max_cumsum_share))
    filtered = filtered.persist(StorageLevel.MEMORY_AND_DISK)
    i = scenario.indices
    low = indices.indices(filtered, by, i.methods, window=i.splice_window_length, exponent=i.splice_exponent, all_periods=i.geary_khamis_all_periods, tolerance=i.geary_khamis_convergence_tolerance)
    web = scenario.staged_data.get("web_scraped")
    weights = aggregation.weights_table(spark, web) if web else None
    return {
        "configuration": tables.configuration_table(spark, asdict(scenario)),
        "classified": classified,
        "inliers_outliers": inliers_outliers,
        "imputed_flagged": imputed,
        "expenditure": expenditure,
        "filtered": filtered,
        "low_level_indices": low,
        "item_indices": aggregation.item_indices(low, by, weights),
    }


def union_scenarios(results: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """Each table of all scenarios in one, with the scenario's name after its first underscore in ``scenario``."""
    names = list(dict.fromkeys(t for tables_ in results.values() for t in tables_))
    tag = lambda s, t: results[s][t].withColumn("scenario", F.lit(s.partition("_")[2] or s))
    return {t: reduce(DataFrame.unionByName, [tag(s, t) for s in results if t in results[s]]) for t in names}


def run(
    spark: SparkSession, scenarios: Mapping[str, Scenario], staged_root: str, keywords: DataFrame | None = None, categories: DataFrame | None = None, groups: DataFrame | None = None,
    output_root: str | None = None, user: str = "user", n_bins: int = 30,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables of all scenarios with their analysis, seconds by scenario and stage). Writes them if there is an output root."""
    results, times = {}, []
    for scenario in scenarios.values():
        scenario.check()
    for name, scenario in scenarios.items():
        began = time.time()
        staged = tables.read_staged(spark, staged_root, scenario.staged_data)
        results[name] = run_scenario(spark, staged, scenario, keywords, categories, groups)
        times.append((name, "plan", time.time() - began))
    every = union_scenarios(results)
    began = time.time()
    every["analysis"] = analysis.analyse(every, [*GROUP_COLS, "scenario"], n_bins)
    times.append(("all", "analysis", time.time() - began))
    if output_root:
        began = time.time()
        tables.write_outputs(every, output_root, tables.run_id(user))
        times.append(("all", "write", time.time() - began))
    return every, spark.createDataFrame(times, "scenario string, stage string, seconds double")
