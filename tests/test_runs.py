"""Sources, sinks, parameters and whole runs."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from indexloom.functions import schema
from indexloom.operators import aggregation, analysis, geary_khamis
from indexloom.plans import observations, pipeline
from indexloom.plans.config import ConfigError, Indices, Outliers, Scenario
from indexloom.sources import tables

SF = "/root/testdata/sf0.001"
WEB = {"web_scraped": {"supplier_1": {"ECONOMY": {"NATION_1": 0.5}, "SMALL": {}}}}
BASE = Scenario(staged_data=WEB | {"scanner": {"supplier_2": None}}, start_date="1995-01-01", end_date="1995-05-01", indices=Indices(methods=("jevons_chained", "dutot_fixed_base"), splice_window_length=3))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staged"))
    web = observations.web_staged(spark, SF)
    for item in ("ECONOMY", "SMALL"):
        rows = web.where(web["item"] == item).drop("item")
        rows.select(*[rows[c].cast("string") for c in rows.columns]).select("remotekey", "retailer", "price", "price_inc_offer", "collection_date_of_price", "product_name").write.parquet(f"{root}/web_scraped/supplier_1/{item}.parquet")
    observations.scanner_staged(spark, SF).write.parquet(f"{root}/scanner/supplier_2")
    return root


def test_run_of_two_scenarios(spark, staged, tmp_path):
    keywords = spark.createDataFrame([("ECONOMY", "ring"), ("SMALL", "old")], "item string, keyword string")
    scanner = observations.scanner_staged(spark, SF)
    categories = scanner.selectExpr("concat(department_code, section_code, sub_section_code) AS retailer_category_id", "concat('item_', department_code) AS item").distinct()
    second = replace(BASE, outliers=Outliers(method="ksigma", k=2.0, log_transform=True), impute=False, filter=False, classify=False, averaging={"web_scraped": "unweighted_geometric", "scanner": "weighted_geometric"})
    every, times = pipeline.run(spark, {"scenario_1": BASE, "scenario_2": second}, staged, keywords, categories, output_root=str(tmp_path), user="me")
    assert set(every) == {"configuration", "classified", "inliers_outliers", "imputed_flagged", "expenditure", "filtered", "low_level_indices", "item_indices", "analysis"}
    written = tables.list_files(spark, str(tmp_path), recursive=True)
    low = spark.read.parquet(next(p for p in written if p.endswith("low_level_indices")))
    assert {r["scenario"] for r in low.select("scenario").distinct().collect()} == {"1", "2"}
    assert {r["index_method"] for r in low.select("index_method").distinct().collect()} == set(BASE.indices.methods)
    stats = spark.read.csv(next(p for p in written if p.endswith("/analysis")), header=True)
    assert {r["table"] for r in stats.select("table").distinct().collect()} == {"sample_count", "churn", "price_stats", "classification", "outlier_detection", "imputation", "filtering", "low_level_indices", "item_indices", "distributions"}
    assert stats.where("metric IS NULL").count() == 0
    assert times.count() >= 3
    one = {"scenario": "1", "item": "ECONOMY"}
    assert analysis.series_by_metric(stats, "price_stats", ["min", "max"], **one).count() > 0
    assert analysis.series_by_scenario(stats, "price_stats", "min", ["1", "2"], item="ECONOMY").select("scenario").distinct().count() == 2
    assert analysis.series_by_retailer(stats, "price_stats", "min", ["x"], **one).count() == 0
    shares = analysis.distribution_by_month(stats, ["1995-03-01"], True, **one)
    assert abs(sum(r["value"] for r in shares.collect()) - 1) < 1e-9
    assert analysis.distribution_by_retailer(stats, [r["retailer"] for r in stats.select("retailer").distinct().collect()], **one).count() > 0
    assert analysis.distribution_by_scenario(stats, ["2"], item="ECONOMY").count() > 0


@pytest.mark.parametrize(
    "change",
    [
        {"staged_data": {}}, {"staged_data": {"conventional": {}}}, {"start_date": "1995-13-01"}, {"start_date": "1996-01-01"}, {"impute": 1}, {"ffill_limit": 0}, {"max_cumsum_share": 1.5}, {"max_cumsum_share": 1},
        {"outliers": Outliers(method="none")}, {"outliers": Outliers(k=5.0)}, {"outliers": Outliers(k=2)}, {"outliers": Outliers(method="udf_fences")}, {"averaging": {"web_scraped": "mean", "scanner": "weighted_arithmetic"}},
        {"indices": Indices(methods=("none",))}, {"indices": Indices(methods=("rygeks_fisher",), splice_window_length=1)}, {"indices": Indices(geary_khamis_convergence_tolerance=0.0)},
    ],
)
def test_wrong_parameters(change):
    BASE.check()
    with pytest.raises(ConfigError):
        replace(BASE, **change).check()


def test_files(spark, tmp_path):
    (tmp_path / "Key_Words.csv").write_text('tea,rye\n"green, black",bread\n,loaf\n')
    got = sorted((r["item"], r["keyword"]) for r in tables.read_keywords(spark, str(tmp_path / "Key_Words.csv")).collect())
    assert got == [("rye", "bread"), ("rye", "loaf"), ("tea", "green, black")]
    (tmp_path / "cat.csv").write_text("retailer_category_id,item\n01,tea\n01,tea\n02,\n")
    assert [tuple(r) for r in tables.read_categories(spark, str(tmp_path / "cat.csv")).collect()] == [("01", "tea")]
    (tmp_path / "none.csv").write_text("a,b\n")
    assert tables.read_csv(spark, str(tmp_path / "none.csv")) is None
    assert tables.read_csv(spark, str(tmp_path / "cat.csv")).count() == 3
    spark.createDataFrame([("p", "g"), ("q", None)], "product_id string, group_id string").write.parquet(str(tmp_path / "groups"))
    assert tables.read_groups(spark, str(tmp_path / "groups")).count() == 1
    (tmp_path / "run.log").write_text("one\ntwo\r\n")
    assert [r["value"] for r in tables.read_lines(spark, str(tmp_path / "run.log")).collect()] == ["one", "two"]
    tables.log_to_csv(spark, str(tmp_path / "run.log"), str(tmp_path / "log_csv"))
    assert spark.read.csv(str(tmp_path / "log_csv"), header=True).columns == ["msg"] and not (tmp_path / "run.log").exists()
    assert [p.rpartition("/")[2] for p in tables.list_files(spark, str(tmp_path), ["key", "CSV"])] == ["Key_Words.csv"]
    assert tables.run_id("me", datetime(2020, 1, 2, 3, 4, 5)) == "20200102_030405_me"


def test_rows_to_pandas():
    df = tables.rows_to_pandas([["1", "a"], [""], ["2", "b"]], ["x", "y"], {"x": int, "y": str.upper})
    assert df.to_dict("list") == {"x": [1, 2], "y": ["A", "B"]}
    assert tables.rows_to_pandas([["1"]], ["x", "y"]).empty


def test_hive_style_tables(spark):
    tables.save_table(spark.createDataFrame([(1, date(2020, 1, 1))], "a int, m date"), "indexloom_t")
    assert tables.read_table(spark, "indexloom_t").count() == 1
    spark.sql("DROP TABLE indexloom_t")


def test_find_in_configuration(spark):
    assert schema.find("NATION_1", WEB) == [0.5]
    rows = {r["stage"]: r["params"] for r in tables.configuration_table(spark, {"filter": True, "k": {"x": 1}}).collect()}
    assert rows == {"filter": "true", "k": '{"x": 1}'}


def test_back_series(spark, tmp_path):
    """The last index of each run is kept; earlier ones are never revised, a month that comes again is."""
    path = str(tmp_path / "back")
    schema = "item string, month date, index_value double"
    months = [date(2020, m, 1) for m in (1, 2, 3)]
    first = spark.createDataFrame([("a", months[0], 1.0), ("a", months[1], 1.25), ("b", months[0], 1.0)], schema)
    got = geary_khamis.update_back_series(spark, first, path, ["item"])
    assert sorted(map(tuple, got.collect())) == [("a", months[1], 1.25), ("b", months[0], 1.0)]
    second = spark.createDataFrame([("a", months[1], 9.0), ("a", months[2], 1.5), ("b", months[0], 0.5)], schema)
    got = geary_khamis.update_back_series(spark, second, path, ["item"])
    assert sorted(map(tuple, got.collect())) == [("a", months[1], 1.25), ("a", months[2], 1.5), ("b", months[0], 0.5)]


def test_hierarchy_from_tables(spark):
    """Items under two nodes under a top node, over two periods; old weights are those of the period before."""
    node = lambda c: ("i", "b", c)
    weights = [(p, 2, *node("top"), 1, *node(c), w) for p, c, w in ((1, "x", 60.0), (1, "y", 40.0), (2, "x", 50.0), (2, "y", 50.0))]
    names = ["parent_indicator", "parent_basis", "parent_cpa21"], ["child_indicator", "child_basis", "child_cpa21"]
    spark.createDataFrame(weights, ["period", "parent_level", *names[0], "child_level", *names[1], "weight"]).write.mode("overwrite").saveAsTable("h_weights")
    items = [(p, *node(c), n, v, w) for p, c, n, v, w in ((1, "x", "x1", 100.0, 70.0), (1, "x", "x2", 110.0, 30.0), (2, "x", "x1", 120.0, 50.0), (2, "x", "x2", 130.0, 50.0), (1, "y", "y1", 100.0, 100.0), (2, "y", "y1", 90.0, 100.0))]
    frame = spark.createDataFrame(items, ["period", "indicator", "basis", "cpa21", "item_no", "imputed_price_relative", "rescaled_weight"])
    frame.write.mode("overwrite").saveAsTable("h_items")
    frame.withColumnRenamed("imputed_price_relative", "imputed_price_relative_oldwgts").write.mode("overwrite").saveAsTable("h_old")
    got = {(r["node"], r["period"]): r for r in aggregation.aggregate_tables(spark, "h_weights", "h_items", "h_old", "h_out", 2).collect()}
    assert [got["i/b/x", 1]["raw"], got["i/b/x", 2]["raw"], got["i/b/top", 1]["raw"], got["i/b/top", 2]["raw"]] == pytest.approx([103, 125, 0.6 * 103 + 40, 62.5 + 45])
    assert [got["i/b/x", 2]["oldwgts"], got["i/b/top", 2]["oldwgts"]] == pytest.approx([0.7 * 120 + 0.3 * 130, 0.6 * 123 + 0.4 * 90])
    top, item = got["i/b/top", 2], got["x1", 1]
    assert (top["level"], top["indicator"], top["basis"], top["cpa21"]) == (2, "i", "b", "top") and (item["level"], item["indicator"], item["raw"]) == (0, None, 100.0)
    for t in ("h_weights", "h_items", "h_old", "h_out"):
        spark.sql(f"DROP TABLE {t}")
