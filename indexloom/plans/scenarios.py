"""Whole scenarios on the driver's tables, stage by stage, and their SQL: web-scraped quotes of all items beside scanner sales."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, preprocess
from . import observations as obs
from .config import Indices, Outliers, Scenario
from .pipeline import run_scenario, union_scenarios

ITEMS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
#: Retailer weights of web-scraped items; a retailer of weight 0 is dropped.
WEIGHTS = {"supplier_1": {item: {} for item in ITEMS} | {"ECONOMY": {"NATION_1": 0.5, "NATION_2": 0.0}, "SMALL": {"NATION_3": 2.0}}}
KEYWORDS = [("ECONOMY", "Ring"), ("ECONOMY", "old"), ("SMALL", "gizmo"), ("PROMO", "")]
START, END = "1995-01-01", "2001-12-01"
_COMMON = {"staged_data": {"web_scraped": WEIGHTS, "scanner": {"supplier_2": None}}, "start_date": START, "end_date": END, "drop_retailers": True}
SCENARIOS = {
    "scenario_1": Scenario(**_COMMON, indices=Indices(methods=("jevons_fixed_base", "carli_fixed_base"))),
    "scenario_two": Scenario(
        **_COMMON, classify=False, outliers=Outliers(k=2.0, log_transform=True), impute=False, filter=False,
        averaging={"web_scraped": "unweighted_geometric", "scanner": "weighted_geometric"}, indices=Indices(methods=("jevons_fixed_base", "carli_fixed_base")),
    ),
}


def staged(s: SparkSession, d: str) -> dict:
    web = obs.web_staged(s, d)
    return {"web_scraped": {"supplier_1": {item: web.where(F.col("item") == item).drop("item") for item in ITEMS}}, "scanner": {"supplier_2": obs.scanner_staged(s, d)}}


def _mappers(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    category = F.concat("department", "section", "sub_section")
    return s.createDataFrame(KEYWORDS, "item string, keyword string"), obs.quotes(s, d).select(category.alias("retailer_category_id"), F.concat(F.lit("item_"), "department").alias("item")).distinct()


def tables(s: SparkSession, d: str, name: str) -> dict[str, DataFrame]:
    return run_scenario(s, staged(s, d), SCENARIOS[name], *_mappers(s, d))


def preprocessed(s: SparkSession, d: str) -> DataFrame:
    out = preprocess.preprocess(staged(s, d), START, END, WEIGHTS, True)
    web = [t.withColumn("item", F.lit(item)) for item, t in out["web_scraped"]["supplier_1"].items()]
    rows = out["scanner"]["supplier_2"]
    for t in web:
        rows = rows.unionByName(t, allowMissingColumns=True)
    return rows.select("data_source", "supplier", "item", "retailer", "product_id", "price", "quantity", "month")


def classified_items(s: SparkSession, d: str) -> DataFrame:
    by = ["data_source", "supplier", "item", "retailer"]
    _, items = classify.classify(s, preprocess.preprocess(staged(s, d), START, END, WEIGHTS, True), *_mappers(s, d), True, by)
    return items["web_scraped"].unionByName(items["scanner"])


_BY = "data_source, supplier, item, retailer"
_GONE = " AND NOT (item = 'ECONOMY' AND retailer = 'NATION_2')"


def _stages(name: str) -> list[str]:
    """The CTEs of a scenario; those of the stages are named like its tables, after ``name``."""
    first = name == "scenario_1"
    x, k = ("price", 1.5) if first else ("ln(price)", 2.0)
    words = " OR ".join(f"(item = '{i}' AND list_contains(regexp_split_to_array(lower(product_name), '\\W+'), '{w.lower()}'))" for i, w in KEYWORDS if w)
    flag = f"CAST(CASE WHEN {words} THEN 1 ELSE 0 END AS INTEGER)" if first else "CAST(0 AS INTEGER)"
    web_price, scanner_price = ("sum(price * quantity) / sum(quantity)", "avg(price)") if first else ("exp(avg(ln(price)))", "exp(sum(ln(price) * quantity) / sum(quantity))")
    web_quantity, scanner_quantity = ("sum(quantity)", "CAST(1 AS DOUBLE)") if first else ("CAST(1 AS DOUBLE)", "sum(quantity)")
    return [
        f"web AS (SELECT DISTINCT 'web_scraped' AS data_source, 'supplier_1' AS supplier, item, retailer, part || '_item_' || retailer AS product_id, product_name, date, price, CAST(1 AS DOUBLE) AS quantity, month FROM quotes WHERE price > 0{_GONE})",
        "weeks AS (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week, department || section || sub_section AS category FROM quotes)",
        f"""scan AS (SELECT 'scanner' AS data_source, 'supplier_2' AS supplier, 'item_' || department AS item, 'retailer_1' AS retailer, part || '_' || category || '_retailer_1' AS product_id, price, quantity, CAST(date_trunc('month', week) AS DATE) AS month
          FROM weeks WHERE price > 0 AND quantity > 0 AND date_trunc('month', week) = date_trunc('month', week + 7) AND week >= DATE '{START}')""",
        f"classified AS (SELECT *, {flag} AS classified FROM web)",
        f"items AS (SELECT {_BY}, month, product_id, price, quantity FROM classified WHERE classified = 0 UNION ALL SELECT {_BY}, month, product_id, price, quantity FROM scan)",
        f"quarts AS (SELECT *, quantile_disc({x}, 0.25) OVER g AS q1, quantile_disc({x}, 0.75) OVER g AS q3 FROM items WINDOW g AS (PARTITION BY {_BY}, month))",
        f"inliers_outliers AS (SELECT {_BY}, month, product_id, price, quantity, CAST(CASE WHEN {x} < q1 - {k} * (q3 - q1) OR {x} > q3 + {k} * (q3 - q1) THEN 1 ELSE 0 END AS INTEGER) AS outlier FROM quarts)",
        f"""averaged AS MATERIALIZED (SELECT {_BY}, month, product_id, {web_price} AS price, {web_quantity} AS quantity FROM inliers_outliers WHERE outlier = 0 AND data_source = 'web_scraped' GROUP BY {_BY}, month, product_id
          UNION ALL SELECT {_BY}, month, product_id, {scanner_price}, {scanner_quantity} FROM inliers_outliers WHERE outlier = 0 AND data_source = 'scanner' GROUP BY {_BY}, month, product_id)""",
        "amonths AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS t FROM (SELECT DISTINCT month FROM averaged))",
        f"seen AS (SELECT a.*, t, lead(t) OVER (PARTITION BY {_BY}, product_id ORDER BY t) AS next FROM averaged a JOIN amonths USING (month))",
        f"""imputed_flagged AS MATERIALIZED (SELECT {_BY}, product_id, m.month, price, quantity, CAST(m.t > s.t AS INTEGER) AS imputed
          FROM seen s JOIN amonths m ON m.t BETWEEN s.t AND least(coalesce(next - 1, (SELECT max(t) FROM amonths)), s.t + {3 if first else 0}))""",
        f"shares AS (SELECT *, price * quantity AS sales, sum(price * quantity) OVER (PARTITION BY {_BY}, month) AS sum_sales FROM imputed_flagged)",
        "shared AS (SELECT *, sales / nullif(sum_sales, 0) AS share FROM shares)",
        f"summed AS (SELECT *, sum(share) OVER (PARTITION BY {_BY}, month ORDER BY share DESC, product_id ROWS UNBOUNDED PRECEDING) AS cumsum_share FROM shared)",
        f"expenditure AS MATERIALIZED (SELECT *, CAST(CASE WHEN {'cumsum_share <= 0.8 OR share >= 0.8' if first else 'true'} THEN 0 ELSE 1 END AS INTEGER) AS filtered FROM summed)",
        "filtered AS MATERIALIZED (SELECT * FROM expenditure WHERE filtered = 0)",
        f"base AS (SELECT {_BY}, product_id, price AS p0 FROM filtered WHERE month = (SELECT min(month) FROM filtered))",
        f"""low_level_indices AS MATERIALIZED (SELECT {_BY}, unnest(['jevons_fixed_base', 'carli_fixed_base']) AS index_method, month, unnest([j, c]) AS index_value FROM (
          SELECT {_BY}, month, exp(avg(ln(price / p0))) AS j, avg(price / p0) AS c FROM filtered JOIN base USING ({_BY}, product_id) GROUP BY {_BY}, month))""",
        """item_indices AS (SELECT item, index_method, month, sum(index_value * CASE WHEN data_source = 'web_scraped' AND item = 'ECONOMY' AND retailer = 'NATION_1' THEN 0.5 WHEN data_source = 'web_scraped' AND item = 'SMALL' AND retailer = 'NATION_3' THEN 2 ELSE 1 END) AS index_value
          FROM low_level_indices GROUP BY item, index_method, month)""",
    ]


def _sql(name: str, select: str) -> str:
    return f"WITH {', '.join([obs.SQL, *_stages(name)])} {select}"


#: Columns of each table of a scenario that a query shows, doubles apart.
_SHOWN = {
    "classified": ([*_BY.split(", "), "month", "classified"], []),
    "inliers_outliers": ([*_BY.split(", "), "month", "product_id", "outlier"], ["price", "quantity"]),
    "imputed_flagged": ([*_BY.split(", "), "month", "product_id", "imputed"], ["price", "quantity"]),
    "expenditure": ([*_BY.split(", "), "month", "product_id", "filtered"], ["price", "quantity", "sales", "sum_sales", "share", "cumsum_share"]),
    "filtered": ([*_BY.split(", "), "month", "product_id"], ["price", "quantity"]),
    "low_level_indices": ([*_BY.split(", "), "index_method", "month"], ["index_value"]),
    "item_indices": (["item", "index_method", "month"], ["index_value"]),
}


def register(add: Callable[..., None], rounded: Callable[[str, str], str]) -> None:
    """Adds the queries by ``add(name, query, sql)``; ``rounded`` is how SQL rounds a double."""

    def select(table: str, more: str = "") -> str:
        plain, doubles = _SHOWN[table]
        return f"SELECT {', '.join([*plain, *(rounded(c, c) for c in doubles)])}{more} FROM {table}"

    columns = f"{_BY}, product_id, {rounded('price', 'price')}, quantity, month"
    add("preprocess_all", preprocessed, _sql("scenario_1", f"SELECT {columns} FROM web UNION ALL SELECT {columns.replace('item, ', 'NULL AS item, ', 1)} FROM scan"))
    add("classified_items", classified_items, _sql("scenario_1", f"SELECT {_BY}, month, product_id, {rounded('price', 'price')}, quantity FROM items"))
    for name, short in (("scenario_1", "scenario"), ("scenario_two", "plain_scenario")):
        for table, (plain, doubles) in _SHOWN.items():
            add(f"{short}_{table}", lambda s, d, n=name, t=table, c=(*plain, *doubles): tables(s, d, n)[t].select(*c), _sql(name, select(table)))
    both = [f"SELECT * FROM ({_sql(name, select('low_level_indices', f''', '{name.partition('_')[2]}' AS scenario'''))})" for name in SCENARIOS]
    add("union_of_scenarios", lambda s, d: union_scenarios({n: tables(s, d, n) for n in SCENARIOS})["low_level_indices"].select(*_SHOWN["low_level_indices"][0], "index_value", "scenario"), " UNION ALL ".join(both))
