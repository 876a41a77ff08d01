"""The named queries of the price-index engine and their SQL.

Doubles are rounded to six places on both sides, so that the order of additions doesn't show.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schema
from ..operators import aggregation, analysis, averaging, bilateral, classify, filtering, fixed_base, geary_khamis, imputation, indices, outliers, preprocess
from . import observations as obs
from . import scenarios

G = obs.GROUP
GM = [*G, "month"]
PLACES = 6
KEYWORDS = ["Ring", "old", "gizmo"]
FENCES = {"ECONOMY": [500.0, 60_000.0], "SMALL": [1_000.0, 40_000.0], "PROMO": [100.0, 1_000.0]}
LIMIT, SHARE, BINS, WINDOW, GK_TOLERANCE = 3, 0.8, 8, 5, 1e-9
START, END = "1996-02-01", "1998-11-01"
#: Retailer weights of an item.
WEIGHT = 0.25

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _round(x: Column) -> Column:
    """Half away from zero of the scaled double, as SQL rounds. Spark's round goes by the decimal digits, so halves may differ."""
    scaled = x * 10.0**PLACES
    whole = F.rint(scaled)
    out = F.when(F.abs(scaled - whole) == 0.5, scaled + 0.5 * F.signum(scaled)).otherwise(whole) / 10.0**PLACES
    return F.when(F.abs(out) < math.inf, out).otherwise(x)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_round(F.col(f"`{c}`")).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _add(name: str, query: Query, sql: str | None = None) -> None:
    _QUERIES[name] = lambda spark, sf_dir: rounded(query(spark, sf_dir))
    if sql:
        _SQL[name] = sql


def _with(*ctes: str, final: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join([obs.SQL, *ctes])} {final}"


def _r(x: str, name: str) -> str:
    return f"round({x}, {PLACES}) AS {name}"


# ---------------------------------------------------------------- stages

_add(
    "preprocess_web",
    lambda s, d: preprocess.web_scraped(obs.web_staged(s, d), START, END),
    _with(
        final=f"""SELECT retailer, product_id, product_name, {_r('price', 'price')}, CAST(1 AS DOUBLE) AS quantity, month FROM (
          SELECT DISTINCT retailer, part || '_item_' || retailer AS product_id, product_name, date, price, month FROM quotes
          WHERE price > 0 AND month BETWEEN DATE '{START}' AND DATE '{END}')"""
    ),
)
_add(
    "preprocess_scanner",
    lambda s, d: preprocess.scanner(obs.scanner_staged(s, d), START, END, "shop"),
    _with(
        "w AS (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week FROM quotes)",
        final=f"""SELECT 'shop' AS retailer, department || section || sub_section AS retailer_category_id, part || '_' || department || section || sub_section || '_shop' AS product_id,
          {_r('price', 'price')}, {_r('quantity', 'quantity')}, CAST(date_trunc('month', week) AS DATE) AS month
        FROM w WHERE price > 0 AND quantity > 0 AND date_trunc('month', week) = date_trunc('month', week + 7) AND date_trunc('month', week) BETWEEN DATE '{START}' AND DATE '{END}'""",
    ),
)
_add(
    "classify_keywords",
    lambda s, d: classify.classify_names(obs.quotes(s, d).select("l_orderkey", "l_linenumber", "product_name"), KEYWORDS),
    _with(
        final=f"""SELECT l_orderkey, l_linenumber, product_name, CAST(CASE WHEN product_name IS NULL OR list_has_any(regexp_split_to_array(lower(product_name), '\\W+'), {[k.lower() for k in KEYWORDS]})
          THEN 1 ELSE 0 END AS INTEGER) AS classified FROM quotes""",
    ),
)


def _categories(s: SparkSession, d: str) -> DataFrame:
    """Sections 0 to 14 by item; section 3 has two items."""
    q = obs.quotes(s, d).select(F.col("section").alias("retailer_category_id")).distinct().where("CAST(retailer_category_id AS INT) < 15")
    first = q.withColumn("item", F.concat(F.lit("item_"), F.col("retailer_category_id")))
    return first.unionByName(q.where("retailer_category_id = '3'").withColumn("item", F.lit("item_x")))


_add(
    "classify_scanner",
    lambda s, d: classify.classify_scanner(obs.quotes(s, d).drop("item").withColumnRenamed("section", "retailer_category_id"), _categories(s, d), ["item", "l_orderkey", "l_linenumber", "price"]),
    _with(
        "m AS (SELECT DISTINCT section, 'item_' || section AS category FROM quotes WHERE CAST(section AS INT) < 15 UNION ALL SELECT DISTINCT section, 'item_x' FROM quotes WHERE section = '3')",
        final=f"SELECT category AS item, l_orderkey, l_linenumber, {_r('price', 'price')} FROM quotes JOIN m USING (section)",
    ),
)

_OUT = ["item", "retailer", "month", "l_orderkey", "l_linenumber", "price", "outlier"]
_OUT_SQL = f"SELECT item, retailer, month, l_orderkey, l_linenumber, {_r('price', 'price')}, CAST(CASE WHEN x < low OR x > high THEN 1 WHEN x >= low AND x <= high THEN 0 END AS INTEGER) AS outlier FROM f"
_OUT_KEYS = ["item", "retailer", "month"]


def _outliers(name: str, method: str, k: float, log: bool, low: str, high: str) -> None:
    x = "ln(price)" if log else "price"
    q = [f"quantile_disc({x}, {p}) OVER g" for p in (0.25, 0.5, 0.75)]
    _add(
        name,
        lambda s, d: outliers.find_outliers(obs.quotes(s, d), _OUT_KEYS, method, k, log_transform=log).select(_OUT),
        _with(
            f"s AS (SELECT *, {x} AS x, avg({x}) OVER g AS m, stddev_samp({x}) OVER g AS sd, {q[0]} AS q1, {q[1]} AS q2, {q[2]} AS q3 FROM quotes WINDOW g AS (PARTITION BY item, retailer, month))",
            f"f AS (SELECT *, {low} AS low, {high} AS high FROM s)",
            final=_OUT_SQL,
        ),
    )


_outliers("outlier_ksigma", "ksigma", 1.5, False, "m - 1.5 * sd", "m + 1.5 * sd")
_outliers("outlier_tukey", "tukey", 1.0, False, "q1 - 1.0 * (q3 - q1)", "q3 + 1.0 * (q3 - q1)")
_outliers("outlier_kimber", "kimber", 2.0, False, "q1 - 2.0 * (q2 - q1)", "q3 + 2.0 * (q3 - q2)")
_outliers("outlier_log_tukey", "tukey", 1.0, True, "q1 - 1.0 * (q3 - q1)", "q3 + 1.0 * (q3 - q1)")
_add(
    "outlier_fences",
    lambda s, d: outliers.find_outliers(obs.quotes(s, d), _OUT_KEYS, "udf_fences", fences=outliers.fences_table(s, FENCES)).select(_OUT),
    _with(
        "b(item, low, high) AS (VALUES " + ", ".join(f"('{i}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for i, (a, b) in FENCES.items()) + ")",
        "f AS (SELECT q.*, q.price AS x, low, high FROM quotes q LEFT JOIN b USING (item))",
        final=_OUT_SQL,
    ),
)

for _method, _price, _quantity in (
    ("weighted_arithmetic", "sum(price * quantity) / sum(quantity)", "sum(quantity)"),
    ("weighted_geometric", "exp(sum(ln(price) * quantity) / sum(quantity))", "sum(quantity)"),
    ("unweighted_arithmetic", "avg(price)", "CAST(1 AS DOUBLE)"),
    ("unweighted_geometric", "exp(avg(ln(price)))", "CAST(1 AS DOUBLE)"),
):
    _add(
        f"avg_{_method}",
        lambda s, d, m=_method: averaging.average(obs.quotes(s, d), ["item", "retailer"], m),
        _with(final=f"SELECT item, retailer, month, product_id, {_r(_price, 'price')}, {_r(_quantity, 'quantity')} FROM quotes GROUP BY item, retailer, month, product_id"),
    )


def _groups(s: SparkSession, d: str) -> DataFrame:
    """Parts by the last digit of their key; digit 9 is in no group."""
    digit = F.substring("product_id", -1, 1)
    return obs.parts(s, d).select("product_id").distinct().select("product_id", F.when(digit != "9", F.concat(F.lit("g"), digit)).alias("group_id"))


_add(
    "grouped_items",
    lambda s, d: averaging.add_grouped(obs.parts(s, d), G, _groups(s, d), "weighted_arithmetic"),
    _with(
        final=f"""SELECT item, month, product_id, {_r('price', 'price')}, {_r('quantity', 'quantity')} FROM parts UNION ALL
        SELECT item || '_grouped', month, 'g' || right(product_id, 1), {_r('sum(price * quantity) / sum(quantity)', 'price')}, {_r('sum(quantity)', 'quantity')} FROM parts WHERE right(product_id, 1) <> '9' GROUP BY ALL"""
    ),
)

_MONTHS = "months AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS t FROM (SELECT DISTINCT month FROM {0}))"
_add(
    "impute_ffill",
    lambda s, d: imputation.forward_fill(obs.parts(s, d), LIMIT, G),
    _with(
        _MONTHS.format("parts"),
        "ids AS (SELECT DISTINCT item, product_id FROM parts)",
        f"""f AS (SELECT i.item, i.product_id, m.month, p.price AS p0, last_value(p.price IGNORE NULLS) OVER w AS price, last_value(p.quantity IGNORE NULLS) OVER w AS quantity
        FROM ids i CROSS JOIN months m LEFT JOIN parts p ON p.item = i.item AND p.product_id = i.product_id AND p.month = m.month
        WINDOW w AS (PARTITION BY i.item, i.product_id ORDER BY m.month ROWS BETWEEN {LIMIT} PRECEDING AND CURRENT ROW))""",
        final=f"SELECT item, product_id, month, {_r('price', 'price')}, {_r('quantity', 'quantity')}, CAST(p0 IS NULL AS INTEGER) AS imputed FROM f WHERE price IS NOT NULL",
    ),
)

_SPENT = (
    "a AS (SELECT *, price * quantity AS sales, sum(price * quantity) OVER (PARTITION BY item, month) AS sum_sales FROM series)",
    "b AS (SELECT *, sales / nullif(sum_sales, 0) AS share FROM a)",
    "c AS (SELECT *, sum(share) OVER (PARTITION BY item, month ORDER BY share DESC, product_id ROWS UNBOUNDED PRECEDING) AS cumsum_share FROM b)",
    f"e AS (SELECT *, CAST(CASE WHEN cumsum_share <= {SHARE} OR share >= {SHARE} THEN 0 ELSE 1 END AS INTEGER) AS filtered FROM c)",
)
_add(
    "expenditure_info",
    lambda s, d: filtering.expenditure(obs.series(s, d), GM, SHARE),
    _with(*_SPENT, final=f"SELECT item, month, product_id, {', '.join(_r(c, c) for c in ('price', 'quantity', 'sales', 'sum_sales', 'share', 'cumsum_share'))}, filtered FROM e"),
)
_add(
    "expenditure_filter",
    lambda s, d: filtering.filter_expenditure(obs.series(s, d), GM, True, SHARE)[1],
    _with(*_SPENT, final=f"SELECT item, month, product_id, {_r('price', 'price')}, {_r('quantity', 'quantity')} FROM e WHERE filtered = 0"),
)

#: The months of the tables' calendar, each of which has quotes; SQL must name its columns, the queries find theirs.
_SHOWN = [f"{y}-{m:02}-01" for y in range(1995, 2002) for m in range(1, 13)][:83]
for _c, _plural in (("price", "prices"), ("quantity", "quantities")):
    _add(
        f"product_by_month_{_plural}",
        lambda s, d, c=_c: schema.product_by_month(obs.series(s, d), G, c),
        _with(final="SELECT item, product_id, " + ", ".join(_r(f"sum({_c}) FILTER (month = DATE '{m}')", f'"{m}"') for m in _SHOWN) + " FROM series GROUP BY item, product_id"),
    )

# ---------------------------------------------------------------- indices

_INDEXED = (_MONTHS.format("series"), "x AS (SELECT s.*, m.t FROM series s JOIN months m USING (month))")
_BASE = (*_INDEXED, "j AS (SELECT a.item, a.month, a.t, a.price, a.quantity, b.price AS p0, b.quantity AS q0 FROM x a JOIN x b ON a.item = b.item AND a.product_id = b.product_id AND b.t = 0)")
_LINK = (*_INDEXED, "j AS (SELECT a.item, a.month, a.t, a.price, a.quantity, b.price AS p0, b.quantity AS q0 FROM x a JOIN x b ON a.item = b.item AND a.product_id = b.product_id AND b.t = a.t - 1)")
_VALUE = {
    "carli": "avg(price / p0)",
    "dutot": "sum(price) / sum(p0)",
    "jevons": "exp(avg(ln(price / p0)))",
    "laspeyres": "sum(price * q0) / sum(p0 * q0)",
    "tornqvist": "exp(0.5 * (sum(p0 * q0 * ln(price / p0)) / sum(p0 * q0) + sum(price * quantity * ln(price / p0)) / sum(price * quantity)))",
}
for _name in ("carli", "jevons", "tornqvist"):
    _add(f"{_name}_fixed_base", lambda s, d, n=_name: indices.METHODS[f"{n}_fixed_base"](obs.series(s, d), G), _with(*_BASE, final=f"SELECT item, month, {_r(_VALUE[_name], 'index_value')} FROM j GROUP BY item, month"))
for _name in ("dutot", "laspeyres"):
    _add(
        f"{_name}_fixed_base",
        lambda s, d, n=_name: indices.METHODS[f"{n}_fixed_base"](obs.series(s, d), G),
        _with(
            *_BASE,
            f"v AS (SELECT item, month, {_VALUE[_name]} AS v FROM j GROUP BY item, month)",
            "g AS (SELECT i.item, m.month, m.t FROM (SELECT DISTINCT item FROM x WHERE t = 0) i CROSS JOIN months m)",
            final=f"SELECT item, month, {_r('CASE WHEN t = 0 THEN 1 ELSE v END', 'index_value')} FROM g LEFT JOIN v USING (item, month)",
        ),
    )
for _name in ("carli", "jevons"):
    _add(
        f"{_name}_chained",
        lambda s, d, n=_name: indices.METHODS[f"{n}_chained"](obs.series(s, d), G),
        _with(
            *_LINK,
            f"v AS (SELECT item, month, {_VALUE[_name]} AS v FROM j GROUP BY item, month)",
            "w AS (SELECT * FROM v UNION ALL SELECT DISTINCT item, (SELECT min(month) FROM months), 1 FROM v)",
            final=f"SELECT item, month, {_r('exp(sum(ln(v)) OVER (PARTITION BY item ORDER BY month ROWS UNBOUNDED PRECEDING))', 'index_value')} FROM w",
        ),
    )
_add(
    "dutot_chained",
    lambda s, d: fixed_base.dutot_chained(obs.series(s, d), G),
    _with(
        *_LINK,
        f"v AS (SELECT item, month, {_VALUE['dutot']} AS v FROM j GROUP BY item, month)",
        "g AS (SELECT i.item, m.month, m.t FROM (SELECT DISTINCT item FROM x) i CROSS JOIN months m)",
        "w AS (SELECT item, month, CASE WHEN t = 0 THEN 1 ELSE v END AS v FROM g LEFT JOIN v USING (item, month))",
        final=f"SELECT item, month, {_r('CASE WHEN v IS NOT NULL THEN exp(sum(ln(v)) OVER (PARTITION BY item ORDER BY month ROWS UNBOUNDED PRECEDING)) END', 'index_value')} FROM w",
    ),
)

_PAIRS = {
    "jevons": "exp(avg(ln(b.price / a.price)))",
    "laspeyres": "sum(b.price * a.quantity) / sum(a.price * a.quantity)",
    "paasche": "sum(b.price * b.quantity) / sum(a.price * b.quantity)",
    "fisher": "sqrt(sum(b.price * a.quantity) / sum(a.price * a.quantity) * sum(b.price * b.quantity) / sum(a.price * b.quantity))",
    "tornqvist": "exp(0.5 * (sum(a.price * a.quantity * ln(b.price / a.price)) / sum(a.price * a.quantity) + sum(b.price * b.quantity * ln(b.price / a.price)) / sum(b.price * b.quantity)))",
}


def _pair_cte(name: str) -> str:
    return f"pairs AS MATERIALIZED (SELECT a.item, a.month AS base_month, b.month AS month, {_PAIRS[name]} AS p FROM series a JOIN series b USING (item, product_id) {'WHERE a.month <> b.month' if name == 'jevons' else ''} GROUP BY a.item, a.month, b.month)"


_GEKS = (
    "pm AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS t FROM (SELECT base_month AS month FROM pairs UNION SELECT month FROM pairs))",
    "l AS (SELECT p.item, a.t AS a, b.t AS b, ln(p.p) AS x FROM pairs p JOIN pm a ON a.month = p.base_month JOIN pm b ON b.month = p.month)",
    "g AS (SELECT i.item, pm.month, pm.t FROM (SELECT DISTINCT item FROM pairs) i CROSS JOIN pm)",
    """geks AS (SELECT g.item, g.month, g.t, exp((coalesce((SELECT sum(x) FROM l WHERE l.item = g.item AND l.a = 0 AND l.b BETWEEN 1 AND g.t), 0)
      + coalesce((SELECT sum(x) FROM l WHERE l.item = g.item AND l.b = g.t AND l.a < g.t), 0)) / (g.t + 1)) AS v FROM g)""",
)
_RYGEKS = (
    *_GEKS,
    f"""link AS (SELECT g.item, g.month, g.t, (coalesce((SELECT sum(CASE WHEN l.a = g.t - 1 THEN 2 * x ELSE x END) FROM l WHERE l.item = g.item AND l.b = g.t AND l.a BETWEEN g.t - {WINDOW} + 1 AND g.t - 1), 0)
      - coalesce((SELECT sum(x) FROM l WHERE l.item = g.item AND l.b = g.t - 1 AND l.a BETWEEN g.t - {WINDOW} + 1 AND g.t - 2), 0)) / {WINDOW} AS x FROM g WHERE g.t >= {WINDOW}
      UNION ALL SELECT item, month, t, ln(v) FROM geks WHERE t = {WINDOW} - 1)""",
    f"rygeks AS (SELECT item, month, v FROM geks WHERE t < {WINDOW} - 1 UNION ALL SELECT item, month, exp(sum(x) OVER (PARTITION BY item ORDER BY t ROWS UNBOUNDED PRECEDING)) FROM link)",
)
for _name in _PAIRS:
    _add(
        f"{_name}_bilateral",
        lambda s, d, n=_name: getattr(bilateral, f"{n}_bilateral")(obs.series(s, d), G),
        _with(_pair_cte(_name), final=f"SELECT item, base_month, month, {_r('p', 'index_value')} FROM pairs"),
    )
    if _name != "fisher":
        _add(f"geks_{_name}", lambda s, d, n=_name: indices.METHODS[f"geks_{n}"](obs.series(s, d), G), _with(_pair_cte(_name), *_GEKS, final=f"SELECT item, month, {_r('v', 'index_value')} FROM geks"))
    _add(
        f"rygeks_{_name}",
        lambda s, d, n=_name: indices.METHODS[f"rygeks_{n}"](obs.series(s, d), G, window=WINDOW),
        _with(_pair_cte(_name), *_RYGEKS, final=f"SELECT item, month, {_r('v', 'index_value')} FROM rygeks"),
    )

# An index of 1/P depends on the month linearly, so the fixed point is iterated on a month by month matrix for each run.
# A run has the months up to number n; runs stop by themselves when no index moves by more than the tolerance.


def _gk_sql(runs: str, tolerance: float, final: str) -> str:
    return _with(
        "o AS (SELECT *, dense_rank() OVER (PARTITION BY item ORDER BY month) AS t FROM series)",
        f"runs AS ({runs})",
        "y AS MATERIALIZED (SELECT r.item, r.n, o.product_id, o.month, o.t, o.price, o.quantity, o.quantity / sum(o.quantity) OVER (PARTITION BY r.item, r.n, o.product_id) AS share FROM runs r JOIN o ON o.item = r.item AND o.t <= r.n)",
        "m AS (SELECT item, n, t, any_value(month) AS month, sum(price * quantity) AS value FROM y GROUP BY item, n, t)",
        "z AS (SELECT a.item, a.n, a.t, b.t AS u, sum(a.quantity * b.share * b.price) AS c FROM y a JOIN y b ON a.item = b.item AND a.n = b.n AND a.product_id = b.product_id GROUP BY a.item, a.n, a.t, b.t)",
        "zz AS (SELECT m.item, m.n, m.t, list(coalesce(z.c, 0) ORDER BY k.t) AS r FROM m JOIN m k ON m.item = k.item AND m.n = k.n LEFT JOIN z ON z.item = m.item AND z.n = m.n AND z.t = m.t AND z.u = k.t GROUP BY m.item, m.n, m.t)",
        "k AS MATERIALIZED (SELECT m.item, m.n, list(m.month ORDER BY m.t) AS months, list(value ORDER BY m.t) AS v, list(r ORDER BY m.t) AS rows FROM m JOIN zz USING (item, n, t) GROUP BY m.item, m.n)",
        f"""it AS (SELECT item, n, 0 AS i, list_transform(v, lambda x: CAST(1 AS DOUBLE)) AS p, CAST(1e9 AS DOUBLE) AS moved FROM k
          UNION ALL SELECT item, n, i + 1, q, list_max(list_transform(range(1, len(q) + 1), lambda j: abs(q[j] - p[j]))) FROM (
            SELECT item, n, i, p, list_transform(range(1, len(v) + 1), lambda j: (v[j] / v[1]) / (w[j] / w[1])) AS q FROM (
              SELECT it.item, it.n, i, p, v, list_transform(rows, lambda r: list_dot_product(r, list_transform(p, lambda e: 1 / e))) AS w FROM it JOIN k ON k.item = it.item AND k.n = it.n WHERE it.moved > {tolerance})))""",
        recursive=True,
        final=final.replace("ENDED", "(SELECT item, n, arg_max(p, i) AS p FROM it GROUP BY item, n)"),
    )


_add(
    "geary_khamis",
    lambda s, d: geary_khamis.geary_khamis(obs.series(s, d), G, False, GK_TOLERANCE),
    _gk_sql("SELECT item, max(t) AS n FROM o GROUP BY item", GK_TOLERANCE, f"SELECT item, unnest(months) AS month, {_r('unnest(p)', 'index_value')} FROM ENDED JOIN k USING (item, n)"),
)
_add(
    "geary_khamis_all_periods",
    lambda s, d: geary_khamis.geary_khamis(obs.series(s, d), G, True),
    _gk_sql("SELECT DISTINCT item, t AS n FROM o", 1e-5, f"SELECT item, months[-1] AS month, {_r('p[-1]', 'index_value')} FROM ENDED JOIN k USING (item, n)"),
)


def _retailer_jevons(s: SparkSession, d: str) -> DataFrame:
    q = obs.quotes(s, d).withColumn("data_source", F.when(F.col("retailer").substr(-1, 1) != "1", "web_scraped").otherwise("scanner")).withColumn("supplier", F.lit("s"))
    by = list(schema.GROUP_COLS)
    return indices.indices(averaging.average(q, by, "weighted_arithmetic"), by, ["jevons_fixed_base"])


def _retailer_weights(s: SparkSession, d: str) -> DataFrame:
    q = obs.quotes(s, d).where("item <> 'PROMO'").select("item", "retailer").distinct()
    return q.select(F.lit("web_scraped").alias("data_source"), F.lit("s").alias("supplier"), "item", "retailer", F.lit(WEIGHT).alias("weight"))


_add(
    "item_indices",
    lambda s, d: aggregation.item_indices(_retailer_jevons(s, d), schema.GROUP_COLS, _retailer_weights(s, d)),
    _with(
        "o AS (SELECT CASE WHEN right(retailer, 1) <> '1' THEN 'web_scraped' ELSE 'scanner' END AS source, item, retailer, product_id, month, sum(price * quantity) / sum(quantity) AS price FROM quotes GROUP BY ALL)",
        "v AS (SELECT a.source, a.item, a.retailer, a.month, exp(avg(ln(a.price / b.price))) AS v FROM o a JOIN o b USING (source, item, retailer, product_id) WHERE b.month = (SELECT min(month) FROM o) GROUP BY ALL)",
        final=f"SELECT item, 'jevons_fixed_base' AS index_method, month, {_r(f'''sum(v * CASE WHEN source = 'web_scraped' AND item <> 'PROMO' THEN {WEIGHT} ELSE 1 END)''', 'index_value')} FROM v GROUP BY item, month",
    ),
)

# ---------------------------------------------------------------- hierarchy


def _tree(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(values, weights) of a tree: brands under types under all, weighted by sales in thousands."""
    q = obs.series(s, d)
    sales = F.sum(F.col("price") * F.col("quantity")) / 1000
    item = q.groupBy(F.col("month").alias("period"), F.lit(1).alias("parent_level"), F.col("item").alias("parent_id"), F.lit(0).alias("child_level"), F.col("product_id").alias("child_id")).agg(sales.alias("weight"))
    top = q.groupBy(F.col("month").alias("period"), F.lit(2).alias("parent_level"), F.lit("all").alias("parent_id"), F.lit(1).alias("child_level"), F.col("item").alias("child_id")).agg(sales.alias("weight"))
    values = q.select(F.col("month").alias("period"), F.col("product_id").alias("child_id"), (F.col("price") / 1000).alias("value"))
    both = [values.withColumn("kind", F.lit(k)).select("kind", "period", "child_id", "value") for k in ("raw", "oldwgts")]
    return both[0].unionByName(both[1]), aggregation.with_old_weights(item.unionByName(top))


def _hierarchy(s: SparkSession, d: str) -> DataFrame:
    values, weights = _tree(s, d)
    return aggregation.hierarchy_output(aggregation.aggregate_hierarchy(values, weights, 2), aggregation.levels(weights))


_TREE = (
    """w0 AS (SELECT month AS period, 1 AS pl, item AS parent, product_id AS child, sum(price * quantity) / 1000 AS weight FROM series GROUP BY ALL
      UNION ALL SELECT month, 2, 'all', item, sum(price * quantity) / 1000 FROM series GROUP BY ALL)""",
    "w1 AS (SELECT 'raw' AS kind, * FROM w0 UNION ALL SELECT 'oldwgts', period, pl, parent, child, lag(weight) OVER (PARTITION BY parent, child ORDER BY period) FROM w0)",
    "v0 AS (SELECT k.kind, month AS period, product_id AS node, price / 1000 AS value FROM series CROSS JOIN (VALUES ('raw'), ('oldwgts')) k(kind))",
    "v1 AS (SELECT w.kind, w.period, parent AS node, coalesce(sum(value * weight) / 100, 0) AS value FROM w1 w LEFT JOIN v0 v ON v.kind = w.kind AND v.period = w.period AND v.node = w.child WHERE pl = 1 GROUP BY w.kind, w.period, parent)",
    "v2 AS (SELECT w.kind, w.period, parent AS node, sum(value * weight) / 100 AS value FROM w1 w JOIN v1 v ON v.kind = w.kind AND v.period = w.period AND v.node = w.child WHERE pl = 2 GROUP BY w.kind, w.period, parent)",
    "every AS (SELECT 0 AS level, * FROM v0 UNION ALL SELECT 1, * FROM v1 UNION ALL SELECT 2, * FROM v2)",
    "wide AS (SELECT CAST(level AS INTEGER) AS level, node, period, max(value) FILTER (kind = 'raw') AS raw, max(value) FILTER (kind = 'oldwgts') AS oldwgts FROM every GROUP BY level, node, period)",
)
_add("hierarchy_aggregation", _hierarchy, _with(*_TREE, final=f"SELECT level, node, period, {_r('raw', 'raw')}, {_r('oldwgts', 'oldwgts')} FROM wide"))
_add(
    "chain_linking",
    lambda s, d: aggregation.chain_linking(_hierarchy(s, d).where("level > 0"), ["node"]),
    _with(
        *_TREE,
        "r AS (SELECT node, period, raw, oldwgts FROM wide WHERE level > 0)",
        "f AS (SELECT *, CASE WHEN period = (SELECT min(period) FROM r) THEN 1 ELSE nullif(oldwgts, 0) / nullif(raw, 0) END AS f FROM r)",
        "c AS (SELECT *, exp(sum(ln(coalesce(f, 1))) OVER (PARTITION BY node ORDER BY period ROWS UNBOUNDED PRECEDING)) AS c FROM f)",
        "l AS (SELECT *, c / coalesce(last_value(CASE WHEN f IS NULL THEN c END IGNORE NULLS) OVER (PARTITION BY node ORDER BY period ROWS UNBOUNDED PRECEDING), 1) AS lf FROM c)",
        final=f"SELECT node, period, {_r('raw', 'raw')}, {_r('oldwgts', 'oldwgts')}, {_r('lf', 'linking_factor')}, {_r('raw * lf', 'linked')} FROM l",
    ),
)

# ---------------------------------------------------------------- analysis

_SEEN = (
    "s AS (SELECT *, lag(month) OVER w AS before, lead(month) OVER w AS after, min(month) OVER (PARTITION BY item, product_id) AS first, (SELECT min(month) FROM parts) AS a, (SELECT max(month) FROM parts) AS b, (SELECT min(month) FROM parts WHERE month > (SELECT min(month) FROM parts)) AS second FROM parts WINDOW w AS (PARTITION BY item, product_id ORDER BY month))",
)
_add(
    "sample_count",
    lambda s, d: analysis.sample_count(obs.parts(s, d), G),
    _with(
        *_SEEN,
        final="""SELECT item, month, CAST(CAST(month - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS metric, CAST(count(*) AS DOUBLE) AS value FROM s WHERE before = month - INTERVAL 1 MONTH GROUP BY item, month
        UNION ALL SELECT item, month, CAST(a AS VARCHAR), CAST(count(*) AS DOUBLE) FROM s WHERE first = a AND month > second GROUP BY item, month, a""",
    ),
)
_add(
    "churn_stats",
    lambda s, d: analysis.churn(obs.parts(s, d), G),
    _with(
        *_SEEN,
        "n AS (SELECT item, month, count(*) AS c, count(*) FILTER (CASE WHEN before IS NULL THEN month > a ELSE before <> month - INTERVAL 1 MONTH END) AS e, count(*) FILTER (CASE WHEN after IS NULL THEN month < b ELSE after <> month + INTERVAL 1 MONTH END) AS d FROM s GROUP BY item, month)",
        "k AS (SELECT item, month, c, e, lag(d) OVER (PARTITION BY item ORDER BY month) AS d FROM n)",
        final=f"""SELECT item, month, 'count' AS metric, CAST(c AS DOUBLE) AS value FROM k
        UNION ALL SELECT item, month, 'dropped_count', d FROM k WHERE d IS NOT NULL UNION ALL SELECT item, month, 'entered_count', e FROM k WHERE d IS NOT NULL
        UNION ALL SELECT item, month, 'dropped_frac', {_r('d / c', 'x')} FROM k WHERE d IS NOT NULL UNION ALL SELECT item, month, 'entered_frac', {_r('e / c', 'x')} FROM k WHERE d IS NOT NULL""",
    ),
)
_add(
    "price_stats",
    lambda s, d: analysis.price_stats(obs.parts(s, d), G),
    _with(final=" UNION ALL ".join(f"SELECT item, month, '{m}' AS metric, {_r(f'CAST({x} AS DOUBLE)', 'value')} FROM parts GROUP BY item, month" for m, x in (("min", "min(price)"), ("max", "max(price)"), ("mean", "avg(price)"), ("stddev", "stddev_samp(price)"), ("count", "count(*)")))),
)
_add(
    "binary_flag_stats",
    lambda s, d: analysis.flag_stats(imputation.forward_fill(obs.parts(s, d), LIMIT, G), G, "imputed"),
    _SQL["impute_ffill"].split(" SELECT item, product_id, month, round")[0]
    + ", i AS (SELECT item, month, CAST(p0 IS NULL AS INTEGER) AS x FROM f WHERE price IS NOT NULL) "
    + " UNION ALL ".join(f"SELECT item, month, '{m}' AS metric, {_r(f'CAST({v} AS DOUBLE)', 'value')} FROM i GROUP BY item, month HAVING {v} > 0 OR '{m}' IN ('count', 'frac1')" for m, v in (("count", "count(*)"), ("count1", "sum(x)"), ("count0", "sum(1 - x)"), ("frac1", "avg(x)"))),
)
_DIST = (
    f"r AS (SELECT item, month, max(price) AS high, (max(price) - min(price)) / {BINS} AS step FROM parts GROUP BY item, month)",
    f"k AS (SELECT r.*, b.b FROM r CROSS JOIN (SELECT unnest(range({BINS})) AS b) b)",
    f"h AS (SELECT k.item, k.month, k.high - k.step * k.b AS edge, count(p.price) AS n FROM k LEFT JOIN parts p ON p.item = k.item AND p.month = k.month AND p.price <= k.high - k.step * k.b AND (k.b = {BINS} - 1 OR p.price > k.high - k.step * (k.b + 1)) GROUP BY k.item, k.month, k.b, k.high, k.step)",
)
_add("distributions", lambda s, d: analysis.distributions(obs.parts(s, d), GM, "price", BINS), _with(*_DIST, final=f"SELECT item, month, {_r('edge', 'price')}, CAST(n AS DOUBLE) AS count FROM h"))
_add(
    "relative_distributions",
    lambda s, d: analysis.relative_distributions(analysis.distributions(obs.parts(s, d), GM, "price", BINS).withColumnRenamed("count", "value"), ["month"]),
    _with(*_DIST, final=f"SELECT item, month, {_r('edge', 'price')}, {_r('n / sum(n) OVER (PARTITION BY month)', 'value')} FROM h"),
)


scenarios.register(_add, _r)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
