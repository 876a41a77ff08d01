"""Edge cases, brute force and axioms of the price-index operators."""

import itertools
import math
import random
from collections import defaultdict
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from indexloom.functions import schema
from indexloom.operators import aggregation, analysis, averaging, bilateral, classify, filtering, fixed_base, geary_khamis, imputation, indices, outliers, preprocess

OBS = "g string, product_id string, month date, price double, quantity double"
G = ["g"]
#: One method of each kind.
SOME_METHODS = ("carli_chained", "dutot_fixed_base", "dutot_chained", "rygeks_tornqvist", "geary_khamis")


def month(t):
    return date(2020 + t // 12, 1 + t % 12, 1)


def sparse(seed, groups=3, products=6, months=8, holes=0.3):
    """Random observations with holes, a group that starts late and one that shares no product between two months."""
    rng = random.Random(seed)
    rows = [
        (f"g{g}", f"p{p}", month(t), rng.uniform(1, 20), float(rng.randint(1, 9)))
        for g in range(groups) for p in range(products) for t in range(months)
        if rng.random() > holes and not (g == 1 and t < 2) and not (g == 2 and p % 2 == (t < 4))
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, OBS)


def values(df, *keys):
    return {tuple(r[k] for k in keys): r["index_value"] for r in df.collect()}


def same(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or math.isclose(got[k], v, rel_tol=1e-9)), (k, got[k], v)


class Brute:
    """Indices by loops over dicts."""

    def __init__(self, rows):
        self.x = defaultdict(lambda: defaultdict(dict))
        for g, p, m, price, q in rows:
            self.x[g][m][p] = (price, q)
        self.months = sorted({r[2] for r in rows})

    def matched(self, g, a, b):
        x, y = self.x[g].get(a, {}), self.x[g].get(b, {})
        return [(*x[p], *y[p]) for p in x.keys() & y.keys()]

    def value(self, formula, g, a, b):
        m = self.matched(g, a, b)
        if not m:
            return None
        s = lambda f: sum(f(*r) for r in m)
        laspeyres = s(lambda p, q, r, u: r * q) / s(lambda p, q, r, u: p * q)
        paasche = s(lambda p, q, r, u: r * u) / s(lambda p, q, r, u: p * u)
        v0, v1 = s(lambda p, q, r, u: p * q), s(lambda p, q, r, u: r * u)
        return {
            "carli": s(lambda p, q, r, u: r / p) / len(m),
            "dutot": s(lambda p, q, r, u: r) / s(lambda p, q, r, u: p),
            "jevons": math.exp(s(lambda p, q, r, u: math.log(r / p)) / len(m)),
            "laspeyres": laspeyres,
            "paasche": paasche,
            "fisher": math.sqrt(laspeyres * paasche),
            "tornqvist": math.exp(s(lambda p, q, r, u: 0.5 * (p * q / v0 + r * u / v1) * math.log(r / p))),
        }[formula]

    def fixed(self, formula, grid):
        out = {}
        first = self.months[0]
        for g in self.x:
            if grid and not self.x[g].get(first):
                continue
            for m in self.months:
                v = 1.0 if grid and m == first else self.value(formula, g, first, m)
                if grid or v is not None:
                    out[g, m] = v
        return out

    def chained(self, formula, grid):
        out = {}
        for g in self.x:
            links = [self.value(formula, g, a, b) for a, b in itertools.pairwise(self.months)]
            if not grid and all(x is None for x in links):
                continue
            out[g, self.months[0]] = total = 1.0
            for m, link in zip(self.months[1:], links, strict=True):
                if link is not None:
                    total *= link
                if link is not None or grid:
                    out[g, m] = total if link is not None else None
        return out

    def pairs(self, formula):
        return {(g, a, b): v for g in self.x for a in self.months for b in self.months if (formula != "jevons" or a != b) and (v := self.value(formula, g, a, b)) is not None}

    def geks(self, formula, window=None, exponent=None):
        p = self.pairs(formula)
        months = sorted({m for _, a, b in p for m in (a, b)})
        out = {}
        for g in {k[0] for k in p}:
            P = lambda a, b: p.get((g, months[a], months[b]), 1.0)  # noqa: B023, E731
            for t in range(len(months)):
                if window is None or t < window:
                    out[g, months[t]] = math.prod([P(0, k) for k in range(1, t + 1)] + [P(k, t) for k in range(t)]) ** (1 / (t + 1))
                else:
                    link = math.prod([P(k, t) / P(k, t - 1) for k in range(t - window + 1, t - 1)] + [P(t - 1, t) ** 2]) ** (1 / (exponent or window))
                    out[g, months[t]] = out[g, months[t - 1]] * link
        return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fixed_and_chained_like_brute_force(spark, seed):
    rows = sparse(seed)
    df, b = frame(spark, rows).cache(), Brute(rows)
    for name in ("carli", "jevons", "tornqvist"):
        same(values(indices.METHODS[f"{name}_fixed_base"](df, G), "g", "month"), b.fixed(name, False))
    for name in ("dutot", "laspeyres"):
        same(values(indices.METHODS[f"{name}_fixed_base"](df, G), "g", "month"), b.fixed(name, True))
    for name in ("carli", "jevons"):
        same(values(indices.METHODS[f"{name}_chained"](df, G), "g", "month"), b.chained(name, False))
    same(values(fixed_base.dutot_chained(df, G), "g", "month"), b.chained("dutot", True))


@pytest.mark.parametrize("window", [2, 3, 5, 20])
def test_multilateral_like_brute_force(spark, window):
    rows = sparse(7)
    df, b = frame(spark, rows).cache(), Brute(rows)
    for name in ("jevons", "fisher"):
        pairs = getattr(bilateral, f"{name}_bilateral")(df, G).cache()
        same(values(pairs, "g", "base_month", "month"), b.pairs(name))
        same(values(bilateral.geks(pairs, G), "g", "month"), b.geks(name))
        same(values(bilateral.rygeks(pairs, G, window), "g", "month"), b.geks(name, window))
    same(values(bilateral.rygeks(pairs, G, window, 13), "g", "month"), b.geks("fisher", window, 13))


def test_axioms(spark):
    rows = sparse(3, holes=0)
    still = frame(spark, [(g, p, m, 2.0, q) for g, p, m, _, q in rows])
    for name in SOME_METHODS:
        assert all(v is None or math.isclose(v, 1) for v in values(indices.indices(still, G, [name], window=3), "g", "month").values()), name
    both = values(bilateral.fisher_bilateral(frame(spark, rows), G), "g", "base_month", "month")
    assert all(math.isclose(v * both[g, b, a], 1) for (g, a, b), v in both.items())


def test_single_month_and_strict(spark):
    one = frame(spark, [("a", "p", month(0), 2.0, 1.0)])
    assert values(fixed_base.dutot_chained(one, G), "g", "month") == {("a", month(0)): 1.0}
    assert values(fixed_base.jevons_chained(one, G), "g", "month") == {}
    gap = frame(spark, [("a", "p", month(t), 1.0 + t, 1.0) for t in (0, 1)] + [("a", "q", month(2), 5.0, 1.0), ("b", "p", month(0), 1.0, 1.0), ("b", "p", month(2), 3.0, 1.0)])
    pairs = bilateral.jevons_bilateral(gap, G)
    loose, strict = values(bilateral.geks(pairs, G), "g", "month"), values(bilateral.geks(pairs, G, strict=True), "g", "month")
    assert strict["a", month(2)] is None and loose["a", month(2)] is not None and strict["a", month(1)] == loose["a", month(1)]
    with pytest.raises(ValueError):
        bilateral.rygeks(pairs, G, 1)


def test_geary_khamis_is_the_fixed_point(spark):
    rows = [(g, p, m, price / (1 + (m.month - 1) * 0.3), q) for g, p, m, price, q in sparse(5, groups=2)]  # falling prices
    got = values(geary_khamis.geary_khamis(frame(spark, rows), G, False, 1e-12), "g", "month")
    for g in ("g0", "g1"):
        own = [(p, m, price, q) for h, p, m, price, q in rows if h == g]
        months = sorted({m for _, m, _, _ in own})
        total = defaultdict(float)
        for p, _, _, q in own:
            total[p] += q
        v = {x: sum(q / total[p] * price / got[g, m] for p, m, price, q in own if p == x) for x in total}
        level = {m: sum(price * q for _, n, price, q in own if n == m) / sum(v[p] * q for p, n, _, q in own if n == m) for m in months}
        for m in months:
            assert math.isclose(got[g, m], level[m] / level[months[0]], rel_tol=1e-8)
    every = values(geary_khamis.geary_khamis(frame(spark, rows), G, True, 1e-12), "g", "month")
    last = max(m for g, m in every if g == "g0")
    assert math.isclose(every["g0", last], got["g0", last], rel_tol=1e-9)
    new, back = geary_khamis.geary_khamis(frame(spark, rows), G, False), spark.createDataFrame([("g0", last, 9.0), ("g0", date(2019, 1, 1), 0.5)], "g string, month date, index_value double")
    merged = values(geary_khamis.append_back_series(new, back, G), "g", "month")
    assert merged["g0", date(2019, 1, 1)] == 0.5 and merged["g0", last] != 9.0 and len(merged) == 3


def test_quartiles_of_large_groups(spark):
    """The quartiles themselves are fences here, so a quartile that is off by one rank shows. Null keys are a group."""
    rng = random.Random(3)
    values = {"a": rng.sample(range(10**6), 20001), None: rng.sample(range(10**6), 12346), "ties": [rng.randint(1, 9) for _ in range(8000)], "one": [5], "none": []}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [(g, None) for g in values for _ in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, price double").repartition(8)
    for flagged, ends in ((outliers.tukey(df, G, k=0.0), (0.25, 0.75)), (outliers.kimber(df, G, k=-1.0), (0.5, 0.5))):
        got = defaultdict(list)
        for r in flagged.collect():
            assert (r["outlier"] is None) == (r["price"] is None)
            if r["outlier"] == 0:
                got[r["g"]].append(r["price"])
        for g, xs in values.items():
            low, high = [sorted(xs)[math.ceil(p * len(xs)) - 1] if xs else 0 for p in ends]
            assert sorted(got[g]) == sorted(x for x in xs if low <= x <= high)


def test_outliers(spark):
    rows = [("a", x) for x in (1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 50.0, None)] + [("b", 5.0), ("c", -1.0), ("c", 1.0)]
    df = spark.createDataFrame(rows, "item string, price double")
    flags = lambda out: sorted(((r["item"], r["price"], r["outlier"]) for r in out.collect()), key=str)
    got = flags(outliers.tukey(df, ["item"], k=1.5))
    assert ("a", 50.0, 1) in got and ("a", None, None) in got and ("a", 4.0, 0) in got
    assert ("b", 5.0, None) in flags(outliers.ksigma(df, ["item"], k=2.0))
    fenced = flags(outliers.fixed_fences(df, outliers.fences_table(spark, {"a": [2, 4]})))
    assert ("a", 2.0, 0) in fenced and ("a", 1.0, 1) in fenced and ("b", 5.0, None) in fenced
    _, inliers = outliers.split_outliers(outliers.find_outliers(df, ["item"], "ksigma", 2.0))
    assert inliers.where("item = 'b'").count() == 0
    assert {r["outlier"] for r in outliers.find_outliers(df, ["item"], "none", active=False).collect()} == {0}
    with pytest.raises(ValueError):
        outliers.find_outliers(df, ["item"], "none")


def test_keywords(spark):
    names = [("Steel-Bolt 5", 0), ("old bolt", 1), ("OLD bolt", 1), ("bolder", 0), (None, 1), ("", 1), (" -! ", 1), ("a nut_case", 0)]
    df = spark.createDataFrame([(n,) for n, _ in names], "product_name string")
    got = {r["product_name"]: r["classified"] for r in classify.classify_names(df, ["Old", "nut"]).collect()}
    assert got == dict(names)
    assert [r["classified"] for r in classify.classify_names(df.where("product_name = 'old bolt'"), []).collect()] == [0]


def test_scanner_weeks_and_nulls(spark):
    base = {"department_code": "1", "section_code": "2", "sub_section_code": "3", "consumer_unit_id": "u", "sales_value_vat_excl_markdowns": 10.0, "number_sold": 4.0, "week_commencing_date": "2020-01-06"}
    change = [{}, {"week_commencing_date": "2020-01-27"}, {"week_commencing_date": "2020-01-25"}, {"week_commencing_date": "2020-01-24"}, {"number_sold": 0.0}, {"number_sold": None}, {"section_code": None}, {"week_commencing_date": "2021-01-04"}, {"week_commencing_date": "no date"}, {"sales_value_vat_excl_markdowns": -1.0}]
    df = spark.createDataFrame([tuple((base | c).values()) for c in change], schema.SCANNER_STAGED)
    out = preprocess.scanner(df, "2020-01-01", "2020-12-01").collect()
    assert [(r["product_id"], r["price"], r["quantity"]) for r in out] == [("u_123_retailer_1", 2.5, 4.0)] * 2  # the 6th and the 24th


def test_web_quotes(spark):
    rows = [("k", "r", "9", "5.5", "2020-01-05", "n"), ("k", "r", "8", "5.5", "2020-01-05", "n"), ("k", "r", "9", "6", "2020-01-05", "n"), ("k", None, "9", "5", "2020-01-05", "n"), ("k", "r", "9", "0", "2020-01-06", "n"), ("k", "r", "9", "x", "2020-01-06", "n"), ("k", "r", "9", "5", "2019-12-31", "n"), ("k", "r", "9", "5", "2020-02-29", None)]
    out = preprocess.web_scraped(spark.createDataFrame(rows, schema.WEB_STAGED), "2020-01-01", "2020-02-01").collect()
    assert sorted((r["price"], r["month"], r["quantity"]) for r in out) == [(5.0, date(2020, 2, 1), 1.0), (5.5, date(2020, 1, 1), 1.0), (6.0, date(2020, 1, 1), 1.0)]


def test_dropped_retailers_and_unknown_suppliers(spark):
    df = spark.createDataFrame([("k", r, "9", "5", "2020-01-05", "n") for r in ("x", "y")], schema.WEB_STAGED)
    weights = {"supplier_1": {"tea": {"x": 0, "y": 1}}}
    out = preprocess.preprocess({"web_scraped": {"supplier_1": {"tea": df}}}, "2020-01-01", "2020-02-01", weights, True)
    assert [r["retailer"] for r in out["web_scraped"]["supplier_1"]["tea"].collect()] == ["y"]
    with pytest.raises(ValueError):
        preprocess.preprocess({"scanner": {"nobody": df}}, "2020-01-01", "2020-02-01")


def test_averages(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("a", 8.0, 3.0), ("b", 5.0, 0.0)], "k string, price double, quantity double")
    got = {m: {r["k"]: (r["price"], r["quantity"]) for r in f(df, ["k"]).collect()} for m, f in averaging.METHODS.items()}
    assert got["weighted_arithmetic"]["a"] == (6.5, 4.0) and got["weighted_arithmetic"]["b"] == (None, 0.0)
    assert math.isclose(got["weighted_geometric"]["a"][0], (2 * 8**3) ** 0.25)
    assert got["unweighted_arithmetic"]["a"] == (5.0, 1.0) and math.isclose(got["unweighted_geometric"]["a"][0], 4.0)
    joined = averaging.left_join(df, df.groupBy("k").agg(F.sum("quantity").alias("total")), ["k"])
    assert sorted((r["k"], r["total"]) for r in joined.collect()) == [("a", 4.0), ("a", 4.0), ("b", 0.0)]


def test_forward_fill_counts_observed_months(spark):
    rows = [("a", "p", month(0), 1.0, 1.0), ("a", "q", month(1), 5.0, 2.0), ("a", "q", month(5), 6.0, 2.0), ("b", "r", month(6), 9.0, 1.0)]
    got = sorted((r["product_id"], r["month"], r["price"], r["imputed"]) for r in imputation.forward_fill(frame(spark, rows), 2, G).collect())
    assert got == [("p", month(0), 1.0, 0), ("p", month(1), 1.0, 1), ("p", month(5), 1.0, 1), ("q", month(1), 5.0, 0), ("q", month(5), 6.0, 0), ("q", month(6), 6.0, 1), ("r", month(6), 9.0, 0)]
    flagged, clean = imputation.impute(frame(spark, rows), G, False, 2)
    assert {r["imputed"] for r in flagged.collect()} == {0} and "imputed" not in clean.columns


def test_expenditure_ties_and_limit(spark):
    rows = [("a", p, month(0), 1.0, q) for p, q in (("p1", 3.0), ("p2", 3.0), ("p3", 3.0), ("p4", 1.0))] + [("b", "x", month(0), 9.0, 1.0), ("b", "y", month(0), 1.0, 1.0), ("c", "z", month(0), 0.0, 1.0)]
    got = {(r["g"], r["product_id"]): r["filtered"] for r in filtering.expenditure(frame(spark, rows), G, 0.6000000001).collect()}
    assert [got["a", p] for p in ("p1", "p2", "p3", "p4")] == [0, 0, 1, 1]
    assert got["b", "x"] == 0 and got["b", "y"] == 1 and got["c", "z"] == 1
    info, clean = filtering.filter_expenditure(frame(spark, rows), G, False, 0.5)
    assert clean.count() == len(rows) and {r["filtered"] for r in info.collect()} == {0}


def test_expenditure_ties_of_sums(spark):
    """The same three sales added in another order are ties, a share that is less by 1e-9 isn't."""
    sums = {"p1": 0.3 + 0.2 + 0.1, "p2": 0.1 + 0.2 + 0.3, "p3": 0.3 + 0.2 + 0.1, "p0": 0.6 - 6e-10}
    assert sums["p1"] < sums["p2"]
    got = filtering.expenditure(frame(spark, [("a", p, month(0), x, 1.0) for p, x in sums.items()]), G, 0.3).collect()
    assert [r["product_id"] for r in sorted(got, key=lambda r: r["cumsum_share"])] == ["p1", "p2", "p3", "p0"]
    assert {r["product_id"] for r in got if r["filtered"] == 0} == {"p1"}


def test_grouped_products(spark):
    by = ["item"]
    df = spark.createDataFrame([("tea", month(0), "p", 2.0, 1.0), ("tea", month(0), "q", 4.0, 1.0), ("tea", month(0), "r", 9.0, 1.0)], "item string, month date, product_id string, price double, quantity double")
    mapper = spark.createDataFrame([("p", "x"), ("q", "x"), ("r", None)], "product_id string, group_id string")
    got = sorted((r["item"], r["product_id"], r["price"], r["quantity"]) for r in averaging.add_grouped(df, by, mapper, "weighted_arithmetic").collect())
    assert got == [("tea", "p", 2.0, 1.0), ("tea", "q", 4.0, 1.0), ("tea", "r", 9.0, 1.0), ("tea_grouped", "x", 3.0, 2.0)]


def test_item_indices(spark):
    rows = [("web_scraped", "s", "tea", r, "m", month(0), v) for r, v in (("x", 2.0), ("y", 4.0))] + [("scanner", "s", "tea", "z", "m", month(0), None), ("scanner", "s", "rye", "z", "m", month(0), None)]
    df = spark.createDataFrame(rows, schema.INDEX)
    weights = aggregation.weights_table(spark, {"s": {"tea": {"x": 0.5}}})
    assert {r["item"]: r["index_value"] for r in aggregation.item_indices(df, schema.GROUP_COLS, weights).collect()} == {"tea": 5.0, "rye": None}
    assert {r["item"]: r["index_value"] for r in aggregation.item_indices(df, schema.GROUP_COLS, weights, True).collect()} == {"tea": 5.0 / 1.5, "rye": None}


def test_analysis_edges(spark):
    df = spark.createDataFrame([("a", 5.0)] * 3 + [("b", 0.1 * k) for k in range(11)] + [("c", None)], "g string, price double")
    got = defaultdict(list)
    for r in analysis.distributions(df, G, "price", 4).collect():
        got[r["g"]].append((r["price"], r["count"]))
    assert sorted(got["a"]) == [(5.0, 0.0)] * 3 + [(5.0, 3.0)] and sum(c for _, c in got["b"]) == 11 and "c" not in got
    x = np.array([0.1 * k for k in range(11)])
    for edge, count in got["b"]:
        lower = edge - x.max() / 4
        assert count == sum((x <= edge) & ((x > lower) | (edge < 0.3)))
    flags = spark.createDataFrame([("a", month(0), 1), ("a", month(0), None), ("b", month(0), 0)], "g string, month date, f int")
    stats = {(r["g"], r["metric"]): r["value"] for r in analysis.flag_stats(flags, G, "f").collect()}
    assert stats == {("a", "count"): 2.0, ("a", "count1"): 1.0, ("a", "frac1"): 1.0, ("b", "count"): 1.0, ("b", "count0"): 1.0, ("b", "frac1"): 0.0}
    relative = analysis.relative_distributions(spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "g string, value double"), G)
    assert sorted((r["g"], r["value"]) for r in relative.collect() if r["value"] is not None) == [("a", 0.25), ("a", 0.75)]


def test_chain_linking_restarts(spark):
    rows = [("n", month(t), raw, old) for t, (raw, old) in enumerate([(1.0, None), (2.0, 3.0), (0.0, 5.0), (4.0, 8.0)])]
    got = {r["period"]: (r["linking_factor"], r["linked"]) for r in aggregation.chain_linking(spark.createDataFrame(rows, "node string, period date, raw double, oldwgts double"), ["node"]).collect()}
    assert got == {month(0): (1.0, 1.0), month(1): (1.5, 3.0), month(2): (1.0, 0.0), month(3): (2.0, 8.0)}


def test_empty_tables(spark):
    none = frame(spark, [])
    for name in SOME_METHODS:
        assert indices.indices(none, G, [name], window=3).count() == 0, name
    assert imputation.forward_fill(none, 2, G).count() == 0
    assert filtering.expenditure(none, G, 0.8).count() == 0
    for f in (analysis.sample_count, analysis.churn, analysis.price_stats):
        assert f(none, G).count() == 0


def test_helpers(spark):
    nested = {"a": {"b": 1, "c": [{"b": 2}]}, "b": 3}
    assert schema.find("b", nested) == [1, 2, 3] and schema.nested_values({"x": {"y": 1}, "z": 2}) == [1, 2]
    wide = spark.createDataFrame([("a", 1, None)], "k string, x int, y int")
    assert sorted((r["variable"], r["value"]) for r in schema.melt(wide, ["k"], ["x", "y"]).collect()) == [("x", 1), ("y", None)]


def test_queries_round_like_their_sql(spark):
    """Halves at the seventh place, as prices over 32 or 64 have them, and what can't be scaled."""
    import duckdb

    from indexloom.plans import registry

    rng = random.Random(11)
    xs = [rng.randint(1, 10**8) / 100 / q for q in (1, 3, 32, 48, 64) for _ in range(3000)]
    xs += [2139.0671875, 5e-7, 1.5e-6, 2.5e-6, 0.49999999999999994e-6, 0.0, 9007199254.740993, 4503599627.3704965, 1e17, 1e300, 1.7e308, math.inf]
    xs += [-x for x in xs]
    got = {r["i"]: r["x"] for r in registry.rounded(spark.createDataFrame(list(enumerate(xs)) + [(-1, None), (-2, math.nan)], "i int, x double")).collect()}
    want = duckdb.connect().execute(f"SELECT list_transform(?::DOUBLE[], lambda x: round(x, {registry.PLACES}))", [xs]).fetchall()[0][0]
    assert [(x, got[i], w) for i, (x, w) in enumerate(zip(xs, want, strict=True)) if got[i] != w] == []
    assert got[-1] is None and math.isnan(got[-2])


@pytest.mark.parametrize("method,sql", [("unweighted_geometric", "exp(avg(ln(x)))"), ("weighted_geometric", "exp(sum(ln(x) * q) / sum(q))")])
def test_geometric_means_round_like_their_sql(spark, method, sql):
    """Of single prices with halves at the seventh place; prices not above 0 have no logarithm."""
    import duckdb

    from indexloom.plans import registry

    rng = random.Random(12)
    rows = [(i, rng.randint(1, 10**7) / 100 / 32, float(rng.randint(1, 9))) for i in range(6000)]
    odd = [(-1, 0.0, 1.0), (-2, -1.0, 1.0), (-3, None, 1.0), (-4, math.inf, 1.0), (-5, 0.0, 1.0), (-5, 4.0, 1.0)]
    df = averaging.METHODS[method](spark.createDataFrame(rows + odd, "i int, price double, quantity double"), ["i"])
    got = {r["i"]: r["price"] for r in registry.rounded(df).collect()}
    con = duckdb.connect()
    want = con.execute(f"SELECT i, round({sql}, {registry.PLACES}) FROM (SELECT unnest(?::INT[]) AS i, unnest(?::DOUBLE[]) AS x, unnest(?::DOUBLE[]) AS q) GROUP BY i", list(map(list, zip(*rows, strict=True)))).fetchall()
    assert len(want) == len(rows) and [(i, got[i], w) for i, w in want if got[i] != w] == []
    assert [got[i] for i in (-1, -2, -3, -4)] == [None, None, None, math.inf] and got[-5] == (4.0 if method == "unweighted_geometric" else 2.0)


def test_logarithmic_fences_like_their_sql(spark):
    """Two equal steps on a log scale above the third quartile lie on the fence: last bits of the logarithms decide."""
    import duckdb

    steps = [(float(i), float(i) * r, float(i) * r**3) for i in range(1, 400) for r in (1.25, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0)]
    rows = [(i, p) for i, (a, b, x) in enumerate(steps) for p in (a, a, b, b, x)]
    df = outliers.find_outliers(spark.createDataFrame([*rows, (-1, 0.0), (-1, 1.0)], "i int, price double"), ["i"], "tukey", 2.0, log_transform=True)
    got = {(r["i"], r["price"]): r["outlier"] for r in df.collect()}
    con = duckdb.connect()
    quartiles = "quantile_disc(ln(p), 0.25) OVER g AS q1, quantile_disc(ln(p), 0.75) OVER g AS q3"
    sql = f"SELECT i, p, CAST(ln(p) < q1 - 2.0 * (q3 - q1) OR ln(p) > q3 + 2.0 * (q3 - q1) AS INTEGER) FROM (SELECT *, {quartiles} FROM (SELECT unnest(?::INT[]) AS i, unnest(?::DOUBLE[]) AS p) WINDOW g AS (PARTITION BY i))"
    want = con.execute(sql, list(map(list, zip(*rows, strict=True)))).fetchall()
    assert len(want) == len(rows) and [(i, p, got[i, p], w) for i, p, w in want if got[i, p] != w] == []
    assert got[-1, 0.0] is None and got[-1, 1.0] == 0


def test_jevons_of_single_products_rounds_like_its_sql(spark):
    """Price relatives with halves at the seventh place."""
    import duckdb

    from indexloom.plans import registry

    rng = random.Random(3)
    rows = [(str(i), rng.randint(1, 10**7) / 100 / 32, float(rng.choice((1, 2, 4, 5, 8, 10, 16, 20, 25, 50)))) for i in range(6000)]
    obs = [(g, "p", month(t), x, 1.0) for g, p, p0 in rows for t, x in ((0, p0), (1, p))]
    odd = [("none", "p", month(0), 0.0, 1.0), ("none", "p", month(1), 2.0, 1.0), ("late", "p", month(1), 2.0, 1.0)]
    df = fixed_base.jevons_fixed_base(spark.createDataFrame(obs + odd, OBS), G)
    got = {(r["g"], r["month"]): r["index_value"] for r in registry.rounded(df).collect()}
    want = duckdb.connect().execute(f"SELECT g, round(exp(avg(ln(p / p0))), {registry.PLACES}) FROM (SELECT unnest(?::VARCHAR[]) AS g, unnest(?::DOUBLE[]) AS p, unnest(?::DOUBLE[]) AS p0) GROUP BY g", list(map(list, zip(*rows, strict=True)))).fetchall()
    assert len(want) == len(rows) and [(g, got[g, month(1)], w) for g, w in want if got[g, month(1)] != w] == []
    assert len(got) == 2 * len(rows) and all(got[g, month(0)] == 1 for g, *_ in rows)


def test_filling_by_stretches(spark):
    """Rows dealt out by stretches of months are filled like others, and fewer are shuffled than are filled."""
    rows = [("a", p, month(t), float(t + 1), 1.0) for p, seen in (("x", (0, 2, 7, 8, 11)), ("y", (3, 15)), ("z", range(16))) for t in seen]
    plain = imputation.forward_fill(frame(spark, rows), 2, G)
    dealt = imputation.forward_fill(frame(spark, rows), 2, G, stretch="s")
    assert sorted(dealt.drop("s").collect()) == sorted(plain.collect())
    assert {r["s"] for r in dealt.select("s").collect()} == {0, 1}
    assert dealt.select(*G, "s", "month").distinct().count() == 16  # a month is in one stretch
