"""Registered queries over all months of the tables, against brute force on the price observations that SQL makes."""

import math
import re
from collections import defaultdict
from datetime import date

import pytest

import oracle
from indexloom.operators import geary_khamis as operator
from indexloom.plans import observations, registry
from test_operators import Brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.fixture(scope="module")
def observed(con):
    """(product_id, month, price, quantity) by item."""
    out = defaultdict(list)
    for item, *row in con.sql(f"WITH {observations.SQL} SELECT item, product_id, month, price, quantity FROM series").fetchall():
        out[item].append(row)
    return out


def values(spark, name):
    return {(r["item"], r["month"]): r["index_value"] for r in registry.queries()[name](spark, SF).collect()}


def geary_khamis(rows):
    """Index by month: reference prices and indices in turn until no index moves any more."""
    index = dict.fromkeys(sorted({m for _, m, _, _ in rows}), 1.0)
    first = min(index)
    total, value = defaultdict(float), defaultdict(float)
    for x, m, p, q in rows:
        total[x] += q
        value[m] += p * q
    while True:
        v, volume = defaultdict(float), defaultdict(float)
        for x, m, p, q in rows:
            v[x] += q / total[x] * p / index[m]
        for x, m, _, q in rows:
            volume[m] += v[x] * q
        new = {m: value[m] / value[first] / (volume[m] / volume[first]) for m in index}
        if max(abs(new[m] - index[m]) for m in index) <= 1e-13:
            return new
        index = new


def test_geary_khamis(spark, observed):
    got = values(spark, "geary_khamis")
    want = {(item, m): v for item, rows in observed.items() for m, v in geary_khamis(rows).items()}
    assert set(got) == set(want) and all(math.isclose(got[k], v, rel_tol=1e-5) for k, v in want.items())


def test_geary_khamis_all_periods(spark, observed):
    """Each index is the last one of the run over the months up to it; early, middle and late ones are looked at."""
    got = values(spark, "geary_khamis_all_periods")
    assert set(got) == {(item, row[1]) for item, rows in observed.items() for row in rows}
    months = sorted({m for _, m in got})
    for item, rows in observed.items():
        for end in (months[2], months[len(months) // 2], months[-1]):
            if (item, end) in got:
                assert math.isclose(got[item, end], geary_khamis([r for r in rows if r[1] <= end])[end], rel_tol=2e-3)


def test_geary_khamis_converges_slowly(spark):
    """Between two months the index is that of the products they share; the less of those, the more rounds."""
    rows = [("g", x, date(2020, m, 1), p, q) for x, m, p, q in (("a", 1, 1.0, 100.0), ("b", 2, 1.0, 100.0), ("c", 1, 1.0, 0.1), ("c", 2, 3.0, 0.1))]
    df = spark.createDataFrame(rows, "g string, product_id string, month date, price double, quantity double")
    for every in (False, True):
        got = {r["month"]: r["index_value"] for r in operator.geary_khamis(df, ["g"], every, 1e-9).collect()}
        assert got[date(2020, 1, 1)] == 1 and math.isclose(got[date(2020, 2, 1)], 3, rel_tol=1e-4)


@pytest.fixture(scope="module")
def brute(observed):
    return Brute([(item, *row) for item, rows in observed.items() for row in rows])


PAIRS = [f"{n}_bilateral" for n in ("jevons", "laspeyres", "paasche", "fisher", "tornqvist")]
GEKS = [f"geks_{n}" for n in ("jevons", "laspeyres", "paasche", "tornqvist")]
RYGEKS = [f"rygeks_{n}" for n in ("jevons", "laspeyres", "paasche", "fisher", "tornqvist")]


@pytest.mark.parametrize("name", PAIRS)
def test_pairs(spark, brute, name):
    got = {(r["item"], r["base_month"], r["month"]): r["index_value"] for r in registry.queries()[name](spark, SF).collect()}
    want = brute.pairs(name.removesuffix("_bilateral"))
    assert set(got) == set(want) and all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-6) for k, v in want.items())


@pytest.mark.parametrize("name", GEKS + RYGEKS)
def test_geks(spark, brute, name):
    got = values(spark, name)
    want = brute.geks(name.partition("_")[2], registry.WINDOW if name in RYGEKS else None)
    assert set(got) == set(want) and all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-6) for k, v in want.items())


@pytest.mark.parametrize(("name", "at"), [("product_by_month_prices", 2), ("product_by_month_quantities", 3)])
def test_product_by_month(spark, observed, name, at):
    df = registry.queries()[name](spark, SF)
    assert df.columns == ["item", "product_id", *sorted({str(row[1]) for rows in observed.values() for row in rows})]
    got = {(r["item"], r["product_id"], m): r[m] for r in df.collect() for m in df.columns[2:] if r[m] is not None}
    want = {(item, row[0], str(row[1])): row[at] for item, rows in observed.items() for row in rows}
    assert set(got) == set(want) and all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-6) for k, v in want.items())


def test_columns_as_they_are(spark, con):
    names = con.sql(f"WITH {observations.SQL} SELECT l_orderkey, l_linenumber, product_name FROM quotes").fetchall()
    got = sorted(map(tuple, registry.queries()["classify_keywords"](spark, SF).select("l_orderkey", "l_linenumber", "product_name", "classified").collect()))
    words = {k.lower() for k in registry.KEYWORDS}
    assert got == sorted((o, n, x, int(bool(words & set(re.split(r"\W+", x.lower()))))) for o, n, x in names)
