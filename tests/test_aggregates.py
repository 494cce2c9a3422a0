import math

import pytest
from plan_util import plan_text

from arrivals_mart.contracts import DEMOGRAPHICS_INPUT, TEMPERATURES_INPUT
from arrivals_mart.operators import group_means, lookup_means, lookup_unmatched
from arrivals_mart.plans.tables import DEMOGRAPHIC_MEANS, country_dimension, demographics_dimension


def _demo(spark):
    rows = [
        # city, state, age, male, female, total, vets, foreign, hh, code, race, count
        ("A", "S1", 30.0, 10, 10, 20, 1, 1, 2.0, "S1", "r1", 5),
        ("A", "S1", 30.0, 10, 10, 20, 1, 1, 2.0, "S1", "r2", 7),  # same city, other race
        ("B", "S1", 40.0, 30, None, None, None, 3, 3.0, "S1", "r1", 1),
        ("C", "S2", None, None, None, None, None, None, None, "S2", "r1", 1),  # all null
        ("D", "S9", 50.0, 1, 1, 2, 1, 1, 1.0, None, "r1", 1),  # no state code
    ]
    return spark.createDataFrame(rows, DEMOGRAPHICS_INPUT)


def test_group_means_counts_each_city_once(spark):
    out = group_means(_demo(spark), "stateCode", DEMOGRAPHIC_MEANS, drop=("race", "count"))
    got = {r["stateCode"]: r for r in out.collect()}
    assert set(got) == {"S1", "S2", None}
    assert got["S1"]["average_median_age"] == 35.0
    assert got["S1"]["average_male_population"] == 20.0
    assert got["S1"]["average_female_population"] == 10.0  # nulls ignored
    assert got["S2"]["average_median_age"] is None  # all-null group


def test_demographics_dimension_leaves_out_null_state(spark):
    out = demographics_dimension(_demo(spark))
    assert sorted(r["stateCode"] for r in out.collect()) == ["S1", "S2"]


def _temps(spark):
    rows = [
        (None, 10.0, 1.0, "c1", "Mexico", None, None),
        (None, 20.0, 3.0, "c2", "Mexico", None, None),
        (None, None, None, "c3", "Albania", None, None),  # all-null country
        (None, 5.0, 1.0, "c4", "ALGERIA", None, None),  # differs in case
        (None, 7.0, 1.0, "c5", "Atlantis", None, None),  # no code
    ]
    return spark.createDataFrame(rows, TEMPERATURES_INPUT)


def _codes(spark):
    return spark.createDataFrame(
        [(582, "Mexico"), (101, "Albania"), (316, "Algeria"), (999, "Nowhere")], "country_code int, country string"
    )


def test_lookup_means(spark):
    got = sorted(tuple(r) for r in country_dimension(_codes(spark), _temps(spark)).collect())
    assert got == [(101, "Albania", None, None), (582, "Mexico", 15.0, 2.0)]


def test_means_keep_all_digits(spark):
    """Values past six decimal places count whole, in any order."""
    groups = {
        "small": [1e-7, 3e-7, 2e-7],
        "long": [0.1234567, 12.00000049, -3.3333333333333335] * 40,
        "tiny": [1e-300, 3e-300],
        "plain": [1.25, 2.5, 26.704],
        "huge": [1e300, 1.0],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    for kind, near in (("double", 1e-12), ("float", 1e-6)):
        docs = spark.createDataFrame(rows, "k string, v double")
        if kind == "float":
            docs = docs.where("k not in ('tiny', 'huge')").selectExpr("k", "cast(v AS float) AS v")
        got = {r["k"]: r["m"] for r in group_means(docs, "k", {"m": "v"}, distinct_rows=False).collect()}
        for k, m in got.items():
            assert m == pytest.approx(math.fsum(groups[k]) / len(groups[k]), rel=near, abs=0), (kind, k)
        turned = docs.repartition(7).orderBy(docs["v"].desc())
        again = {r["k"]: r["m"] for r in group_means(turned, "k", {"m": "v"}, distinct_rows=False).collect()}
        assert again["long"] == got["long"] and again["small"] == got["small"]


def test_lookup_unmatched(spark):
    got = sorted(tuple(r) for r in lookup_unmatched(_codes(spark), _temps(spark), "country", "Country").collect())
    assert got == [(316, "Algeria"), (999, "Nowhere")]


def test_lookup_means_generic_names(spark):
    facts = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 5.0)], "n string, v double")
    codes = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "c int, name string")
    out = lookup_means(codes, facts, "c", "name", "n", {"mean_v": "v"}, out_code="code", out_name="label")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 2.0), (2, "y", 5.0)]


def test_lookup_plan_is_inner_and_broadcasts_codes(spark):
    out = country_dimension(_codes(spark), _temps(spark))
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()  # as it ran
    assert "BroadcastHashJoin" in text
    assert "LeftOuter" not in text


def test_lookup_unmatched_without_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        out = lookup_unmatched(_codes(spark), _temps(spark), "country", "Country")
        assert sorted(tuple(r) for r in out.collect()) == [(316, "Algeria"), (999, "Nowhere")]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_means_do_not_depend_on_the_order(spark):
    values = [0.1 * i + 1e9 * (i % 7) for i in range(2000)]
    rows = [(1, v) for v in values] + [(2, float("nan")), (2, 1.0), (3, None), (4, float("inf"))]
    facts = spark.createDataFrame(rows, "k int, v double")
    seen = set()
    for n in (1, 3, 16):
        got = {r.k: r.m for r in group_means(facts.repartition(n, "v"), "k", {"m": "v"}, distinct_rows=False).collect()}
        assert math.isnan(got[2]) and got[3] is None and got[4] == math.inf
        seen.add(got[1])
    assert len(seen) == 1
    assert seen.pop() == pytest.approx(math.fsum(values) / len(values), rel=1e-12)
