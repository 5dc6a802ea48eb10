"""Scored rules and profiles on rows with planted faults."""

from datetime import date, datetime
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from weftline.operators import profile as P
from weftline.operators.clean import clean, drop_duplicates
from weftline.operators.quality import (
    QualityGateError, Rule, check_target, gate, rules_or_default, run_rules, summarize,
)

NOW = datetime(2024, 3, 9)
EMAIL = r"^[a-z]+@[a-z]+[.][a-z]+$"
ROWS = [
    (11, "Chair", 40, "ann@shop.org", "0201", date(2024, 3, 1), 71.0, "home", True),
    (12, None, 55, "bob@shop.org", "0202", date(2024, 3, 2), 64.5, "home", True),
    (13, "Lamp", 70, "lamp-at-shop", "0203", date(2024, 3, 3), 120.0, "light", False),
    (14, "Lamp", 70, "lamp-at-shop", "0203", date(2024, 3, 3), 120.0, "light", False),
    (15, "Desk", -5, "dee@shop.org", "0205", date(2024, 3, 4), 55.0, "home", True),
    (16, "Rug", 2500, "rug@shop", "0206", date(2024, 3, 5), 33.0, "floor", True),
    (17, "", 12, "eve@shop.org", "", date(2024, 3, 6), 0.0, "", True),
    (18, "Vase", 90, "fay@shop.org", "0208", date(2024, 3, 7), 88.0, "home", True),
    (19, "Sofa", 310, "gus@shop.org", "0209", date(2024, 3, 8), 15.0, "home", True),
    (20, "Bowl", 8, "hal@shop.org", "0210", date(2024, 3, 8), 47.5, "table", True),
]
SCHEMA = "id int, name string, value int, email string, phone string, created_date date, score double, category string, is_valid boolean"


@pytest.fixture(scope="module")
def faulty(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def score(df, rule):
    return run_rules(df, [rule], NOW).first()


@pytest.mark.parametrize("rule,expected", [
    (Rule("r", "not_null", "name"), 0.9),
    (Rule("r", "unique", "name"), 0.8),
    (Rule("r", "pattern", "email", {"pattern": EMAIL}), 0.7),
    (Rule("r", "range", "value", {"min_value": 0, "max_value": 1000}), 0.8),
    (Rule("r", "range", "score", {"min_value": 0, "max_value": 100}), 0.8),
    (Rule("r", "completeness"), 89 / 90),
    (Rule("r", "row_count"), 1.0),
    (Rule("r", "custom", parameters={"expression": "avg(if(is_valid, 1D, 0D))"}), 0.8),
    (Rule("r", "freshness", "created_date", {"max_age_hours": 48}), 0.5),
])
def test_scores(faulty, rule, expected):
    assert score(faulty, rule).score == pytest.approx(expected)


def test_threshold_decides(faulty):
    assert not score(faulty, Rule("r", "not_null", "name")).passed
    assert score(faulty, Rule("r", "not_null", "name", threshold=0.9)).passed


def test_all_null_column_passes_range_and_pattern(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert score(df, Rule("r", "range", "a", {"min_value": 1})).score == 1.0
    assert score(df, Rule("r", "pattern", "b", {"pattern": "x"})).score == 1.0


@pytest.mark.parametrize("rule,text", [
    (Rule("r", "not_null", "gone"), "no column"), (Rule("r", "range", "value"), "give"),
    (Rule("r", "pattern", "email"), "give"), (Rule("r", "pattern", "email", {"pattern": "("}), "cannot be read"),
    (Rule("r", "validity", "email"), "no rule is called"), (Rule("r", "custom"), "give"),
    (Rule("r", "custom", parameters={"function": lambda df: 1 / 0}), "the function raised"),
    (Rule("r", "pattern", "email", {"pattern": "(?P<x>a)"}), "cannot be read"), (Rule("r", "custom", parameters={"expression": "avg(nope)"}), "cannot be resolved"),
    (Rule("r", "custom", parameters={"expression": "avg("}), "cannot be resolved"), (Rule("r", "custom", parameters={"query": "SELECT count(*) FROM no_such_table"}), "cannot be resolved"),
    (Rule("r", "range", "email", {"min_value": [1]}), "cannot be resolved"), (Rule("r", "freshness", "created_date", {"max_age_hours": "soon"}), "cannot be resolved"),
])
def test_unusable_rules_fail_with_a_reason(faulty, rule, text):
    row = score(faulty, rule)
    assert not row.passed and row.score == 0.0 and text in row.details


def test_a_broken_rule_leaves_the_others(faulty):
    good = Rule("ok", "not_null", "id")
    for broken in (Rule("bad", "pattern", "email", {"pattern": "(?P<x>a)"}), Rule("bad", "custom", parameters={"expression": "avg(nope)"}), Rule("bad", "custom", parameters={"query": "SELECT 1 FROM nope"})):
        rows = {r.rule_name: r for r in run_rules(faulty, [broken, good], NOW).collect()}
        assert rows["ok"].passed and not rows["bad"].passed and "error" in rows["bad"].details


def test_gate_without_results(spark):
    """A critical rule that has no result, as on an empty table, does not let the run pass."""
    rules = [Rule("key", "not_null", "id", severity="critical"), Rule("soft", "not_null", "name")]
    results = run_rules(spark.createDataFrame([], SCHEMA), rules, NOW)
    assert gate(results, fail_on_error=False, asked=rules) == ["key"]
    with pytest.raises(QualityGateError):
        gate(results, asked=rules)


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "a double")
    assert score(df, Rule("r", "not_null", "a")).score == 0.5


def test_empty_input_gives_no_results(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert run_rules(df, [Rule("r", "not_null", "name"), Rule("u", "unique", "id")], NOW).count() == 0
    some = run_rules(df, [Rule("n", "row_count", severity="critical"), Rule("r", "not_null", "name")], NOW)
    assert gate(some, fail_on_error=False) == ["n"]


def test_summary_and_gate(faulty):
    results = run_rules(faulty, [Rule("a", "not_null", "id", severity="critical"), Rule("b", "unique", "name", severity="critical")], NOW)
    row = summarize(results).first()
    assert (row.total_checks, row.passed_checks, row.failed_checks, row.overall_score) == (2, 1, 1, 0.9)
    assert gate(results, fail_on_error=False) == ["b"]
    with pytest.raises(QualityGateError):
        gate(results)


def test_sql_rules_on_a_target(spark, faulty):
    faulty.createOrReplaceTempView("target")
    rules = [Rule("rows", "custom", parameters={"query": "SELECT count(*) FROM target", "min_threshold": 10}),
             Rule("bad", "custom", parameters={"query": "SELECT count(*) FROM target", "max_threshold": 9}),
             Rule("many", "custom", parameters={"query": "SELECT value FROM target", "max_threshold": 1e9}),
             Rule("skipped", "not_null", "name")]
    assert {r.rule_name: r.passed for r in check_target(spark, rules, NOW).collect()} == {"rows": True, "bad": False, "many": False}


def test_default_rules():
    assert rules_or_default(None, None)[0].threshold == 0.95
    assert rules_or_default([], [Rule("g", "unique")])[0].name == "g"


def test_valid_and_invalid_add_up(faulty):
    import json
    details = json.loads(score(faulty, Rule("r", "range", "value", {"min_value": 0, "max_value": 1000})).details)
    assert details["valid_count"] + details["invalid_count"] == details["total_non_null_rows"] == 10


def test_clamped_values_are_in_range(faulty):
    fixed = clean(faulty, {"range_validations": {"value": {"min": 0, "max": 1000}}})
    assert score(fixed, Rule("r", "range", "value", {"min_value": 0, "max_value": 1000})).score == 1.0


def test_duplicate_rows(faulty):
    assert drop_duplicates(faulty.drop("id")).count() == 9


def test_profile_of_numbers(faulty):
    row = P.profile(faulty, include=["value"]).first()
    assert (row["mean"], row["median"], row.q25, row.q75) == (315.0, 62.5, 19.0, 85.0)
    assert row["std"] == pytest.approx(stdev(r[2] for r in ROWS))
    assert (row["count"], row.null_count, row.unique_count) == (10, 0, 9)


def test_profile_of_text_dates_and_single_values(spark, faulty):
    rows = {r.column: r for r in P.profile(faulty, exclude=["id"]).collect()}
    assert rows["name"].null_percentage == 10.0 and rows["name"].min_length == 0
    assert rows["category"].most_common.startswith('[{"value":"home","n":5}')
    assert rows["created_date"].date_range_days == 7
    one = P.profile(spark.createDataFrame([(5,)], "a int")).first()
    assert one["std"] == 0.0 and one["median"] == 5.0


def test_profile_of_empty_and_all_null(spark):
    row = P.profile(spark.createDataFrame([(None,)], "a int")).first()
    assert row["count"] == 1 and row.null_percentage == 100.0 and row["median"] is None and row["std"] is None


def test_approximate_profile_is_close(spark):
    df = spark.range(10_000).withColumn("v", F.col("id") * 2)
    row = P.profile(df, include=["v"], approx=True).first()
    assert row["median"] == pytest.approx(9999, rel=0.01) and row.unique_count == pytest.approx(10_000, rel=0.1)
