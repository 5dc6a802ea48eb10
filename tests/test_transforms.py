"""Cleaning, aggregation, quantiles, names, user code, vectors."""

import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from weftline.functions.names import clean_identifier, dedupe_names, match_column
from weftline.operators.aggregate import aggregate, stack
from weftline.operators.clean import clean, convert_types, decimals_to_double, drop_duplicates, fill_missing
from weftline.operators.code import resolve, run_callable, through_command
from weftline.operators.quantiles import column_quantiles, grouped_quantiles
from weftline.operators.vectors import cosine_distance, nearest

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(df, column="v"):
    return [r[column] for r in df.orderBy("id").collect()]


def test_first_row_per_key_needs_an_order(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (3, None, 5), (4, None, 4)], "id int, k string, o int")
    kept = drop_duplicates(df, ["k"], ["o"])
    assert sorted(r.id for r in kept.collect()) == [2, 4]
    with pytest.raises(ValueError):
        drop_duplicates(df, ["k"])


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0, "x", 1), (2, None, None, None), (3, 5.0, "y", 3)], "id int, v double, t string, n int")
    assert values(fill_missing(df, {"v": "fill_mean"})) == [1.0, 3.0, 5.0]
    assert values(fill_missing(df, {"v": "fill_zero"})) == [1.0, 0.0, 5.0]
    assert values(fill_missing(df, {"t": "fill_none given"}), "t") == ["x", "none given", "y"]
    assert values(fill_missing(df, {"v": "drop", "gone": "drop"})) == [1.0, 5.0]
    assert values(fill_missing(df, {"n": "fill_mean"}), "n") == [1, 2, 3]
    both = fill_missing(df.union(spark.createDataFrame([(4, 30.0, None, 5)], df.schema)), {"v": "fill_mean", "t": "drop", "n": "fill_mean"})
    assert sorted((r.v, r.n) for r in both.collect()) == [(1.0, 1.0), (5.0, 3.0)]
    with pytest.raises(ValueError):
        fill_missing(df, {"t": "fill_mean"})


def test_many_means_are_one_aggregate(spark):
    names = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame([tuple(float(i) for i in range(14)), (None,) * 14], ", ".join(f"{c} double" for c in names))
    rows = fill_missing(df, dict.fromkeys(names, "fill_mean")).collect()
    assert rows[0] == rows[1] == tuple(float(i) for i in range(14))


def test_numbers_are_plain_decimal_text(spark):
    df = spark.createDataFrame(list(enumerate([" 1.5 ", "1.5d", "1e3", "x", None, "-.5", "0x1", "NaN"])), "id int, v string")
    assert values(convert_types(df, {"v": "numeric"})) == [1.5, None, 1000.0, None, None, -0.5, None, None]


def test_other_types_change_as_a_whole(spark):
    df = spark.createDataFrame([(1, "1", "1"), (2, "2", "x")], "id int, v string, w string")
    out = convert_types(df, {"v": "int", "w": "int"})
    assert dict(out.dtypes)["v"] == "bigint" and dict(out.dtypes)["w"] == "string"


def test_ranges_keep_nulls(spark):
    df = spark.createDataFrame([(1, -5), (2, None), (3, 5), (4, 50)], "id int, v int")
    rule = {"range_validations": {"v": {"min": 0, "max": 10}}}
    assert values(clean(df, rule)) == [0, None, 5, 10]
    assert values(clean(df, rule, drop_invalid=True)) == [None, 5]
    assert values(clean(df, {"range_validations": {"v": {"max": 4.5}}})) == [-5.0, None, 4.5, 4.5]


def test_patterns_match_from_the_start(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "cab"), (3, None)], "id int, v string")
    rule = {"pattern_validations": {"v": "a|x"}}
    assert values(clean(df, rule, drop_invalid=True)) == ["ab"]
    assert values(clean(df, rule), "v_valid") == [None, False, False]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=1, max_size=30), st.integers(-50, 0), st.integers(1, 50))
def test_clamping_is_idempotent(spark, numbers, low, high):
    df = spark.createDataFrame(list(enumerate(numbers)), "id int, v int")
    rule = {"range_validations": {"v": {"min": low, "max": high}}}
    once = clean(df, rule)
    assert values(once) == values(clean(once, rule)) == [None if n is None else min(max(n, low), high) for n in numbers]


def test_category_report(spark):
    rows = [("casa", 125.75, 7.54), ("casa", 75.30, 5.04), ("livros", 89.90, 0.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "c string, a double, d double")
    out = {r.c: r for r in aggregate(df, ["c"], {"a": ["sum", "mean", "count"], "d": "sum"}).collect()}
    assert set(out) == {"casa", "livros"}
    assert out["casa"].a_sum == pytest.approx(201.05) and out["casa"].a_mean == pytest.approx(100.525)
    assert out["casa"].a_count == 2 and out["casa"].d_sum == pytest.approx(12.58)
    assert aggregate(df, ["c"], {"a": "sum"}, null_keys="keep").count() == 3


def test_half_even_and_half_up_differ(spark):
    row = spark.sql("SELECT bround(CAST(100.525 AS DECIMAL(10,3)), 2) AS e, round(CAST(100.525 AS DECIMAL(10,3)), 2) AS u").first()
    assert (float(row.e), float(row.u)) == (100.52, 100.53)


def test_aggregate_edge_cases(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 3.0, 3)], "k string, v double, o int")
    out = {r.k: r for r in aggregate(df, ["k"], {"v": ["sum", "std", "median", "first", "nunique", "size"]}, order_col="o").collect()}
    assert (out["a"].v_sum, out["a"].v_median, out["a"].v_nunique, out["a"].v_size) == (0.0, None, 0, 2)
    assert out["b"].v_std is None and out["b"].v_first == 3.0
    whole = aggregate(df, [], {"o": ["sum", "median"]}).first()
    assert (whole.o_sum, whole.o_median) == (6, 2.0)
    with pytest.raises(ValueError):
        aggregate(df, ["k"], {"v": "first"})


def test_stack_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    assert {(r.x, r.y) for r in stack([a, b]).collect()} == {(1, None), (None, "t")}


@FEW
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b"]), st.integers(0, 40)), min_size=1, max_size=200), st.sampled_from([4, 20]))
def test_quantiles_are_exact_with_tiny_brackets(spark, rows, accuracy):
    """A coarse sketch forces the bracket path even on small groups."""
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", {"q": 0.25, "m": 0.5}, accuracy).collect()}
    for key in {k for k, _ in rows}:
        v = sorted(x for k, x in rows if k == key)
        assert got[key].m == pytest.approx(statistics.median(v))
        h = 0.25 * (len(v) - 1)
        low = v[int(h)]
        assert got[key].q == pytest.approx(low + (h - int(h)) * (v[min(int(h) + 1, len(v) - 1)] - low))


def test_quantiles_of_a_large_skewed_column(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), F.lit(None).cast("double").alias("none"))
    exact = df.agg(F.percentile("v", [0.1, 0.5, 0.99]).alias("p")).first().p
    rows = {r.column: r for r in column_quantiles(df, ["v", "none"], {"a": 0.1, "b": 0.5, "c": 0.99}, 1000).collect()}
    assert [rows["v"].a, rows["v"].b, rows["v"].c] == pytest.approx(list(exact))
    assert rows["none"].a is None


def test_quantiles_narrowed_over_several_passes(spark, few=2):
    """Brackets that may hold a few values only: ties, a hot value in the middle, and a rank at its border."""
    for make in ("if(id % 10 < 7, 5000, id)", "if(id < 10000, 1, id)", "-id * 0.5"):
        df = spark.range(20_000).select(F.expr(make).cast("double").alias("v"), (F.col("id") % 3 == 0).alias("k.k"))
        want = df.agg(F.percentile("v", [0.0, 0.5, 0.3, 1.0]).alias("p")).first().p
        probs = {"a": 0.0, "b": 0.5, "c": 0.3, "d": 1.0}
        got = column_quantiles(df, ["v"], probs, 100, few).first()
        assert [got.a, got.b, got.c, got.d] == pytest.approx(list(want)), make
        by = {r[0]: r for r in grouped_quantiles(df, ["k.k"], "v", probs, 100, few).collect()}
        for r in df.groupBy("`k.k`").agg(F.percentile("v", [0.0, 0.5, 0.3, 1.0]).alias("p")).collect():
            assert [by[r[0]][x] for x in "abcd"] == pytest.approx(list(r.p)), make


@pytest.mark.parametrize("raw,clean_name", [
    ("a b!c", "a_b_c"), ("__x__", "x"), ("2nd", "field_2nd"), ("", "unnamed_field"), ("!!!", "unnamed_field"), ("é ü", "é_ü"),
    ("a" * 55, "a" * 55),
])
def test_identifiers(raw, clean_name):
    assert clean_identifier(raw) == clean_name


def test_long_identifiers_are_hashed():
    long = ["lesson_result_" + c * 50 + "_definition_name" for c in "xy"]
    short = [clean_identifier(name) for name in long]
    assert short[0] != short[1] and all(s.startswith("lesson_result_") and s.endswith("_definition_name") and len(s) <= 60 for s in short)
    assert match_column(long[0], short) == short[0]


@FEW
@given(st.text(max_size=120))
def test_cleaning_gives_a_usable_name(text):
    name = clean_identifier(text)
    assert name and len(name) <= 60 + len("field_") and not name[0].isdigit()


def test_unique_and_matched_names():
    assert dedupe_names(["c", "c", "C", "d"]) == ["c", "c_1", "C_2", "d"]
    assert match_column("exact", ["exact", "exact_2"]) == "exact"
    assert match_column("customer_full_name_of_record", ["customer_full_name", "customer_id"]) == "customer_full_name"
    assert match_column("short", ["shorter"]) is None


def test_callables(spark, tmp_path):
    df = spark.range(3)
    assert run_callable(lambda data: data["a"], {"a": df}).count() == 3
    assert run_callable(lambda data, context: data["a"].limit(context["k"]), {"a": df}, {"k": 2}).count() == 2
    assert run_callable(lambda data, **kw: data["a"].limit(kw["k"]), {"a": df}, {"k": 1}).count() == 1
    script = tmp_path / "job.py"
    script.write_text("def main(data):\n    return data['a'].limit(1)\n")
    assert run_callable(str(script), {"a": df}).count() == 1
    assert resolve("math.sqrt")(4) == 2
    with pytest.raises(TypeError):
        run_callable(lambda data: 5, {"a": df})


def test_command(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a")], "k int, s string")
    out = through_command(df, ["k", "s"], "tr ab xy", "k string, s string")
    assert sorted((r.k, r.s) for r in out.collect()) == [("1", "y"), ("2", "x")]


def test_decimals(spark):
    df = spark.sql("SELECT CAST(1.25 AS DECIMAL(5,2)) AS a, 1 AS b")
    assert decimals_to_double(df).dtypes == [("a", "double"), ("b", "int")]


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product"])
def test_vectors_against_brute_force(spark, monkeypatch, metric):
    """A table of queries in several blocks, ties, odd rows, and more neighbours asked for than there are."""
    import numpy as np
    from weftline.operators import vectors
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", 24)
    monkeypatch.setattr(vectors, "BATCH_ROWS", 7)
    rng = np.random.default_rng(1)
    data = rng.integers(-2, 3, size=(80, 6)).astype(float)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    odd = [(100, None), (101, [1.0]), (102, [None] * 6), (103, []), (104, [float("nan")] * 6)]
    df = spark.createDataFrame(rows + odd, "id bigint, v array<double>").repartition(5)
    asked = spark.createDataFrame([(i, v) for i, v in rows if i % 8 == 0] + odd[:1] + odd[2:3], "q_id bigint, q array<double>")

    def distance(q):
        with np.errstate(all="ignore"):
            return np.sqrt(((data - q) ** 2).sum(axis=1)) if metric == "l2" else -(data @ q) if metric == "inner_product" else 1 - data @ q / np.sqrt((data ** 2).sum(axis=1) * (q ** 2).sum())

    for k in (5, 200):
        got = {}
        for r in nearest(df, "v", asked, k, "id", metric, "q", "q_id").orderBy("query_id", "position").collect():
            got.setdefault(r.query_id, []).append((round(r.distance, 9), r.id))
        for i in range(0, 80, 8):
            d = distance(data[i])
            want = sorted((round(x, 9) + 0.0, j) for j, x in enumerate(d) if not np.isnan(x))[:k]
            assert [x for x, _ in got.get(i, [])] == pytest.approx([x for x, _ in want], abs=1e-8)
            if k == 200:
                assert {j for _, j in got.get(i, [])} == {j for _, j in want}
        assert set(got) <= set(range(0, 80, 8))
    zero = df.limit(1).select(cosine_distance(F.col("v"), F.array(*[F.lit(0.0)] * 6)).alias("d")).first()
    assert zero.d is None
