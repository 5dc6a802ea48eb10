"""SQL names of transform text, by value; where a name has no SQL form, the error is Spark's own."""

from datetime import date, datetime

import pytest

from weftline.plans.runner import Runner


def values(spark, text):
    return tuple(Runner(spark).sql(f"SELECT {text}", {}, {}).first())


def test_times(spark):
    assert values(spark, "strftime('%Y/%j %w %W %s %f 100%%', '2024-02-29 10:11:12.5'), strftime('%Y', 'no time'), strftime(NULL, '2024-01-01')") == (
        "2024/060 4 09 1709201472 12.500 100%", None, None)
    assert values(spark, "datetime('2024-01-31', '+1 month'), datetime('2024-01-31 10:00:00', 'start of month', '-1 day')") == (
        "2024-03-02 00:00:00", "2023-12-31 00:00:00")
    assert values(spark, "datetime(1700000000, 'unixepoch'), datetime('2460310.5'), time_of('12:30'), datetime('2024-01-31', 'weekday 1')") == (
        "2023-11-14 22:13:20", "2024-01-01 00:00:00", "12:30:00", "2024-02-05 00:00:00")
    assert values(spark, "datetime('2024-01-31', 'sideways'), datetime('2024-02-29', '+1 year', '-2 hours'), datetime('')") == (
        None, "2025-02-28 22:00:00", None)
    assert values(spark, "day_of('2024-05-06', 'start of year'), unixepoch('2024-01-31'), julianday('2024-01-31'), datetime(DATE'2024-01-31')") == (
        date(2024, 1, 1), 1706659200, 2460340.5, "2024-01-31 00:00:00")


def test_glob_and_json(spark):
    cases = {("s*[t-z]", "sat"): True, ("s*[t-z]", "sa"): False, ("[*]x", "*x"): True, ("[*]x", "ax"): False, ("[^a]b", "cb"): True,
             ("a.c", "abc"): False, ("a*", "a\n\nb"): True, ("[]a]", "]"): True, ("(a+b)$", "(a+b)$"): True, ("A*", "abc"): False,
             ("a*", "b a"): False, ("", ""): True, ("?", ""): False, ("[&&a]", "&"): True, ("\\d", "\\d"): True, ("*]", "a]"): True}
    rows = spark.createDataFrame([(i, p, x) for i, (p, x) in enumerate(cases)], "i int, p string, x string")
    found = Runner(spark).sql("SELECT glob(p, x) AS hit FROM t ORDER BY i", {"t": rows}, {}).collect()
    assert [r.hit for r in found] == list(cases.values())
    assert values(spark, """glob(NULL, 'a'), json_extract('{"a":{"b":2}}', '$.a.b'), json_extract('broken', '$.a')""") == (None, "2", None)


@pytest.mark.parametrize("text", ["iif(true, 1, 2)", "max(1, 2)", "group_concat(1)", "total(1)"])
def test_names_without_a_form(spark, text):
    with pytest.raises(Exception):
        values(spark, text)


def test_run_date(spark):
    sql = "SELECT day_of(:ds, '-1 day') AS d, strftime('%H', '{{ ts }}') AS h"
    got = Runner(spark).sql(sql, {}, {"ds": "2024-03-01", "ts": datetime(2024, 3, 1, 7).isoformat()}).first()
    assert (got.d, got.h) == (date(2024, 2, 29), "07")
