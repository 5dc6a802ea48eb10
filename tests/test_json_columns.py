"""Flattening of JSON documents whose shape varies by row."""

import json

import pytest
from pyspark.sql import functions as F

from weftline.operators.jsonflat import (
    Options, context_activities, discover, field_coverage, find_json_column, flatten_json, leaves_from_json,
    leaves_to_json, parse, split_records,
)

RAW = Options(type_inference=False)


def flat(spark, texts, options=RAW, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, event string")
    out = flatten_json(df, "event", options, **kw)
    return out, [r.asDict() for r in out.orderBy("id").collect()]


def test_nested_objects_join_their_keys(spark):
    _, rows = flat(spark, ['{"a":{"b":1,"c d":2}}'])
    assert rows == [{"id": 0, "a_b": "1", "a_c_d": "2"}]


def test_text_in_one_row_and_object_in_another(spark):
    _, rows = flat(spark, ['{"a":"str","n":null}', '{"a":{"b":1}}', '{"a":{}}'])
    assert rows[0] == {"id": 0, "a": "str", "a_b": None, "n": None}
    assert rows[1] == {"id": 1, "a": None, "a_b": "1", "n": None}
    assert rows[2] == {"id": 2, "a": None, "a_b": None, "n": None}


def test_array_of_objects(spark):
    _, rows = flat(spark, ['{"l":[{"x":1},{"x":2,"y":"q"}]}'])
    assert rows == [{"id": 0, "l": '[{"x":1}, {"x":2,"y":"q"}]', "l_count": "2", "l_first_x": "1", "l_0_x": "1",
                     "l_1_x": "2", "l_1_y": "q"}]


def test_only_three_items_are_indexed(spark):
    out, rows = flat(spark, ['{"l":[{"x":1},{"x":2},{"x":3},{"x":4}]}'])
    assert "l_2_x" in out.columns and "l_3_x" not in out.columns
    assert rows[0]["l_count"] == "4"


@pytest.mark.parametrize("mode,expected", [
    ("json_string", {"p": "[1, 2]"}), ("first_item", {"p": "1"}), ("count", {"p_count": "2"}),
])
def test_array_of_primitives(spark, mode, expected):
    _, rows = flat(spark, ['{"p":[1,2]}'], Options(type_inference=False, array_handling=mode))
    assert rows == [{"id": 0, **expected}]


def test_empty_array_and_empty_object(spark):
    out, rows = flat(spark, ['{"e":[],"o":{}}'])
    assert rows == [{"id": 0, "e": "[]", "e_count": "0"}]


def test_top_level_array_gives_rows(spark):
    _, rows = flat(spark, ['[{"z":1},{"z":2}]', "[]", '[[{"z":3}],{"z":4}]'])
    assert sorted((r["id"], r["z"]) for r in rows) == [(0, "1"), (0, "2"), (2, "3"), (2, "4")]


def test_top_level_value_and_null(spark):
    _, rows = flat(spark, ["7", "null"])
    assert rows == [{"id": 0, "value": "7"}, {"id": 1, "value": None}]


def test_bad_text_keeps_its_row(spark):
    _, rows = flat(spark, ['{"a":1}', "bad", "  ", None])
    assert [r["a"] for r in rows] == ["1", None, None, None]


@pytest.mark.parametrize("text,want", [
    ('{"a":NaN,"b":1}', '{"a":null,"b":1}'),
    ('[-Infinity, Infinity,NaN]', '[null,null,null]'),
    (r'{"NaN":"NaN, \"NaN\" ,NaN","b\\":NaN}', r'{"NaN":"NaN, \"NaN\" ,NaN","b\\":null}'),
    ('{"a":"","b":-Infinity}', '{"a":"","b":null}'),
    ('{"a":xNaN}', None), ('{"a":"x"NaN}', None), ('{"a":"NaN}', None), ('{"a":"NaN"}', '{"a":"NaN"}'),
])
def test_bare_nan_is_null(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(F.to_json(parse(F.col("t"))).alias("j")).first().j
    assert (got is None) == (want is None) and (want is None or json.loads(got) == json.loads(want))


def test_very_long_text_with_nan(spark):
    text = '{"x":NaN,"a":[' + ",".join([r'"q\"\\ NaN"'] * 100_000) + "]}"
    got = spark.createDataFrame([(text,)], "t string").select(F.try_variant_get(parse(F.col("t")), "$.a[99999]", "string").alias("j")).first().j
    assert got == 'q"\\ NaN'


def test_deep_documents_take_another_pass(spark):
    text = "1"
    for i in range(20):
        text = '{"k%d":%s}' % (i, text)
    out, rows = flat(spark, [text], Options(type_inference=False, clean_column_names=False, separator="."))
    assert rows[0][".".join(f"k{i}" for i in reversed(range(20)))] == "1"


def test_depth_limit_leaves_json_text(spark):
    _, rows = flat(spark, ['{"a":{"b":{"c":1}},"x":2}'], Options(max_depth=1, type_inference=False))
    assert rows == [{"id": 0, "a": '{"b":{"c":1}}', "x": "2"}]


def test_prefix_collision_and_original_column(spark):
    df = spark.createDataFrame([(1, '{"id":5}')], "id int, event string")
    row = flatten_json(df, "event", Options(include_original=True, type_inference=False)).first().asDict()
    assert row == {"id": 1, "event": '{"id":5}', "id_1": "5"}
    row = flatten_json(df, "event", Options(column_prefix="j_", type_inference=False)).first().asDict()
    assert row == {"id": 1, "j_id": "5"}


def test_null_handling(spark):
    _, rows = flat(spark, ['{"a":1,"n":null}'], Options(null_handling="empty_string"))
    assert rows == [{"id": 0, "a": "1", "n": ""}]
    out, _ = flat(spark, ['{"a":1,"n":null}'], Options(null_handling="drop", type_inference=False))
    assert out.columns == ["id", "a"]


def test_type_inference(spark):
    out, rows = flat(spark, [
        '{"i":1,"d":1.5,"m":"1","b":true,"w":"yes","time":"2024-01-01 10:00:00","s":"x"}',
        '{"i":2,"d":2,"m":"x","b":false,"w":"No","time":"2024-01-02","s":"1"}'], Options())
    types = dict(out.dtypes)
    assert types["i"] == "bigint" and types["d"] == "double" and types["m"] == "string"
    assert types["b"] == "boolean" and types["w"] == "boolean"
    assert types["time"] == "timestamp" and types["s"] == "string"
    assert [r["w"] for r in rows] == [True, False]


def test_mostly_numeric_column_stays_text(spark):
    out, _ = flat(spark, ['{"a":"%s"}' % v for v in [*range(9), "x"]], Options())
    assert dict(out.dtypes)["a"] == "string"


def test_large_whole_numbers_are_not_rounded(spark):
    ids = [1234567890123456789, 1234567890123456788]
    out, rows = flat(spark, ['{"a":%d}' % v for v in ids], Options())
    assert dict(out.dtypes)["a"] == "bigint" and [r["a"] for r in rows] == ids
    out, rows = flat(spark, ['{"a":"12345678901234567890"}', '{"a":"1.5"}'], Options())
    assert [r["a"] for r in rows] == ["12345678901234567890", "1.5"]


def test_arrays_in_arrays_of_any_depth(spark):
    out, rows = flat(spark, ['[[[[[[{"a":1}]]]],[]],{"a":2}]', '{"a":3}', "bad", None])
    assert sorted((r["id"], r["a"]) for r in rows if r["a"]) == [(0, "1"), (0, "2"), (1, "3")] and len(rows) == 5


def test_places_of_equal_cleaned_names_stay_apart(spark):
    out, rows = flat(spark, ['{"a b":1,"a_b":2}', '{"a":{"b":3}}'])
    assert [r["a_b"] for r in rows] == [None, "3"] and [(r["a_b_1"], r["a_b_2"]) for r in rows] == [("1", "2"), (None, None)]


def test_more_than_ten_spellings_of_booleans(spark):
    words = ["true", "TRUE", "True", "tRue", "yes", "YES", "Yes", "no", "NO", "No", "n", "N"]
    out, rows = flat(spark, ['{"a":"%s"}' % w for w in words], Options())
    assert [r["a"] for r in rows] == [w.lower() in ("true", "yes") for w in words]


def test_known_field_list_skips_discovery(spark):
    df = spark.createDataFrame([('{"a":1}',)], "event string")
    leaves = leaves_from_json(leaves_to_json(discover(split_records(df, "event"))))
    wide = spark.createDataFrame([('{"a":3,"b":4}',)], "event string")
    assert flatten_json(wide, "event", RAW, leaves=leaves).collect()[0].asDict() == {"a": "3"}


def test_find_json_column(spark):
    assert find_json_column(spark.createDataFrame([("x", "y")], "a string, Payload string")) == "Payload"
    df = spark.createDataFrame([("x", None, 1), ("x", ' {"k":1}', 2)], "a string, b string, c int")
    assert find_json_column(df) == "b"
    assert find_json_column(df.select("a")) is None


def test_activities_preset(spark):
    text = '{"c":[{"id":"u1","objectType":"Activity","definition":{"type":"t","name":{"en":"Hi"},"description":"d"}}]}'
    df = spark.createDataFrame([(text,)], "event string").select(parse_col())
    row = df.select(*[c.alias(n) for n, c in context_activities(df["doc"], ("c",), "ctx").items()]).first()
    assert (row.ctx_0_id, row.ctx_first_name, row.ctx_0_definition_description, row.ctx_first_type) == ("u1", "Hi", "d", "t")
    assert row.ctx_1_id is None


def parse_col():
    from pyspark.sql import functions as F
    return parse(F.col("event")).alias("doc")


def test_field_coverage(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    rows = {r.field: (r.filled, r.coverage) for r in field_coverage(df, ["a", "b"]).collect()}
    assert rows == {"a": (3, 100.0), "b": (1, 33.33)}


def test_both_ways_of_discovery_agree(spark, monkeypatch):
    from weftline.operators import jsonflat

    texts = ['{"a":{"b":1,"c d":2.5}}', '{"a":"x","n":null}', '{"a":{}}', '{"p":[1,2],"q":[[1]],"e":[]}', '{"l":[{"x":1},{"y":[1]}]}',
             '{"m":[1,{"x":1}],"k: DECIMAL(1,2)":{"z":1.25},"A":1,"t<":{"u":[null]}}', "7", "null", '{"":{"w":true}}', '{"x`y":{"v":"s"}}']
    docs = split_records(spark.createDataFrame([(t,) for t in texts], "event string"), "event")
    for options in (Options(), Options(max_depth=1)):
        by_shape = discover(docs, options=options)
        monkeypatch.setattr(jsonflat, "MAX_SHAPES", 1)
        assert discover(docs, options=options) == by_shape
        monkeypatch.undo()
    paths = {x.path for x in by_shape}
    assert {("",), ("x`y",), ("t<",), ("k: DECIMAL(1,2)",)} <= paths
