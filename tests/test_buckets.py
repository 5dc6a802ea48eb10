"""Tables in key-hash buckets against a dictionary, and what an upsert leaves alone."""

import json
from datetime import datetime
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from weftline.plans.spec import SinkSpec, SourceSpec
from weftline.sinks import buckets as B
from weftline.sinks.registry import write_sink
from weftline.sources.registry import read_source


def rows(spark, *pairs, kind="k long, v int"):
    return spark.createDataFrame(list(pairs), kind)


def content(spark, path, number=None):
    return sorted((tuple(r) for r in B.read_buckets(spark, path, number).collect()), key=repr)


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_upsert_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    first = B.upsert_buckets(rows(spark, *[(i, i) for i in range(200)]), path, ["k"], buckets=16)
    assert (first.rows, first.created) == (200, True)
    before = files(path)
    second = B.upsert_buckets(rows(spark, (7, -7), (7, -7), (500, 5)), path, ["k"])
    assert (second.rows, second.created) == (2, False)
    wanted = {i: i for i in range(200)} | {7: -7, 500: 5}
    assert content(spark, path) == sorted(wanted.items(), key=repr)
    assert content(spark, path, 1) == sorted(((i, i) for i in range(200)), key=repr)
    assert before.items() <= files(path).items()
    old, new = B.version_of(spark, path, 1).folders, B.version_of(spark, path).folders
    changed = {b for b in new if old.get(b) != new[b]}
    assert 1 <= len(changed) <= 2 and len(new) > 10
    assert B.vacuum(spark, path) == len([b for b in changed if b in old])
    assert content(spark, path) == sorted(wanted.items(), key=repr)
    with pytest.raises(ValueError):
        content(spark, path, 1)
    assert B.vacuum(spark, path) == 0


def test_null_keys_order_new_columns_and_wider_types(spark, tmp_path):
    path = str(tmp_path / "t")
    B.upsert_buckets(rows(spark, (None, 1), (1, 1), (1, 9), (2, 2)), path, ["k"], order=[F.desc("v")], buckets=4)
    assert content(spark, path) == sorted([(None, 1), (1, 9), (2, 2)], key=repr)
    B.upsert_buckets(rows(spark, (None, 5, "x"), kind="k int, v int, `a.b` string"), path, ["k"])
    assert content(spark, path) == sorted([(None, 5, "x"), (1, 9, None), (2, 2, None)], key=repr)
    B.upsert_buckets(rows(spark, (2, 1 << 40), kind="k long, v long"), path, ["k"])
    assert content(spark, path) == sorted([(None, 5, "x"), (1, 9, None), (2, 1 << 40, None)], key=repr)
    assert len({f.split("/")[0] for f in B.version_of(spark, path).folders.values()}) == 1


def test_empty_input_and_wrong_calls(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = rows(spark)
    assert B.upsert_buckets(empty, path, ["k"]).rows == 0
    assert not B.is_bucketed(spark, path)
    with pytest.raises(FileNotFoundError):
        B.read_buckets(spark, path)
    B.upsert_buckets(rows(spark, (1, 1)), path, ["k"])
    B.upsert_buckets(empty, path, ["k"])
    assert B.version_of(spark, path).number == 1
    for keys, df in ((["v"], empty), ([], empty), (["none"], empty), (["k"], empty.withColumn("_bucket", F.lit(1)))):
        with pytest.raises(ValueError):
            B.upsert_buckets(df, path, keys)


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    B.upsert_buckets(rows(spark, (1, 1)), path, ["k"], buckets=4)
    seen = B.version_of(spark, path)
    B.upsert_buckets(rows(spark, (2, 2)), path, ["k"])
    before = set(files(path))
    with monkeypatch.context() as m:
        m.setattr(B, "version_of", lambda *a: seen)
        with pytest.raises(B.ConcurrentWrite):
            B.upsert_buckets(rows(spark, (1, 100)), path, ["k"])
    assert content(spark, path) == [(1, 1), (2, 2)]
    assert set(files(path)) == before
    assert not list(Path(path).rglob("*.draft"))
    assert json.loads((Path(path) / "_versions" / "0000000002.json").read_text())["keys"] == ["k"]


def test_sink_and_source(spark, tmp_path):
    sink = SinkSpec(type="file", name="out", file_path="t", write_mode="upsert", upsert_keys=["k"], connection_id="lake", custom_config={"buckets": 8})
    lake = {"lake": {"path": str(tmp_path)}}
    for value in (1, 2):
        write_sink(rows(spark, (1, value), (value + 5, 0)), sink, lake)
    found = read_source(spark, SourceSpec(type="file", name="in", connection_id="lake", file_path="t"), lake, datetime(2024, 1, 1))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 2), (6, 0), (7, 0)]
