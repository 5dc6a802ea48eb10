"""Writes, evolution, staging, sources and whole specs."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from weftline.operators.quality import QualityGateError
from weftline.operators.staging import LINEAGE, Stage, stage_name
from weftline.plans.runner import Runner, first_non_empty
from weftline.plans.spec import SinkSpec, SourceSpec, SpecError, load_plan, load_plans, order_tasks, parse_plan, save_plan, validate_plan
from weftline.sinks import outbound
from weftline.sinks.registry import write_many, write_sink
from weftline.sinks.shape import align_to, evolve, serialize_for_sink, spark_type, widened, with_schema
from weftline.sinks.tables import evolve_table, read_table, table_exists, usable_sort, write_table
from weftline.sources import files, jdbc, remote
from weftline.sources.documents import filter_documents
from weftline.sources.normalize import normalize_types
from weftline.sources.registry import read_source, with_run_date

RUN = datetime(2024, 3, 5, 7)


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "table")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


# --- writes ---

def test_modes(spark, place):
    assert write_table(frame(spark, [(1, "a"), (2, "b")]), place, "overwrite").created
    assert write_table(frame(spark, [(2, "B"), (3, "c")]), place, "upsert", keys=["k"]).rows == 2
    assert rows(read_table(spark, place)) == [(1, "a"), (2, "B"), (3, "c")]
    write_table(frame(spark, [(3, "C"), (9, "x")]), place, "update", keys=["k"])
    assert rows(read_table(spark, place)) == [(1, "a"), (2, "B"), (3, "C")]
    write_table(frame(spark, [(3, "no"), (4, "d")]), place, "insert_only", keys=["k"])
    assert rows(read_table(spark, place)) == [(1, "a"), (2, "B"), (3, "C"), (4, "d")]
    write_table(frame(spark, [(4, "d")]), place, "append")
    assert read_table(spark, place).count() == 5
    write_table(frame(spark, [(7, "z")]), place, "overwrite")
    assert rows(read_table(spark, place)) == [(7, "z")]


def test_empty_input_leaves_the_table(spark, place):
    write_table(frame(spark, [(1, "a")]), place, "overwrite")
    assert write_table(frame(spark, []), place, "overwrite").rows == 0
    assert rows(read_table(spark, place)) == [(1, "a")]


def test_upsert_reads_what_it_writes(spark, place):
    """The input may come from the table itself."""
    write_table(frame(spark, [(1, "a"), (2, "b")]), place, "overwrite")
    write_table(read_table(spark, place).withColumn("v", F.upper("v")), place, "upsert", keys=["k"])
    assert rows(read_table(spark, place)) == [(1, "A"), (2, "B")]


def test_upsert_null_keys_and_new_columns(spark, place):
    write_table(frame(spark, [(None, "a"), (1, "b")]), place, "overwrite")
    write_table(spark.createDataFrame([(None, "c", 5)], "k int, v string, extra int"), place, "upsert", keys=["k"])
    assert {(r.k, r.v, r.extra) for r in read_table(spark, place).collect()} == {(None, "c", 5), (1, "b", None)}


def test_partition_upsert_leaves_other_partitions_alone(spark, place):
    schema = "p string, k int, v string"
    write_table(frame(spark, [("x", 1, "a"), ("y", 1, "b"), ("y", 2, "c")], schema), place, "overwrite", partition_by=["p"])
    fs = lambda: {f for f in read_table(spark, place).inputFiles() if "/p=x/" in f}
    before = fs()
    write_table(frame(spark, [("y", 2, "C"), ("z", 1, "d")], schema), place, "upsert", keys=["p", "k"], partition_by=["p"])
    assert sorted((r.p, r.k, r.v) for r in read_table(spark, place).collect()) == [("x", 1, "a"), ("y", 1, "b"), ("y", 2, "C"), ("z", 1, "d")]
    assert before and fs() == before


def test_a_failing_input_leaves_the_old_table(spark, place):
    write_table(frame(spark, [(1, "a")]), place, "overwrite")
    broken = spark.range(2).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") == 1, F.raise_error(F.lit("no"))).cast("string").alias("v"))
    with pytest.raises(Exception):
        write_table(broken, place, "overwrite")
    assert rows(read_table(spark, place)) == [(1, "a")]


def test_missing_requirements(spark, place):
    with pytest.raises(ValueError):
        write_table(frame(spark, [(1, "a")]), place, "upsert")
    with pytest.raises(FileNotFoundError):
        write_table(frame(spark, [(1, "a")]), place, "append", auto_create=False)
    with pytest.raises(ValueError):
        write_table(frame(spark, [(1, "a")]), place, "merge")
    assert not table_exists(spark, place)


def test_types_widen_or_fail(spark, place):
    assert widened(T.IntegerType(), T.LongType()) == T.LongType()
    assert widened(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    with pytest.raises(TypeError):
        widened(T.LongType(), T.BooleanType())
    write_table(frame(spark, [(1, "a")]), place, "overwrite")
    wide = spark.createDataFrame([(2**40, "b")], "k bigint, v string")
    with pytest.raises(TypeError):
        write_table(wide, place, "append")
    evolve_table(spark, place, wide.schema)
    write_table(wide, place, "append")
    assert rows(read_table(spark, place)) == [(1, "a"), (2**40, "b")]
    fitted, schema = evolve(frame(spark, [(1, "a")]), wide.schema)
    assert fitted.schema["k"].dataType == T.LongType() and all(f.nullable for f in schema.fields)


def test_column_types_from_database_names():
    names = {"INTEGER": "int", "VARCHAR(50)": "string", "NUMERIC(12,2)": "decimal(12,2)", "DECIMAL(10,2) NOT NULL": "decimal(10,2)",
             "TIMESTAMP": "timestamp", "Nullable(Int64)": "bigint", "jsonb": "string", "double precision": "double"}
    assert {k: spark_type(k) for k in names} == names


def test_shapes(spark):
    df = spark.createDataFrame([("a", "b", 1)], "customer_full_name string, customer_full_name_of_record string, other int")
    assert align_to(df, ["customer_full_name"]).first().customer_full_name == "a; b"
    same = spark.createDataFrame([("a", ""), ("", "b"), ("a", "a"), (None, None)], "customer_full_name string, customer_full_name_of_record string")
    assert [r[0] for r in align_to(same, ["customer_full_name"]).collect()] == ["a", "b", "a", None]
    assert with_schema(df, {"other": "VARCHAR(5)", "new": "DATE"}).dtypes == [("other", "string"), ("new", "date")]
    assert usable_sort(df, ["other", "gone"]) == ["other"]


def test_serialized_values(spark):
    df = spark.sql("""SELECT double('NaN') AS nan, double('-Infinity') AS inf, 'Null' AS word, 'x' AS keep, CAST(1.5 AS DECIMAL(3,1)) AS d,
        array(1, 2) AS arr, named_struct('a', 1, 'b', CAST(NULL AS INT)) AS st, X'C328' AS raw, X'61' AS utf""")
    row = serialize_for_sink(df).first()
    assert (row.nan, row.inf, row.word, row.keep, row.d) == (None, None, None, "x", 1.5)
    assert (row.arr, row.st, row.raw, row.utf) == ("[1,2]", '{"a":1,"b":null}', "c328", "a")


def test_many_sinks(spark, tmp_path):
    done = write_many(frame(spark, [(1, "a")]), [SinkSpec("good", "file", file_path=str(tmp_path / "g")), SinkSpec("bad", "custom")], {})
    assert done["good"].rows == 1 and done["bad"].startswith("error")
    with pytest.raises(SpecError):
        write_sink(frame(spark, [(1, "a")]), SinkSpec("x", "postgresql"), {})


def test_outbound_rest_batches(spark, tmp_path):
    folder = str(tmp_path)

    def send(batch):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump(batch, f)

    sink = SinkSpec("s", "rest_api", "api", batch_size=10)
    assert write_sink(spark.range(0, 25, 1, 2), sink, {"api": {"send": send}}).rows == 25
    sent = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    assert sorted(x["id"] for b in sent for x in b) == list(range(25)) and max(map(len, sent)) == 10


def test_outbound_files(spark, tmp_path):
    folder = str(tmp_path)

    def put(path, content):
        with open(f"{folder}/{path.replace('/', '_')}", "wb") as f:
            f.write(content)

    outbound.write_remote_files(spark.range(0, 10, 1, 2), put, "out", "csv")
    outbound.write_remote_files(spark.range(0, 10, 1, 2), put, "out", "json")
    assert sum(len(p.read_text().splitlines()) - 1 for p in tmp_path.glob("*.csv")) == 10
    assert sum(len(p.read_text().splitlines()) for p in tmp_path.glob("*.json")) == 10


def test_outbound_files_are_committed_as_a_whole(spark, tmp_path):
    root = str(tmp_path)

    def put(path, content):
        if b"boom" in content:
            raise OSError("no room")
        with open(f"{root}/{path.replace('/', '_')}", "wb") as f:
            f.write(content)

    def listed(path):
        return [n.removeprefix("out_") for n in os.listdir(root)]

    def remove(path):
        os.remove(f"{root}/{path.replace('/', '_')}")

    def parts():
        return sorted(n for n in os.listdir(root) if "part-" in n)

    def rows():
        return sorted(json.loads(x)["v"] for n in parts() for x in open(f"{root}/{n}"))

    def write(df, **more):
        connection = {"put": put, "list": listed, "remove": remove}
        return write_sink(df, SinkSpec("s", "sftp", "c", file_path="out", file_format="json", **more), {"c": connection}).rows

    four = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("v"))
    assert write(four) == 100 and len(parts()) == 4 and len(rows()) == 100
    with pytest.raises(Exception, match="no room"):
        write(spark.range(0, 9, 1, 3).select(F.when(F.col("id") == 8, "boom").otherwise("x").alias("v")))
    assert len(parts()) == 4 and len(rows()) == 100
    assert write(spark.range(0, 10, 1, 1).select(F.lit("b").alias("v"))) == 10 and len(parts()) == 1 and rows() == ["b"] * 10
    told = json.loads((tmp_path / "out__committed").read_text())
    assert told["rows"] == 10 and [f"out_{n}" for n in told["files"]] == parts()
    assert write(four.limit(0)) == 0 and parts() == []
    outbound.write_remote_files(four.coalesce(1), put, "out", "json", listed, remove, file_bytes=100)
    assert len(parts()) > 5 and len(rows()) == 100


def test_outbound_csv_text(spark, tmp_path):
    root = str(tmp_path)

    def put(path, content):
        with open(f"{root}/{path.replace('/', '_')}", "wb") as f:
            f.write(content)

    import csv
    data = [('a,"b"', "x\ny"), ("", None), (None, "back\\slash"), (" pad ", "\u00e9")]
    outbound.write_remote_files(spark.createDataFrame(data, "`n,1` string, v string").coalesce(1), put, "out", "csv")
    [name] = [n for n in os.listdir(root) if n.endswith("csv")]
    got = list(csv.reader(open(f"{root}/{name}", newline="")))
    assert got[0] == ["n,1", "v"] and sorted(map(tuple, got[1:])) == sorted((a or "", b or "") for a, b in data)


def test_database_upserts(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        class Recorder:
            def cursor(self):
                return self

            def executemany(self, statement, batch):
                import uuid
                with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
                    json.dump([statement, batch], f)

            def commit(self):
                pass

            close = commit

        return Recorder()

    df = spark.createDataFrame([(1, "a", 1.5), (1, "a", 1.5), (2, "null", float("nan"))], "k int, v string, n double")
    sink = SinkSpec("s", "postgresql", "pg", "upsert", "public", "t", upsert_keys=["k"], batch_size=1)
    assert write_sink(df, sink, {"pg": {"url": "jdbc:x", "connect": connect}}).rows == 2
    sent = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    assert {s for s, _ in sent} == {'INSERT INTO public.t ("k", "v", "n") VALUES (%s, %s, %s) ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v", "n" = EXCLUDED."n"'}
    assert sorted(tuple(r) for _, b in sent for r in b) == [(1, "a", 1.5), (2, None, None)]
    assert outbound.upsert_statement("t", ["k"], ["k"]).endswith("DO NOTHING")


def test_database_options():
    options = outbound.jdbc_write_options("postgresql", "jdbc:x", "t", "s")
    assert options["dbtable"] == "s.t" and options["batchsize"] == "1000" and options["truncate"] == "true"
    assert outbound.jdbc_write_options("clickhouse", "jdbc:x", "t")["batchsize"] == "10000"
    assert outbound.merge_tree_options(["a", "gone"], ["a", "b"], "toYYYYMM(d)") == "ENGINE = MergeTree() ORDER BY (a) PARTITION BY toYYYYMM(d)"
    assert outbound.merge_tree_options([], ["a"]).endswith("ORDER BY tuple()")
    assert jdbc.read_options("postgresql", "u", table="t", schema="s")["dbtable"] == "s.t"
    split = jdbc.read_options("postgresql", "u", query="SELECT 1;", split=jdbc.Split("id", 0, 100, 4))
    assert split["dbtable"] == "(SELECT 1) src" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        jdbc.read_options("pgvector", "u", table="t")
    with pytest.raises(ValueError):
        jdbc.read_options("clickhouse", "u")


# --- sources ---

def test_paths():
    assert files.expand_path("/d/{year}/{month}/{day}/{hour}/{ds}/{ts}", RUN) == "/d/2024/3/5/7/2024-03-05/2024-03-05T07:00:00"


def test_file_formats(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "a.csv").write_text("x,y\n1,a\n2,\n")
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "a.dat").write_bytes(b"\x00\x01")
    read = lambda n: files.read_files(spark, str(tmp_path / n))
    assert [r.x for r in read("a.json").collect()] == [1, 2]
    assert read("a.csv").dtypes == [("x", "int"), ("y", "string")]
    assert read("a.txt").first().content == "one\ntwo"
    assert bytes(read("a.dat").first().content) == b"\x00\x01"
    assert read("gone.json").count() == 0
    assert files.read_files(spark, str(tmp_path / "gone.csv"), schema="x int").columns == ["x"]


def test_wildcards_cross_folders(spark, tmp_path):
    for name in ("2024/a.json", "2024/deep/b.json", "2025/c.json"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text('{"f": "%s"}' % path.stem)
    got = files.read_wildcard(spark, f"{tmp_path}/{{year}}*.json", run=RUN, schema="f string")
    assert sorted(r.f for r in got.collect()) == ["a", "b"]
    assert sorted(r.f for r in files.read_wildcard(spark, f"file:{tmp_path}/2024*.json").collect()) == ["a", "b"]
    assert files.read_wildcard(spark, f"{tmp_path}/none*.json", schema="f string").count() == 0
    odd = tmp_path / "a b+c%d" / "x.json"
    odd.parent.mkdir()
    odd.write_text('{"f": "odd"}')
    for schema in (None, "f string"):
        assert [r.f for r in files.read_wildcard(spark, f"{tmp_path}/a b+*.json", schema=schema).collect()] == ["odd"]


@pytest.mark.parametrize("document,expected", [
    ({"a": 1}, [1]), ({"a": {"$ne": 1}}, [2, 3]), ({"a": None}, [3]), ({"a": {"$in": [1, None]}}, [1, 3]), ({"a": {"$nin": [1]}}, [2, 3]),
    ({"a": {"$gt": 1}}, [2]), ({"a": {"$gte": 1, "$lt": 2}}, [1]), ({"$or": [{"a": 1}, {"b": "y"}]}, [1, 2]), ({"$nor": [{"a": 1}]}, [2, 3]),
    ({"$and": [{"b": {"$regex": "^[xy]"}}, {"a": {"$exists": True}}]}, [1, 2]), ({"a": {"$not": {"$gt": 1}}}, [1, 3]), ({"gone": {"$exists": False}}, [1, 2, 3]),
    ({"gone": "x"}, []),
])
def test_filter_documents(spark, document, expected):
    df = spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (3, None, "z")], "_id int, a int, b string")
    assert sorted(int(r._id) for r in filter_documents(df, document).collect()) == expected


def test_unknown_filter_operator(spark):
    with pytest.raises(ValueError):
        filter_documents(spark.range(1), {"id": {"$near": 1}})


def test_statement_pages_are_followed(spark):
    def fetch(request):
        if "link" in request:
            return {"statements": [{"id": request["link"]}], "more": ""}
        day = request["params"]["since"][:10]
        return {"statements": [{"id": f"{day}-a"}], "more": f"{day}-b"}

    got = remote.read_statements(spark, fetch, datetime(2024, 1, 1), datetime(2024, 1, 3), 1, timedelta(days=1))
    assert got.rdd.getNumPartitions() == 2
    assert sorted(json.loads(r.event)["id"] for r in got.collect()) == ["2024-01-01-a", "2024-01-01-b", "2024-01-02-a", "2024-01-02-b"]


@pytest.mark.parametrize("answer,expected", [
    ([{"a": 1}, {"a": 2}], ['{"a":1}', '{"a":2}']), ({"results": [{"a": 1}]}, ['{"a":1}']), ({"a": 1}, ['{"a":1}']), (7, ['{"data":7}']), ([], []),
])
def test_answers_are_unwrapped(spark, answer, expected):
    got = remote.read_rest(spark, lambda request: answer, [{"endpoint": "/x"}], RUN)
    assert [r.record.replace(" ", "") for r in got.collect()] == expected


def test_run_date_goes_into_rest_requests(spark):
    got = remote.read_rest(spark, lambda request: request["params"], [{"params": {"q": 1}}], RUN)
    assert json.loads(got.first().record) == {"q": 1, "execution_date": "2024-03-05T07:00:00", "ds": "2024-03-05"}


def test_remote_files(spark):
    store = {"/a.csv": b'x,y\n1,"two\nlines"\n2,\n', "/a.json": b'[{"x": 1}, {"x": 2}]'}
    got = remote.read_remote_files(spark, store.get, ["/a.csv", "/gone.csv"])
    parsed = remote.parse_remote_files(got, "csv", "x int, y string")
    assert sorted((r.x, r.y) for r in parsed.collect()) == [(1, "two\nlines"), (2, None)]
    parsed = remote.parse_remote_files(remote.read_remote_files(spark, store.get, ["/a.json"]), "json", "x int")
    assert sorted(r.x for r in parsed.collect()) == [1, 2]


def test_normalized_values(spark):
    df = spark.sql("""SELECT CAST(1.50 AS DECIMAL(5,2)) AS d, DATE '2024-01-02' AS day, TIMESTAMP_NTZ '2024-01-02 03:04:05.5' AS t, X'C328' AS raw, X'61' AS utf,
        map(DATE '2024-01-01', array(DATE '2024-01-02')) AS m, named_struct('x', CAST(2 AS DECIMAL(3,1))) AS s""")
    row = normalize_types(df).first()
    assert (row.d, row.day, row.t, row.raw, row.utf) == (1.5, "2024-01-02", "2024-01-02T03:04:05.500000", "c328", "a")
    assert row.m == {"2024-01-01": ["2024-01-02"]} and row.s.x == 2.0


def test_vectors_from_text(spark):
    df = spark.createDataFrame([("[0.5,1]",)], "v string")
    assert jdbc.vectors_from_text(df, ["v"]).first().v == [0.5, 1.0]


def test_unknown_source(spark):
    with pytest.raises(SpecError):
        read_source(spark, SourceSpec("x", "custom"), {}, RUN)
    with pytest.raises(SpecError):
        read_source(spark, SourceSpec("x", "file"), {}, RUN)


# --- staging ---

def test_staging_round_trip(spark, place):
    stage = Stage(spark, place)
    df = spark.createDataFrame([(1, [1, 2], "a")], "k int, arr array<int>, v string")
    for kind in ("temp_database", "temp_file", "temp_datalake", "temp_postgres"):
        stage.put(df, "d", f"t_{kind}", RUN, kind)
        assert stage.get("d", f"t_{kind}").collect() == df.collect()
    assert set(LINEAGE) <= set(stage.get("d", "t_temp_file", lineage=True).columns)
    assert stage.query("SELECT v FROM t_temp_file WHERE k = 1", "d", ["t_temp_file"]).first().v == "a"
    assert stage.query(None, "d", ["t_temp_database"]).count() == 1
    assert stage_name("d", "t", RUN) == "d_t_20240305_070000"
    with pytest.raises(KeyError):
        stage.get("d", "gone")
    with pytest.raises(ValueError):
        stage.put(df, "d", "t", RUN, "shelf")


def test_staging_keeps_runs_apart_and_forgets_old_ones(spark, place):
    stage = Stage(spark, place)
    for day in (1, 2, 9):
        stage.put(spark.range(day), "d", "t", datetime(2024, 1, day), created=datetime(2024, 1, day))
    assert stage.get("d", "t").count() == 9 and stage.get("d", "t", datetime(2024, 1, 2)).count() == 2
    assert len(stage.cleanup(datetime(2024, 1, 10), 7)) == 2
    assert stage.registry().count() == 1
    stage.drop("d", "t", datetime(2024, 1, 9))
    assert stage.registry().count() == 0


# --- specs ---

def task(task_id, kind="dummy", **kw):
    return {"task_id": task_id, "operator_type": kind, **kw}


def problems(*tasks, **kw):
    return validate_plan(parse_plan({"dag_id": "d", "tasks": list(tasks), **kw}))


def test_validation():
    assert problems(task("a"), task("b", depends_on=["a"])) == []
    assert any("more than once" in p for p in problems(task("a"), task("a")))
    assert any("waits for x" in p for p in problems(task("a", depends_on=["x"])))
    assert any("from which to extract" in p for p in problems(task("a", "extract")))
    assert len(problems(task("a", "load"))) == 2
    assert any("circle" in p for p in problems(task("a", depends_on=["b"]), task("b", depends_on=["a"])))
    assert any("add upsert_keys" in p for p in problems(task("z"), task("a", "load", depends_on=["z"], sink={
        "name": "s", "type": "file", "file_path": "x", "write_mode": "upsert"})))
    assert len(problems()) == 1 and "add tasks" in problems()[0]
    with pytest.raises(SpecError):
        load_plan({"dag_id": "", "tasks": []})


def test_all_task_keys_are_read(tmp_path):
    plan = parse_plan({"dag_id": "d", "start_date": datetime(2024, 1, 1).date(), "quality_rules": [{"rule_name": "r", "rule_type": "unique"}], "tasks": [
        task("a", "transform", sinks=[{"name": "s", "type": "file", "file_path": "x"}], auto_sink=False, auto_sink_type="temp_file", source_task_ids=["z"], python_script_path="p.py")]})
    a = plan.tasks[0]
    assert a.sinks[0].file_path == "x" and a.auto_sink is False and a.inputs == ["z"] and a.python_script_path == "p.py"
    assert plan.global_quality_rules[0].name == "r"
    save_plan(plan, tmp_path / "plan.json", RUN)
    assert json.loads((tmp_path / "plan.json").read_text())["plan"]["dag_id"] == "d"


def test_several_plans_in_one_file():
    one = "dag_id: %s\ntasks:\n  - {task_id: a, operator_type: dummy}\n"
    assert [p.dag_id for p in load_plans(one % "x" + "---\n" + one % "y")] == ["x", "y"]
    with pytest.raises(SpecError):
        load_plan(one % "x" + "---\n" + one % "y")


def test_order():
    plan = parse_plan({"dag_id": "d", "tasks": [task("c", source_task_ids=["b"]), task("b", depends_on=["a"]), task("a")]})
    assert [t.task_id for t in order_tasks(plan)] == ["a", "b", "c"]


def test_rules_on_a_stored_target(spark, tmp_path):
    """A quality task without inputs runs every rule on its source, and fails rules that have no table."""
    path = str(tmp_path / "target.parquet")
    frame(spark, [(1, "a"), (1, None)]).write.parquet(path)
    rules = [{"name": n, "rule_type": k, "column": c, "severity": s} for n, k, c, s in (("once", "unique", "k", "critical"), ("there", "not_null", "v", "warning"), ("whole", "not_null", "k", "critical"))]
    on = {"dag_id": "d", "tasks": [task("check", "quality_check", source={"name": "s", "type": "file", "file_path": path}, quality_rules=rules)]}
    done = Runner(spark, fail_on_quality=False).run(load_plan(on), RUN)
    assert {r.rule_name: r.passed for r in done.quality["check"].collect()} == {"once": False, "there": False, "whole": True}
    with pytest.raises(QualityGateError, match="once$"):
        Runner(spark, fail_on_quality=True).run(load_plan(on), RUN)
    bare = {"dag_id": "d", "tasks": [task("check", "quality_check", quality_rules=rules)]}
    with pytest.raises(QualityGateError, match="once, whole"):
        Runner(spark, fail_on_quality=True).run(load_plan(bare), RUN)


def test_run_with_staging_and_functions(spark, tmp_path):
    plan = load_plan({"dag_id": "d", "description": "x", "tasks": [
        task("src", "extract", source={"name": "s", "type": "file", "file_path": "given"}),
        task("doubled", "transform", depends_on=["src"], python_transform="double", auto_sink_type="temp_file"),
        task("total", "transform", depends_on=["doubled"], sql_transform="SELECT SUM(id) AS s, '{{ ds }}' AS ds FROM doubled"),
        task("grouped", "transform", depends_on=["doubled"], group_by=["id"], aggregations={"id": "count"}, auto_sink=False),
        task("out", "load", depends_on=["total"], sinks=[{"name": "a", "type": "file", "file_path": str(tmp_path / "a")}, {"name": "b", "type": "custom"}]),
        task("check", "quality_check", depends_on=["doubled"])]})
    runner = Runner(spark, functions={"double": lambda data: data["src"].select((F.col("id") * 2).alias("id"))}, stage=Stage(spark, str(tmp_path / "stage")))
    done = runner.run(plan, RUN, {"src": spark.range(4)})
    assert done.frames["total"].first().asDict() == {"s": 12, "ds": "2024-03-05"}
    assert done.writes["out"]["a"].rows == 1 and done.writes["out"]["b"].startswith("error")
    assert done.quality["check"].first().rule_name == "basic_completeness"
    assert done.frames["grouped"].count() == 4 and set(done.status.values()) == {"success"}


def test_staged_outputs_can_be_dropped(spark, tmp_path):
    plan = load_plan({"dag_id": "d", "description": "x", "tasks": [
        task("src", "extract", source={"name": "s", "type": "file", "file_path": "given"}),
        task("out", "load", depends_on=["src"], sink={"name": "a", "type": "file", "file_path": str(tmp_path / "a")})]})
    stage = Stage(spark, str(tmp_path / "stage"))
    done = Runner(spark, stage=stage, drop_staged=True).run(plan, RUN, {"src": spark.range(4)})
    assert done.writes["out"]["a"].rows == 4 and done.staged == ["src"] and stage.registry().count() == 0


def test_code_inside_a_spec_is_refused(spark):
    plan = load_plan({"dag_id": "d", "description": "x", "tasks": [task("t", "transform", python_transform="def f(data):\n    return data")]})
    with pytest.raises(ValueError, match="register"):
        Runner(spark).run(plan, RUN)


def test_load_falls_back_to_its_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    plan = load_plan({"dag_id": "d", "description": "x", "tasks": [
        task("bad", "transform", python_transform="boom", trigger_rule="all_done"),
        task("out", "load", depends_on=["bad"], source={"name": "o", "type": "file", "file_path": str(tmp_path / "own"), "file_format": "parquet"},
             sink={"name": "a", "type": "file", "file_path": str(tmp_path / "a")})]})
    runner = Runner(spark, functions={"boom": lambda data: 1 / 0})
    done = runner.run(plan, RUN)
    assert done.status == {"bad": "failed", "out": "success"} and done.writes["out"]["a"].rows == 3


def test_first_non_empty(spark):
    empty = spark.range(0)
    assert first_non_empty([empty, spark.range(2)]).count() == 2
    assert first_non_empty([empty]).count() == 0
    with pytest.raises(SpecError):
        first_non_empty([])


def test_run_date_in_source_queries():
    assert with_run_date("SELECT 1 WHERE d = '{{ ds }}' AND t < '{{ts}}'", RUN) == f"SELECT 1 WHERE d = '{RUN:%Y-%m-%d}' AND t < '{RUN.isoformat()}'"
    assert with_run_date({"d": {"$gte": "{{ ds }}", "n": [1, "{{ds}}"]}}, RUN) == {"d": {"$gte": f"{RUN:%Y-%m-%d}", "n": [1, f"{RUN:%Y-%m-%d}"]}}


def test_unknown_spec_keys_are_refused():
    from weftline.plans.spec import parse_plan

    with pytest.raises(SpecError, match="sql_transfrom"):
        parse_plan({"dag_id": "d", "tasks": [{"task_id": "t", "operator_type": "transform", "sql_transfrom": "SELECT 1"}]})
