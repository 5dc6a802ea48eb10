"""Task outputs kept between steps: lineage columns, lookup, SQL over them, retention.

Outputs are Parquet under `<root>/<dag>/<task>/<run>/`, whatever kind the spec
asks for, except `temp_file`, which gives JSON lines. The register itself is a
small append-only table with one row per staged output.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.sinks.tables import newest_version, table_exists

# --- fixed values ---
STAGE_FORMATS = {"temp_database": "parquet", "temp_postgres": "parquet", "temp_file": "json", "temp_datalake": "parquet"}
LINEAGE = ["_dag_id", "_task_id", "_run_date", "_created_at"]
REGISTRY_SCHEMA = ("key string, dag_id string, task_id string, run_date timestamp, kind string, format string, "
                   "path string, name string, ddl string, created_at timestamp, dropped boolean, version bigint")
DEFAULT_DAYS = 7
# --- end of fixed values ---


def stage_name(dag_id: str, task_id: str, run: datetime) -> str:
    return f"{dag_id}_{task_id}_{run:%Y%m%d_%H%M%S}"


def with_lineage(df: DataFrame, dag_id: str, task_id: str, run: datetime, created: datetime) -> DataFrame:
    return df.withColumns({
        "_dag_id": F.lit(dag_id), "_task_id": F.lit(task_id),
        "_run_date": F.lit(run).cast("timestamp"), "_created_at": F.lit(created).cast("timestamp")})


class Stage:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.registry_path = f"{self.root}/registry"

    def registry(self) -> DataFrame:
        """Current state of every staged output."""
        if not self._exists(self.registry_path):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        rows = self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.registry_path)
        return newest_version(rows, ["key"], "version").filter(~F.col("dropped"))

    def _exists(self, path: str) -> bool:
        return table_exists(self.spark, path)

    def _log(self, row: tuple) -> None:
        self.spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(self.registry_path)

    def put(self, df: DataFrame, dag_id: str, task_id: str, run: datetime, kind: str = "temp_database",
            created: datetime | None = None, mode: str = "overwrite") -> str:
        """Stage the rows with lineage columns and register the place; returns the path."""
        if kind not in STAGE_FORMATS:
            raise ValueError(f"unknown staging kind: {kind}")
        created = created or datetime.now()
        path = f"{self.root}/{dag_id}/{task_id}/{run:%Y%m%d_%H%M%S}"
        staged = with_lineage(df, dag_id, task_id, run, created)
        staged.write.mode(mode).format(STAGE_FORMATS[kind]).save(path)
        ddl = staged.schema.json()
        self._log((self.key(dag_id, task_id, run), dag_id, task_id, run, kind, STAGE_FORMATS[kind], path,
                   stage_name(dag_id, task_id, run), ddl, created, False, self._version()))
        return path

    @staticmethod
    def key(dag_id: str, task_id: str, run: datetime) -> str:
        return f"{dag_id}:{task_id}:{run.isoformat()}"

    @staticmethod
    def _version() -> int:
        import time
        return time.time_ns()

    def locate(self, dag_id: str, task_id: str, run: datetime | None = None):
        """Registry row of one output, the newest run when none is named; None if there is none."""
        rows = self.registry().filter((F.col("dag_id") == dag_id) & (F.col("task_id") == task_id))
        if run is not None:
            rows = rows.filter(F.col("key") == self.key(dag_id, task_id, run))
        return rows.orderBy(F.desc("run_date"), F.desc("version")).first()

    def get(self, dag_id: str, task_id: str, run: datetime | None = None, lineage: bool = False) -> DataFrame:
        from pyspark.sql.types import StructType
        import json

        place = self.locate(dag_id, task_id, run)
        if place is None:
            raise KeyError(f"no staged output for {dag_id}:{task_id}")
        df = self.spark.read.schema(StructType.fromJson(json.loads(place.ddl))).format(place.format).load(place.path)
        return df if lineage else df.drop(*LINEAGE)

    def query(self, sql: str | None, dag_id: str, task_ids: list[str], run: datetime | None = None) -> DataFrame:
        """SQL over staged outputs named by task id; without SQL, all rows of the first one."""
        for task_id in task_ids:
            self.get(dag_id, task_id, run).createOrReplaceTempView(task_id)
        return self.spark.sql(sql or f"SELECT * FROM `{task_ids[0]}`")

    def drop(self, dag_id: str, task_id: str, run: datetime) -> None:
        """Delete one staged output, as after the last load that needs it."""
        place = self.locate(dag_id, task_id, run)
        if place is not None:
            self._delete(place)

    def _delete(self, place) -> None:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(place.path)
        jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)
        self._log((place.key, place.dag_id, place.task_id, place.run_date, place.kind, place.format, place.path,
                   place.name, place.ddl, place.created_at, True, self._version()))

    def cleanup(self, now: datetime, days_to_keep: int = DEFAULT_DAYS) -> list[str]:
        """Delete outputs older than the given days; one registry row per output, never data rows."""
        limit = now - timedelta(days=days_to_keep)
        old = self.registry().filter(F.col("created_at") < F.lit(limit)).collect()
        for place in old:
            self._delete(place)
        return sorted(p.path for p in old)
