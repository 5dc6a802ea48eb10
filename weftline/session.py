"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package relies on. They can be set on
# a session that somebody else created, so `tune` works on the driver's session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Each map task keeps only its own top k rows per group before a shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Of a key that stands twice in a JSON object the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Small batches to and from Python, so that texts of a few kilobytes do not fill its memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Streaming state lives outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Temporary folders of local sessions without a configured one, by application.
_LOCAL_DIRS: dict[str, str] = {}
# Folders that `freeze` has written and `release` has not deleted yet, oldest first.
_FROZEN: list[str] = []


def build_session(app: str = "weftline", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in `spark.checkpoint.dir`. Where that is unset the session
    is a local one (tests), and a temporary folder is created once.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="weftline-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df, label: str = "frozen", options: dict[str, str] | None = None):
    """Cut lineage: write to the shared folder, with the writer's options, and read the files back."""
    path = scratch_path(df.sparkSession, label)
    _FROZEN.append(path)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frozen() -> tuple[str, ...]:
    """Folders written by `freeze` and not released."""
    return tuple(_FROZEN)


def release(spark: SparkSession, paths) -> None:
    """Delete folders of `freeze` that no later read needs."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _FROZEN.remove(path)
