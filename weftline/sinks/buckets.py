"""A table in buckets by key hash: an upsert rewrites only the buckets its keys fall into.

Folder `path` holds `v-<id>/_bucket=<b>/` (Parquet files of one write) and
`_versions/<number>.json`: key columns, number of buckets, stored schema and the folder
of every bucket. The highest number is the table; it appears by one rename that fails
where the number exists, so a reader always sees one whole version and of two writers at
the same time one gets `ConcurrentWrite` and has changed nothing. Files of earlier
versions stay until `vacuum`, and untouched buckets keep theirs for good.

A lost executor repeats tasks; a lost driver leaves a folder no version names. Key columns
may hold nulls (equal to each other). Of input rows with equal keys one is kept, the
first in `order`. An empty input makes no version. New columns are added (null before);
where a stored type has to widen, all buckets are rewritten once. The number of buckets is
fixed by the first write; it bounds the version file and what one upsert reads.

The rename needs a file system whose rename is atomic, such as HDFS or a local disk.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from weftline.functions.columns import quote
from weftline.session import scratch_path
from weftline.sinks.shape import conform, evolve
from weftline.sinks.tables import WriteResult, _delete, _fs, latest_per_key, merge_upsert

BUCKETS = 256
_BUCKET = "_bucket"
_VERSIONS = "_versions"


class ConcurrentWrite(RuntimeError):
    """Another writer has finished since this one began; run the write again."""


@dataclass(frozen=True)
class Version:
    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType
    folders: dict[int, str]

    def text(self) -> str:
        return json.dumps({"keys": list(self.keys), "buckets": self.buckets, "schema": self.schema.jsonValue(),
                           "folders": {str(b): f for b, f in sorted(self.folders.items())}})


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path.rstrip('/')}/{_VERSIONS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json") and not x.startswith((".", "_")))


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def version_of(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or one by number; None where there is no table."""
    known = _numbers(spark, path)
    if number is None and not known:
        return None
    number = known[-1] if number is None else number
    if number not in known:
        raise ValueError(f"{path} has no version {number}")
    text = spark.read.text(f"{path.rstrip('/')}/{_VERSIONS}/{number:010d}.json", wholetext=True).first()[0]
    raw = json.loads(text)
    return Version(number, tuple(raw["keys"]), raw["buckets"], T.StructType.fromJson(raw["schema"]),
                   {int(b): f for b, f in raw["folders"].items()})


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """The version file appears whole or not at all."""
    fs, folder = _fs(spark, f"{path.rstrip('/')}/{_VERSIONS}")
    fs.mkdirs(folder)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(folder, f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(version.text().encode()))
    finally:
        out.close()
    files = hadoop.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        files.rename(draft, hadoop.Path(folder, f"{version.number:010d}.json"), no_options)
    except Exception as problem:
        fs.delete(draft, False)
        if version.number in _numbers(spark, path):
            raise ConcurrentWrite(f"{path} has a version {version.number} already") from problem
        raise


def _bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quote(k)) for k in keys]), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, version: Version, only=None) -> DataFrame:
    folders = [f"{path.rstrip('/')}/{f}" for b, f in sorted(version.folders.items()) if only is None or b in only]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_buckets(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """All rows of the newest version, or of the version with that number."""
    version = version_of(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"{path} is no table in buckets")
    return _read(spark, path, version)


def _write(df: DataFrame, path: str, keys, buckets: int) -> str:
    """Write the rows by bucket to a new folder of the table; large buckets are split over tasks."""
    folder = f"v-{uuid.uuid4().hex}"
    rows = df.withColumn(_BUCKET, _bucket_of(keys, buckets)).hint("rebalance", F.col(_BUCKET))
    rows.write.partitionBy(_BUCKET).parquet(f"{path.rstrip('/')}/{folder}")
    return folder


def upsert_buckets(df: DataFrame, path: str, keys: list[str], order: list[Column] | None = None, buckets: int = BUCKETS) -> WriteResult:
    """Replace rows with the same keys, add the others. The input is computed once."""
    spark = df.sparkSession
    if _BUCKET in df.columns:
        raise ValueError(f"a column may not be named {_BUCKET}")
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise ValueError(f"key columns not in the data: {', '.join(missing) or 'none given'}")
    old = version_of(spark, path)
    if old is not None and tuple(keys) != old.keys:
        raise ValueError(f"{path} has the keys {', '.join(old.keys)}")
    version = old or Version(0, tuple(keys), buckets, T.StructType(), {})
    counter = Observation()
    staged = scratch_path(spark, "incoming")
    if old is not None:
        # A key hashes by its type, so it gets the stored one before.
        df = df.withColumns({k: F.col(quote(k)).cast(old.schema[k].dataType) for k in keys})
    latest_per_key(df, keys, order).observe(counter, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    try:
        rows = int(counter.get["rows"])
        if not rows:
            return WriteResult(path, "upsert", 0, columns=df.columns)
        incoming = spark.read.schema(df.schema).parquet(staged)
        # At most one number for each bucket.
        touched = {r[0] for r in incoming.select(_bucket_of(keys, version.buckets)).distinct().collect()}
        merged = incoming
        if old is not None:
            _, schema = evolve(incoming, old.schema)
            if any(schema[f.name].dataType != f.dataType for f in old.schema.fields):
                touched |= set(old.folders)
            merged = merge_upsert(_read(spark, path, old, touched), incoming, keys)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in merged.schema.fields])
        folder = _write(conform(merged, schema), path, keys, version.buckets)
        fresh = {b: f"{folder}/{_BUCKET}={b}" for b in touched}
        try:
            _commit(spark, path, replace(version, number=version.number + 1, schema=schema, folders={**version.folders, **fresh}))
        except ConcurrentWrite:
            _delete(spark, f"{path.rstrip('/')}/{folder}")
            raise
    finally:
        _delete(spark, staged)
    return WriteResult(path, "upsert", rows, created=old is None, columns=df.columns)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the newest `keep` versions and every folder those do not name.

    Not while a write or a reader of an earlier version is running. Returns the number of folders deleted.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    known = _numbers(spark, path)
    named: set[str] = set()
    for number in known[-keep:]:
        named |= set(version_of(spark, path, number).folders.values())
    gone = 0
    fs, root = _fs(spark, path)
    for write in [s.getPath() for s in fs.listStatus(root)] if known else []:
        if not write.getName().startswith("v-"):
            continue
        parts = [s.getPath() for s in fs.listStatus(write) if s.getPath().getName().startswith(f"{_BUCKET}=")]
        left = [p for p in parts if f"{write.getName()}/{p.getName()}" in named]
        for part in [write] if not left else [p for p in parts if p not in left]:
            fs.delete(part, True)
            gone += 1
    versions = f"{path.rstrip('/')}/{_VERSIONS}"
    for number in known[:-keep]:
        _delete(spark, f"{versions}/{number:010d}.json")
    return gone
