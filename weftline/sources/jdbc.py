"""Database reads over JDBC. The query runs in the database, the rows arrive in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.functions.columns import quote

# --- fixed values: driver class and URL start per kind of database ---
DRIVERS = {"postgresql": "org.postgresql.Driver", "pgvector": "org.postgresql.Driver",
           "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver"}
# --- end of fixed values ---


@dataclass(frozen=True)
class Split:
    """How to cut a table scan into parallel range scans on one numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def read_options(kind: str, url: str, query: str | None = None, table: str | None = None, schema: str | None = None,
                 split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    if kind == "pgvector" and not query:
        raise ValueError("a vector source needs a query")
    if not query and not table:
        raise ValueError("a database source needs table_name or query")
    options = {"url": url, "driver": DRIVERS.get(kind, ""), "fetchsize": str(fetch_size)}
    options = {k: v for k, v in options.items() if v}
    name = f"{schema}.{table}" if schema and table else table
    if split is None:
        return {**options, **({"query": query} if query else {"dbtable": name})}
    # `query` cannot be combined with a split, a subquery can.
    source = f"({query.rstrip().rstrip(';')}) src" if query else name
    return {**options, "dbtable": source, "partitionColumn": split.column, "lowerBound": str(split.lower),
            "upperBound": str(split.upper), "numPartitions": str(split.partitions)}


def read_jdbc(spark: SparkSession, kind: str, url: str, properties: dict | None = None, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(kind, url, **kw), **(properties or {})).load()


def vectors_from_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """`[0.1,0.2]` text, as a vector column travels over JDBC, to array<double>."""
    return df.withColumns({c: F.from_json(F.col(quote(c)).cast("string"), "array<double>") for c in columns})
