"""Name -> query and name -> SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables: `t.orders` is a DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def views(self, *names: str) -> None:
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)


def query(name: str, oracle: str | None = None):
    """Register `fn(tables) -> DataFrame`."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def sql_query(name: str, tables: str, text: str, oracle: str | None = None) -> None:
    """Register SQL that runs unchanged on both sides unless `oracle` differs."""

    def run(t: Tables) -> DataFrame:
        t.views(*tables.split())
        return t.spark.sql(text)

    query(name, oracle if oracle is not None else text)(run)


def r(c: Column | str, digits: int = 4) -> Column:
    """Double rounded for comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits).cast("double")


def n(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
