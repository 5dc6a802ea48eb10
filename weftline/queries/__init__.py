"""Registered queries, each over whole tables, most with a SQL twin to check against."""

from __future__ import annotations

from weftline.queries.registry import ORACLES, QUERIES


def load_all() -> None:
    from weftline.queries import (  # noqa: F401
        alerting, cleaning, json_columns, monitoring, quality, relational, remote, sqlsurface, streams, tables, vectors,
    )


__all__ = ["ORACLES", "QUERIES", "load_all"]
