"""Vector distances and nearest neighbours over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators.vectors import cosine_distance, inner_product, l2_distance, nearest
from weftline.queries.registry import query, r


def probe(size: int, shift: int) -> list[float]:
    """A fixed query vector: a short repeating ramp."""
    return [((i + shift) % 7 - 3) / 10 for i in range(size)]


def probe_sql(shift: int) -> str:
    return f"list_transform(range(len(embedding)), lambda i: ((i + {shift}) % 7 - 3) / 10)"


DISTANCES = """
SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(e, q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 5) AS l2,
 round(1 - list_inner_product(e, q) / sqrt(list_inner_product(e, e) * list_inner_product(q, q)), 5) AS cosine,
 round(list_inner_product(e, q), 5) AS ip FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST(%s AS DOUBLE[]) AS q FROM embeddings)""" % probe_sql(0)


def width(t) -> int:
    return t.embeddings.select(F.size("embedding").alias("w")).first().w


@query("vector_distances", DISTANCES)
def _(t):
    q = F.lit(probe(width(t), 0)).cast("array<double>")
    e = F.col("embedding")
    return t.embeddings.select("vec_id", r(l2_distance(e, q), 5).alias("l2"), r(cosine_distance(e, q), 5).alias("cosine"), r(inner_product(e, q), 5).alias("ip"))


def nearest_sql(distance: str, k: int) -> str:
    """Every row whose id is divisible by 20 against all rows."""
    return f"""SELECT query_id, id, position, round(d, 5) AS distance FROM (
 SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY d, id))::INTEGER AS position FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, {distance} AS d FROM v a CROSS JOIN v b WHERE a.vec_id % 20 = 0)) WHERE position <= {k}"""


VECTORS = "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) "


def search(t, k: int, metric: str):
    found = nearest(t.embeddings, "embedding", t.embeddings.filter("vec_id % 20 = 0"), k, "vec_id", metric)
    return found.select("query_id", "id", "position", r("distance", 5).alias("distance"))


@query("vector_nearest", VECTORS + nearest_sql("sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))", 10))
def _(t):
    return search(t, 10, "l2")


@query("vector_nearest_cosine", VECTORS + nearest_sql("1 - list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e))", 20))
def _(t):
    return search(t, 20, "cosine")
