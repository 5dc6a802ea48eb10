"""Document fingerprints: a Merkle tree over paragraphs and sections, in SQL functions only.

A section is what stands between blank lines, a paragraph is a line. The fingerprint holds
    root : paragraph digests, `,` between paragraphs and `;` between sections : sketch
The root is a digest of the section digests, which are digests of the paragraph digests; equal roots mean equal
texts, and the first differing branch locates an edit. The sketch holds the SKETCH smallest hashes
of the leaves (PIECE code points of a paragraph); it gives the likeness of two texts, the
share of common leaves, also where every paragraph was touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SKETCH = 128
PIECE = 12
BUCKET_DOCS = 1000
BROADCAST_ROWS = 100_000  # bucket starts that may be broadcast; more are joined by a shuffle


def sketch(text: Column) -> Column:
    """The smallest 32-bit hashes of a text's leaves, ascending."""
    leaves = F.regexp_extract_all(text, F.lit(f"([^\\n]{{1,{PIECE}}})"), F.lit(1))
    return F.slice(F.sort_array(F.array_distinct(F.transform(leaves, lambda x: F.hash(x)))), 1, SKETCH)


def _paragraphs(text: Column) -> Column:
    """Paragraph digests of each section."""
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), lambda p: F.substring(F.sha2(p, 256), 1, 16)))


def _print(paragraphs: Column, leaves: Column) -> Column:
    sections = F.transform(paragraphs, lambda s: F.sha2(F.array_join(s, ","), 256))
    branches = F.array_join(F.transform(paragraphs, lambda s: F.array_join(s, ",")), ";")
    return F.concat_ws(":", F.sha2(F.array_join(sections, ";"), 256), branches, F.array_join(F.transform(leaves, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; a null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    return _print(_paragraphs(text), sketch(text))


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def branches(print_: Column) -> Column:
    """Paragraph digests of each section: array of arrays."""
    return F.transform(F.split(F.split(print_, ":")[1], ";"), lambda s: F.split(s, ","))


def sketch_of(print_: Column) -> Column:
    # Eight hexadecimal digits to a signed 32-bit number, as in `sketch`.
    return F.transform(F.regexp_extract_all(F.split(print_, ":")[2], F.lit("([0-9A-F]{8})"), F.lit(1)), lambda x: F.pmod(F.conv(x, 16, 10).cast("long") + (1 << 31), F.lit(1 << 32)).cast("long") - (1 << 31)).cast("array<int>")


def first_difference(one: Column, two: Column) -> Column:
    """Number (from 0) of the first paragraph in which two fingerprints differ; null if they are equal."""
    a, b = F.flatten(branches(one)), F.flatten(branches(two))
    same = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, e: F.struct((s["n"] + F.when(s["on"] & e, 1).otherwise(0)).alias("n"), (s["on"] & e).alias("on")), lambda s: s["n"])
    return F.when(root(one) != root(two), same)


def _likeness(a: Column, b: Column, equal: Column) -> Column:
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(equal, F.lit(1.0)).when(F.size(union) == 0, F.lit(0.0)).otherwise(both / F.size(union))


def likeness(one: Column, two: Column) -> Column:
    """Share of common leaves of two fingerprints, 0 to 1; exact up to SKETCH leaves, else estimated."""
    return _likeness(sketch_of(one), sketch_of(two), root(one) == root(two))


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Rows with `next_*`, the columns of the following row by id (then by the columns); the first follows the last.

    Rows go to buckets of neighbouring ids. The first row of each bucket is also sent to the bucket
    before, so that one window a bucket is enough. Rows without an id have no next row.
    """
    known = docs.where(F.col(id_col).isNotNull())
    low, high, count = known.agg(F.min(id_col), F.max(id_col), F.count("*")).first()
    nothing = [F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns]
    alone = docs.where(F.col(id_col).isNull()).select(id_col, *columns, *nothing)
    if not count:
        return alone
    width = max(1, (high - low + 1) * BUCKET_DOCS // count)
    rows = known.select(id_col, *columns, F.floor((F.col(id_col) - low) / width).alias("_bucket"), F.lit(False).alias("_guest"))
    starts = known.groupBy(F.floor((F.col(id_col) - low) / width).alias("_bucket")).agg(F.min(id_col).alias("_first"))
    # The bucket before each, found inside shelves of 4096 buckets and between shelves.
    shelf = F.floor(F.col("_bucket") / 4096)
    inside = starts.withColumn("_shelf", shelf).withColumn("_before", F.lag("_bucket").over(Window.partitionBy("_shelf").orderBy("_bucket")))
    shelves = starts.groupBy(shelf.alias("_shelf")).agg(F.max("_bucket").alias("_last"))
    shelves = shelves.withColumn("_end", F.lag("_last").over(Window.orderBy("_shelf"))).select("_shelf", "_end")
    last = F.lit((high - low) // width)
    before = inside.join(shelves, "_shelf").select(F.coalesce("_before", "_end", last).alias("_to"), "_first")
    before = F.broadcast(before) if count // BUCKET_DOCS + 1 <= BROADCAST_ROWS else before
    guests = known.join(before, known[id_col] == before["_first"])
    # Of rows of equal id the least is the first.
    least = guests.groupBy("_to", "_first").agg(F.min(F.struct(*columns)).alias("_row")).select(F.col("_first").alias(id_col), *[F.col(f"_row.{c}").alias(c) for c in columns], F.col("_to").alias("_bucket"), F.lit(True).alias("_guest"))
    order = Window.partitionBy("_bucket").orderBy("_guest", id_col, *columns)
    together = rows.unionByName(least).select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return together.where("not _guest").select(id_col, *columns, *[f"next_{c}" for c in columns]).unionByName(alone)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, the fingerprint, that of the edited text, and likenesses.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the next document.
    A null text is empty. Rows of equal id follow one another by text; a row without an id has no next document and
    loses its end. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("leaves", sketch(F.col("text")))
    rows = with_next(rows, "doc_id", ["text", "leaves"]).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_leaves", sketch(F.col("edited"))).withColumn("p", _paragraphs(F.col("text"))).withColumn("edited_p", _paragraphs(F.col("edited")))
    nothing = F.array().cast("array<int>")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), _print(F.col("p"), F.col("leaves")).alias("fingerprint"), _print(F.col("edited_p"), F.col("edited_leaves")).alias("edited_fingerprint"),
        _likeness(F.col("leaves"), F.col("edited_leaves"), F.col("text") == F.col("edited")).alias("near_edited"),
        _likeness(F.col("leaves"), F.coalesce("next_leaves", nothing), F.coalesce(F.col("text") == F.col("next_text"), F.lit(False))).alias("near_next"))
