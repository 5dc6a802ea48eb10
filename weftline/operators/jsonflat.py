"""JSON text in a column -> typed columns, for documents whose shape varies by row.

Two steps. `discover` finds every leaf path in a distributed pass: only distinct
shapes and distinct (path, kind) pairs are shuffled, so names, never data, reach the
driver. `project`
then reads each path straight out of the parsed variant in one projection. A known
field list skips the first step.

Kinds of leaf: `value` (text, number, boolean or null), `objects` (an array that
holds objects only, or nothing), `array` (any other array), `empty` (an object
without keys: it gives no column but can hide a value of another row).
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.functions.columns import fits_double, looks_whole, quote, to_number
from weftline.functions.names import clean_identifier, dedupe_names
from weftline.session import freeze

# --- fixed values ---
INDEXED_ITEMS = 3
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]
NUMERIC_SHARE = 0.8
TIME_SHARE = 0.5
TIME_MARK = "time"
JSON_COLUMN_NAMES = ["event", "xapi_event", "json_data", "event_data", "data", "payload"]
ACTIVITY_FIELDS = ["id", "objectType"]
LANGUAGE_FIELDS = ["name", "description"]
# --- end of fixed values ---

LEVELS_PER_PASS = 5
# Distinct document shapes the driver will look at; a shape is a short text.
MAX_SHAPES = 1000
DECIMAL_SHAPE = r": DECIMAL\(\d+,\s*\d+\)"


@dataclass(frozen=True)
class Options:
    max_depth: int | None = None
    include_original: bool = False
    column_prefix: str = ""
    separator: str = "_"
    array_handling: str = "json_string"  # json_string, count, first_item
    null_handling: str = "keep"  # keep, drop, empty_string
    type_inference: bool = True
    clean_column_names: bool = True


@dataclass(frozen=True)
class Leaf:
    """A path into the document. `item` is the array index for fields of array items."""

    path: tuple[str, ...]
    kind: str
    item: int | None = None
    inner: tuple[str, ...] = ()


def bare_numbers_as_null(c: Column) -> Column:
    """`NaN`, `Infinity` and `-Infinity` outside strings as `null`; null for text without them.

    Escapes give way to control characters first, so that a string is a run without a
    quote; then each string or word found is marked behind, and a mark with no string
    before it stands for the word. No step backtracks or recurses, however long the text.
    """
    backslash, escaped, mark = "\x02", "\x03", "\x01"
    known = c.rlike("NaN|Infinity") & ~c.rlike("[\x01-\x03]")
    plain = F.replace(F.replace(c, F.lit("\\\\"), F.lit(backslash)), F.lit('\\"'), F.lit(escaped))
    marked = F.regexp_replace(plain, '("[^"]*+")|-?(?:NaN|Infinity)', f"$1{mark}")
    nulled = F.replace(F.replace(marked, F.lit(f'"{mark}'), F.lit('"')), F.lit(mark), F.lit("null"))
    restored = F.replace(F.replace(nulled, F.lit(escaped), F.lit('\\"')), F.lit(backslash), F.lit("\\\\"))
    return F.when(known, restored)


def parse(c: Column) -> Column:
    """Variant of the text; null for blank or malformed text. Bare NaN and infinities count as null values."""
    text = F.when(F.trim(c) != "", c)
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(bare_numbers_as_null(text)))


def _entries(v: Column) -> Column:
    """Keys and values of an object, null for anything else."""
    return F.map_entries(v.try_cast("map<string,variant>"))


def _items(v: Column) -> Column:
    """Items of an array, null for anything else."""
    return v.try_cast("array<variant>")


def _is_object(v: Column) -> Column:
    return v.try_cast("map<string,variant>").isNotNull()


def _objects_only(items: Column) -> Column:
    """For the items of an array: true if every one is an object, so also for none."""
    return ~F.exists(items, lambda x: ~_is_object(x))


def split_records(df: DataFrame, json_column: str, out: str = "_doc") -> DataFrame:
    """One row per document; a top-level array gives a row per element, nested arrays included.

    An empty top-level array gives no row; text that is no document gives one null row.
    """
    text = F.col(quote(json_column)).cast("string")
    rows = df.withColumn(out, parse(text))
    # A round for each level of arrays in arrays; the check reads only texts that start as an array, and stops at the first.
    while not rows.where(text.rlike(r"^\s*\[")).where(_items(F.col(out)).isNotNull()).isEmpty():
        rows = rows.withColumn(out, F.explode(F.coalesce(_items(F.col(out)), F.array(F.col(out)))))
    return rows


def _node(path: Column, inner: Column, item: Column, v: Column, kind: Column) -> Column:
    return F.struct(path.alias("path"), inner.alias("inner"), item.alias("item"), v.alias("v"), kind.alias("kind"))


def _expand(state: DataFrame, options: Options) -> DataFrame:
    """One level down: an object becomes its entries, an array of objects also its first items.

    `state` rows are (path, inner, item, v, kind); a row with a kind is finished and
    no longer carries its value.
    """
    state = state.withColumns({"entries": _entries(F.col("v")), "items": _items(F.col("v"))})
    v, path, inner, item, entries, items = (F.col(c) for c in ("v", "path", "inner", "item", "entries", "items"))
    nothing, unknown = F.lit(None).cast("variant"), F.lit(None).cast("string")
    in_item = item.isNotNull()
    limit = F.lit(False) if options.max_depth is None else F.size(path) + F.size(inner) >= options.max_depth

    def leaf(kind: Column | str) -> Column:
        return F.array(_node(path, inner, item, nothing, F.lit(kind) if isinstance(kind, str) else kind))

    children = F.transform(entries, lambda e: _node(
        F.when(in_item, path).otherwise(F.array_append(path, e["key"])),
        F.when(in_item, F.array_append(inner, e["key"])).otherwise(inner), item, e["value"], unknown))
    firsts = F.transform(F.slice(items, 1, INDEXED_ITEMS), lambda x, i: _node(path, inner, i.cast("int"), x, unknown))
    objects = F.concat(leaf("objects"), firsts)
    # A null document has no field at all, not even `value`.
    at_root = (F.size(path) == 0) & ~in_item
    value = F.when(at_root & F.is_variant_null(v), F.array().cast(_node_type())).otherwise(leaf("value"))
    step = (F.when(F.col("kind").isNotNull(), leaf(F.col("kind")))
            .when(F.array_size(entries) == 0, leaf("empty"))
            .when(entries.isNotNull(), F.when(limit, leaf("deep")).otherwise(children))
            .when(F.array_size(items) == 0, leaf("objects"))
            .when(items.isNotNull(), F.when(~_objects_only(items), leaf("array"))
                  .when(in_item | limit, leaf("objects")).otherwise(objects))
            .otherwise(value))
    return state.select(F.explode(step).alias("s")).select("s.*")


def _node_type() -> str:
    return "array<struct<path:array<string>,inner:array<string>,item:int,v:variant,kind:string>>"


def _shape(v: Column) -> Column:
    """Type of a document as text, without the precision of its numbers."""
    return F.regexp_replace(F.schema_of_variant(v), DECIMAL_SHAPE, ": DOUBLE")


def discover(documents: DataFrame, doc: str = "_doc", options: Options = Options()) -> list[Leaf]:
    """Every distinct leaf of the documents, sorted by path.

    Most tables hold few distinct shapes, so one pass collects those. A shape says
    everything but what arrays hold; a second pass looks at just the array paths that
    are unclear. Where there are too many shapes to list, or one cannot be read, the
    documents are exploded level by level instead.
    """
    found = documents.filter(F.col(doc).isNotNull())
    leaves = _listed_leaves(found, F.col(doc), options)
    if leaves is None:
        leaves = _explode_leaves(found, doc, options)
    return sorted(leaves, key=lambda x: (x.path, -1 if x.item is None else x.item, x.inner, x.kind))


def _listed_leaves(documents: DataFrame, doc: Column, options: Options) -> set[Leaf] | None:
    shapes = [r.shape for r in documents.select(_shape(doc).alias("shape")).distinct().limit(MAX_SHAPES + 1).collect()]
    read = [_shape_leaves(s, options) for s in shapes]
    if len(shapes) > MAX_SHAPES or None in read:
        return None
    leaves = {leaf for some in read for leaf in some}
    unclear = sorted({x.path for x in leaves if x.kind == "unclear"})
    leaves = {x for x in leaves if x.kind != "unclear"}
    if not unclear:
        return leaves
    looks = []
    for i, path in enumerate(unclear):
        items = _items(F.try_variant_get(doc, _json_path(path), "variant"))
        firsts = F.transform(F.slice(items, 1, INDEXED_ITEMS), lambda x: _shape(x))
        looks.append(F.when(items.isNotNull(), F.struct(F.lit(i).alias("i"), _objects_only(items).alias("objects"), firsts.alias("firsts"))))
    arrays = (documents.select(F.explode(F.array_compact(F.array(*looks))).alias("a")).select("a.*")
              .distinct().limit(MAX_SHAPES + 1).collect())
    if len(arrays) > MAX_SHAPES:
        return None
    for row in arrays:
        path = unclear[row.i]
        leaves.add(Leaf(path, "objects" if row.objects else "array"))
        if not row.objects or (options.max_depth is not None and len(path) >= options.max_depth):
            continue
        for item, shape in enumerate(row.firsts):
            inner = _shape_leaves(shape, options, len(path))
            if inner is None:
                return None
            leaves.update(Leaf(path, "objects" if x.kind == "unclear" else x.kind, item, x.path) for x in inner)
    return leaves


def _shape_leaves(shape: str, options: Options, depth: int = 0) -> list[Leaf] | None:
    """Leaves of a shape such as `OBJECT<a: BIGINT, b: OBJECT<c: STRING>>`; None if it cannot be read.

    Kind `unclear` is an array that may be empty or hold objects only.
    """
    quoted = re.findall(r"`((?:[^`]|``)*)`", shape)
    if any(mark in name for name in quoted for mark in ("<", ">", ": ")):
        return None
    try:
        kind = T.DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<"))
    except Exception:  # noqa: BLE001 - a name the parser does not take
        return None
    out: list[Leaf] = []

    def walk(dtype: T.DataType, path: tuple[str, ...]) -> None:
        if isinstance(dtype, T.StructType):
            if not dtype.fields:
                out.append(Leaf(path, "empty"))
            elif options.max_depth is not None and depth + len(path) >= options.max_depth:
                out.append(Leaf(path, "deep"))
            else:
                for f in dtype.fields:
                    walk(f.dataType, (*path, f.name))
        elif isinstance(dtype, T.ArrayType):
            clear = not isinstance(dtype.elementType, (T.StructType, T.NullType))
            out.append(Leaf(path, "array" if clear else "unclear"))
        elif path or depth or not isinstance(dtype, T.NullType):
            out.append(Leaf(path, "value"))

    walk(kind, ())
    return out


def _explode_leaves(documents: DataFrame, doc: str, options: Options) -> set[Leaf]:
    """Leaves by exploding the documents level by level inside one stage.

    Documents deeper than one pass are taken further in another pass.
    """
    empty = F.array().cast("array<string>")
    levels = LEVELS_PER_PASS
    while True:
        state = documents.select(empty.alias("path"), empty.alias("inner"), F.lit(None).cast("int").alias("item"),
                                 F.col(doc).alias("v"), F.lit(None).cast("string").alias("kind"))
        for _ in range(levels):
            state = _expand(state, options)
        found = state.select("path", "inner", "item", F.coalesce("kind", F.lit("open")).alias("kind")).distinct().collect()
        if not any(r.kind == "open" for r in found):
            return {Leaf(tuple(r.path), r.kind, r.item, tuple(r.inner)) for r in found}
        levels += LEVELS_PER_PASS


def _json_path(keys: tuple[str, ...], item: int | None = None, inner: tuple[str, ...] = ()) -> str:
    def step(key: str) -> str:
        return '["' + key.replace("\\", "\\\\").replace('"', '\\"') + '"]'

    middle = "" if item is None else f"[{item}]"
    return "$" + "".join(map(step, keys)) + middle + "".join(map(step, inner))


def _spaced_array(v: Column) -> Column:
    """`[1, "a"]`: JSON text of an array with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(_items(v), lambda x: F.to_json(x)), ", ", "null"), F.lit("]"))


def _field_name(parts: tuple[str, ...], options: Options) -> str:
    clean = clean_identifier if options.clean_column_names else str
    return options.separator.join(clean(p) for p in parts)


def _leaf_columns(leaves: list[Leaf], options: Options, doc: str) -> list[tuple[str, Column]]:
    """Field name and value of each place in the documents; cleaned names may coincide."""
    kinds: dict[tuple, set[str]] = defaultdict(set)
    has_keys_below = set()
    for leaf in leaves:
        kinds[(leaf.path, leaf.item, leaf.inner)].add(leaf.kind)
        has_keys_below.update((leaf.path[:i], None, ()) for i in range(len(leaf.path)))
        has_keys_below.update((leaf.path, leaf.item, leaf.inner[:i]) for i in range(len(leaf.inner)))
    out: list[tuple[str, Column]] = []
    variant = F.col(doc)
    for place in sorted(kinds, key=lambda k: (k[0], -1 if k[1] is None else k[1], k[2])):
        (path, item, inner), seen = place, kinds[place]
        if seen == {"empty"}:
            continue
        where = _json_path(path, item, inner)
        value = F.try_variant_get(variant, where, "variant")
        text = F.try_variant_get(variant, where, "string")
        # Only a path that some document uses for an object needs a per-row check.
        if place in has_keys_below or "empty" in seen:
            keep = F.array_size(_entries(value)) > 0 if "deep" in seen else F.lit(False)
            text = F.when(~_is_object(value) | keep, text)
        arrays = seen & {"array", "objects"}
        name = _field_name(path, options) if path else "value"
        if item is not None:
            field = _field_name(inner, options)
            text = _array_text(value, text) if arrays else text
            for prefix in ([f"{name}_first"] if item == 0 else []) + [f"{name}_{item}"]:
                out.append((f"{prefix}_{field}" if field else prefix, text))
            continue
        if not arrays:
            out.append((name, text))
            continue
        is_array = _items(value).isNotNull()
        # Where no document has any other array here, the items need no look.
        of_objects = is_array if arrays == {"objects"} else _objects_only(_items(value))
        counts = options.array_handling == "count"
        if options.array_handling == "first_item":
            first = F.try_variant_get(variant, f"{where}[0]", "string")
            out.append((name, F.when(of_objects, _spaced_array(value)).when(is_array, first).otherwise(text)))
        elif not counts:
            out.append((name, _array_text(value, text)))
        elif seen != {"array"}:
            out.append((name, F.when(of_objects, _spaced_array(value)).when(~is_array, text)))
        if counts or "objects" in arrays:
            size = F.array_size(_items(value))
            only_some = not counts and arrays != {"objects"}
            out.append((f"{name}_count", (F.when(of_objects, size) if only_some else size).cast("string")))
    return out


def _array_text(value: Column, text: Column) -> Column:
    return F.coalesce(_spaced_array(value), text)


def project(documents: DataFrame, leaves: list[Leaf], keep: list[str], options: Options = Options(), doc: str = "_doc") -> DataFrame:
    """`keep` columns plus one text column per field; of fields whose cleaned names coincide the later ones get `_1`, `_2`, ..."""
    fields = _leaf_columns(leaves, options, doc)
    names = dedupe_names([options.column_prefix + f for f, _ in fields], taken=keep)
    columns = []
    for name, (_, c) in zip(names, fields):
        columns.append((F.coalesce(c, F.lit("")) if options.null_handling == "empty_string" else c).alias(name))
    return documents.select(*[F.col(quote(k)) for k in keep], *columns)


def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers, booleans and times out of text columns; a column changes as a whole or not at all.

    One aggregate looks at all columns. Whole numbers that a bigint holds become bigint, other numbers double. No
    number is rounded: a column with whole numbers too large for its type stays text.
    """
    if not columns:
        return df
    words = TRUE_WORDS + FALSE_WORDS
    probes = []
    for i, name in enumerate(columns):
        c = F.col(quote(name))
        is_word = F.lower(c).isin(*words)
        probes += [
            F.count(c).alias(f"n{i}"),
            F.count(to_number(c)).alias(f"num{i}"),
            F.count_if(to_number(c).isNotNull() & looks_whole(c) & F.trim(c).try_cast("bigint").isNotNull()).alias(f"int{i}"),
            F.count_if(to_number(c).isNotNull() & looks_whole(c) & ~fits_double(c)).alias(f"wide{i}"),
            F.count_if(is_word).alias(f"word{i}"),
        ]
        if TIME_MARK in name.lower():
            probes.append(F.count(c.try_cast("timestamp")).alias(f"time{i}"))
    seen = df.agg(*probes).first()
    changes = {}
    for i, name in enumerate(columns):
        c, total = F.col(quote(name)), seen[f"n{i}"]
        if total == 0:
            continue
        if seen[f"num{i}"] / total > NUMERIC_SHARE:
            if seen[f"num{i}"] == total:
                if seen[f"int{i}"] == total:
                    changes[name] = F.trim(c).cast("bigint")
                elif not seen[f"wide{i}"]:
                    changes[name] = to_number(c)
        elif seen[f"word{i}"] == total:
            changes[name] = F.when(F.lower(c).isin(*TRUE_WORDS), True).when(c.isNotNull(), False)
        elif TIME_MARK in name.lower() and seen[f"time{i}"] / total > TIME_SHARE and seen[f"time{i}"] == total:
            changes[name] = c.cast("timestamp")
    return df.withColumns(changes) if changes else df


def drop_empty_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if not columns:
        return df
    counts = df.agg(*[F.count(F.col(quote(c))).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return df.drop(*[c for c, filled in zip(columns, counts) if filled == 0])


def flatten_json(df: DataFrame, json_column: str, options: Options = Options(), leaves: list[Leaf] | None = None) -> DataFrame:
    """The whole operator: split, discover (unless `leaves` is given), project, infer types."""
    documents = split_records(df, json_column)
    if leaves is None:
        leaves = discover(documents, options=options)
    keep = [c for c in df.columns if c != json_column or options.include_original]
    flat = project(documents, leaves, keep, options)
    made = flat.columns[len(keep):]
    if options.null_handling == "drop":
        flat = drop_empty_columns(flat, made)
        made = flat.columns[len(keep):]
    if options.type_inference and options.null_handling != "empty_string":
        # The text columns are written out once: looking at their values and casting them
        # then read columns instead of parsing every document again.
        flat = infer_types(freeze(flat, "json-columns"), made)
    return flat


def find_json_column(df: DataFrame, names: list[str] | None = None) -> str | None:
    """A column with a usual name, else the first text column whose first value looks like JSON."""
    lookup = {c.lower(): c for c in df.columns}
    for name in JSON_COLUMN_NAMES if names is None else names:
        if name.lower() in lookup:
            return lookup[name.lower()]
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return None
    firsts = df.agg(*[F.any_value(F.col(quote(c)), F.lit(True)).alias(f"c{i}") for i, c in enumerate(texts)]).first()
    return next((c for c, text in zip(texts, firsts) if text and text.strip()[:1] in ("{", "[")), None)


def context_activities(doc: Column, path: tuple[str, ...], base: str) -> dict[str, Column]:
    """Preset for an array of learning activities: three indexed items and the first one by name.

    Language maps give their first entry (by language code); a plain text stays as it is.
    """
    def get(*keys, item, kind="string"):
        return F.try_variant_get(doc, _json_path(path, item, keys), kind)

    def language(field, item):
        value = get("definition", field, item=item, kind="variant")
        spoken = F.map_values(value.cast("map<string,variant>"))
        return F.when(_is_object(value), F.when(F.size(spoken) > 0, spoken[0].cast("string"))).otherwise(
            get("definition", field, item=item))

    out = {}
    for i in range(INDEXED_ITEMS):
        out |= {f"{base}_{i}_{f}": get(f, item=i) for f in ACTIVITY_FIELDS}
        out[f"{base}_{i}_definition_type"] = get("definition", "type", item=i)
        out |= {f"{base}_{i}_definition_{f}": language(f, i) for f in LANGUAGE_FIELDS}
    out |= {f"{base}_first_{f}": get(f, item=0) for f in ACTIVITY_FIELDS}
    out |= {f"{base}_first_type": get("definition", "type", item=0), f"{base}_first_name": language("name", 0)}
    return out


def field_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """Row per field: how many rows have it, and the share in percent (two decimals)."""
    structs = [F.struct(F.lit(f).alias("field"), F.count(F.col(quote(f))).alias("filled"),
                        F.count(F.lit(1)).alias("total")) for f in fields]
    return (df.agg(F.array(*structs).alias("s")).select(F.explode("s").alias("s")).select("s.*")
            .withColumn("coverage", F.round(F.col("filled") * 100.0 / F.col("total"), 2).cast("double")))


def leaves_from_json(text: str) -> list[Leaf]:
    """Field list saved earlier with `leaves_to_json`."""
    return [Leaf(tuple(p), k, i, tuple(n)) for p, k, i, n in json.loads(text)]


def leaves_to_json(leaves: list[Leaf]) -> str:
    return json.dumps([[x.path, x.kind, x.item, x.inner] for x in leaves])
