"""Category reference documents (JSON) to the silver reference table.

A document stays one row until its items are exploded; validation, counting and
the choice of the newest document per region need no shuffle of items.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendlake.functions import decode_key, instant, normalize_region, region_from_key
from trendlake.operators.fields import discover_fields
from trendlake.schemas import REFERENCE_ITEM

EMPTY = "No category items in the document"
MALFORMED = "Not a JSON document"
LONG_TEXT = {"maxStringLen": "2147483647"}
BAD_TEXT = {"columnNameOfCorruptRecord": "_bad", **LONG_TEXT}
VARIANT_CHARS = 16 << 20  # texts from here on may be more than one variant holds
REQUIRED = ("id", "snippet.title")  # fixed values: fields every item should have
ITEM_COLUMNS = ("key", "region", "pos", "has_id")
ADDED_COLUMNS = ("_ingestion_timestamp", "_source_file")


def _once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)``, each computed once per row: a generator of one row, which the optimiser does not merge
    with the many expressions that read them (a document would be parsed again for each)."""
    row = F.struct(*(df.columns if isinstance(columns[0], str) and columns[0] == "*" else columns[:1]), *columns[1:])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")


def parse_documents(docs: DataFrame, key_is_uri: bool = True) -> DataFrame:
    """``(path, modified, value)`` rows to ``(key, region, modified, items, has_id, error, missing_columns)``.

    ``items`` is the document's ``items`` array; without one, the document itself (a
    top-level list: its elements). ``error`` says why a document is unusable and
    ``missing_columns`` lists required fields no item has (a warning only).
    """
    first = F.substring(F.ltrim(F.col("value")), 1, 1)
    # Only split here, every item as text: a whole document may be larger than one variant can be.
    whole = F.from_json("value", "items array<string>, _bad string", BAD_TEXT)
    top = F.from_json("value", "array<string>", LONG_TEXT)
    # An object whose items are no list is one item itself.
    is_object = F.from_json("value", "map<string,string>", LONG_TEXT).isNotNull()
    parsed = _once(
        docs,
        decode_key(F.col("path"), plus_is_blank=not key_is_uri).alias("key"),
        "modified",
        first.alias("first"),
        F.when(first == "{", F.col("value")).alias("object"),
        F.when(first == "{", whole).alias("whole"),
        F.when(first == "{", F.when(whole["_bad"].isNotNull(), is_object)).alias("one_item"),
        F.when(first == "[", top).alias("list"),
        F.when(~first.isin("[", "{"), F.try_parse_json(F.col("value"))).isNotNull().alias("scalar"),
    )
    texts = (
        F.when(F.col("first") == "[", F.col("list"))
        .when(F.col("whole").isNotNull() & F.col("whole._bad").isNull(), F.coalesce("whole.items", F.array("object")))
        .when(F.col("one_item"), F.array("object"))
    )
    # The statistics have lower-case regions, whatever the landing directory is called.
    region = normalize_region(region_from_key(F.col("key")))
    parsed = parsed.select("key", region.alias("region"), "modified", texts.alias("texts"), "scalar")
    parsed = _once(parsed, "*", F.transform("texts", F.try_parse_json).alias("items"))

    def as_object(item: Column) -> Column:
        return F.try_variant_get(item, "$", "map<string,variant>")

    def any_item_has(path: str) -> Column:
        return F.exists("items", lambda item: F.try_variant_get(item, f"$.{path}", "variant").isNotNull())

    too_large = F.exists("texts", lambda text: F.try_parse_json(text).isNull() & (F.length(text) > VARIANT_CHARS))
    error = (
        F.when(F.col("texts").isNull(), F.when(F.col("scalar"), F.lit("Neither an object nor a list")).otherwise(F.lit(MALFORMED)))
        .when(too_large, F.lit("An item is over the parser's limit"))
        .when(F.exists("items", lambda item: as_object(item).isNull()), F.lit("Items are not all objects"))
        .when(~F.exists("items", lambda item: F.size(as_object(item)) > 0), F.lit(EMPTY))
    )
    absent = F.array(*(F.when(~any_item_has(path), F.lit(path)) for path in REQUIRED))
    missing = F.filter(absent, lambda c: c.isNotNull())
    return _once(
        parsed,
        "key",
        "region",
        "modified",
        "items",
        F.coalesce(any_item_has("id"), F.lit(False)).alias("has_id"),
        error.alias("error"),
        F.when(error.isNull(), missing).alias("missing_columns"),
    )


def ingest_report(parsed: DataFrame) -> DataFrame:
    """One row per document: rows it yields after duplicates, or its error. No shuffle."""
    ids = F.transform("items", lambda item: F.try_variant_get(item, "$.id", "string"))
    rows = F.when(F.col("has_id"), F.size(F.array_distinct(ids))).otherwise(F.size("items")).cast("bigint")
    good = F.col("error").isNull()
    region = F.when(good, F.col("region"))
    return parsed.select("key", region.alias("region"), F.when(good, rows).alias("rows"), "error", "missing_columns")


def report_alerts(report: DataFrame) -> DataFrame:
    """One alert per failed document, in the form of the check alerts."""
    failed = report.where(F.col("error").isNotNull())
    return failed.select(F.lit("Reference document FAILED").alias("subject"), F.to_json(F.struct("key", "error")).alias("message"))


def newest_per_region(parsed: DataFrame) -> DataFrame:
    """The last usable document of each region by (modification time, key): a later
    file replaces an earlier one. Cut to one per region and task before the shuffle."""
    window = Window.partitionBy("region").orderBy(F.col("modified").desc(), F.col("key").desc())
    usable = parsed.where(F.col("error").isNull())
    return usable.withColumn("_n", F.row_number().over(window)).where(F.col("_n") == 1).drop("_n")


def explode_items(parsed: DataFrame) -> DataFrame:
    """One row per item of each usable document, with its position."""
    usable = parsed.where(F.col("error").isNull())
    return usable.select("key", "region", "has_id", F.posexplode("items").alias("pos", "item"))


def _entries(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _leaf(path: Sequence[str], kind: str) -> Column:
    """A field by its name alone, whatever letters that has."""
    value = F.col("item")
    for name in path:
        value = F.try_element_at(_entries(value), F.lit(name))
    known = REFERENCE_TYPES.get(tuple(path))
    if known:
        return F.try_variant_get(value, "$", known)
    if kind == "VOID" or kind == "STRING":
        return F.try_variant_get(value, "$", "string")
    if kind in ("BIGINT", "BOOLEAN", "DOUBLE", "FLOAT", "DATE") or kind.startswith("DECIMAL"):
        return F.try_variant_get(value, "$", kind)
    if kind.startswith("ARRAY<") and "OBJECT" not in kind and "VARIANT" not in kind:
        return F.try_variant_get(value, "$", kind.replace("VOID", "STRING"))
    # Mixed kinds, or lists of objects: as text.
    scalar = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(scalar, F.to_json(value))


def flatten(items: DataFrame, schema: StructType | None = None, separator: str = "_") -> DataFrame:
    """Item objects to columns, nested names joined by ``separator``.

    By default every field that any item has becomes a column (one job finds them); names that differ
    only by case, or that meet once joined, share one. ``schema`` limits them to known fields and reads
    nothing ahead. A field named like a column of the table gets ``item`` before its name. Items with too
    many names for columns are kept as text in ``item``, beside the known fields.
    """
    fields = discover_fields(items) if schema is None else _kinds(schema)
    if () in fields:
        fields = fields | {path: kind.upper() for path, kind in REFERENCE_TYPES.items()}
    columns: dict[str, list[Column]] = {}
    spelled: dict[str, str] = {}
    for path, kind in fields.items():
        name = separator.join(path) if path else "item"
        if name.lower() in (*ITEM_COLUMNS, *ADDED_COLUMNS):
            name = f"item{separator}{name}"
        key = spelled.setdefault(name.lower(), name)
        columns.setdefault(key, []).append(_leaf(path, kind))
    leaves = [
        (F.coalesce(*(c.cast("string") for c in found)) if len(found) > 1 else found[0]).alias(name)
        for name, found in columns.items()
    ]
    return items.select(*ITEM_COLUMNS, *leaves)


def _kinds(schema: StructType, path: tuple[str, ...] = ()) -> dict[tuple[str, ...], str]:
    out: dict[tuple[str, ...], str] = {}
    for field in schema:
        here = (*path, field.name)
        nested = isinstance(field.dataType, StructType)
        out |= _kinds(field.dataType, here) if nested else {here: field.dataType.simpleString().upper()}
    return out


REFERENCE_TYPES = {path: kind.lower() for path, kind in _kinds(REFERENCE_ITEM).items()}


def dedupe_last(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """The last item of each id in its document. Items without an id count as one id;
    a document where no item has an id is left whole."""
    if id_column not in rows.columns:
        rows = rows.withColumn(id_column, F.lit(None).cast("string"))
    own = F.when(F.col("has_id"), F.lit(-1)).otherwise(F.col("pos"))
    window = Window.partitionBy("key", id_column, "_own").orderBy(F.col("pos").desc())
    numbered = rows.withColumn("_own", own).withColumn("_n", F.row_number().over(window))
    return numbered.where(F.col("_n") == 1).drop("_n", "_own")


def silver_reference(
    parsed: DataFrame,
    as_of: dt.datetime | None = None,
    schema: StructType | None = None,
    separator: str = "_",
) -> DataFrame:
    """Rows of the silver reference table from the newest usable document of each region."""
    rows = dedupe_last(flatten(explode_items(newest_per_region(parsed)), schema, separator))
    return rows.withColumns({"_ingestion_timestamp": instant(as_of), "_source_file": F.col("key")}).drop("key", "pos", "has_id")
