"""The fields of JSON objects of any shape, found in one pass.

Spark tells the type of one variant as text, nested objects included. Items of the same shape have the
same text, so only different texts are read, by a small parser, into paths; rows of one path then
combine across the cluster, and Spark itself merges their types.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

MAX_FIELDS = 2000  # fields that become columns; objects with very many names are maps, and are kept as text
MAX_KINDS = 10_000  # shapes of items that are read by the driver
FOUND = "path array<string>, example string, deeper boolean"

# A quoted or plain field name, the begin of an object or list, the end of one, or any other type.
TOKEN = re.compile(r"`((?:[^`]|``)*)`: |(\w+): |(OBJECT<)|(ARRAY<)|(>)|(, )|([A-Z_]+(?:\([\d, ]+\))?)")


def _array_end(text: str, at: int) -> int:
    """Where the list whose ``ARRAY<`` ends at ``at`` ends."""
    depth = 1
    while depth:
        token = TOKEN.match(text, at)
        depth += token.lastindex in (3, 4)
        depth -= token.lastindex == 5
        at = token.end()
    return at


def paths_of(kind: str) -> Iterator[tuple[tuple[str, ...], str | None]]:
    """Path and type of every field in the type text of an object; no type for a field that is an object."""
    path: list[str] = []
    at = 0
    while at < len(kind):
        token = TOKEN.match(kind, at)
        at = token.end()
        which = token.lastindex
        if which == 1:
            path.append(token[1].replace("``", "`"))
        elif which == 2:
            path.append(token[2])
        elif which == 3:
            if path:
                yield tuple(path), None
        elif which == 4:
            end = _array_end(kind, at)
            yield tuple(path), kind[token.start() : end]
            path.pop()
            at = end
        elif which == 5:
            if path:
                path.pop()
        elif which == 7:
            yield tuple(path), token[7]
            path.pop()


# A JSON value of each type.
EXAMPLES = {"BIGINT": "1", "DOUBLE": "1e300", "STRING": '"a"', "BOOLEAN": "true", "VOID": "null"}
KINDS = {text: kind for kind, text in EXAMPLES.items()}


def example(kind: str) -> str:
    """A JSON text whose type is ``kind``; lists of objects or of mixed kinds count as mixed."""
    depth = kind.count("ARRAY<")
    inner = kind.replace("ARRAY<", "").rstrip(">")
    if inner.startswith("DECIMAL("):
        digits, scale = map(int, re.findall(r"\d+", inner))
        value = ("9" * (digits - scale) or "0") + ("." + "9" * scale if scale else "")
    else:
        value = EXAMPLES.get(inner)
    if value is None:
        return '[1,"a"]'
    return "[" * depth + ("" if depth and inner == "VOID" else value) + "]" * depth


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = {}
        for kind in batch["kind"]:
            for path, leaf in paths_of(kind):
                found[path, leaf if leaf is None else example(leaf)] = None
        rows = [(list(path), leaf, leaf is None) for path, leaf in found]
        yield pd.DataFrame(rows, columns=["path", "example", "deeper"])


def _kinds_of(objects: DataFrame, value: str) -> DataFrame:
    """The different shapes of the objects, one type text each."""
    return objects.select(F.schema_of_variant(F.col(value)).alias("kind")).where("kind like 'OBJECT<%'").distinct()


def _fields(objects: DataFrame, value: str) -> DataFrame:
    """One row per path: its merged type, how many kinds of leaves it has, and whether it is an object somewhere."""
    return _kinds_of(objects, value).mapInPandas(_read, FOUND).groupBy("path").agg(
        F.schema_of_variant_agg(F.try_parse_json("example")).alias("kind"),
        F.count("example").alias("leaves"),
        F.bool_or("deeper").alias("deeper"),
    )


def _widest(fields: DataFrame, most: int) -> list[tuple[str, ...]]:
    """Objects with more than ``most`` names, those inside another left out."""
    parent = F.slice("path", 1, F.size("path") - 1)
    wide = fields.groupBy(parent.alias("parent")).count().where(F.col("count") > most)
    # Each has over ``most`` of the fields, and the widest decide first.
    found = [tuple(r["parent"]) for r in wide.orderBy(F.size("parent"), F.desc("count")).limit(MAX_FIELDS).collect()]
    return [p for p in found if not any(p[: len(q)] == q and p != q for q in found)]


def _below(paths: Sequence[tuple[str, ...]]) -> Column:
    inside = F.lit(False)
    for path in paths:
        head = F.slice("path", 1, len(path)) == F.array(*map(F.lit, path)).cast("array<string>")
        inside = inside | ((F.size("path") > len(path)) & head)
    return inside


def _merged(objects: DataFrame, examples: dict[tuple[str, ...], set[str]]) -> dict[tuple[str, ...], str]:
    """The type of each path. Several types of one are merged by Spark, which reads them as one list: no job."""
    found, mixed = {}, []
    for path, values in examples.items():
        if len(values) == 1:
            found[path] = KINDS.get(next(iter(values)))
        if found.get(path) is None:
            mixed.append(path)
    if mixed:
        lists = ", ".join(f"('[{','.join(sorted(examples[p]))}]')" for p in mixed)
        rows = objects.sparkSession.sql(f"SELECT schema_of_variant(parse_json(list)) AS kind FROM VALUES {lists} AS t(list)").collect()
        found |= {path: row["kind"].removeprefix("ARRAY<")[:-1] for path, row in zip(mixed, rows)}
    return found


def discover_fields(objects: DataFrame, value: str = "item", most: int = MAX_FIELDS) -> dict[tuple[str, ...], str]:
    """Path and type of every field that is not itself an object, in the order of the names.

    One job, whatever the depth. Beyond ``MAX_KINDS`` different shapes they are read where they are. Where there are
    more than ``most`` fields, objects with many names (ids used as names) are text, the widest first, until the rest
    fits; the log names them. The path of a whole item is empty.
    """
    kinds = _kinds_of(objects, value).limit(MAX_KINDS + 1).collect()
    if len(kinds) <= MAX_KINDS:
        examples: dict[tuple[str, ...], set[str]] = {}
        for row in kinds:
            for path, leaf in paths_of(row["kind"]):
                if leaf is not None:
                    examples.setdefault(path, set()).add(example(leaf))
        if len(examples) <= most:
            return dict(sorted(_merged(objects, examples).items()))
    fields = _fields(objects, value)
    found = fields.limit(most + 1).collect()
    maps: list[tuple[str, ...]] = []
    wide = most
    while len(found) > most:
        wide //= 2
        maps += [p for p in _widest(fields.where(~_below(maps)), wide) if p not in maps]
        found = fields.where(~_below(maps)).limit(most + 1).collect()
    if maps:
        log.warning("objects with too many names are kept as text: %s", [".".join(p) or "the whole item" for p in maps])
    leaves = {tuple(r["path"]): r["kind"] for r in found if r["leaves"] or not r["deeper"]}
    return dict(sorted({**leaves, **dict.fromkeys(maps, "VARIANT")}.items()))
