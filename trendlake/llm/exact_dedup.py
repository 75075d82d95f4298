"""Exact deduplication with a Grace hash table.

Texts are dealt to partitions by hash. Inside a partition an open-addressing table compares complete
contents; once it holds ``budget`` bytes of different texts, further new texts are spilled to files
by the next bits of their hash, and each file is then treated the same way, until it fits. Equal
texts are combined in each task before they are dealt out, so a text that a third of all rows hold
reaches its partition once per task.

Null counts as empty. Of equal texts the row with the largest id stays; ids may be null (smallest)
and rows may be repeated: of equal rows one stays. A text larger than the budget is one entry. Spill
files live in the task's temporary folder only while it runs, so a lost executor's task starts anew.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import TEXTS, free_names, without
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import arrow_rows, materialise

BUDGET = 48 << 20  # bytes of different texts that a table holds
FANOUT_BITS = 4
EMPTY = -1


class OpenTable:
    """Linear probing over slots that point into the entries."""

    def __init__(self):
        self.entries: list[list] = []  # hash, text, largest id, rows
        self.slots = [EMPTY] * 1024
        self.bytes = 0

    def _slot(self, key: int, text: str) -> int:
        mask = len(self.slots) - 1
        at = (key ^ key >> 29) & mask
        while (found := self.slots[at]) != EMPTY:
            entry = self.entries[found]
            if entry[0] == key and entry[1] == text:
                break
            at = (at + 1) & mask
        return at

    def merge(self, row) -> bool:
        """Adds the row to the entry of its text, if there is one."""
        found = self.slots[self._slot(row[0], row[1])]
        if found == EMPTY:
            return False
        entry = self.entries[found]
        if entry[2] is None or (row[2] is not None and row[2] > entry[2]):
            entry[2] = row[2]
        entry[3] += row[3]
        return True

    def insert(self, row) -> None:
        if 3 * len(self.entries) > 2 * len(self.slots):
            self.slots = [EMPTY] * (4 * len(self.slots))
            for n, entry in enumerate(self.entries):
                self.slots[self._slot(entry[0], entry[1])] = n
        self.slots[self._slot(row[0], row[1])] = len(self.entries)
        self.entries.append(list(row))
        self.bytes += len(row[1]) + 200


def combine(rows: Iterator[tuple], budget: int = BUDGET) -> Iterator[list]:
    """Combines equal texts as far as one table reaches; a full table is given out and begun anew."""
    table = OpenTable()
    for row in rows:
        if not table.merge(row):
            if table.entries and table.bytes + len(row[1]) > budget:
                yield from table.entries
                table = OpenTable()
            table.insert(row)
    yield from table.entries


def grace(rows: Iterator[tuple], folder: str, budget: int = BUDGET, level: int = 0) -> Iterator[list]:
    """One entry for each different text. Needs ``budget`` bytes whatever the number of rows."""
    table, spills = OpenTable(), {}
    last = (level + 1) * FANOUT_BITS >= 64  # no bits left: equal hashes, few rows
    try:
        for row in rows:
            if table.merge(row):
                continue
            if last or not table.entries or table.bytes + len(row[1]) <= budget:
                table.insert(row)
                continue
            part = row[0] >> (level * FANOUT_BITS) & ((1 << FANOUT_BITS) - 1)
            if part not in spills:
                spills[part] = tempfile.TemporaryFile(dir=folder)
            pickle.dump(tuple(row), spills[part], protocol=pickle.HIGHEST_PROTOCOL)
        yield from table.entries
        del table
        for file in spills.values():
            file.seek(0)
            yield from grace(_spilled(file), folder, budget, level + 1)
            file.close()
    finally:
        for file in spills.values():
            file.close()


def _spilled(file) -> Iterator[tuple]:
    load = pickle.Unpickler
    while True:
        try:
            yield load(file).load()
        except EOFError:
            return


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        ids = [None if pd.isna(i) else int(i) for i in batch["id"]]
        yield from zip(batch["key"].tolist(), batch["text"].tolist(), ids, batch["n"].tolist())


def _frames(entries: Iterator[list], chars: int = 8 << 20) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for entry in entries:
        held.append(entry)
        size += len(entry[1]) + 100
        if size >= chars:
            yield _frame(held)
            held, size = [], 0
    if held:
        yield _frame(held)


def _frame(entries: list[list]) -> pd.DataFrame:
    keys, texts, ids, counts = zip(*entries)
    return pd.DataFrame({"key": keys, "text": texts, "id": pd.array(ids, "Int64"), "n": counts})


def text_groups(df: DataFrame, key: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row for each different text: text_sha256, keep_id and group_size."""
    schema = "key long, text string, id long, n long"
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.xxhash64(value).alias("key"), value.alias("text"), F.col(f"`{key}`").cast("long").alias("id"), F.lit(1).cast("long").alias("n")
    )

    def before(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(combine(_rows(batches), budget))

    def partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as folder:
            yield from _frames(grace(_rows(batches), folder, budget))

    found = rows.mapInPandas(before, schema).repartition("key").mapInPandas(partition, schema)
    return found.select(text_sha256(F.col("text")).alias("text_sha256"), F.col("id").alias("keep_id"), F.col("n").alias("group_size"))


def text_sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row per row of ``df``: key, text_sha256, keep_id, group_size, kept. Of equal rows the first is kept."""
    groups = text_groups(df, key, text, budget).withColumnRenamed("text_sha256", "_sha")
    rows = df.select(F.col(f"`{key}`").cast("long").alias(key), text_sha256(F.col(f"`{text}`")).alias("text_sha256"))
    rows = rows.groupBy(f"`{key}`", "text_sha256").agg(F.count(F.lit(1)).alias("_copies"))
    joined = rows.join(groups, F.col("text_sha256") == F.col("_sha"), "inner")
    joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    kept = F.col(f"`{key}`").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return joined.select(f"`{key}`", "text_sha256", "keep_id", "group_size", kept.alias("kept"))


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. Runs jobs at call time."""
    with arrow_rows(df.sparkSession, TEXTS):  # written: three jobs read it, and each would shuffle all texts
        found = materialise(exact_groups(df, key, text, budget), "exact-groups")
    sha, gone_key, gone_sha = free_names(df, "sha", "gone", "gone_sha")
    gone = found.where(~F.col(f"`{key}`").eqNullSafe(F.col("keep_id"))).select(F.col(f"`{key}`").alias(gone_key), F.col("text_sha256").alias(gone_sha))
    repeated = found.where(F.col(f"`{key}`").eqNullSafe(F.col("keep_id")) & ~F.col("kept"))
    rows = df.withColumn(sha, text_sha256(F.col(f"`{text}`")))
    same = F.col(f"`{key}`").eqNullSafe(F.col(gone_key)) & (F.col(sha) == F.col(gone_sha))
    kept = rows.join(broadcast_if_small(gone.distinct()), same, "left_anti")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([key, sha])
    return without(kept, sha)
