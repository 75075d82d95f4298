"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import delete_path, scratch_path

# The bytes that separate words, [\x20\x09-\x0D].
WORD_BREAKS = " \t\n\x0b\x0c\r"
WORD_BREAK_PATTERN = r"[ \t\n\x0B\f\r]+"

TEXTS = 512  # whole texts in an Arrow batch of the operators that run their jobs themselves


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def words(text: Column) -> Column:
    """The words of ``text`` as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK_PATTERN), lambda w: w != "")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (compared as Spark does, ignoring case)."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` as they are where ``df`` has no such column, else with a number (ignoring case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free, n = f"_{name}", 0
        while free.lower() in taken:
            n += 1
            free = f"_{name}{n}"
        taken.add(free.lower())
        out.append(free)
    return out


def bounded_rows(df: DataFrame, rows: int, order_key: Sequence[str]) -> DataFrame:
    """About ``rows`` rows of ``df``, the same ones in every run: those with the smallest hashes of the key.

    One count, then a filter; no task sees more than its own share.
    """
    total = df.count()
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(*[f"`{c}`" for c in order_key]), F.lit(1 << 30))
    return df.where(share < int((1 << 30) * rows / total))


def bind(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with columns computed once per row: a generator of one row, which the optimiser does not
    merge with what reads the columns (lambdas would otherwise compute them for every element)."""
    (whole,) = free_names(df, "bound")
    bound = F.explode(F.array(F.struct(*[value.alias(name) for name, value in values.items()]))).alias(whole)
    return df.select("*", bound).select(*[f"`{c}`" for c in df.columns], *[f"`{whole}`.`{name}`" for name in values])


class Passes:
    """Intermediate tables of one operator in the shared scratch folder, dropped once later ones are written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables nothing reads any more, and lets Spark remove the shuffle files of their jobs,
        which it does when the driver collects its garbage."""
        for name in names:
            delete_path(self.spark, self.paths.pop(name))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
