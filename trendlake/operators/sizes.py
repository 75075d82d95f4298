"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and (about) bytes, from one aggregate job whose result is a single row."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema), F.lit(16)
    )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint when it is within both bounds, else as it is: the
    join is then a shuffle join, where adaptive execution splits skewed keys."""
    rows, size = measured_size(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
