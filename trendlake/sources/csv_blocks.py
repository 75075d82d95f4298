"""CSV files with line breaks inside quotes, read in blocks by many tasks.

Where a record ends depends on the quotes before it, so a reader that starts in the middle of a file cannot
know. But a line can say what it does to either case: whether it ends inside quotes if it starts a record
(``f0``), and if it starts inside quotes (``f1``). Such pairs compose:

1. every block of a file composes those of its lines to one pair (a shuffle of flags, not of text);
2. the pairs of a file's blocks, one row each, give the state that each block starts in;
3. lines of a block are joined to records; the head of a block that starts inside quotes goes to the record
   that an earlier block left open.

A quoted field has its quotes doubled inside; a quote in a field that does not start with one is plain text,
and so is what follows a closing quote up to the comma, as in Spark's own reader. Lines end with ``\\n``, or
with ``\\r\\n`` in files whose first line does. Quotes that are never closed make the rest of their file one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Possessive throughout: such patterns neither backtrack nor recurse, however long a line is.
QUOTED = r'[^"]*+(?:""[^"]*+)*+'  # inside quotes
FIELD = rf'(?:"{QUOTED}"[^,]*+|[^",][^,]*+)?+'  # a field that ends in its line
OPENS = rf'(?:{FIELD},)*+"{QUOTED}\z'  # fields, the last of which does not end
F0 = rf"^{OPENS}"
F1 = rf'^{QUOTED}(?:\z|"[^,]*+,{OPENS})'

BLOCK = ["file", "block"]


def _composed(df: DataFrame, order: Window) -> DataFrame:
    """``df`` with ``after0`` and ``after1``: the state after each row (true: inside quotes) if the first one starts outside
    or inside. Only the last row that sets the state, and the flips since, count."""
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("flips", F.sum((F.col("f0") & ~F.col("f1")).cast("int")).over(so_far))
    setting = F.when(F.col("f0") == F.col("f1"), F.struct("f0", "flips"))
    df = df.withColumn("set", F.last(setting, ignorenulls=True).over(so_far))
    odd = (F.col("flips") - F.coalesce("set.flips", F.lit(0))) % 2 == 1
    after = {f"after{s}": F.coalesce("set.f0", F.lit(bool(s))) != odd for s in (0, 1)}
    return df.withColumns(after).drop("flips", "set")


def _in_block() -> Window:
    return Window.partitionBy(*BLOCK).orderBy("id")


def _before(order: Window, state: str, start: Column) -> Column:
    """The state before each row."""
    return F.coalesce(F.lag(state).over(order), start)


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block: ``start`` (state), ``closes`` (the line that ends what an earlier block left open), ``opened`` (the
    line that begins its last record), and ``owner``, ``record``: the block and line that began what is open at its start; ``crlf``:
    whether the first line of the file ends with ``\\r\\n``."""
    in_block = _in_block()
    ending = F.col("line").endswith("\r").alias("crlf")
    flags = lines.select(*BLOCK, "id", "f0", "f1", ending).withColumn("nr", F.row_number().over(in_block))
    flags = _composed(flags, in_block)
    opened = {f"opened{s}": F.when(~_before(in_block, f"after{s}", F.lit(bool(s))), F.col("nr")) for s in (0, 1)}
    blocks = flags.withColumns(opened).groupBy(*BLOCK).agg(
        F.max_by("after0", "nr").alias("f0"), F.max_by("after1", "nr").alias("f1"),
        F.min(F.when(~F.col("f1"), F.col("nr"))).alias("closes"), F.max("opened0").alias("opened0"), F.max("opened1").alias("opened1"),
        F.min_by("crlf", "nr").alias("crlf"),
    )
    order = Window.partitionBy("file").orderBy("block")
    blocks = _composed(blocks, order).withColumn("start", _before(order, "after0", F.lit(False)))
    blocks = blocks.withColumn("crlf", F.first("crlf").over(order))
    blocks = blocks.withColumn("opened", F.when(F.col("start"), F.col("opened1")).otherwise(F.col("opened0")))
    last = F.last(F.when(F.col("opened").isNotNull(), F.struct("block", "opened")), ignorenulls=True)
    last = last.over(order.rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select(*BLOCK, "start", "closes", "crlf", last["block"].alias("owner"), last["opened"].alias("record"))


def _text(*order: str) -> Column:
    """The lines of a group in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"]), "\n")


def records(lines: DataFrame, keep: list[str]) -> DataFrame:
    """(file, block, record, text, *keep) from ``lines`` (file, block, id, line, *keep): ``id`` orders the lines of a block,
    ``keep`` is the same in all of a file. ``record`` is the number of its first line in the block."""
    in_block = _in_block()
    lines = lines.withColumns({"f0": F.col("line").rlike(F0), "f1": F.col("line").rlike(F1)})
    blocks = _blocks(lines)
    head = F.col("start") & (F.col("closes").isNull() | (F.col("nr") <= F.col("closes")))
    line = F.when(F.col("crlf"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line"))
    heads = lines.join(blocks.where("start"), BLOCK).withColumn("line", line).withColumn("nr", F.row_number().over(in_block)).where(head)
    tails = heads.groupBy("file", F.col("owner").alias("block"), "record").agg(_text("block", "nr").alias("tail"))

    own = lines.join(blocks.drop("owner", "record"), BLOCK).withColumn("line", line).withColumn("nr", F.row_number().over(in_block))
    own = _composed(own, in_block)
    own = own.withColumn("after", F.when(F.col("start"), F.col("after1")).otherwise(F.col("after0")))
    begins = F.when(~_before(in_block, "after", F.col("start")), F.col("nr"))
    own = own.withColumn("begins", begins).withColumn("record", F.last("begins", ignorenulls=True).over(in_block))
    whole = own.where(~head).groupBy(*BLOCK, "record", *keep).agg(_text("nr").alias("text"))
    whole = whole.join(tails, [*BLOCK, "record"], "left")
    return whole.select(*BLOCK, "record", F.concat_ws("\n", "text", "tail").alias("text"), *keep)


def read_csv_blocks(scan: DataFrame, schema: StructType, keep: list[str], options: dict) -> DataFrame:
    """Rows of the CSV files behind ``scan``, a text scan with ``lineSep`` ``\\n``: columns ``schema`` and ``keep``.

    The first record of every file must be the header, or the read fails."""
    lines = scan.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"), *keep,
    )
    found = records(lines, keep)
    header = (F.col("block") == 0) & (F.col("record") == 1)
    names = F.regexp_replace(F.lower("text"), "[\"\ufeff]", "")
    expected = ",".join(schema.fieldNames())
    wrong = F.raise_error(F.concat(F.lit(f"CSV header does not conform to the schema {expected}: "), "file"))
    is_header = F.when(header, F.when(names == expected.lower(), True).otherwise(wrong.cast("boolean"))).otherwise(False)
    row = F.from_csv("text", schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    return found.where(~is_header & (F.col("text") != "")).select(row.alias("row"), *keep).select("row.*", *keep)
