"""Quality rules: figures of each text, and lines that many documents of a host share.

Lines are normalised (lower case, digits as one mark, white space as one blank, trimmed) and
hashed; the documents of each host that hold a line are counted, and lines of more than
``max_docs`` documents are removed. A document is depleted, and rejected, when less than
``min_kept`` of its words remain or fewer than ``min_words`` do.

Everything is built from DataFrame functions. A line counts once per row, so counts combine before
the shuffle; only lines above the limit come back, through a broadcast when their measured size is
small and a shuffle join otherwise, where adaptive execution splits a line that a third of all rows
hold. Each row is a document: repeated rows count as often as they occur. A null host is a host of
its own. Null texts have no words and no lines. Line hashes have 64 bits; two lines of one host
that share a hash would be counted together (chance below 1e-7 for a million different lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import WORD_BREAK_PATTERN, WORD_BREAKS, bind, free_names, without, words
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import materialise

MAX_DOCS = 100  # documents of one host that may hold the same line
MIN_KEPT = 0.3  # share of the words that must remain
MIN_WORDS = 5
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SPACES = r"[ \t\x0B\f\r]+"
UNEVEN = r"[\t\x0B\f\r]|  "


def text_figures(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every whole text.

    n_repeat_words are the words inside a run of ``window`` words that the text holds twice or more:
    the runs' hashes (64 bits) are sorted with their places, so that equal ones are neighbours.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = [f"`{c}`" for c in without(df, *names).columns]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.btrim(line, F.lit(WORD_BREAKS)) != "")
    own_words, own_lines, own_keys, own_placed, own_at = free_names(df, "words", "lines", "keys", "placed", "at")
    rows = bind(df, **{own_words: words(value), own_lines: lines})
    n = F.size(own_words)
    starts = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))
    keys = F.transform(starts, lambda i: F.xxhash64(*[F.get(own_words, i + k if k else i) for k in range(window)]))
    rows = bind(rows, **{own_keys: keys})
    some = F.size(F.array_distinct(own_keys)) < F.size(own_keys)
    none = F.array().cast("array<struct<key: bigint, at: int>>")
    placed = F.array_sort(F.transform(own_keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))
    rows = bind(rows, **{own_placed: F.when(some, placed).otherwise(none)})
    beside = lambda i: F.get(own_placed, i)["key"]
    again = F.filter(own_placed, lambda x, i: F.coalesce(x["key"] == beside(i - 1), F.lit(False)) | F.coalesce(x["key"] == beside(i + 1), F.lit(False)))
    rows = bind(rows, **{own_at: F.array_sort(F.transform(again, lambda x: x["at"]))})
    covered = F.transform(own_at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(own_at, i + 1) - p, F.lit(window))))
    return rows.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.aggregate(own_words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)).alias("word_chars"),
        F.regexp_count(value, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(own_lines) - F.size(F.array_distinct(own_lines))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda total, p: total + p).alias("n_repeat_words"),
    )


def _digits_alike(text: Column) -> Column:
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, "[0-9]+", "0")).otherwise(text)


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(_digits_alike(F.lower(line)), WORD_BREAK_PATTERN, " "))


def _lines(text: Column) -> Column:
    """(line hash, words) of every line that has any, in order."""
    # Normalised before it is split: one call a text instead of one a line.
    whole = _digits_alike(F.lower(F.coalesce(text, F.lit(""))))
    plain = F.when(whole.rlike(UNEVEN), F.regexp_replace(whole, SPACES, " ")).otherwise(whole)
    lines = F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    # One blank between words.
    n = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), n(x).alias("n")))


def with_lines(df: DataFrame, names: tuple[str, str], text: str = "text") -> DataFrame:
    """``df`` with what ``remove_common_lines`` needs of the text, in new columns of these names:
    its hash, and (line hash, words) of its lines."""
    value = F.col(f"`{text}`")
    return bind(df, **dict(zip(names, (F.xxhash64(value), _lines(value)))))


def common_lines(rows: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, docs) of the normalised lines that more than ``max_docs`` documents of a host hold."""
    hashes = F.array_distinct(F.transform("_found", lambda x: x["line"]))
    rows = rows.select("_host", F.explode(hashes).alias("line")).withColumnRenamed("_host", "host")
    return rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs)


def remove_common_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = MAX_DOCS,
    min_kept: float = MIN_KEPT,
    min_words: int = MIN_WORDS,
    clean_text: str | None = None,
    lines: tuple[str, str] | None = None,
) -> DataFrame:
    """``df`` with ``n_lines_removed``, ``n_words_kept`` and ``depleted``; with ``clean_text`` also the text
    without the removed lines (null if null). Runs one counting job at call time.

    Rows are matched by key, host and text, so equal rows get equal results and a null key is a key.
    ``lines`` names the columns that ``with_lines`` added: no text is needed then, unless ``clean_text`` is
    wanted. These two are not in the result, all other columns of ``df`` are.
    """
    if lines is None:
        row, found = free_names(df, "row", "found")
        lines = (row, found)
        df = with_lines(df, lines, text)
    own_row, own_lines = (F.col(f"`{name}`") for name in lines)
    names = ["n_lines_removed", "n_words_kept", "depleted"] + ([clean_text] if clean_text else [])
    identity = {"_key": F.col(f"`{key}`"), "_host": F.col(f"`{host}`"), "_row": own_row}
    narrow = materialise(df.select(*[c.alias(n) for n, c in identity.items()], own_lines.alias("_found")), "lines")
    found = materialise(common_lines(narrow, max_docs), "common-lines")

    held = narrow.select("_key", "_host", "_row", F.explode(F.array_distinct(F.transform("_found", lambda x: x["line"]))).alias("_line"))
    small = broadcast_if_small(found.select(F.col("host").alias("_common_host"), F.col("line").alias("_common_line")))
    held = held.join(small, F.col("_host").eqNullSafe(F.col("_common_host")) & (F.col("_line") == F.col("_common_line")), "inner")
    removed = held.groupBy("_key", "_host", "_row").agg(F.collect_set("_line").alias("_removed"))

    rest = without(df, *lines, *names)
    kept = [f"`{c}`" for c in rest.columns]
    value, all_lines, common, gone = free_names(rest, "text", "lines", "removed", "gone")
    here, there = (free_names(rest, *(side + n for n in identity)) for side in ("of", "at"))
    rows = df.select(
        *kept,
        *[c.alias(n) for n, c in zip(here, identity.values())],
        own_lines.alias(all_lines),
        *([F.col(f"`{text}`").alias(value)] if clean_text else []),
    )
    removed = removed.withColumnsRenamed({**dict(zip(identity, there)), "_removed": common})
    same = F.lit(True)
    for a, b in zip(here, there):
        same = same & F.col(a).eqNullSafe(F.col(b))
    joined = rows.join(removed, same, "left")
    found = F.filter(all_lines, lambda x: F.array_contains(common, x["line"]))
    joined = joined.withColumn(gone, F.when(F.col(common).isNotNull(), found).otherwise(F.array().cast("array<struct<line: bigint, n: int>>")))
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda t, x: t + x["n"])
    left = total(F.col(all_lines)) - total(F.col(gone))
    out = joined.select(
        *kept,
        F.size(gone).cast("long").alias("n_lines_removed"),
        left.alias("n_words_kept"),
        ((left < min_words) | (left < min_kept * total(F.col(all_lines)))).alias("depleted"),
        *([_without_lines(F.col(value), common).alias(clean_text)] if clean_text else []),
    )
    return out


def _without_lines(text: Column, removed: str) -> Column:
    kept = F.filter(F.split(text, "\n"), lambda x: (normal_line(x) == "") | ~F.coalesce(F.array_contains(removed, F.xxhash64(normal_line(x))), F.lit(False)))
    return F.array_join(kept, "\n")
