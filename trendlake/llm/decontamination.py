"""Benchmark decontamination by a broadcast hash set of word windows.

Texts are normalised (A-Z to lower case, everything in ASCII but letters and digits separates words).
A benchmark item is its windows of ``window`` consecutive words; an item of fewer words is one window.
Windows are kept as arrays: sorted 64-bit hashes, the words of each as numbers of the benchmark's own
vocabulary, and the items that hold it. Documents are scanned once: words become vocabulary numbers
(0: not in any item), windows without an unknown word are looked up by hash, and every hit is verified
by comparing all its words. A word of a document inside a window that occurs is hit. Texts of any
length are scanned whole.

The set is broadcast in blocks. Item texts are cut into overlapping pieces and dealt to as many blocks
as their measured bytes need, ``block_bytes`` each, so neither the driver nor a task holds more than
one block; a benchmark of several blocks takes one scan of the documents per block, whose hits are
put together by the text's digest (hits depend on the text alone). Usual benchmarks are one block,
and then nothing is shuffled.

Null texts have no words. Rows of one item id are one item, a null id is the item named by the empty
text. An empty benchmark hits nothing. Repeated rows are each scanned. Other columns stay as they
are, whatever their names; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.arrays import STEP, U64, mix, word_chunks
from trendlake.llm.common import free_names, without
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import materialise

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of item texts in one broadcast
PIECE = 4096  # words of an item in one piece
GROUP = 1 << 20  # bytes of texts scanned together
RANGES = "array<struct<first: int, last: int>>"

# What is no word, in lower-cased ASCII: [\x00-\x2F\x3A-\x60\x7B-\x7F].
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    """The text's words, separated by blanks."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


class WindowSet:
    """The windows of ``items``: (item name, normalised text) pairs."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number: dict[str, int] = {}
        texts: list[np.ndarray] = []
        starts: dict[int, list[np.ndarray]] = {}  # by width
        owners: dict[int, list[np.ndarray]] = {}
        at = 0
        for name, data in items:
            words = data.split()
            if not words:
                continue
            owner = number.setdefault(name, len(number))
            texts.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32))
            width = min(window, len(words))
            starts.setdefault(width, []).append(np.arange(at, at + len(words) - width + 1))
            owners.setdefault(width, []).append(np.full(len(words) - width + 1, owner))
            at += len(words)
        self.names = list(number)
        flat = np.concatenate(texts) if texts else np.empty(0, np.int32)
        self.tables = {
            width: _table(flat[np.concatenate(starts[width])[:, None] + np.arange(width)], np.concatenate(owners[width]))
            for width in sorted(starts)
        }

    def numbers(self, data: bytes) -> np.ndarray:
        """The vocabulary number of each word; 0 for a word in no item."""
        number = self.vocabulary.get
        parts = [np.fromiter(map(number, words, repeat(0)), np.int32, len(words)) for words in word_chunks(data)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, places, window numbers) of all windows in a row of word numbers."""
        unknown = np.zeros(len(words) + 1, np.int64)
        np.cumsum(words == 0, out=unknown[1:])
        for width, (seed, keys, rows, _, _) in self.tables.items():
            if len(words) < width:
                continue
            at = np.flatnonzero(unknown[width:] == unknown[:-width])
            key = _hash(words[at[:, None] + np.arange(width)], seed)
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = np.flatnonzero(keys[found] == key)
            at, found = at[same], found[same]
            exact = (words[at[:, None] + np.arange(width)] == rows[found]).all(axis=1)
            yield width, at[exact], found[exact]

    def scan(self, texts: list[bytes]) -> list[tuple[int, list, list[str]]]:
        """Words, hit ranges of words and names of the items found (sorted), of each text."""
        each = [self.numbers(t) for t in texts]
        size = np.array([len(n) for n in each], np.int64)
        first = np.cumsum(size + 1) - size - 1  # texts are parted by an unknown word
        words = np.zeros(int(size.sum()) + len(each), np.int32)
        for at, numbers in zip(first.tolist(), each):
            words[at : at + len(numbers)] = numbers
        change = np.zeros(len(words) + 1, np.int64)
        owned: dict[int, set[int]] = {}
        for width, at, window in self.hits(words):
            np.add.at(change, at, 1)
            np.add.at(change, at + width, -1)
            _, _, _, ends, owners = self.tables[width]
            of = np.searchsorted(first, at, "right") - 1
            for pair in np.unique(of << 32 | window).tolist():
                n = pair & 0xFFFFFFFF
                owned.setdefault(pair >> 32, set()).update(owners[ends[n] : ends[n + 1]].tolist())
        edges = np.flatnonzero(np.diff(np.cumsum(change) > 0, prepend=False)).tolist()
        ranges: dict[int, list] = {}
        for a, b in zip(edges[::2], edges[1::2]):
            n = int(np.searchsorted(first, a, "right")) - 1
            ranges.setdefault(n, []).append((a - int(first[n]), b - int(first[n])))
        return [
            (len(each[n]), ranges.get(n, []), sorted(self.names[i] for i in owned.get(n, ()))) for n in range(len(texts))
        ]


def _hash(rows: np.ndarray, seed: int) -> np.ndarray:
    out = np.full(len(rows), seed, U64)
    for column in rows.T:
        out = mix(out * STEP + column.astype(U64))
    return out


def _table(rows: np.ndarray, owners: np.ndarray):
    """(seed, sorted hashes, the windows' words, and where each one's owners begin in the last)."""
    rows, window = np.unique(rows, axis=0, return_inverse=True)
    seed = 1
    while len(np.unique(key := _hash(rows, seed))) < len(rows):
        seed += 1  # a hash must tell all windows apart
    order = np.argsort(key)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pairs = np.unique(place[window.ravel()] << 32 | owners)
    ends = np.searchsorted(pairs >> 32, np.arange(len(order) + 1))
    return seed, key[order], rows[order], ends, pairs & 0xFFFFFFFF


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """name, words (normalised) of pieces that hold every window of an item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, value in zip(batch["name"], batch["text"]):
                words = normalised(value).split()
                step = PIECE - window + 1
                starts = range(0, max(1, len(words) - window + 1), step)
                yield pd.DataFrame({"name": [name] * len(starts), "words": [b" ".join(words[s : s + PIECE]) for s in starts]})

    rows = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(cut, "name string, words binary").where(F.octet_length("words") > 0)


def window_sets(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> Iterator[WindowSet]:
    """The benchmark's windows in blocks of about ``block_bytes``, one held by the driver at a time."""
    pieces = materialise(_pieces(benchmark, item, text, window).distinct(), "benchmark-pieces")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    for block in range(max(1, blocks)):
        own = pieces if blocks <= 1 else pieces.where(F.pmod(F.xxhash64("name", "words"), F.lit(blocks)) == block)
        yield WindowSet(sorted((r["name"], bytes(r["words"])) for r in own.collect()), window)


def _groups(texts: pd.Series) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        group.append(normalised(text))
        size += len(group[-1])
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scanner(found: WindowSet, df: DataFrame):
    shared = df.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf(f"words long, ranges {RANGES}, items array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [row for group in _groups(texts) for row in shared.value.scan(group)]
            ranges = [[{"first": a, "last": b} for a, b in r] for _, r, _ in rows]
            yield pd.DataFrame({"words": [n for n, _, _ in rows], "ranges": ranges, "items": [i for _, _, i in rows]})

    return scan.asNondeterministic()  # so that it stays one column, computed once


def _union(ranges) -> list[dict]:
    """Ranges that meet become one."""
    runs: list[dict] = []
    for first, last in sorted((r["first"], r["last"]) for r in ranges):
        if runs and first <= runs[-1]["last"]:
            runs[-1]["last"] = max(last, runs[-1]["last"])
        else:
            runs.append({"first": first, "last": last})
    return runs


def _scanned(df: DataFrame, sets: Iterator[WindowSet], text: str, out: str) -> DataFrame:
    """``df`` with the struct ``out``: words, ranges and items."""
    value = F.col(f"`{text}`")
    first = next(sets)
    second = next(sets, None)
    if second is None:
        return df.withColumn(out, _scanner(first, df)(value))
    # Equal texts have equal hits, so a digest is their key; only hit texts are written.
    digest = F.sha2(F.coalesce(value, F.lit("")), 256)
    docs = df.select(digest.alias("digest"), value.alias("text"))
    parts = []
    for found in (w for part in ([first, second], sets) for w in part):
        hits = docs.select("digest", _scanner(found, df)("text").alias("s")).where("size(s.ranges) > 0")
        parts.append(materialise(hits.groupBy("digest").agg(F.first("s").alias("s")), "benchmark-hits"))

    @F.pandas_udf(RANGES)
    def joined(found: pd.Series) -> pd.Series:
        return pd.Series([_union(r) for r in found], dtype="object")

    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = every.groupBy("digest").agg(F.flatten(F.collect_list("s.ranges")).alias("r"), F.flatten(F.collect_list("s.items")).alias("i"))
    every = materialise(every.select("digest", joined("r").alias("r"), F.array_sort(F.array_distinct("i")).alias("i")), "benchmark-hits")
    key, ranges, items = free_names(df, "digest", "ranges", "items")
    every = broadcast_if_small(every.toDF(key, ranges, items))
    rows = df.join(every, digest == F.col(key), "left")
    none = WindowSet([], WINDOW)
    struct = F.struct(
        _scanner(none, df)(value)["words"].alias("words"),
        F.coalesce(ranges, F.array().cast(RANGES)).alias("ranges"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"),
    )
    return rows.select(*[f"`{c}`" for c in df.columns], struct.alias(out))


def mark_contaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit`` (words hit), ``hit_items`` (names, sorted) and ``hit_ranges`` (of words, end
    exclusive). Runs jobs on the benchmark at call time."""
    names = ("n_words", "n_hit", "hit_items", "hit_ranges")
    rest = without(df, *(n for n in names if n != text))
    (found,) = free_names(rest, "found")
    scanned = _scanned(rest, window_sets(benchmark, item, item_text, window, block_bytes), text, found)
    part = lambda name: F.col(f"`{found}`.{name}")
    return scanned.select(
        *[f"`{c}`" for c in rest.columns],
        part("words").alias("n_words"),
        F.aggregate(part("ranges"), F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"]).alias("n_hit"),
        part("items").alias("hit_items"),
        part("ranges").alias("hit_ranges"),
    )


def _cut(text: str, ranges) -> str:
    """The text without the words of ``ranges`` (and what stands between them)."""
    out, at, runs = [], 0, iter((r["first"], r["last"]) for r in ranges)
    first, last = next(runs)
    for n, word in enumerate(WORD.finditer(text)):
        if n == first:
            out.append(text[at : word.start()])
        if n == last - 1:
            at = word.end()
            first, last = next(runs, (-1, -1))
            if first < 0:
                break
    return "".join(out) + text[at:]


def remove_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", how: str = "spans", most: float = 0.0, **options) -> DataFrame:
    """``df`` without what the benchmark holds, with its own columns.

    ``how="documents"`` drops rows of which more than the share ``most`` of the words is hit; ``"spans"`` cuts the
    hit words out of the text.
    """
    if how not in ("spans", "documents"):
        raise ValueError(f"how must be 'spans' or 'documents', not '{how}'")
    names = free_names(df, "row", "value")
    row, value = names
    # Packed, so that no column of the table can be taken for a result.
    packed = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias(row), F.col(f"`{text}`").alias(value))
    marked = mark_contaminated(packed, benchmark, value, **options)
    if how == "documents":
        kept = marked.where(F.col("n_hit") <= most * F.col("n_words"))
        return kept.select(*[F.col(row)[c].alias(c) for c in df.columns])

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, r) for t, r in zip(texts, ranges)], dtype="object")

    hit = F.col("n_hit") > 0
    shorter = marked.withColumn("hit_items", cut(F.when(hit, F.col(value)), F.col("hit_ranges")))
    whole: dict[str, Column] = {c: F.col(row)[c] for c in df.columns}
    whole[text] = F.when(hit, F.col("hit_items")).otherwise(F.col(value))
    return shorter.select(*[column.alias(c) for c, column in whole.items()])
