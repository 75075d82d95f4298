"""Repeated passages by grouping windows by minimizer and content hashes.

This is not the depth-limited radix sort of suffixes: nothing is ordered by any digit. A passage is removed
where a string of ``length`` bytes also starts anywhere else. That needs equality only, so each pass
groups by a hash and keeps the groups that still have two members. Contents are not compared beyond the hashes.

1. First hash: the run of ``GRAM`` bytes with the smallest hash inside the suffix's first ``length``
   bytes. Equal suffixes have the same one in the same place. Neighbouring suffixes mostly share it,
   so one row stands for a whole stretch of suffixes (about 50). Hashes that occur once drop out:
   most of the corpus.
2. Second hash: the bytes of the whole stretch. Stretches that are equal throughout are repeated in
   all their suffixes at once: copies and the inside of shared passages end here.
3. Last hash: the ``length`` bytes of each suffix, for the stretches left, which lie where a repeated
   passage begins or ends, against one of each different stretch with the same first hash.

Every pass is a count by hash that combines before the shuffle and a join back, so a passage that a
third of all documents share is never gathered in one task. The hashes of stretches have 64
bits below an equal first hash of 64, those of suffixes 96; a false match has a chance below 1e-9 at
10^9 suffixes. Passes are written and the ones before dropped, so disk holds one pass at a time.

Null counts as empty. Texts shorter than ``length`` lose nothing and repeat nothing. Rows are told
apart by key and text hash; equal rows are each other's copies. Matches do not cross rows, and are
judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import Passes, free_names, without
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import materialise

LENGTH = 200
CHUNK = 1 << 18  # suffixes looked at together
ROWS = 1000  # texts whose stretches are given out together
PLACE_BITS = 20
BROADCAST_BYTES = 16 << 20
U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Rolling:
    """Hashes of any stretch of a byte string by prefix sums modulo 2**64."""

    def __init__(self, seed: int, longest: int):
        random = np.random.default_rng(seed)
        self.letters = random.integers(1 << 63, size=256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        base = int(random.integers(1 << 62)) * 8 + 5
        self.up = np.cumprod(np.full(longest + 1, base % 2**64, U64))
        self.down = np.cumprod(np.full(longest + 1, pow(base, -1, 2**64), U64))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def stretch(self, sums: np.ndarray, start, end) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.down[start])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: prefix minima of blocks against suffix minima."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(U64).max, U64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


class Suffixes:
    def __init__(self, length: int):
        self.length = length
        self.gram = max(1, length // 2)
        self.one = Rolling(11, CHUNK + length)
        self.two = Rolling(12, CHUNK + length)

    def _chunks(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for at in range(0, len(data) - self.length + 1, CHUNK):
            yield at, data[at : at + CHUNK + self.length - 1]

    def stretches(self, data: np.ndarray) -> list[np.ndarray]:
        """Columns gram, span, first, last of the stretches of suffixes that share their smallest run."""
        out = []
        place = U64((1 << PLACE_BITS) - 1)
        for at, part in self._chunks(data):
            sums = self.one.prefixes(part)
            starts = np.arange(len(part) - self.gram + 1)
            grams = self.one.stretch(sums, slice(0, len(starts)), slice(self.gram, self.gram + len(starts)))
            least = _sliding_min(grams & ~place | starts.astype(U64), self.length - self.gram + 1)
            anchor = (least & place).astype(np.int64)
            first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            last = np.r_[first[1:] - 1, len(anchor) - 1]
            anchor = anchor[first]
            shape = (anchor - first).astype(U64) * U64(0x9E3779B97F4A7C15) + (last - first).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
            spans = _mix(self.two.stretch(self.two.prefixes(part), first, last + self.length) + shape)
            out.append((grams[anchor].view(np.int64), spans.view(np.int64), (first + at).astype(np.int64), (last + at).astype(np.int64)))
        return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4

    def suffixes(self, data: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the first ``length`` bytes of the suffixes at ``wanted`` (ascending)."""
        found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        for at, part in self._chunks(data):
            some = wanted[np.searchsorted(wanted, at) : np.searchsorted(wanted, at + CHUNK)] - at
            if len(some):
                for rolling, out in zip((self.one, self.two), found):
                    out.append(rolling.stretch(rolling.prefixes(part), some, some + self.length).view(np.int64))
        return np.concatenate(found[0]), np.concatenate(found[1])


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _stretches(docs: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sort = Suffixes(length)
        for batch in (whole.iloc[at : at + ROWS] for whole in batches for at in range(0, len(whole), ROWS)):
            found = [sort.stretches(_bytes(t)) for t in batch["text"]]
            times = [len(f[0]) for f in found]
            columns = [np.concatenate(c) for c in zip(*found)] if found else []
            if sum(times):
                at = np.repeat(np.arange(len(batch)), times)
                ids = {"key": batch["key"].take(at).array, "row": batch["row"].to_numpy()[at]}
                yield pd.DataFrame({**ids, **dict(zip(("gram", "span", "first", "last"), columns))})

    return docs.mapInPandas(find, "key long, row long, gram long, span long, first int, last int")


def _suffixes(docs: DataFrame, length: int) -> DataFrame:
    """One row per suffix of the ``ranges`` (first, last, mark) of each text."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sort = Suffixes(length)
        for batch in batches:
            for key, row, text, ranges in zip(batch["key"], batch["row"], batch["text"], batch["ranges"]):
                first, last, mark = (np.array([r[n] for r in ranges], np.int64) for n in ("first", "last", "mark"))
                size = last - first + 1
                wanted = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                mark = np.repeat(mark, size)
                order = np.argsort(wanted, kind="stable")
                one, two = sort.suffixes(_bytes(text), wanted[order])
                columns = {"one": one, "two": two.astype(np.int32), "at": wanted[order], "mark": mark[order] > 0, "row": row}
                out = pd.DataFrame(columns)
                out["key"] = pd.array([None if pd.isna(key) else int(key)] * len(out), "Int64")
                yield out

    return docs.mapInPandas(find, "one long, two int, at int, mark boolean, row long, key long")


def _with_texts(docs: DataFrame, small: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with rows per (_key, _row); texts stay where they are if ``small`` is small."""
    same = (F.col("row") == F.col("_row")) & F.col("key").eqNullSafe(F.col("_key"))
    return docs.join(broadcast_if_small(small, max_bytes=BROADCAST_BYTES), same, how).drop("_key", "_row")


def repeated_starts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, row, first, last): ranges of starts whose ``length`` bytes also start elsewhere.

    ``docs`` has key, row (text hash) and text. Runs jobs at call time.
    """
    ids = ["key", "row", "first", "last"]
    passes = Passes(docs.sparkSession)
    found = passes.write(_stretches(docs, length), "sort-1")
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    # Written, so that the join has plain shuffles on both sides: only then is a hot digit split.
    grams = passes.write(grams, "sort-grams")
    found = passes.write(found.join(grams, "gram"), "sort-2")
    passes.drop("sort-1", "sort-grams")

    spans = found.groupBy("gram", "span").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*ids)).alias("one"))
    spans = passes.write(spans, "sort-3")
    equal = found.join(spans.where("n > 1").select("gram", "span"), ["gram", "span"], "left_semi").select(*ids)
    equal = passes.write(equal, "sort-equal")
    passes.drop("sort-2")

    mixed = spans.groupBy("gram").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1").select("gram")
    part = F.struct("one.first", "one.last", (F.col("n") == 1).alias("mark"))
    ranges = spans.join(mixed, "gram").groupBy(F.col("one.key").alias("_key"), F.col("one.row").alias("_row"))
    ranges = passes.write(ranges.agg(F.collect_list(part).alias("ranges")), "sort-ranges")
    suffixes = passes.write(_suffixes(_with_texts(docs, ranges, "inner"), length), "sort-4")
    passes.drop("sort-3", "sort-ranges")
    twice = suffixes.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.max("mark").alias("mark")).where("n > 1 and mark")
    twice = passes.write(twice.select("one", "two"), "sort-twice")
    passes.drop()
    hits = suffixes.where("mark").join(twice, ["one", "two"], "left_semi")
    hits = passes.write(hits.select("key", "row", F.col("at").alias("first"), F.col("at").alias("last")), "sort-hits")
    passes.drop("sort-4", "sort-twice")
    return equal.union(hits)


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, kept: str = "kept", spans: str = "removed"
) -> DataFrame:
    """``df`` with ``kept`` (binary: the bytes that remain) and ``spans`` (the maximal removed runs: start, end)."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.xxhash64(value).alias("row"), value.alias("text"))
    starts = repeated_starts(docs, length)
    marks = starts.groupBy(F.col("key").alias("_key"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("first", "last")).alias("_ranges"))
    marks = materialise(marks, "sort-marks")

    @F.pandas_udf("kept binary, spans array<struct<start: int, end: int>>")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        out = []
        for value, found in zip(texts, ranges):
            if value is None:
                out.append((None, None))
                continue
            data = value.encode("utf-8", "surrogatepass")
            runs = _union(found, length)
            ends = [0, *(e for _, e in runs)]
            begins = [*(s for s, _ in runs), len(data)]
            out.append((b"".join(data[a:b] for a, b in zip(ends, begins)), [{"start": s, "end": e} for s, e in runs]))
        return pd.DataFrame(out, columns=["kept", "spans"])

    rest = without(df, kept, spans)
    names = [f"`{c}`" for c in rest.columns]
    own, own_key, own_row, mark_key, mark_row, ranges, done = free_names(rest, "t", "own_key", "own_row", "key", "row", "ranges", "cut")
    rows = df.select(*names, F.struct(F.col(f"`{text}`").alias("t")).alias(own), F.col(f"`{key}`").cast("long").alias(own_key), F.xxhash64(value).alias(own_row))
    marks = marks.withColumnsRenamed({"_key": mark_key, "_row": mark_row, "_ranges": ranges})
    small = broadcast_if_small(marks, max_bytes=BROADCAST_BYTES)
    joined = rows.join(small, (F.col(own_row) == F.col(mark_row)) & F.col(own_key).eqNullSafe(F.col(mark_key)), "left")
    value = F.coalesce(F.col(f"{own}.t"), F.lit(""))
    marked = F.col(ranges).isNotNull()
    result = joined.withColumn(done, cut(F.when(marked, value), F.col(ranges)))
    none = F.array().cast("array<struct<start: int, end: int>>")
    return result.select(
        *names,
        F.when(marked, F.col(f"{done}.kept")).otherwise(value.cast("binary")).alias(kept),
        F.when(marked, F.col(f"{done}.spans")).otherwise(none).alias(spans),
    )


def _union(ranges, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the ``length`` bytes from each start."""
    out: list[list[int]] = []
    for first, last in sorted((int(r["first"]), int(r["last"])) for r in ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(s, e) for s, e in out]
