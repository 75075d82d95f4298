"""Periodic runs of words: seeds of equal word runs, extended along diagonals.

A run is a stretch of words with smallest period q, of at least ``least`` words and two periods, that
neither neighbour extends. On the diagonal of lag q (words compared with the q-th after them) it is
a stretch of equal words of at least max(least - q, q), so never less than k = ceil(least / 2): every
run holds, on its own diagonal, two equal k-grams at distance q.

Seeds. For lags below 2k all pairs of equal k-grams that close are taken, at most 2k - 1 for a word.
Longer lags go by levels: lags from K up to 2K, K = 2k, 4k, ..., are found from pairs of equal
K-grams, whose numbers come from pairs of K/2-grams. Pairs are bounded without leaving any run out: a
K-gram that comes again within K/2 words is passed over. If every K-gram of a run did (had a period of
at most K/2), neighbours, which overlap in K - 1 words, would share that period, and so would the whole
run: it would not be its smallest. So some K-gram of the run is not passed over; it comes again
q words before or after, and those between are more than K/2 apart, so at most four follow in reach.
There are O(n log n) seeds, however often a word repeats. Levels end when no K-gram repeats.

Extension. Seeds of a lag are taken from left to right; a table of the furthest place covered on each
lag passes over those inside a stretch that was extended already. Stretches too short for their lag
are no runs, and of stretches in the same place only the smallest period is kept (longer ones are its
multiples).

Words are separated by the bytes 0x09-0x0D and 0x20. Null, empty and short texts have no runs. Texts of
any length are searched whole, in memory proportional to the text. Every row is its own task's work: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.arrays import STEP, mix, word_chunks
from trendlake.llm.common import free_names, without

LEAST = 12  # words of a run
RUNS = "array<struct<start: int, length: int, period: int>>"


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _joined(left: np.ndarray, right: np.ndarray, apart: int) -> np.ndarray:
    """Numbers of the grams made of ``left`` and of ``right`` at ``apart`` words behind."""
    n = len(right) - apart
    return _dense(left[:n] << 32 | right[apart:])


def _repeats(hashes: np.ndarray, k: int) -> bool:
    """Whether some k-gram may occur twice (hashes: one per word)."""
    if len(hashes) < k + 1:
        return False
    grams = hashes[: len(hashes) - k + 1].copy()
    for n in range(1, k):
        grams = mix(grams * STEP + hashes[n : len(hashes) - k + 1 + n])
    grams.sort()
    return bool((grams[1:] == grams[:-1]).any())


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k-grams, by doubling."""
    have, width, power, size = None, 0, words, 1
    while True:
        if k & size:
            have = power if have is None else _joined(have, power, width)
            width += size
        size *= 2
        if size > k:
            return have
        power = _joined(power, power, size // 2)


def _seeds(grams: np.ndarray, least: int, below: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of pairs of equal grams with least <= lag < below, by lag, then place. Grams that come
    again within ``skip`` words have none."""
    order = np.argsort(grams, kind="stable")
    number = grams[order]
    lags, places = [], []
    left = np.arange(len(order))
    if skip:
        soon = np.flatnonzero((number[1:] == number[:-1]) & (order[1:] - order[:-1] <= skip))
        left = np.delete(left, soon)
    ahead = 1
    while len(left):
        left = left[left + ahead < len(order)]
        lag = order[left + ahead] - order[left]
        left, lag = (x[(number[left + ahead] == number[left]) & (lag < below)] for x in (left, lag))
        found = lag >= least
        lags.append(lag[found])
        places.append(order[left[found]])
        ahead += 1
    lag, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (lags, places))
    by = np.lexsort((place, lag))
    return lag[by], place[by]


def _equal_ahead(words: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal those ``lag`` behind them."""
    done, step = at, 32
    while True:
        end = min(done + step, len(words) - lag)
        differ = words[done:end] != words[done + lag : end + lag]
        if differ.any():
            return done + int(differ.argmax()) - at
        done, step = end, step * 2
        if end >= len(words) - lag:
            return end - at


def _equal_before(words: np.ndarray, at: int, lag: int) -> int:
    """How many words just before ``at`` equal those ``lag`` behind them."""
    done, step = at, 32
    while done > 0:
        start = max(0, done - step)
        differ = words[start:done] != words[start + lag : done + lag]
        if differ.any():
            return at - (done - int(differ[::-1].argmax()))
        done, step = start, step * 2
    return at


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` (numbers), by start, then period."""
    n = len(words)
    k = (least + 1) // 2
    found: dict[tuple[int, int], int] = {}
    covered: dict[int, int] = {}
    grams, size = _grams(words, k) if n > k else np.empty(0, np.int64), k
    while len(grams) and grams.max() + 1 < len(grams):
        lags, places = _seeds(grams, 1 if size == k else size, 2 * size, 0 if size == k else size // 2)
        # Neighbouring seeds of a lag are one stretch; the table passes over what an extension covered.
        new = np.flatnonzero(np.r_[True, (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)])[: len(lags)]
        for lag, place in zip(lags[new].tolist(), places[new].tolist()):
            if place < covered.get(lag, 0):
                continue
            start = place - _equal_before(words, place, lag)
            end = place + _equal_ahead(words, place, lag) + lag
            covered[lag] = end - lag
            length = end - start
            if length >= max(least, 2 * lag) and lag < found.get((start, length), n):
                found[start, length] = lag
        grams = _joined(grams, grams, size) if len(grams) > size else np.empty(0, np.int64)
        covered.clear()  # the next level has other lags
        size *= 2
    return sorted((start, length, period) for (start, length), period in found.items())


def _numbers(data: bytes) -> np.ndarray:
    """Words as numbers, told apart exactly."""
    number: dict[bytes, int] = {}
    parts = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in word_chunks(data)]
    return np.concatenate(parts)


def runs_of(text: str | None, least: int = LEAST) -> list[tuple[int, int, int]]:
    data = (text or "").encode("utf-8", "surrogatepass")
    hashes = np.concatenate([np.fromiter(map(hash, words), np.int64, len(words)) for words in word_chunks(data)])
    if not _repeats(hashes.view(np.uint64), (least + 1) // 2):
        return []
    return find_runs(_numbers(data), least)


def collapsed(text: str | None, runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds behind its first period, joined by blanks."""
    data = (text or "").encode("utf-8", "surrogatepass")
    change: dict[int, int] = {}
    for start, length, period in runs:
        change[start + period] = change.get(start + period, 0) + 1
        change[start + length] = change.get(start + length, 0) - 1
    kept, at, depth = [], 0, 0
    marks = iter(sorted(change.items()))
    mark = next(marks, None)
    for words in word_chunks(data):
        begin = 0
        while mark is not None and mark[0] <= at + len(words):
            if not depth:
                kept += words[begin : mark[0] - at]
            begin = max(begin, mark[0] - at)
            depth += mark[1]
            mark = next(marks, None)
        if not depth:
            kept += words[begin:]
        at += len(words)
    return b" ".join(kept).decode("utf-8", "surrogatepass")


def mark_runs(df: DataFrame, text: str = "text", least: int = LEAST, runs: str = "runs", out: str = "collapsed") -> DataFrame:
    """``df`` with the ``runs`` of every whole text (start, length and period in words, by start, then period) and, as
    ``out``, the text in which each run is its first period. Columns of these names are replaced, others stay."""

    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                found = runs_of(value, least)
                rows.append(([dict(zip(("start", "length", "period"), r)) for r in found], collapsed(value, found)))
            yield pd.DataFrame(rows, columns=["runs", "collapsed"])

    rest = without(df, *(n for n in (runs, out) if n != text))
    (found,) = free_names(rest, "found")
    searched = rest.withColumn(found, search.asNondeterministic()(F.col(f"`{text}`")))
    names = [f"`{c}`" for c in rest.columns if c.lower() not in (runs.lower(), out.lower())]
    return searched.select(*names, F.col(f"`{found}`.runs").alias(runs), F.col(f"`{found}`.collapsed").alias(out))


def collapse_runs(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``df`` with every run in ``text`` cut to its first period; texts without runs stay as they are."""
    runs, short = free_names(df, "runs", "short")
    marked = mark_runs(df, text, least, runs, short)
    return marked.select(
        *[F.when(F.size(runs) > 0, F.col(short)).otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    )
