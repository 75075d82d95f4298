"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 drawn from its code point. A run of three letters is
bound into one vector: the product of its letters' vectors, each rotated by its place. A text is
the bundle (sum) of its runs, a language the bundle of its texts, and a text gets the language
whose bundle has the largest cosine with its own.

Words are runs of letters; everything else separates them and counts as one blank. Null texts and
texts without letters are ``und`` with score 0. Whole texts are read. Equal cosines go to the
language first in code point order. With nothing learned every text is ``und``. Profiles are
bundled from a bounded number of texts per language (``per_language``), so a language with most of
the rows costs no more than others; sums are whole numbers, so every run learns the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import free_names, without

DIM = 1024
PER_LANGUAGE = 2000
CACHED = 1 << 14
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
POINT_BITS = 21


class Bundler:
    """Turns a text into its bundle."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.bound = np.empty((CACHED, DIM), np.float32)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = np.random.default_rng(point).choice(np.array([-1, 1], np.int8), DIM)
        return self.letters[point]

    def _bind(self, code: int) -> np.ndarray:
        mask = (1 << POINT_BITS) - 1
        a, b, c = code >> 2 * POINT_BITS, code >> POINT_BITS & mask, code & mask
        return np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)

    def _rows(self, codes: list[int]) -> np.ndarray:
        fresh = [c for c in codes if c not in self.place]
        if len(self.place) + len(fresh) > CACHED:
            self.place.clear()
            if len(codes) > CACHED:  # more runs in one text than are kept
                return np.array([self._bind(c) for c in codes], np.float32)
            fresh = codes
        for code in fresh:
            self.bound[len(self.place)] = self._bind(code)
            self.place[code] = len(self.place)
        return self.bound[[self.place[c] for c in codes]]

    def __call__(self, text: str | None) -> np.ndarray | None:
        found = LETTERS.findall((text or "").lower())
        if not found:
            return None
        points = np.frombuffer(f" {' '.join(found)} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        codes = points[:-2] << 2 * POINT_BITS | points[1:-1] << POINT_BITS | points[2:]
        runs, times = np.unique(codes, return_counts=True)
        bundle = np.zeros(DIM, np.float64)
        for at in range(0, len(runs), CACHED):
            some = slice(at, at + CACHED)
            bundle += times[some].astype(np.float32) @ self._rows(runs[some].tolist())
        return bundle


def fit_profiles(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE
) -> dict[str, np.ndarray]:
    """The bundle of each non-null language, from about ``per_language`` texts of it."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`")).alias("place")
    )
    counts = rows.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return {}
    part = spark.createDataFrame([(r["lang"], min(1.0, per_language / r["count"])) for r in counts], "lang string, part double")
    share = F.pmod("place", F.lit(1 << 30)) < F.col("part") * (1 << 30)
    sample = rows.join(F.broadcast(part), "lang").where(share).select("lang", "text")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundler, sums = Bundler(), {}
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                if (bundle := bundler(value)) is not None:
                    # A text counts by its direction: long texts do not drown the others.
                    unit = np.rint(bundle * (1e6 / np.linalg.norm(bundle) if bundle.any() else 0)).astype(np.int64)
                    sums[name] = sums.get(name, 0) + unit
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sums": [s.tobytes() for s in sums.values()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s, np.int64) for s in group["sums"]], axis=0).astype(np.int64)
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "sums": [total.tobytes()]})

    schema = "lang string, sums binary"
    found = sample.mapInPandas(partial, schema).groupBy("lang").applyInPandas(add, schema).collect()
    return {r["lang"]: np.frombuffer(r["sums"], np.int64).astype(np.float64) for r in sorted(found, key=lambda r: r["lang"])}


def identify(
    df: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", out: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``df`` with the language of every text and the cosine (0 to 1) behind it."""
    names = sorted(profiles)
    matrix = np.array([profiles[n] / max(np.linalg.norm(profiles[n]), 1e-9) for n in names]).reshape(-1, DIM)
    shared = df.sparkSession.sparkContext.broadcast((names, matrix))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bundler = Bundler()
        known, prototypes = shared.value
        for texts in batches:
            rows = []
            for value in texts:
                bundle = bundler(value)
                if bundle is None or not known or not bundle.any():
                    rows.append((UNDETERMINED, 0.0))
                    continue
                cosines = prototypes @ bundle / np.linalg.norm(bundle)
                best = int(np.argmax(cosines))
                rows.append((known[best], float(min(1.0, max(0.0, cosines[best])))))
            yield pd.DataFrame(rows, columns=["lang", "score"])

    kept = [f"`{c}`" for c in without(df, out, score).columns]
    (predicted,) = free_names(df, "predicted")
    found = df.select(*kept, predict(F.col(f"`{text}`")).alias(predicted))
    return found.select(*kept, F.col(f"{predicted}.lang").alias(out), F.col(f"{predicted}.score").alias(score))
