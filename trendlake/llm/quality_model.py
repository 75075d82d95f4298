"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word has a sparse random index vector. A word's vector is that plus the sum of the index
vectors of its neighbours over a bounded sample, so words used alike lie close. A document is the
mean of its words' vectors, with the square of the mean's length (high when few words repeat) and
its log length. Two marker words stand for "word in capitals" and "same word again". A two-layer
network scores that, and a temperature fitted on rows the network did not see calibrates it.

Words are hashed to a fixed number of buckets, so vectors, model and everything that reaches the
driver are bounded by the parameters ``fit_rows``, BUCKETS and DIM, whatever the corpus. Null and
empty texts have the zero vector and are scored like any other; nothing but the text is read.
Labels of null documents or documents without labels are ignored. Every run fits the same model.
Without labels of both kinds nothing can be learned: every score is then 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import bounded_rows, without

FIT_ROWS = 8000  # labelled rows the vectors and the network are fitted on, about
BUCKETS = 1 << 15
DIM = 128
NONZERO = 8
TOGETHER = 512  # buckets added up in one group
REACH = 2  # neighbours on either side
CACHED = 1 << 18
TOKEN = re.compile(r"\w+|[^\w\s]+")
CAPITALS, AGAIN = "\x01capitals", "\x01again"


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


class _Buckets(dict):
    """Token to (bucket, whether in capitals)."""

    def __missing__(self, token: str) -> tuple[int, bool]:
        found = (_bucket(token.lower()), len(token) > 1 and token.isupper())
        if len(token) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[token] = found
        return found


def index_vectors() -> np.ndarray:
    """NONZERO entries of +1 or -1 for each bucket, the same on every machine."""
    random = np.random.default_rng(20240131)
    vectors = np.zeros((BUCKETS, DIM), np.int8)
    where = random.integers(0, DIM, (BUCKETS, NONZERO))
    vectors[np.arange(BUCKETS)[:, None], where] = random.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO))
    return vectors


def _contexts(texts: Iterator[str | None], index: np.ndarray) -> np.ndarray:
    """For each bucket the sum of its neighbours' index vectors. Whole numbers: the order of adding is no matter."""
    sums, index = np.zeros((BUCKETS, DIM), np.int64), index.astype(np.int32)
    known = _Buckets()
    for text in texts:
        found = np.array([known[t][0] for t in TOKEN.findall(text or "")], np.int64)
        for distance in range(1, REACH + 1):
            left, right = found[:-distance], found[distance:]
            pairs, times = np.unique(np.concatenate([left * BUCKETS + right, right * BUCKETS + left]), return_counts=True)
            if len(pairs):
                centre, neighbour = np.divmod(pairs, BUCKETS)
                starts = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
                sums[centre[starts]] += np.add.reduceat(index[neighbour] * times[:, None], starts, axis=0)
    return sums


def word_vectors(sample: DataFrame, text: str = "text") -> np.ndarray:
    """BUCKETS x DIM, from the neighbours in ``sample`` (bounded by the caller)."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = _contexts((t for batch in batches for t in batch.iloc[:, 0]), index_vectors())
        some = np.flatnonzero(sums.any(axis=1))
        if len(some):
            yield pd.DataFrame({"part": some // TOGETHER, "bucket": some, "sums": [sums[b].tobytes() for b in some]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        buckets, which = np.unique(group["bucket"].to_numpy(), return_inverse=True)
        total = np.zeros((len(buckets), DIM), np.int64)
        for at, sums in zip(which, group["sums"]):
            total[at] += np.frombuffer(sums, np.int64)
        return pd.DataFrame({"part": buckets // TOGETHER, "bucket": buckets, "sums": [t.tobytes() for t in total]})

    schema = "part long, bucket long, sums binary"
    parts = sample.select(f"`{text}`").mapInPandas(partial, schema)
    index = index_vectors().astype(np.float32)
    context = np.zeros_like(index)
    for row in parts.groupBy("part").applyInPandas(add, schema).select("bucket", "sums").collect():  # BUCKETS rows
        context[row["bucket"]] = np.frombuffer(row["sums"], np.int64)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    return (unit(index) + unit(context)).astype(np.float16)


class _Pool:
    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.known = _Buckets()
        self.marks = [_bucket(CAPITALS), _bucket(AGAIN)]

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text or "")
        out = np.zeros(DIM + 2, np.float32)
        if tokens:
            counts = Counter(tokens)
            found = [self.known[t] for t in counts]
            times = list(counts.values())
            capitals = sum(n for n, f in zip(times, found) if f[1])
            again = sum(map(eq, tokens, tokens[1:]))
            rows = self.vectors[[f[0] for f in found] + self.marks].astype(np.float32)
            weights = np.array([*times, capitals, again], np.float32)
            mean = weights @ rows / weights.sum()
            out[:DIM] = mean
            out[DIM] = mean @ mean
            out[DIM + 1] = np.log1p(len(tokens))
        return out


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        margin = _margins((pooled - self.centre) / self.spread, self.layers) / self.temperature
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def _margins(x: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2[0]


def _train(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, decay: float, seed: int) -> list[np.ndarray]:
    """Adam on the logistic loss; both labels weigh as they occur."""
    random = np.random.default_rng(seed)
    layers = [random.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            some = order[at : at + 256]
            w1, b1, w2, b2 = layers
            h = np.tanh(x[some] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -60, 60))) - y[some]) / len(some)
            back = np.outer(error, w2) * (1 - h * h)
            slopes = [x[some].T @ back + decay * w1, back.sum(0), h.T @ error + decay * w2, np.array([error.sum()])]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def _temperature(margin: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the margins with the least logistic loss on rows the network did not see."""
    grid = np.geomspace(0.25, 16, 97)
    loss = [np.mean(np.logaddexp(0, -np.where(y > 0, margin, -margin) / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_quality(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS
) -> QualityModel:
    """``labelled`` has key, text and 0/1 label; about ``fit_rows`` of its rows are used."""
    rows = labelled.where(F.col(f"`{label}`").isNotNull())
    sample = bounded_rows(rows, fit_rows, [key]).select(
        F.xxhash64(F.col(f"`{key}`")).alias("place"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("int").alias("label")
    )
    vectors = word_vectors(sample, "text")
    pool = pool_udf(sample, vectors)
    found = sample.select("place", "label", pool("text").alias("pooled")).toPandas()
    width = DIM + 2
    x = np.frombuffer(b"".join(found["pooled"]), np.float32).reshape(-1, width).astype(np.float64)
    y = found["label"].to_numpy(np.float64)
    order = np.lexsort((*x.T[:3], found["place"].to_numpy()))
    x, y = x[order], y[order]
    if len(set(y)) < 2:
        return QualityModel(vectors, np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.zeros(1)], 1.0)
    centre, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - centre) / spread
    apart = np.arange(len(z)) % 5 == 0
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart[:] = False
    layers = _train(z[~apart], y[~apart], hidden=24, epochs=40, decay=1e-4, seed=7)
    seen = apart if apart.any() else ~apart
    return QualityModel(vectors, centre, spread, layers, _temperature(_margins(z[seen], layers), y[seen]))


def pool_udf(df: DataFrame, vectors: np.ndarray):
    shared = df.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x DIM halves: 8 MB

    @F.pandas_udf("binary")
    def pooled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pool = _Pool(shared.value)
        for texts in batches:
            yield pd.Series([pool(t).tobytes() for t in texts], dtype=object)

    return pooled


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability (0 to 1) that a row's whole text has label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pool = _Pool(shared.value.vectors)
        for texts in batches:
            pooled = np.array([pool(t) for t in texts], np.float64).reshape(-1, DIM + 2)
            yield pd.Series(shared.value.scores(pooled))

    return without(df, out).withColumn(out, scores(F.col(f"`{text}`")))
