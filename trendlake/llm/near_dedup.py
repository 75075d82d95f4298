"""Near-duplicates by DartMinHash signatures and banded joins.

A text is the set (or, with ``weighting="count"``, the weighted set) of its runs of five words. Each
element owns a region, as high as its weight and endless along a rank axis, into which hashed darts
fall: one per unit of area on average, each with a coordinate. A set's signature holds, for each
coordinate, its earliest dart. Darts depend on the element only, so two sets share a coordinate's
dart with the probability of their (weighted) Jaccard similarity. Darts are looked for only as deep
as a set needs to fill all coordinates: few per element for large sets.

Signatures are cut into bands; sets that share a band meet. The leader of a band's bucket is the set
that meets most others (of an edited text, the original). Each set is first compared, exactly, with the
greatest of its leaders, then, for ``ROUNDS``, with the greatest that is still in another group: one pair
per set at a time. Where a bucket's sets are then still in different groups,
all that met are compared, block by block inside tasks that give out no more links than join their
groups, except sets of which too many elements are in no other set left. Groups are connected components
of pairs at or above the threshold; links found later join groups, not sets, again. At the default 28 bands of 4 a pair of similarity 0.8 shares no band with probability
below 4e-7.

Words are separated by the bytes 0x09-0x0D and 0x20. A text of one to four words is one element; a
text without words (null, empty) has none, is similar to nothing and stays. Equal sets are one node,
so copies, however many, are never paired. Ids may be null or repeated: the group's id is its
smallest id, null if all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import TEXTS, free_names, without
from trendlake.llm.components import connected
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import arrow_rows, materialise

WINDOW = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 4
CACHED = 1 << 17
ROUNDS = 2  # times a set is compared with a leader in another group
BLOCK = 256  # sets of one cluster compared with as many others in one task
FIRST = 1 / 8  # rank at which the first slab ends; slabs double up to 1 and are 1 wide from there
U64 = np.uint64
GOLDEN = 0x9E3779B97F4A7C15
STEP = U64(GOLDEN)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U64(11)).astype(np.float64) * 2.0**-53


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found


def shingles(text: str | None, known: dict, window: int = WINDOW) -> np.ndarray:
    """Hashes of the runs of ``window`` words, in order, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").split()
    if not found:
        return np.empty(0, U64)
    words = np.fromiter(map(known.__getitem__, found), U64, len(found))
    width = min(window, len(words))
    out = np.zeros(len(words) - width + 1, U64)
    for k in range(width):
        out = _mix(out * STEP + words[k : len(words) - width + 1 + k])
    return out


def _poisson_steps(mean: float) -> np.ndarray:
    """Chances of at most 0, 1, 2, ... darts in a cell."""
    terms = [np.exp(-mean)]
    while len(terms) < 24:
        terms.append(terms[-1] * mean / len(terms))
    return np.cumsum(terms)


STEPS = {width: _poisson_steps(width) for width in (FIRST, *(FIRST * 2**n for n in range(3)), 1.0)}


def _slabs(start: int, depth: float) -> list[tuple[int, float, float]]:
    """(number, rank where it begins, width) of the slabs from ``start`` on that begin below ``depth``."""
    out = []
    number = start
    while True:
        if number == 0:
            low, width = 0.0, FIRST
        elif number <= 3:
            low = width = FIRST * 2 ** (number - 1)
        else:
            low, width = float(number - 3), 1.0
        if out and low >= depth:
            return out
        out.append((number, low, width))
        number += 1


def darts(elements: np.ndarray, weights: np.ndarray | None, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates for a weighted set (unit weights if None)."""
    if weights is None:
        cells, height = elements, None
    else:
        layers = np.ceil(weights).astype(np.int64)
        at = np.repeat(np.arange(len(elements)), layers)
        layer = np.arange(len(at)) - np.repeat(np.cumsum(layers) - layers, layers)
        cells = np.where(layer == 0, elements[at], _mix(elements[at] + STEP * layer.astype(U64)))
        height = weights[at] - layer  # the top layer may be thinner than 1
    total = len(cells) if height is None else float(np.minimum(height, 1).sum())
    depth, start = k * (np.log(k) + 0.6) / total, 0
    rank, won = np.full(k, np.inf), np.zeros(k, U64)
    while True:
        slabs = _slabs(start, depth)
        found = []
        for width in {w for _, _, w in slabs}:
            group = [s for s in slabs if s[2] == width]
            keys = np.array([s[0] for s in group], U64)
            low = np.array([s[1] for s in group])
            cell = _mix(cells[:, None] ^ _mix(STEP * (keys[None, :] + U64(1))))
            number = np.searchsorted(STEPS[width], _unit(cell))
            n = 0
            while (has := np.nonzero(number > n))[0].size:
                dart = _mix(cell[has] + U64(GOLDEN * (n + 2) % 2**64))
                if height is not None:
                    inside = _unit(_mix(dart + U64(1))) < height[has[0]]
                    dart, has = dart[inside], (has[0][inside], has[1][inside])
                found.append((dart, low[has[1]] + width * _unit(_mix(dart + U64(2)))))
                n += 1
        if found:
            dart = np.concatenate([f[0] for f in found])
            at = np.concatenate([f[1] for f in found])
            order = np.argsort(at, kind="stable")
            coordinate, first = np.unique(dart[order] % U64(k), return_index=True)
            coordinate, first = coordinate.astype(np.int64), order[first]
            better = at[first] < rank[coordinate]
            rank[coordinate[better]], won[coordinate[better]] = at[first][better], dart[first][better]
        if np.isfinite(rank).all():
            return won
        start, depth = slabs[-1][0] + 1, 2 * depth


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature[: bands * rows].reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=U64)
    for r in range(rows):
        out = _mix(out * STEP + parts[:, r])
    return out.view(np.int64)


def _element_set(text: str | None, known: dict, weighting: str) -> tuple[np.ndarray, np.ndarray | None]:
    elements, counts = np.unique(shingles(text, known), return_counts=True)
    return elements, counts.astype(np.float64) if weighting == "count" else None


def _node(elements: np.ndarray, weights: np.ndarray | None) -> bytes:
    content = elements.tobytes() + (b"" if weights is None else weights.tobytes())
    return xxhash.xxh3_128_digest(content)


def signatures(df: DataFrame, text: str, bands: int, rows: int, weighting: str) -> DataFrame:
    """key, row, and the node, size and band keys of each row's set (node null without words)."""

    @F.pandas_udf("node binary, n long, bands array<long>")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for texts in batches:
            out = []
            for value in texts:
                elements, weights = _element_set(value, known, weighting)
                if len(elements):
                    keys = band_keys(darts(elements, weights, bands * rows), bands, rows)
                    out.append((_node(elements, weights), len(elements), keys))
                else:
                    out.append((None, 0, None))
            yield pd.DataFrame(out, columns=["node", "n", "bands"])

    return df.withColumn("_s", signed(F.col(text))).select("key", "row", "_s.node", "_s.n", "_s.bands")


def element_sets(df: DataFrame, text: str, weighting: str) -> DataFrame:
    """node, elements and (for counts) weights of each row's set."""

    @F.pandas_udf("node binary, elements array<long>, weights array<double>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for texts in batches:
            out = []
            for value in texts:
                elements, weights = _element_set(value, known, weighting)
                out.append((_node(elements, weights), elements.view(np.int64), weights))
            yield pd.DataFrame(out, columns=["node", "elements", "weights"])

    return df.select(sets(F.col(text)).alias("_s")).select("_s.node", "_s.elements", "_s.weights")


def _similarity(weighting: str):
    if weighting == "set":
        both = F.size(F.array_intersect("e1", "e2"))
        return both / (F.size("e1") + F.size("e2") - both)

    @F.pandas_udf("double")
    def weighted(e1: pd.Series, w1: pd.Series, e2: pd.Series, w2: pd.Series) -> pd.Series:
        out = []
        for a, x, b, y in zip(e1, w1, e2, w2):
            _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            both = np.minimum(x[i], y[j]).sum()
            out.append(both / (x.sum() + y.sum() - both))
        return pd.Series(out, dtype="float64")

    return weighted("e1", "w1", "e2", "w2")


def _compared(pairs: DataFrame, sets: DataFrame, weighting: str) -> DataFrame:
    """(a, b) with their exact similarity."""
    side = lambda n: sets.select(F.col("node").alias("ab"[n - 1]), F.col("elements").alias(f"e{n}"), F.col("weights").alias(f"w{n}"))
    joined = pairs.join(side(1), "a").join(side(2), "b")
    return joined.select("a", "b", _similarity(weighting).alias("similarity"))


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, weighting: str) -> DataFrame:
    """The element sets of the ``wanted`` nodes, each from one of its texts."""
    rows = nodes.join(wanted, "node", "left_semi").select(F.col("row").alias("_row"), F.col("key").alias("_key"))
    rows = broadcast_if_small(materialise(rows, "near-wanted"))
    texts = docs.join(rows, (F.col("row") == F.col("_row")) & F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    sets = element_sets(texts, "text", weighting).groupBy("node")
    sets = sets.agg(F.first("elements").alias("elements"), F.first("weights").alias("weights"))
    with arrow_rows(docs.sparkSession, TEXTS):
        return materialise(sets, "near-sets")


def near_groups(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    weighting: str = "set",
) -> DataFrame:
    """One row per row of ``df``: key, row (hash of the text), class_id, class_size and kept.

    The row with the smallest key stays (of equal rows all are marked). Runs jobs at call time.
    """
    docs = df.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text"))
    with arrow_rows(df.sparkSession, TEXTS):
        signed = materialise(signatures(docs, "text", bands, rows, weighting), "near-signed")
    one = F.min(F.struct("key", "row"))
    nodes = signed.where("node is not null").groupBy("node").agg(one.alias("one"), F.first("bands").alias("bands"))
    nodes = materialise(nodes.select("node", "one.key", "one.row", "bands"), "near-nodes")

    met = nodes.select("node", F.explode("bands").alias("band"))
    buckets = met.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = materialise(met.join(buckets, "band"), "near-met")  # sets in buckets with several
    degree = met.groupBy("node").agg(F.sum("size").alias("degree"))
    leaders = met.join(degree, "node").groupBy("band").agg(F.max(F.struct("degree", "node")).alias("leader"))
    met = materialise(met.select("band", "node").join(leaders, "band"), "near-led")
    wanted = met.select(F.explode(F.array("node", "leader.node")).alias("node")).distinct()
    sets = _sets_of(docs, nodes, wanted, weighting)
    labels = met.select("node", F.col("node").alias("component")).distinct()
    led = met.where("node <> leader.node").select("node", "leader").distinct()
    for _ in range(1 + ROUNDS):
        at = labels.select(F.col("node").alias("of"), F.col("component").alias("other"))
        apart = led.join(labels, "node").join(at, F.col("leader.node") == F.col("of")).where("component <> other")
        # The greatest leader in another group, of every set that has one.
        best = materialise(apart.groupBy("node").agg(F.max("leader").alias("tried")), "near-best")
        if best.isEmpty():
            break
        ends = F.col("node"), F.col("tried.node")
        pairs = best.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
        links = _compared(pairs, sets, weighting).where(F.col("similarity") >= similarity).select("a", "b")
        labels = _merged(labels, materialise(links, "near-links"))
        led = led.join(best, "node").where("leader < tried").drop("tried")
    labels = _merged(labels, materialise(_open_links(met, labels, sets, similarity, weighting), "near-more"))

    placed = signed.select("key", "row", "node").join(labels, "node", "left")
    placed = placed.withColumn("group", F.coalesce("component", "node"))
    placed = materialise(placed.select("key", "row", "group"), "near-placed")
    stays = F.min(F.struct(F.isnull("key").alias("last"), "key", "row")).alias("stays")
    groups = placed.where("group is not null").groupBy("group").agg(stays, F.count(F.lit(1)).alias("class_size"))
    found = placed.join(groups, "group", "left")
    return found.select(
        F.col("key").alias(key),
        "row",
        F.when(F.col("group").isNull(), F.col("key")).otherwise(F.col("stays.key")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("group").isNull() | (F.col("key").eqNullSafe(F.col("stays.key")) & (F.col("row") == F.col("stays.row")))).alias("kept"),
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) in which ``links`` (a, b) between nodes have joined components."""
    end = lambda name: labels.select(F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    joined = links.join(end("a"), "a").join(end("b"), "b").where("ca <> cb")
    joined = connected(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    new = broadcast_if_small(joined.select(F.col("node").alias("component"), F.col("component").alias("new")))
    merged = labels.join(new, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return materialise(merged, "near-labels")


def _shared_weight(sets: DataFrame, weighting: str) -> DataFrame:
    """(node, total, shared): the weight of a set, and of its elements that another of ``sets`` has too."""
    weight = F.lit(1.0) if weighting == "set" else F.col("w")
    weights = F.transform("elements", lambda e: F.lit(1.0)) if weighting == "set" else F.col("weights")
    each = sets.select("node", F.explode(F.arrays_zip(F.col("elements").alias("e"), weights.alias("w"))).alias("x"))
    each = each.select("node", "x.e", "x.w")
    alone = each.groupBy("e").agg(F.count(F.lit(1)).alias("sets"), F.first("node").alias("node"), F.first("w").alias("w")).where("sets = 1")
    total = each.groupBy("node").agg(F.sum(weight).alias("total"))
    lost = alone.groupBy("node").agg(F.sum(weight).alias("lost"))
    return total.join(lost, "node", "left").select("node", "total", (F.col("total") - F.coalesce("lost", F.lit(0.0))).alias("shared"))


def _open_links(met: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float, weighting: str) -> DataFrame:
    """Links (a, b) that join the groups of similar sets which met, directly or through others.

    Groups that met are a cluster. Its sets are compared in blocks of about ``BLOCK``,
    every block with every other, inside tasks that give out links of a spanning forest only.
    """
    at = labels.select(F.col("node").alias("of"), F.col("component").alias("b"))
    open_ = met.join(labels, "node").join(at, F.col("leader.node") == F.col("of")).where("component <> b")
    clusters = connected(open_.select(F.col("component").alias("a"), "b").distinct())
    clusters = broadcast_if_small(clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster")))
    members = materialise(labels.join(clusters, "component").select("cluster", "node", "component"), "near-open")
    ends = lambda rows: rows.groupBy("cluster").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    left = sets.join(members.select("node"), "node", "left_semi")
    members = members.join(_shared_weight(left, weighting), "node")
    # What two sets share is at most what either shares with any: a bound on a partner's weight.
    most = F.col("shared") * (1 + 1 / similarity) - F.col("total") + 1e-6
    least = members.groupBy("cluster").agg(F.min("total").alias("least"))
    members = materialise(members.join(least, "cluster").where(most >= F.col("least")).select("cluster", "node", "component"), "near-open")
    size = ends(members).select("cluster").join(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "cluster")
    parts = max(1, members.count() // BLOCK)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.join(size, "cluster").withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    # A large cluster's set goes to the pairs of blocks its own is in; small clusters share a task.
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    place = F.when(alone, F.pmod(F.xxhash64("cluster"), F.lit(parts)).cast("string")).otherwise(F.hex("cluster"))
    members = members.select(
        "node", "cluster", "component", place.alias("place"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    rows = members.join(sets, "node")

    def similar(group: pd.DataFrame) -> pd.DataFrame:
        found = [link for _, part in group.groupby("cluster", sort=False) for link in _links(part, similarity)]
        return pd.DataFrame(found, columns=["a", "b"])

    return rows.groupBy("place", "low", "high").applyInPandas(similar, "a binary, b binary").distinct()


def _links(part: pd.DataFrame, similarity: float) -> list[tuple[bytes, bytes]]:
    """As many pairs of similar sets as join the groups of ``part`` that have any: fewer than groups."""
    node, above, out = part["node"].tolist(), {}, []

    def top(group: bytes) -> bytes:
        while (up := above.get(group, group)) != group:
            above[group] = above.get(up, up)
            group = up
        return group

    group = part["component"].tolist()
    for i, j in zip(*_similar_pairs(part, similarity)):
        if (a := top(group[i])) != (b := top(group[j])):
            above[a] = b
            out.append((node[i], node[j]))
    return out


def _similar_pairs(part: pd.DataFrame, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact similarities of all sets of ``part`` at once, by the elements that two of them share."""
    elements, owners = [], []
    for n, (found, weights) in enumerate(zip(part["elements"], part["weights"])):
        found = np.asarray(found, np.int64).view(U64)
        if weights is not None:  # whole counts: each copy of an element is an element
            times = np.asarray(weights).astype(np.int64)
            copy = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found = _mix(np.repeat(found, times) + STEP * copy.astype(U64))
        elements.append(found)
        owners.append(np.full(len(found), n))
    total = np.array([len(e) for e in elements], np.float64)
    _, which, times = np.unique(np.concatenate(elements), return_inverse=True, return_counts=True)
    owner, shared = np.concatenate(owners), times[which] > 1
    column = np.cumsum(times > 1)[which[shared]] - 1
    owner = owner[shared]
    both = np.zeros((len(part), len(part)), np.float32)
    for at in range(0, int(column.max(initial=-1)) + 1, 4096):
        some = (column >= at) & (column < at + 4096)
        held = np.zeros((len(part), 4096), np.float32)
        held[owner[some], column[some] - at] = 1
        both += held @ held.T
    both = both.astype(np.float64)
    near = np.triu(both / (total[:, None] + total[None, :] - both) >= similarity, 1)
    return np.nonzero(near)


def drop_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``df`` of each group, with all its columns. Runs jobs at call time."""
    found = materialise(near_groups(df, key, text, **options), "near-groups")
    row, gone_key, gone_row = free_names(df, "row", "key", "gone")
    rows = df.withColumn(row, F.xxhash64(F.col(f"`{text}`")))
    gone = broadcast_if_small(found.where("not kept").select(F.col(f"`{key}`").alias(gone_key), F.col("row").alias(gone_row)).distinct())
    kept = rows.join(gone, (F.col(row) == F.col(gone_row)) & F.col(f"`{key}`").eqNullSafe(F.col(gone_key)), "left_anti")
    stay = found.where("kept and class_size > 1").groupBy(f"`{key}`", "row").count()
    if not stay.where("count > 1").isEmpty():  # equal rows
        kept = kept.dropDuplicates([key, row])
    return without(kept, row)
