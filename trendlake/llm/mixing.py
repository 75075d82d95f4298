"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words. Among all document rates w between 0 and ``MAX_RATE``
that meet the targets, entropy balancing takes those with the least relative entropy to 1. They are
exponential tilts, w = min(MAX_RATE, exp(lambda * size / mean size)), one lambda per source, and
lambda solves a convex dual: its slope, the words taken less the target, must be 0. Newton
iterations, each one distributed pass over (source, size) classes, find every lambda at once inside
a shrinking bracket. Rates are then rounded to copies: 0, 1 or 2 of each document.

Documents of one source and size are alike, so the passes read one row per (source, size), combined
before the shuffle; a source with a third of the rows adds no more classes than it has sizes. All
sums are exact decimals, so neither task order nor retries change a copy. A class's copies go to its
documents by the hash of their key, in groups of about ``GROUP`` documents, so that no task holds a
large class.

Sizes are words of the whole text; null and empty texts have size 0 and are never copied. Rows are
told apart by key and text hash; equal rows may share a hash order, any of them is as good. Sources
are weighed by code point order, null last. Only DataFrame functions run on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import free_names, without, words
from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import materialise

WEIGHTS = (5, 2, 1)
TOTAL = 1.5  # of the words of all sources
MAX_RATE = 2
TOLERANCE = 1e-7
MAX_STEPS = 60
GROUP = 128
EXACT = "decimal(38,9)"


def sizes(df: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    return without(df, out).withColumn(out, F.size(words(F.col(f"`{text}`"))).cast("long"))


def source_targets(
    classes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, max_rate: float = MAX_RATE
) -> DataFrame:
    """(source, source_size, target): ``total`` times all words shared by weight; what exceeds ``max_rate``
    times a source's words is shared again among the rest until no source is above.

    Sharing again until nothing is above means one level: target = min(cap, weight * level) with the
    targets adding up to the total. Sorted by cap / weight the capped sources come first, so the level
    follows from running sums: one row per source, in range order.
    """
    per_source = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # One row per source; the windows below order sources, never documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int"))
    rows = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_rate))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = rows.withColumns(
        {
            "before": F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "rest": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
            "all": F.sum("source_size").over(everything) * float(total),
        }
    )
    rows = rows.withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))
    # The first source that its level does not fill sets the level of all that follow.
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    rows = rows.withColumn("shared", F.first(open_level, ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.least(F.col("cap"), F.col("shared") * F.col("weight")), F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def _rate(lam: Column, scaled: Column, max_rate: float) -> Column:
    return F.least(F.lit(float(max_rate)), F.exp(F.least(lam * scaled, F.lit(700.0))))


def _exact_sum(value: Column) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(value.cast(EXACT)).cast("double")


def balance(classes: DataFrame, targets: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``targets`` with each source's lambda. Every step is one pass over the classes."""
    spread = classes.where("size > 0").groupBy("source").agg(
        F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    state = _on_source(targets, spread, "left").withColumns(
        {"least": F.coalesce("least", F.lit(1)), "mean": F.coalesce("mean", F.lit(1.0))}
    )
    # At the upper end every rate is max_rate; at the lower end even the smallest is next to nothing.
    top = F.log(F.lit(float(max_rate))) * F.col("mean") / F.col("least")
    state = state.withColumns({"low": -745.0 * F.col("mean") / F.col("least"), "high": top, "lam": F.lit(0.0)})
    state = state.withColumn("open", (F.col("target") > 0) & (F.col("target") < max_rate * F.col("source_size")))
    state = state.withColumn("lam", F.when(F.col("open"), F.lit(0.0)).when(F.col("target") > 0, F.col("high")).otherwise(F.col("low")))
    state = materialise(state, "mix-state")
    for _ in range(MAX_STEPS):
        scaled = F.col("size") / F.col("mean")
        rows = _on_source(classes.where("size > 0"), state.where("open"), "inner")
        rate = _rate(F.col("lam"), scaled, max_rate)
        taken = F.col("n") * F.col("size") * rate
        slope = F.when(rate < float(max_rate), taken * scaled).otherwise(F.lit(0.0))
        sums = rows.groupBy("source").agg(_exact_sum(taken).alias("taken"), _exact_sum(slope).alias("slope"))
        step = _on_source(state, sums, "left")
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        inside = (newton > low) & (newton < high)
        done = F.abs(gap) <= TOLERANCE * F.col("target")
        moved = F.when(done, F.col("lam")).otherwise(F.when(inside, newton).otherwise((low + high) / 2))
        step = step.select(
            "source", "source_size", "target", "least", "mean",
            *[F.when(F.col("open"), c).otherwise(F.col(n)).alias(n) for n, c in (("low", low), ("high", high), ("lam", moved))],
            (F.col("open") & ~F.coalesce(done, F.lit(True))).alias("open"),
        )
        state = materialise(step, "mix-state")
        if state.where("open").isEmpty():
            break
    return state


def _on_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def class_copies(classes: DataFrame, solved: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, size, n, copies): whole copies for each class.

    Rates are added up along a source's sizes, largest first, and every class gets the whole numbers
    that its stretch of the sum passes. What words are then missing or too many are settled by a few
    copies, largest sizes first. Both walk the sizes of a source, of which there are no more than its
    longest text has words, however many documents it has.
    """
    rows = _on_source(classes.where("size > 0"), solved, "inner")
    rows = rows.withColumn("rate", _rate(F.col("lam"), F.col("size") / F.col("mean"), max_rate))
    down = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    passed = F.sum((F.col("rate") * F.col("n")).cast(EXACT)).over(down)
    so_far = F.floor(passed + F.lit("0.5").cast("decimal(2,1)")).cast("long")
    rows = rows.withColumn("so_far", so_far)
    earlier = F.coalesce(F.lag("so_far").over(Window.partitionBy("source").orderBy(F.col("size").desc())), F.lit(0))
    most = F.col("n") * max_rate
    rows = rows.withColumn("copies", F.least(most, F.greatest(F.lit(0), F.col("so_far") - earlier)).cast("long"))
    rows = materialise(rows.select("source", "size", "n", "copies", "target"), "mix-classes")

    step = F.struct(F.col("size").alias("size"), F.col("n").alias("n"), F.col("copies").alias("copies"))
    lists = rows.groupBy("source").agg(
        F.reverse(F.array_sort(F.collect_list(step))).alias("steps"),
        (F.round(F.first("target")).cast("long") - F.sum(F.col("size") * F.col("copies"))).alias("missing"),
    )
    empty = F.array().cast("array<struct<size: bigint, more: bigint>>")

    def settle(state, x):
        add = F.least(F.floor(state["missing"] / x["size"]).cast("long"), x["n"] * max_rate - x["copies"])
        drop = -F.least(F.floor(-state["missing"] / x["size"]).cast("long"), x["copies"])
        more = F.when(state["missing"] >= 0, add).otherwise(drop)
        change = F.array(F.struct(x["size"].alias("size"), more.alias("more")))
        return F.struct(
            (state["missing"] - more * x["size"]).alias("missing"),
            F.when(more != 0, F.concat(state["changes"], change)).otherwise(state["changes"]).alias("changes"),
        )

    start = F.struct(F.col("missing").alias("missing"), empty.alias("changes"))
    changes = lists.select("source", F.explode(F.aggregate("steps", start, settle)["changes"]).alias("c"))
    changes = changes.select(F.col("source").alias("_source"), F.col("c.size").alias("_size"), F.col("c.more").alias("more"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    copies = (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies")
    return rows.join(changes, same, "left").select("source", "size", "n", copies)


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total: float = TOTAL,
    max_rate: int = MAX_RATE,
) -> DataFrame:
    """key, row (hash of the text), source, size, source_size, target and copies of every row of ``df``."""
    value = F.col(f"`{text}`")
    docs = df.select(
        F.col(f"`{key}`").alias("key"),
        F.xxhash64(value).alias("row"),
        F.col(f"`{source}`").alias("source"),
        F.size(words(value)).cast("long").alias("size"),
    )
    docs = materialise(docs, "mix-sizes")
    classes = materialise(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    solved = balance(classes, source_targets(classes, weights, total, max_rate), max_rate)
    copies = class_copies(classes, solved, max_rate)

    by_class = copies.withColumnsRenamed({"source": "_source", "size": "_size"})
    by_class = by_class.withColumn("groups", F.ceil(F.col("n") / GROUP))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    order = F.xxhash64("key", "row")
    placed = docs.join(by_class, same, "left").drop("_source", "_size")
    placed = placed.withColumns({"order": order, "group": F.coalesce(F.pmod(order, F.col("groups")), F.lit(0))})
    placed = materialise(placed, "mix-placed")

    groups = placed.groupBy("source", "size", "group").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    along = Window.partitionBy("source", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    rows_so_far = F.sum("m").over(along)
    exact = lambda c: c.cast("decimal(38,0)")
    done = F.floor(exact(F.col("copies")) * exact(rows_so_far) / exact(F.col("n")))
    before = F.floor(exact(F.col("copies")) * exact(rows_so_far - F.col("m")) / exact(F.col("n")))
    groups = groups.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("group").alias("_group"), "m",
        F.coalesce((done - before).cast("long"), F.lit(0)).alias("group_copies"),
    )
    same = same & (F.col("group") == F.col("_group"))
    placed = placed.drop("n", "copies", "groups").join(groups, same, "left").drop("_source", "_size", "_group")
    first = F.row_number().over(Window.partitionBy("source", "size", "group").orderBy("order", "key", "row"))
    base = F.floor(F.col("group_copies") / F.col("m")).cast("long")
    extra = F.when(first <= F.col("group_copies") - base * F.col("m"), 1).otherwise(0)
    placed = placed.withColumn("copies", (base + extra).cast("long"))
    ends = solved.select("source", "source_size", "target")
    return _on_source(placed.select("key", "row", "source", "size", "copies"), ends, "left")


def apply_mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df``, with all their columns, as often as the mix takes them. Runs jobs at call time.

    Equal rows (key and text) stand for each other: their copies are added up.
    """
    found = mix(df, key, text, source, **options).groupBy("key", "row")
    found = found.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    found = materialise(found, "mix-copies")
    repeated = not found.where("rows > 1").isEmpty()
    names = free_names(df, "hash", "key", "row", "copies", "copy")
    own_hash, taken_key, taken_row, copies, copy = names
    taken = found.where("copies > 0").select(F.col("key").alias(taken_key), F.col("row").alias(taken_row), F.col("copies").alias(copies))
    rows = df.withColumn(own_hash, F.xxhash64(F.col(f"`{text}`")))
    if repeated:
        rows = rows.dropDuplicates([key, own_hash])
    same = (F.col(own_hash) == F.col(taken_row)) & F.col(f"`{key}`").eqNullSafe(F.col(taken_key))
    joined = rows.join(broadcast_if_small(taken), same, "inner")
    joined = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return without(joined, *names)
