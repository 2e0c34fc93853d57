"""Mixing sources to target weights as a curriculum whose weights change over the training run.

Targets: source i by code point order (null last) weighs `weights[i % len]`; the sources share
`share` times all words, no source gets more than `most` times its size, and what one cannot take is
shared out again by weight. Documents of a source follow each other in a fixed pseudo-random order, again
and again, until the target is reached; the last one is cut where the target ends.

Schedule: each weight comes with a piecewise linear schedule over the run (time 0 to 1). Its integral, scaled to
the target, is the demand for words of the source up to a time. Inverting it at the words already taken gives the
position of a copy, and copies are range-sorted by position.

Scale: running totals are taken within (source, slice of the order), the slices' own totals within a source;
with sqrt(n) slices both windows hold about sqrt(n) rows, also for a source with a third of all rows.
Only the table of sources (one row each) is ever put in one order.

Null and empty texts have size 0 and are never taken (copy null); null sources are one source; rows with
equal or null ids are separate documents. An empty table gives an empty result. All columns are kept,
columns that are named like the added ones are replaced.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.llm.words import WORD_SQL
from paperlake.session import broadcast_if_small, materialize

Knots = Sequence[tuple[float, float]]
WEIGHTS = (5, 2, 1)
#: Heavy sources lead the run, light ones end it.
SCHEDULES: tuple[Knots, ...] = (((0, 1.5), (1, 0.5)), ((0, 1.0), (1, 1.0)), ((0, 0.5), (1, 1.5)))


def order_key(doc_id: Column, seed: str = "mix") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SQL)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """From (source, size) rows: source, place (0-based order), source_size, target."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("place", (F.row_number().over(in_order) - 1).cast("long")).withColumn("weight", weight.cast("long"))
    # Sources are full in order of room per weight. The level is the one at the first that isn't full.
    sources = sources.withColumn("room", F.col("source_size") * most)
    fullest = Window.orderBy(F.col("room") / F.col("weight"), "place")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    after = fullest.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total * F.lit(share) - F.coalesce(F.sum("room").over(before), F.lit(0))) / F.sum("weight").over(after)
    sources = sources.withColumn("level", level)
    reached = F.min(F.when(F.col("room") >= F.col("level") * F.col("weight"), F.struct(F.col("room") / F.col("weight"), "place", "level")))
    sources = sources.withColumn("level", reached.over(everything)["level"])
    target = F.least(F.col("room").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("room").cast("double")))
    return sources.select("source", "place", "source_size", target.alias("target"))


def invert_schedule(share: Column, knots: Knots) -> Column:
    """The time at which the integral of a piecewise linear schedule reaches a share of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    whole, done, time = sum(areas), 0.0, F.lit(float(knots[-1][0]))
    pieces = []
    for (start, low), (end, high), area in zip(knots, knots[1:], areas, strict=False):
        rest = F.greatest(share * F.lit(float(whole)) - F.lit(float(done)), F.lit(0.0))
        slope = (high - low) / (end - start)
        root = F.lit(float(low)) + F.sqrt(F.greatest(F.lit(float(low * low)) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        pieces.append((done + area, F.lit(float(start)) + F.when(root > 0, 2.0 * rest / root).otherwise(0.0)))
        done += area
    for until, at in reversed(pieces):
        time = F.when(share * F.lit(float(whole)) <= F.lit(float(until)), at).otherwise(time)
    return time


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Knots] = SCHEDULES,
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per copy in order of position; a document that isn't taken keeps one row with copy null.

    Adds size, source_size, target, taken (words of the document over all copies), copy (0-based),
    words (of this copy) and position (0 to 1).
    """
    added = ("size", "source_size", "target", "taken", "copy", "words", "position")
    key = order_key(F.col("doc_id"), seed)
    docs = docs.drop(*added)
    small = materialize(docs.select("source", key.alias("key"), size_of(F.col("text")).alias("size")), "mix-sizes")
    n_slices = max(1, int(small.count() ** 0.5))
    slice_of = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("double") * n_slices / 2.0**32).cast("long")

    table = materialize(targets(small, weights, share, most), "mix-targets")
    table = broadcast_if_small(table.withColumnsRenamed({"source": "__source", "place": "__place"}))
    placed = F.col("source").eqNullSafe(F.col("__source"))
    slices = small.withColumnRenamed("key", "__key").withColumn("__slice", slice_of).join(table, placed)
    slices = slices.groupBy("__place", "__slice").agg(F.sum("size").alias("__words"))
    earlier = Window.partitionBy("__place").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("__place", "__slice", F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__before"))

    sized = docs.withColumns({"__key": key, "size": size_of(F.col("text"))}).withColumn("__slice", slice_of)
    sized = sized.join(table, placed).drop("__source")
    sized = sized.join(slices.hint("shuffle_merge"), ["__place", "__slice"])
    running = Window.partitionBy("__place", "__slice").orderBy("__key", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    sized = sized.withColumn("__start", start)

    goal = F.round("target").cast("long")
    passes = F.sequence(F.lit(0), F.lit(most - 1))
    wanted = lambda i: F.least(F.col("size"), goal - F.col("__start") - i * F.col("source_size"))
    copies = F.filter(F.transform(passes, lambda i: F.struct(i.alias("copy"), wanted(i).alias("words"))), lambda c: c["words"] > 0)
    sized = sized.withColumn("__copies", copies)
    taken = F.aggregate("__copies", F.lit(0).cast("long"), lambda n, c: n + c["words"])
    rows = sized.withColumn("taken", taken).withColumn("__copy", F.explode_outer("__copies"))
    asked = (F.col("__start") + F.col("__copy.copy") * F.col("source_size")) / F.col("target")
    position = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        position = F.when(F.col("__place") % len(schedules) == i, invert_schedule(asked, knots)).otherwise(position)
    rows = rows.withColumns({"copy": F.col("__copy.copy"), "words": F.col("__copy.words"), "position": position})
    return rows.orderBy(F.col("position").asc_nulls_last(), "__key", "copy").select(*docs.columns, *added)
