import math

import pytest
from pyspark.sql import functions as F

from paperlake.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, place string, size string, target int")


def docs(sizes):
    """(doc_id, source, n words) with clashing extra columns."""
    return [(i, s, None if n is None else "w " * n, "p", "z", 7) for i, s, n in sizes]


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """The rule of the contract, literally: share out, stop at the limit, share out the rest."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    left, open_ = share * sum(sizes.values()), list(order)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    while open_ and left > 1e-9:
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += unit * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.remove(s)
    return target


CASES = [
    [(i, "abcd"[i % 4], 3 + i % 7) for i in range(60)],
    [(i, "a" if i < 50 else "b", 10) for i in range(53)],
    [(1, None, 4), (2, "a", 100), (3, "", 9), (4, "é", 0), (5, "b", None)],
    [(1, "a", 1000), (None, "a", 1), (None, "a", 1), (2, "z", 1)],
    [(1, "a", None), (2, "b", 0)],
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_and_taken_words(spark, sizes):
    out = mixing.mix(frame(spark, docs(sizes))).where("copy IS NULL OR copy = 0").collect()
    assert len(out) == len(sizes)
    per_source = {}
    for _, s, n in sizes:
        per_source[s] = per_source.get(s, 0) + (n or 0)
    goal = fill(per_source)
    for s, total in per_source.items():
        rows = [r for r in out if r.source == s]
        assert all(r.source_size == total and math.isclose(r.target, goal[s], abs_tol=1e-6) for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.5
        assert all(0 <= r.taken <= 2 * r.size for r in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    data = frame(spark, docs(CASES[0]))
    columns = ["doc_id", "taken", "copy", "words", "position"]
    first = mixing.mix(data.repartition(7)).select(columns).collect()
    assert first == mixing.mix(data.coalesce(1)).select(columns).collect()
    assert [r.position for r in first if r.copy is not None] == sorted(r.position for r in first if r.copy is not None)


def test_positions_follow_the_schedule(spark):
    sizes = [(i, s, 10) for i, s in enumerate("abc" * 200)]
    out = mixing.mix(frame(spark, docs(sizes))).where("copy IS NOT NULL")
    early = out.withColumn("early", F.col("position") < 0.5).groupBy("source").agg(
        (F.sum(F.when(F.col("early"), F.col("words"))) / F.sum("words")).alias("share")
    )
    share = {r.source: r.share for r in early.collect()}
    # integrals of 1.5 - t, 1 and 0.5 + t over the first half
    assert share["a"] == pytest.approx(0.625, abs=0.01) and share["b"] == pytest.approx(0.5, abs=0.01)
    assert share["c"] == pytest.approx(0.375, abs=0.01)


@pytest.mark.parametrize("knots", [((0, 1.0), (1, 1.0)), ((0, 0.0), (1, 2.0)), ((0, 2.0), (0.5, 0.0), (1, 1.0)), ((0, 1.5), (1, 0.5))])
def test_inverse_of_the_integral(spark, knots):
    steps = 2000
    grid = [i / steps for i in range(steps + 1)]

    def height(t):
        for (a, low), (b, high) in zip(knots, knots[1:], strict=False):
            if t <= b:
                return low + (high - low) * (t - a) / (b - a)

    area = [0.0]
    for a, b in zip(grid, grid[1:], strict=False):
        area.append(area[-1] + (height(a) + height(b)) / 2 / steps)
    frame_ = spark.createDataFrame([(t, s / area[-1]) for t, s in list(zip(grid, area, strict=True))[::100]], "t double, s double")
    for row in frame_.select("t", mixing.invert_schedule(F.col("s"), knots).alias("got")).collect():
        assert row.got == pytest.approx(row.t, abs=2e-3)


def test_empty_table(spark):
    assert mixing.mix(frame(spark, docs(CASES[0])).limit(0)).count() == 0
