import hashlib
import math

import numpy as np
import pytest

from paperlake.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, positions=8, entries=16, rounds=6):
    """The contract in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // positions)) * positions
    whole = [[math.floor(4096 * x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))
    step = width // positions
    cut = lambda v, p: v[p * step : (p + 1) * step]
    book = [[cut(whole[i], p) for i in order[:entries]] for p in range(positions)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), entry)), e) for e, entry in enumerate(book[p]))

    for _ in range(rounds):
        at = [[assign(v, p)[1] for v in whole] for p in range(positions)]
        for p in range(positions):
            for e in range(len(book[p])):
                if members := [cut(v, p) for v, a in zip(whole, at[p]) if a == e]:
                    book[p][e] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()
    out = []
    for row, v in zip(kept, whole):
        found = [assign(v, p) for p in range(positions)]
        out.append((row[0], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), row[2], digest))
    totals = {}
    for row in out:
        totals[row[3]] = totals.get(row[3], 0) + row[2]
    return sorted(((r[0], r[1], r[2], totals[r[3]], r[4]) for r in out), key=str)


def ours(spark, rows, **settings):
    done = codes.compress(spark.createDataFrame(rows, SCHEMA), **settings)
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r[c] for c in columns) for r in done.collect()), key=str)


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(24) * 0.2).tolist(), None if i % 7 == 0 else i % 3) for i in range(400)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(200)]  # one hot entry
    assert ours(spark, rows) == plain(rows)


def test_left_out_short_repeated_and_null(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(10).tolist(), 1) for i in range(30)]
    rows += [(3, rows[3][1], 2), (3, rows[4][1], 2), (None, rows[5][1], None), (40, [0.5], None), (41, [], 1)]
    assert ours(spark, rows) == plain(rows)
    bad = [(50, None, 1), (51, [1.0, None], 1), (52, [math.nan] * 10, 1), (53, [math.inf] + [0.0] * 9, 1), (54, [-math.inf] * 10, 1)]
    assert ours(spark, rows + bad) == plain(rows)
    assert ours(spark, bad) == [] and ours(spark, []) == []


def test_fewer_rows_than_entries_and_large_components(spark):
    rows = [(i, [i * 1000.25] * 8, 1) for i in range(4)]
    assert ours(spark, rows) == plain(rows)
    assert len(ours(spark, rows + [(9, [1e30] * 8, 2)])) == 5


def test_exact_distances_of_large_integers():
    rng = np.random.default_rng(3)
    parts, book = rng.integers(-(1 << 24), 1 << 24, (200, 8)), rng.integers(-(1 << 24), 1 << 24, (16, 8))
    far = ((parts[:, None, :].astype(object) - book[None].astype(object)) ** 2).sum(2)
    entry, least = codes.nearest(parts, book)
    assert least.tolist() == far.min(1).tolist() and entry.tolist() == [row.tolist().index(row.min()) for row in far]


def test_only_parts_that_change_move(spark, monkeypatch):
    moved, measured = [], codes._measured

    def watch(members, books):
        out = measured(members, books)
        moved.append((members.count(), out.where("kind = 1").count(), out.where("kind = 0").count()))
        return out

    monkeypatch.setattr(codes, "_measured", watch)
    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(16)[i % 16] + 0.01 * rng.standard_normal(16)).tolist(), 1) for i in range(320)]
    ours(spark, rows)
    assert len(moved) == 5 and all(leave + stay == whole == 320 * 8 for whole, leave, stay in moved)
    assert moved[-1][1] < 320


def test_clashing_columns(spark):
    rows = [(i, [float(i)] * 8, 1, "a", 2, "row") for i in range(5)]
    table = spark.createDataFrame(rows, SCHEMA + ", code string, ints int, row string")
    done = codes.compress(table)
    assert done.columns == ["vec_id", "embedding", "label", "ints", "row", "code", "error", "label_error", "codebooks_sha256"]
    assert {(r["ints"], r["row"]) for r in done.collect()} == {(2, "row")}


@pytest.mark.parametrize("setting", [{"positions": 4, "entries": 3, "rounds": 2}, {"rounds": 0}])
def test_other_settings(spark, setting):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist(), i % 2) for i in range(60)]
    assert ours(spark, rows, **setting) == plain(rows, **setting)
