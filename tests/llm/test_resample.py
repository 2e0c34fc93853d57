import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, most=1):
    words = WORD.findall((text or "").translate(FOLD))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=10, min_words=20, buckets=10_000, most=1, seed=2024):
    number = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for x in features(text, most)[1]:
                counts[number(x)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text, most)
        weight = sum(gain[number(x)] for x in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r in rows if r[1] >= min_words]
    for rank, row in enumerate(sorted(able, key=lambda r: (-r[4], r[0] is None, r[0] or 0))[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=str)


def ours(spark, docs, target, **settings):
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    right = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted(map(tuple, resample.resample(left, right, **settings).collect()), key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["Straße", "É", "x1y", "日本"]
    return [(i, rng.choice([" ", "\n", "_", ", "]).join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]


def test_against_plain_python(spark):
    docs = corpus(400)
    target = ["w1 w2 w3 Straße", "w1 W2"]
    assert ours(spark, docs, target) == plain(docs, target)
    assert ours(spark, docs, target, most=3, buckets=97, percent=37, seed=5) == plain(docs, target, most=3, buckets=97, percent=37, seed=5)


def test_nulls_empty_long_and_ties(spark):
    docs = [*corpus(60), (None, "a " * 30), (70, None), (71, ""), (72, "\x00 \x7f"), (73, "y" * 200_000), (74, "w1 " * 50_000)]
    for target in ([], [None, ""], ["w1"]):
        assert ours(spark, docs, target, percent=50) == plain(docs, target, percent=50)
    assert ours(spark, [], ["a"]) == []


def test_repeated_ids_are_cut_exactly(spark):
    docs = [(5, "w1 " * 25)] * 300 + [(i, "w1 " * 25) for i in range(100)]
    rows = ours(spark, docs, ["w1"], percent=43)
    assert sorted(r[5] for r in rows if r[5]) == list(range(1, 173))
    by_rank = sorted((r for r in rows if r[5]), key=lambda r: r[5])
    assert [r[4] for r in by_rank] == sorted((r[4] for r in rows), reverse=True)[:172]


@pytest.mark.parametrize("wanted", [1, 2, 50, 99, 100])
def test_cutoff(spark, wanted):
    values = [-(1 << 40)] * 2 + [7] * 50 + list(range(100, 148))
    rows = spark.createDataFrame([(v,) for v in values], "falls long")
    at, below = resample.cutoff(rows, "falls", wanted)
    assert at == sorted(values)[wanted - 1] and below == sum(v < at for v in values)


def test_crc32():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + np.r_[rng.integers(0, 30, 290), [63, 64, 65, 66, 200, 900, 0, 1, 64, 65]]
    assert resample.crc32_of(data, starts, ends).tolist() == [zlib.crc32(data[s:e].tobytes()) for s, e in zip(starts, ends)]
