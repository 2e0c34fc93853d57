"""Importance resampling towards a target distribution: hashed n-gram weights, Gumbel noise, the highest scores drawn.

Features are runs of 1 to `most` words, hashed to buckets. The gain of a bucket is the log ratio of its smoothed shares in the
target and in the corpus, both counted over all texts; a document's weight is the sum of its features' gains,
looked up in one array. Noise that depends on the id alone turns the highest scores into a draw without replacement.

Scores are written once. The cutoff is found by numeric bisection: each job counts, exactly and over all written
scores, how many rows lie up to each of `PIVOTS` thresholds; rows tied at the cutoff are divided the same way by doc_id,
and those tied in both by their row number. Nothing but counts reaches the driver. Drawn rows are range-partitioned by
score, doc_id and row number, and each rank is the row's place in its range plus the rows of the ranges before it.

Defined results: null and empty texts have no features and weight 0. Null ids hash as an empty id and come last among
ties; repeated ids are documents of their own, ordered by row number. An empty corpus gives an empty result; an empty target
counts as all zero. Columns other than doc_id and text are not looked at.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.llm.words import LOWER, Texts, chunks, runs_of, text_udf, texts_of
from paperlake.session import broadcast_if_small, materialize, parts_for, ship_package

BUCKETS, MOST, SEED = 10_000, 1, 2024
MIN_WORDS, PERCENT = 20, 10
#: Thresholds that one count job looks at.
PIVOTS = 15
_RANK_ROWS = 1 << 20
_NO_ID = (1 << 63) - 1

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`, after A-Z are lower-cased.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, np.uint32(0xEDB88320) ^ (_CRC >> np.uint32(1)), _CRC >> np.uint32(1)).astype(np.uint32)


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int = 64) -> np.ndarray:
    """crc32 of byte ranges: all ranges advance byte by byte together, very long ones are left to zlib."""
    order = np.argsort(starts - ends, kind="stable")
    lengths = (ends - starts)[order]
    n_long = int(np.searchsorted(-lengths, -longest, side="left"))
    out = np.empty(len(starts), np.uint32)
    for i in order[:n_long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    order, lengths = order[n_long:], lengths[n_long:]
    at, crc = starts[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    for place in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -place, side="left"))  # ranges longer than `place`
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + place]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features_of(texts: Texts, buckets: int = BUCKETS, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every feature, and the number of words of each text."""
    lowered = Texts(LOWER[texts.data], texts.bounds)
    words = runs_of(lowered, _INSIDE[lowered.data])
    if most == 1:
        return words.text, crc32_of(lowered.data, words.starts, words.ends) % buckets, words.counts
    lengths = words.ends - words.starts  # words one after the other, joined by one space
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    within = np.arange(int(ends[-1]) + 1 if len(ends) else 0)
    owner = np.repeat(np.arange(len(ends)), lengths + 1)
    place = within - starts[owner]
    joined = np.where(place < lengths[owner], lowered.data[np.minimum(words.starts[owner] + place, len(lowered.data) - 1)], 0x20).astype(np.uint8)
    text, crc = [], []
    for size in range(1, most + 1):
        first = np.flatnonzero(words.text[: len(ends) - size + 1] == words.text[size - 1 :]) if len(ends) >= size else np.zeros(0, int)
        text.append(words.text[first])
        crc.append(crc32_of(joined, starts[first], ends[first + size - 1]))
    return np.concatenate(text), np.concatenate(crc) % buckets, words.counts


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MOST) -> np.ndarray:
    """How often the features of all texts fall into each bucket; every task passes on one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for start, end in chunks(batch.column("text")):
                found = features_of(texts_of(batch.column("text").slice(start, end - start)), buckets, most)[1]
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some])})

    counted = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t, more = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + more) / ((s + 1) * (t.sum() + more)))).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, most: int = MOST) -> Column:
    """A struct of n_words, n_features and weight for the column text."""
    held = docs.sparkSession.sparkContext.broadcast(gains)

    def run(texts: Texts) -> pa.Array:
        text, bucket, words = features_of(texts, len(held.value), most)
        order = np.argsort(text, kind="stable")
        sums = np.concatenate(([0], np.cumsum(held.value[bucket[order]])))
        counts = np.bincount(text, minlength=len(texts))
        ends = np.cumsum(counts)
        columns = [words.astype(np.int64), counts.astype(np.int64), sums[ends] - sums[ends - counts]]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], ["n_words", "n_features", "weight"])

    return text_udf(run, "struct<n_words: long, n_features: long, weight: long>")(F.col("text"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * g) for a Gumbel variate g that depends on the id and the seed alone."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(key, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def cutoff(rows: DataFrame, column: str, wanted: int, pivots: int = PIVOTS) -> tuple[int, int]:
    """The smallest value with `wanted` rows up to it, and the number of rows below it. There are that many rows at least."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high, below = ends["low"], ends["high"], 0
    while low < high:
        steps = sorted({low + (high - low) * (i + 1) // (pivots + 1) for i in range(pivots)} - {high})
        counts = rows.agg(*[F.count(F.when(F.col(column) <= step, 1)).alias(f"n{i}") for i, step in enumerate(steps)]).first()
        for step, count in zip(steps, counts, strict=True):
            if count >= wanted:
                high = step
                break
            low, below = step + 1, count
    return low, below


def draw(scored: DataFrame, among: Column, wanted: int) -> Column:
    """Whether a row of the written table (falls, id, row) is one of the first `wanted` rows for which `among` holds."""
    if wanted <= 0:
        return F.lit(False)
    tied, chosen, left = among, F.lit(False), wanted
    for column in ("falls", "id", "row"):
        at, below = cutoff(scored.where(tied), column, left)
        chosen = chosen | (tied & (F.col(column) < at))
        tied, left = tied & (F.col(column) == at), left - below
        if scored.where(tied).count() == left:
            return chosen | tied
    raise AssertionError("row numbers are distinct")


def ranked(drawn: DataFrame, n: int) -> DataFrame:
    """Adds rank: 1, 2, 3 ... by (falls, id, row)."""
    order = ["falls", "id", "row"]
    parts = parts_for(n, _RANK_ROWS, drawn.sparkSession.sparkContext.defaultParallelism, 1 << 16)
    ranges = materialize(drawn.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "resample-ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranges.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return ranges.join(broadcast_if_small(starts), "range").withColumn("rank", (F.col("start") + place).cast("long")).drop("range", "start")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, most: int = MOST, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    ship_package(docs.sparkSession)
    gains = gains_of(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    scored = docs.select("doc_id", weighed(docs, gains, most).alias("w"))
    scored = scored.select("doc_id", "w.*", (F.col("w.weight") + noise(F.col("doc_id"), seed)).alias("score"))
    number = F.coalesce(F.col("doc_id").try_cast("long"), F.lit(_NO_ID))
    scored = scored.withColumns({"falls": -F.col("score"), "id": number, "row": F.monotonically_increasing_id()})
    scored = materialize(scored, "resample-scores")
    among = F.col("n_words") >= min_words
    wanted = percent * scored.where(among).count() // 100
    drawn = draw(scored, among, wanted)
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    if wanted <= 0:
        return rest.select(columns)
    return ranked(scored.where(drawn), wanted).select(columns).unionByName(rest.select(columns))
