"""Substring dedup with difference-cover anchors: removes every word of a repeated window of words.

A window is `window` consecutive words of one document; it is repeated if its words also start at any other
place, in the same document or another. All windows are judged on the input.

1. Anchors. A difference cover D modulo p has, for any two places i and j, a shift below p that brings both
   into D. So two equal windows of `window` words share an equal, aligned anchor of `window - p + 1` words that
   starts in D, and hashing the places in D (5 of 21) finds every match. Anchors that occur once are dropped.
2. Extension. Only windows around repeated anchors are hashed whole, with 128 bits, and counted.
3. Removal. The words under repeated windows are cut from the texts.

Texts that occur several times as a whole enter step 2 once and are removed whole if they hold a window.
Anchors and windows are counted before they meet, so one passage in a third of all documents costs a counter;
their places are brought back by a semi-join that adaptive execution can split. What comes back per document is
a list of places of that document; it is broadcast only if measured small, else joined by text.

Null and empty texts have no words. Null or equal ids are allowed: documents are told apart by row, texts by
md5. Fewer than `window` words: nothing is removed. An empty table gives an empty result. All columns are kept;
columns named like the added ones are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.llm.words import Texts, Words, chunks, map_texts, texts_of, window_hashes, window_starts, word_hashes, words_of
from paperlake.session import broadcast_if_small, materialize, ship_package

WINDOW = 35
#: Perfect difference sets, by period.
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
MIN_ANCHOR = 12


def period_for(window: int) -> int:
    return max((p for p in COVERS if window - p + 1 >= MIN_ANCHOR), default=1)


def _key():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, key, place) of every cover position of texts that hold a window."""
    period = period_for(window)
    size = window - period + 1
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        words = words_of(texts)
        starts = window_starts(words, size)
        text = words.text[starts]
        place = starts - words.firsts[text]
        chosen = cover[place % period] & (words.counts[text] >= window)
        starts, text, place = starts[chosen], text[chosen], place[chosen]
        anchors = window_hashes(word_hashes(texts, words), starts, size)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.view(np.int64)), batch.column("key").take(pa.array(text)), pa.array(place, pa.int32())],
            ["anchor", "key", "place"],
        )

    return map_texts(docs.select(_key().alias("key"), "text"), "anchor bigint, key binary, place int", run)


def _around(words: Words, text: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """Windows that hold one of the given anchors at a place that both texts of a match could share."""
    period = period_for(window)
    at = words.firsts[text] + place
    steps = np.zeros(len(words.text) + 1, np.int64)
    np.add.at(steps, np.maximum(at - period + 1, words.firsts[text]), 1)
    np.add.at(steps, at + 1, -1)
    starts = window_starts(words, window)
    return starts[np.cumsum(steps)[starts] > 0]


def _windows(marked: DataFrame, window: int) -> DataFrame:
    """(low, high, key, place, whole) of the windows around repeated anchors."""

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        words = words_of(texts)
        places = batch.column("places")
        text = np.repeat(np.arange(len(texts)), np.diff(places.offsets.to_numpy()))
        starts = _around(words, text, places.flatten().to_numpy(zero_copy_only=False).astype(np.int64), window)
        hashes = word_hashes(texts, words)
        text = words.text[starts]
        taken = pa.array(text)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(window_hashes(hashes, starts, window, 1).view(np.int64)),
                pa.array(window_hashes(hashes, starts, window, 2).view(np.int64)),
                batch.column("key").take(taken),
                pa.array(starts - words.firsts[text], pa.int32()),
                batch.column("whole").take(taken),
            ],
            ["low", "high", "key", "place", "whole"],
        )

    return map_texts(marked.select("key", "text", "places", "whole"), "low bigint, high bigint, key binary, place int, whole boolean", run)


def _ranges(window: int):
    """Sorted places of windows to the ranges of words they cover: [start, end, start, end, ...]."""

    def run(places: pa.Array) -> pa.Array:
        out = []
        for found in places:
            at = np.sort(np.asarray(found.values.to_numpy(zero_copy_only=False), np.int64))
            new = np.concatenate(([True], at[1:] > at[:-1] + window))
            starts, ends = at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + window
            out.append(np.stack([starts, ends], 1).ravel().astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    run.__annotations__ = {"places": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>").asNondeterministic()


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per text (by key) that loses words: whole, or the ranges of words to remove."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    anchors = _anchors(docs, window)
    repeated = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    places = anchors.join(repeated, "anchor", "left_semi").groupBy("key").agg(F.collect_set("place").alias("places"))
    keyed = docs.withColumn("key", _key())
    copies = keyed.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    # each text enters once; a text that occurs again is repeated as a whole
    marks = materialize(places.join(copies, "key").withColumn("whole", F.col("copies") > 1), "substring-anchors")
    marked = keyed.join(broadcast_if_small(marks.withColumnRenamed("key", "marked")), F.col("key") == F.col("marked"))
    marked = marked.where(F.col("doc_id").eqNullSafe(F.col("first")))

    windows = _windows(marked, window)
    again = windows.groupBy("low", "high").agg(F.count("*").alias("n")).where("n > 1").select("low", "high")
    found = windows.where("NOT whole").join(again, ["low", "high"], "left_semi")
    found = found.groupBy("key").agg(F.collect_set("place").alias("places"))
    ranges = found.select("key", F.lit(False).alias("whole"), _ranges(window)("places").alias("ranges"))
    whole = marks.where("whole").select("key", "whole", F.expr("CAST(NULL AS array<int>)").alias("ranges"))
    return materialize(whole.union(ranges), "substring-ranges")


def _cut(column: pa.Array, whole: pa.Array, ranges: pa.Array) -> pa.Array:
    texts = texts_of(column)
    words = words_of(texts)
    removed = np.zeros(len(words.text) + 1, np.int64)
    for i, (every, found) in enumerate(zip(whole.to_pylist(), ranges, strict=True)):
        first = words.firsts[i]
        if every:
            removed[first] += 1
            removed[words.firsts[i + 1]] -= 1
        elif found.is_valid:
            at = found.values.to_numpy(zero_copy_only=False) + first
            np.add.at(removed, at[::2], 1)
            np.add.at(removed, at[1::2], -1)
    keep = np.cumsum(removed)[:-1] == 0
    starts, ends, text = words.starts[keep], words.ends[keep], words.text[keep]
    gap = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, bool)
    lengths = ends - starts + gap
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    out = texts.data[np.minimum(index, max(len(texts.data) - 1, 0))]
    out[offsets[1:][gap] - 1] = 0x20
    bounds = np.concatenate(([0], np.cumsum(np.bincount(text, lengths, len(texts))))).astype(np.int32)
    kept = pa.StringArray.from_buffers(len(texts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes()))
    n_words = words.counts
    n_kept = np.bincount(text, minlength=len(texts))
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_words - n_kept, pa.int64()), kept], ["n_words", "n_removed", "kept"]
    )


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns, n_words, n_removed and kept (the words left, joined by one space)."""
    marks = broadcast_if_small(repeated_ranges(docs, window).withColumnsRenamed({"key": "__marked", "whole": "__whole", "ranges": "__ranges"}))

    def run(text: pa.Array, whole: pa.Array, ranges: pa.Array) -> pa.Array:
        parts = [_cut(text.slice(a, b - a), whole.slice(a, b - a), ranges.slice(a, b - a)) for a, b in chunks(text)]
        return pa.concat_arrays(parts) if parts else _cut(text, whole, ranges)

    run.__annotations__ = {"text": pa.Array, "whole": pa.Array, "ranges": pa.Array, "return": pa.Array}
    cut = F.arrow_udf(run, "n_words bigint, n_removed bigint, kept string").asNondeterministic()
    joined = docs.withColumn("__key", _key()).join(marks, F.col("__key") == F.col("__marked"), "left")
    done = joined.withColumn("__cut", cut("text", "__whole", "__ranges"))
    names = ("n_words", "n_removed", "kept")
    return done.withColumns({name: F.col(f"__cut.{name}") for name in names}).drop("__key", "__marked", "__whole", "__ranges", "__cut")
