"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Tokens are runs of letters and digits (numbers keep inner points and commas), in lower case. Numbers and number
words become one placeholder, units of measure another, capitalised words inside a sentence a third (neighbouring
names count as one; not within `NEAR` words behind a German function word, where every noun has a capital). Windows of `WINDOW` template tokens with at least `LITERALS` plain words are hash-joined between
documents and items; an item with fewer tokens is one window of its own length if it has `SHORTEST` tokens.

An item dense in numbers, names or units may have no such window. It gets longer windows, of the first of the sizes
12, 16, 24, 32, 48 ... that holds enough plain words, else the richest ones of the largest such size that fits, if they have
`PLAIN` of them; and beside these, windows of the words themselves, so that verbatim copies are found (kept apart by a negative size). Items of
fewer than `SHORTEST` words are not searched: a phrase that short says nothing about where a text comes from.

Items with the same template and the same pattern of equal slots are one class, reported by its smallest item_id. A window
that more than `SHARED` classes hold (a common preamble) proves none of them and is left out, also of the item's count. An item
made of such windows only is searched as a whole: by two windows at its ends that cover it (of the largest of the sizes 8, 12, 16, 24, 32 ...
that fits), both of which have to match on one diagonal. Only those may meet more than `SHARED` classes.

A run of matches on one diagonal (place in the document minus place in the item) counts only if its slots are
consistent: the same value in the item always stands for the same value in the document, so a question with other
numbers or names is found, but not one that mixes them up. If a diagonal is not consistent, but every value in it
also stands for itself somewhere (a verbatim copy, edited in places), the windows with the item's own values count. A document is contaminated by an item if consistent
matches cover `COVERAGE` of the item's windows, or if one diagonal matches `RUN` windows.

Scale: document windows are filtered in tasks by a bitmap of the items' windows (at most `BITMAP_BYTES`); what
passes is joined by hash, with the items broadcast only if measured small. Only hits are shuffled, by document
and item. Ids may be of any type. Null and empty texts have no windows. Null ids are kept; repeated rows give one result row. Empty tables
give an empty result.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake.llm.words import LOWER, Texts, Words, map_texts, runs_of, texts_of, window_hashes, window_starts, word_hashes
from paperlake.session import broadcast_if_small, materialize, ship_package

WINDOW, LITERALS, SHORTEST, PLAIN = 8, 5, 4, 2
COVERAGE, RUN, SHARED = 0.5, 6, 3
BITMAP_BYTES = 8 << 20

NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen"
).split()
UNITS = (
    "mm cm km kg mg lb lbs oz ml mile miles meter meters metre metres foot feet inch inches yard yards hour hours minute minutes "
    "second seconds day days week weeks month months year years dollar dollars cent cents euro euros pound pounds percent "
    "gram grams kilogram kilograms liter liters litre litres gallon gallons mph kmh watt watts volt volts degree degrees"
).split()
#: German words that stand before nouns (without those that are English words too), and how far they reach.
NOUNS_FOLLOW = (
    "der die das dem ein eine einen einem einer eines kein keine und oder mit für von zum zur vom beim im ins auf bei nach aus "
    "über unter sein seine seinen ihr ihre ihren unser unsere viele mehr alle zwei drei vier"
).split()
NEAR = 3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT, _JOINS, _STOPS = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58], _JOINS[list(b".,")], _STOPS[list(b".!?\n:|")] = True, True, True
#: Codes of the placeholders
NUMBER, UNIT, NAME = np.uint64(11), np.uint64(22), np.uint64(33)


def _hashes_of(words: list[str]) -> np.ndarray:
    texts = texts_of(pa.array(words))
    return np.sort(word_hashes(texts, runs_of(texts, _LETTER[texts.data])))


_NUMBER_HASHES, _UNIT_HASHES, _GERMAN_HASHES = _hashes_of(NUMBER_WORDS), _hashes_of(UNITS), _hashes_of(NOUNS_FOLLOW)


def _among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values


def _upper(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    first = data[at]
    second = data[np.minimum(at + 1, len(data) - 1)]
    return ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))


def templates(texts: Texts) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, Words, np.ndarray]:
    """Template tokens: where they are, their codes, whether they are plain words, what fills the others (else 0);
    and the tokens before that, with their hashes."""
    data = texts.data
    mask = _LETTER[data]
    if len(data) > 2:
        mask[1:-1] |= _JOINS[data[1:-1]] & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
    words = runs_of(texts, mask)
    low = LOWER[data]
    if len(data) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][accented] += 0x20
    hashes = word_hashes(Texts(low, texts.bounds), words)
    if not len(hashes):
        return words, hashes, np.zeros(0, bool), hashes, words, hashes
    number = _DIGIT[data[words.starts]] | _among(hashes, _NUMBER_HASHES)
    unit = _among(hashes, _UNIT_HASHES)
    stops = np.concatenate(([0], np.cumsum(_STOPS[data])))
    opens = np.ones(len(hashes), bool)
    opens[1:] = (stops[words.starts[1:]] > stops[words.ends[:-1]]) | (words.text[1:] != words.text[:-1])
    capital = _upper(data, words.starts) & (words.ends - words.starts > 1) & ~_upper(data, np.minimum(words.starts + 1, len(data) - 1))
    german, noun, open_since = _among(hashes, _GERMAN_HASHES), np.zeros(len(hashes), bool), opens.copy()
    for back in range(1, NEAR + 1):  # a German function word up to NEAR words before, in the same sentence
        noun[back:] |= german[:-back] & ~open_since[back:]
        open_since[back:] |= opens[:-back]
    name = capital & ~opens & ~number & ~unit & ~noun
    codes = np.select([number, unit, name], [NUMBER, UNIT, NAME], hashes)
    literal = ~(number | unit | name)
    keep = np.ones(len(hashes), bool)
    keep[1:] = ~(name[1:] & name[:-1])
    text = words.text[keep]
    kept = Words(words.starts[keep], words.ends[keep], text, np.searchsorted(text, np.arange(len(texts) + 1)))
    return kept, codes[keep], literal[keep], np.where(literal, np.uint64(0), hashes)[keep], words, hashes


def _windows(found: tuple, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows with enough plain words; of the tokens themselves if the size is negative."""
    words, codes, literal, _, plain_words, hashes = found
    if size < 0:
        starts = window_starts(plain_words, -size)
        return starts, window_hashes(hashes, starts, -size)
    starts = window_starts(words, size)
    plain = np.concatenate(([0], np.cumsum(literal)))
    starts = starts[plain[starts + size] - plain[starts] >= least]
    return starts, window_hashes(codes, starts, size)


def _dense(words: Words, literal: np.ndarray, item: int) -> tuple[int, int, np.ndarray]:
    """Size, least plain words and starts of the windows of an item that has none of the usual size."""
    n, first = int(words.counts[item]), int(words.firsts[item])
    plain = np.concatenate(([0], np.cumsum(literal[first : first + n])))
    size, step = WINDOW + WINDOW // 2, 2 * WINDOW
    largest = min(n, WINDOW)
    while size <= n:
        starts = np.flatnonzero(plain[size:] - plain[:-size] >= LITERALS)
        if len(starts):
            return size, LITERALS, first + starts
        largest, size, step = size, step, 2 * size
    held = plain[largest:] - plain[: len(plain) - largest]
    most = int(held.max(initial=0)) if n >= SHORTEST else 0
    return largest, min(most, LITERALS), first + np.flatnonzero(held == most) if most >= PLAIN else np.zeros(0, int)


def _largest(n: int) -> int:
    """The largest size of windows that fits, at least two thirds of `n`: all up to `WINDOW`, then 12, 16, 24, 32 ..."""
    size, step = min(n, WINDOW), WINDOW + WINDOW // 2
    following = 2 * WINDOW
    while step <= n:
        size, step, following = step, following, 2 * step
    return size


def _class_keys(words: Words, codes: np.ndarray, values: np.ndarray) -> pa.Array:
    """Equal for items of the same template whose slots are equal in the same places."""
    keys = []
    for first, last in zip(words.firsts[:-1], words.firsts[1:], strict=True):
        pattern = np.zeros(last - first, np.int64)
        seen: dict[int, int] = {}
        for i, value in enumerate(values[first:last].tolist()):
            pattern[i] = seen.setdefault(value, len(seen) + 1) if value else 0
        keys.append(hashlib.md5(codes[first:last].tobytes() + pattern.tobytes()).digest())
    return pa.array(keys, pa.binary())


def _slots(values: np.ndarray, starts: np.ndarray, size: int) -> pa.Array:
    rows = values[starts[:, None] + np.arange(size)] if len(starts) else np.zeros((0, size), np.uint64)
    flat = np.where(rows.any(1), size, 0)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(flat))), pa.int32()), pa.array(rows[rows.any(1)].ravel().view(np.int64))
    )


def item_windows(items: DataFrame) -> DataFrame:
    """(window, size, plain, item_id, item_place, windows, item_slots, whole) of one item of each class, without windows that many
    classes hold; an item that would have none of a kind has the `whole` ones of its ends. windows is how many of its kind the item has.
    Item ids are text here."""

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found = templates(texts)
        words, codes, literal, values, plain_words, tokens = found
        sizes = np.clip(words.counts, 0, WINDOW)
        keys = _class_keys(words, codes, values)
        parts = []

        def add(of: Words, starts: np.ndarray, hashes: np.ndarray, size: int, plain: int, whole: bool = False) -> None:
            text = of.text[starts]
            parts.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array(np.full(len(starts), size), pa.int32()),
                        pa.array(np.full(len(starts), plain), pa.int32()),
                        batch.column("item_id").take(pa.array(text)),
                        keys.take(pa.array(text)),
                        pa.array(starts - of.firsts[text], pa.int32()),
                        _slots(values if size > 0 else np.zeros(len(tokens), np.uint64), starts, abs(size)),
                        pa.array(np.full(len(starts), whole)),
                    ],
                    names,
                )
            )

        def add_whole(of: Words, item: int, hashes: np.ndarray, sign: int) -> None:
            n = int(of.counts[item])
            size = _largest(n)
            starts = of.firsts[item] + np.unique([0, n - size])
            add(of, starts, window_hashes(hashes, starts, size), sign * size, 0, True)

        usual = np.zeros(len(texts), bool)
        for size in np.unique(sizes[sizes >= SHORTEST]).tolist():
            least = min(LITERALS, size - 1)
            starts, hashes = _windows(found, size, least)
            fits = sizes[words.text[starts]] == size
            add(words, starts[fits], hashes[fits], size, least)
            usual[words.text[starts[fits]]] = True
        for item in np.flatnonzero(usual).tolist():
            add_whole(words, item, codes, 1)
        for item in np.flatnonzero(~usual).tolist():
            size, least, starts = _dense(words, literal, item)
            add(words, starts, window_hashes(codes, starts, size), size, least)
            if len(starts):
                add_whole(words, item, codes, 1)
            size = min(WINDOW, int(plain_words.counts[item]))
            if size >= SHORTEST:
                starts = np.arange(plain_words.firsts[item], plain_words.firsts[item + 1] - size + 1)
                add(plain_words, starts, window_hashes(tokens, starts, size), -size, 0)
                add_whole(plain_words, item, tokens, -1)
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if sum(p.num_rows for p in parts) else empty

    names = ["window", "size", "plain", "item_id", "class", "item_place", "item_slots", "whole"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.bool_()]
    empty = pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names)
    schema = "window bigint, size int, plain int, item_id string, class binary, item_place int, item_slots array<bigint>, whole boolean"
    rows = materialize(map_texts(items.select(F.col("item_id").cast("string").alias("item_id"), "text"), schema, run), "decontaminate-items")
    order = F.struct(F.length("item_id"), "item_id")  # numbers in order of their value
    first = rows.groupBy("class").agg(F.min(order).alias("first")).select("class", F.col("first.item_id").alias("item_id"))
    rows = rows.join(broadcast_if_small(first), (rows["class"] == first["class"]) & rows["item_id"].eqNullSafe(first["item_id"]), "left_semi")
    rows = rows.distinct()
    ends, rows = rows.where("whole"), rows.where("NOT whole")
    many = rows.groupBy("window", "size").agg(F.count_distinct("class").alias("n")).where(F.col("n") > SHARED)
    rows = rows.join(broadcast_if_small(many), ["window", "size"], "left_anti")
    verbatim = (F.col("size") < 0).alias("verbatim")
    left = broadcast_if_small(rows.select("class", verbatim).distinct())
    rows = rows.unionByName(ends.withColumn("verbatim", verbatim).join(left, ["class", "verbatim"], "left_anti").select(rows.columns))
    windows = F.count("*").over(Window.partitionBy("class", F.col("size") < 0)).cast("int")
    return rows.withColumn("windows", windows).drop("class")


def _bitmap(windows: DataFrame) -> np.ndarray | None:
    """One bit per low part of a window's hash; None if the items are too many for it to help."""
    n = windows.count()
    if n > BITMAP_BYTES // 2:
        return None
    hashes = windows.select("window").toArrow().column("window").to_numpy().view(np.uint64)
    bits = max(16, min(int(n * 16).bit_length(), (BITMAP_BYTES * 8).bit_length() - 1))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    low = hashes & np.uint64((1 << bits) - 1)
    np.bitwise_or.at(bitmap, (low >> np.uint64(3)).astype(np.int64), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
    return bitmap


def _document_windows(docs: DataFrame, sizes: dict[int, int], bitmap: np.ndarray | None) -> DataFrame:
    """(window, size, doc_id, key, place, slots) of the windows that may be in the items; sizes with least plain words."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def passes(hashes: np.ndarray) -> np.ndarray:
        bits = held.value
        if bits is None:
            return np.ones(len(hashes), bool)
        low = hashes & np.uint64(len(bits) * 8 - 1)
        return (bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found = templates(texts)
        parts = []
        for size, least in sizes.items():
            words, values = (found[0], found[3]) if size > 0 else (found[4], np.zeros(len(found[5]), np.uint64))
            starts, hashes = _windows(found, size, least)
            passed = passes(hashes)
            starts, hashes = starts[passed], hashes[passed]
            text = words.text[starts]
            taken = pa.array(text, pa.int64())
            parts.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array(np.full(len(starts), size), pa.int32()),
                        batch.column("doc_id").take(taken),
                        batch.column("key").take(taken),
                        pa.array(starts - words.firsts[text], pa.int32()),
                        _slots(values, starts, abs(size)),
                    ],
                    ["window", "size", "doc_id", "key", "place", "slots"],
                )
            )
        return pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=None)[0] if sum(p.num_rows for p in parts) else parts[0]

    schema = "window bigint, size int, doc_id string, key binary, place int, slots array<bigint>"
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key")
    return map_texts(docs.select(F.col("doc_id").cast("string").alias("doc_id"), key, "text"), schema, run)


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, covered, longest) for every document and item with a consistent match."""
    ship_package(docs.sparkSession)
    windows = materialize(item_windows(items), "decontaminate-windows")
    found = windows.groupBy("size").agg(F.min("plain").alias("plain")).orderBy("size").collect()  # some twenty, at most
    sizes = {r["size"]: r["plain"] for r in found} or {WINDOW: LITERALS}
    hits = _document_windows(docs, sizes, _bitmap(windows)).join(broadcast_if_small(windows), ["window", "size"])
    slots = F.filter(F.arrays_zip("item_slots", "slots"), lambda s: s["item_slots"] != 0)
    diagonals = (
        hits.withColumns({"diagonal": F.col("place") - F.col("item_place"), "verbatim": F.col("size") < 0})
        .groupBy("doc_id", "key", "item_id", "verbatim", "diagonal")
        .agg(
            F.collect_set("item_place").alias("places"),
            F.collect_set(F.when(F.col("item_slots") == F.col("slots"), F.col("item_place"))).alias("same"),
            F.max("windows").alias("windows"),
            F.max("whole").alias("whole"),
            F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"),
        )
    )
    values = F.size(F.array_distinct(F.col("slots.item_slots")))
    consistent = F.size("slots") == values
    edited = F.size(F.filter("slots", lambda s: s["item_slots"] == s["slots"])) == values
    kept = diagonals.withColumn("places", F.when(consistent, F.col("places")).when(edited, F.col("same")).otherwise(F.array().cast("array<int>")))
    kept = kept.where((F.size("places") > 0) & (~F.col("whole") | (F.size("places") >= F.col("windows"))))
    kinds = kept.groupBy("doc_id", "key", "item_id", "verbatim").agg(
        (F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.max("windows")).alias("covered"),
        F.max(F.size("places")).alias("longest"),
    )
    pairs = kinds.groupBy("doc_id", "key", "item_id").agg(F.max("covered").alias("covered"), F.max("longest").alias("longest"))
    given = {"doc_id": docs.schema["doc_id"].dataType, "item_id": items.schema["item_id"].dataType}
    return pairs.withColumns({name: F.col(name).cast(kind) for name, kind in given.items()})


def contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """The pairs of `matches` that reach the coverage or the run."""
    return matches(docs, items).where((F.col("covered") >= coverage) | (F.col("longest") >= run))


def remove(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that no item contaminates, all columns unchanged."""
    found = materialize(contaminated(docs, items).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(), "contaminated")
    key = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    return docs.join(broadcast_if_small(found), F.col("__id").eqNullSafe(docs["doc_id"]) & (F.col("__key") == key), "left_anti")
