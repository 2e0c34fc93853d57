"""N-gram Jaccard self-join: all documents whose sets of word shingles have a similarity of at least 0.75.

A document's set holds its distinct shingles of five words (A-Z in lower case); with fewer words the whole sequence
is the one element; a text without words has an empty set and no links. Two sets are linked if
100 * common >= 75 * all. The result names the connected component of each document by its smallest doc_id.

1. Equal sets become one class (128-bit sums over the elements), whatever the number of copies.
2. Grouping. Classes that share two or three minima under different hash functions are compared with one leader of
   their bucket: a number of comparisons linear in the classes. The links found put similar classes into groups.
3. Token-group matrix. In one global order of elements two linked sets share an element among the first
   n - ceil(0.75 n) + 1 of each. The matrix has one row per such element and group (a group is split into parts of
   about `PART` members), with the range of set sizes.
4. A class that meets another group in the matrix is bounded by its overlap with the union of the part's sets.
   Only parts that reach 0.75 n are opened, and their members compared one by one.

The order puts frequent elements last. They are counted in every chunk of every task, from two classes on, and the
counts are summed. The order only moves work: any order finds all links. Elements are 64-bit hashes of five word
hashes. Sets are made again from the texts where they are compared, because texts are smaller than sets; only
prefixes are shuffled, once. Within a group nothing more is compared: its members are connected already.

Null texts are empty. Rows with null ids take part; a component without any id has a null component_id. Repeated
rows and ties are copies of one class. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.components import components
from paperlake.llm.words import CHUNK_BYTES, Texts, map_texts, mix, range_hashes, texts_of, window_hashes, window_starts, word_hashes, words_of
from paperlake.session import broadcast_if_small, materialize, ship_package

SHINGLE, PERCENT = 5, 75
#: Counts from which an element goes to the end of the order; elements moved at most; members of a part; classes
#: that are compared with one copy of a part.
HOT, HOT_MOST, PART, ASKING = 200, 1_000_000, 32, 128
#: Minima kept of each set, an even number; buckets are made of two and of three neighbouring ones.
SKETCHES = 6


def _order(found: np.ndarray, text: np.ndarray, hot: np.ndarray | None) -> np.ndarray:
    """Sorts elements by text, moved ones last, then by hash."""
    late = np.zeros(len(found), bool)
    if hot is not None and len(hot):
        late = hot[np.minimum(np.searchsorted(hot, found), len(hot) - 1)] == found
    # one 64-bit key sorts many times faster; it cuts the hash, so look for elements it can't tell apart
    key = (text.astype(np.uint64) << np.uint64(40)) | (late.astype(np.uint64) << np.uint64(39)) | (found >> np.uint64(25))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    if (found[order][1:][same] != found[order][:-1][same]).any():
        return np.lexsort((found, late, text))
    return order


def shingles(texts: Texts, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text in the global order: elements, their text, and counts per text."""
    texts = texts.lowered()
    words = words_of(texts)
    hashes = word_hashes(texts, words)
    starts = window_starts(words, SHINGLE)
    found, text = window_hashes(hashes, starts, SHINGLE), words.text[starts]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        whole = range_hashes(hashes, words.firsts[short], words.firsts[short + 1])
        found, text = np.concatenate([found, whole]), np.concatenate([text, short])
    order = _order(found, text, hot)
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    return found, text, np.bincount(text, minlength=len(texts))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n + (-PERCENT * n) // 100 + 1, 0)


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def _lists(found: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(counts), pa.int32()), pa.array(found.view(np.int64)))


def _prefixes(found: np.ndarray, text: np.ndarray, counts: np.ndarray) -> pa.Array:
    kept = prefix_length(counts)
    place = np.arange(len(found)) - _offsets(counts)[:-1][text]
    return _lists(found[place < kept[text]], kept)


def _fingerprints(found: np.ndarray, text: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    out = []
    for seed in (101, 102):
        sums = np.zeros(len(found) + 1, np.uint64)
        np.cumsum(mix(found, seed), out=sums[1:])
        ends = _offsets(counts)
        out.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
    return out


def _minima(found: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        out[full] = np.minimum.reduceat(mix(found, seed), _offsets(counts)[:-1][full])
    return out.view(np.int64)


def _key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _frequent(found: np.ndarray, text: np.ndarray, prints: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Elements that two or more different sets of a chunk hold, and how many do."""
    _, first = np.unique(np.stack(prints, 1), axis=0, return_index=True)
    once = np.zeros(len(prints[0]), bool)
    once[first] = True
    elements, held = np.unique(found[once[text]], return_counts=True)
    return elements[held > 1], held[held > 1]


def _scan(docs: DataFrame) -> DataFrame:
    """Size, fingerprint and minima of every text's set; the first row of a chunk carries its frequent elements."""

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found, text, counts = shingles(texts)
        minima = [pa.array(_minima(found, counts, seed)) for seed in range(1, SKETCHES + 1)]
        prints = _fingerprints(found, text, counts)
        elements, held = _frequent(found, text, prints)
        offsets = pa.array([0] + [len(elements)] * len(texts), pa.int32())
        frequent = pa.StructArray.from_arrays([pa.array(elements.view(np.int64)), pa.array(held, pa.int32())], ["token", "held"])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int32()), *map(pa.array, prints), *minima, pa.ListArray.from_arrays(offsets, frequent)],
            ["doc_id", "key", "n", "f1", "f2", *(f"s{i}" for i in range(SKETCHES)), "frequent"],
        )

    sketches = "".join(f"s{i} bigint, " for i in range(SKETCHES))
    schema = f"doc_id bigint, key binary, n int, f1 bigint, f2 bigint, {sketches}frequent array<struct<token: bigint, held: int>>"
    return map_texts(docs.select("doc_id", _key().alias("key"), "text"), schema, run)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of each wanted class (rid and rkey name its representative), other columns kept."""
    side = broadcast_if_small(wanted)
    rows = docs.select("doc_id", _key().alias("key"), "text")
    return rows.join(side, (F.col("key") == F.col("rkey")) & F.col("doc_id").eqNullSafe(F.col("rid"))).drop("doc_id", "key", "rid", "rkey")


def _compare(asking: DataFrame, parts: DataFrame, on: list[str]) -> DataFrame:
    """Links (a, b) between asking classes (node, text) and the members (node, text) of the parts they meet.

    The bound comes first: a part whose union does not hold 0.75 n of a set is not opened. Of the links found
    in one chunk those are returned that connect something; the others follow from them.
    """
    met = asking.join(parts, on).select("node", "text", "members")

    def run(batches):
        for batch in batches:
            lists = batch.column("members")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            held = lists.flatten()
            heads = held.field("node").to_numpy()[ends[:-1]]
            same = np.append(False, heads[1:] == heads[:-1])  # rows of one part follow each other
            inside = texts_of(held.field("text")).bounds
            cost = np.diff(texts_of(batch.column("text")).bounds) + np.where(same, 0, np.diff(inside[ends]))
            slices = np.cumsum(cost) // (2 * CHUNK_BYTES)
            for value in np.unique(slices):
                rows = np.flatnonzero(slices == value)
                yield compare(batch.slice(rows[0], len(rows)))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("members")
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        held = lists.flatten()
        nodes, members = batch.column("node").to_numpy(), held.field("node").to_numpy()
        sets = _sets_by_node(np.concatenate([nodes, members]), pa.concat_arrays([batch.column("text"), held.field("text")]))
        a, b, at, above = [], [], None, {}

        def root(node: int) -> int:
            while (up := above.get(node, node)) != node:
                above[node] = above.get(up, up)
                node = up
            return node

        for i, node in enumerate(nodes.tolist()):
            part = members[ends[i] : ends[i + 1]]
            if at is None or part[0] != at:
                at, inside = part[0], [sets[m] for m in part.tolist()]
                union = np.unique(np.concatenate(inside))
                holds = np.zeros((len(part), len(union)), bool)
                for k, other in enumerate(inside):
                    holds[k, np.searchsorted(union, other)] = True
                sizes = np.array([len(other) for other in inside])
            own = sets[node]
            place = np.minimum(np.searchsorted(union, own), len(union) - 1)
            place = place[union[place] == own]
            if 100 * len(place) < PERCENT * len(own):
                continue
            common = holds[:, place].sum(1)
            linked = (100 * common >= PERCENT * (len(own) + sizes - common)) & (part != node)
            for other in part[linked].tolist():
                if (one := root(node)) != (two := root(other)):  # else a chain of links joins them already
                    above[one] = two
                    a.append(node)
                    b.append(other)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a bigint, b bigint")


def _sets_by_node(nodes: np.ndarray, texts: pa.Array) -> dict[int, np.ndarray]:
    nodes, first = np.unique(nodes, return_index=True)
    found, _, counts = shingles(texts_of(texts.take(pa.array(first))))
    return dict(zip(nodes.tolist(), np.split(found, np.cumsum(counts)[:-1]), strict=True))


def _near(n_a: Column, n_b: Column) -> Column:
    return (100 * n_a >= PERCENT * n_b) & (100 * n_b >= PERCENT * n_a)


def _share(n: Column) -> Column:
    """The least overlap of a set of n elements with any linked set."""
    return F.ceil(n * PERCENT / 100 - 1e-9)


def _overlap(n: Column, m: Column) -> Column:
    """The least overlap of linked sets of n and m elements."""
    return F.ceil((n + m) * PERCENT / (100 + PERCENT) - 1e-9)


def _spare(n: Column, low: Column, high: Column) -> Column:
    """Most elements behind the end of the longer prefix that may be unshared, over partners of low to high elements.

    Above n it grows by 9 every 28 sizes, but not evenly: it can be one less at a size than at the size before. So the last
    size but one counts too.
    """
    spare = lambda m: _share(F.greatest(n, m)) - 1 - _overlap(n, m)
    return F.greatest(spare(low), spare(high), spare(F.greatest(low, high - 1)))


def _members(texts: DataFrame, *keys: str) -> DataFrame:
    return texts.groupBy(*keys).agg(F.collect_list(F.struct("node", "text")).alias("members"))


def _bucket_pairs(classes: DataFrame) -> DataFrame:
    """(node, leader): classes of one bucket and about one size, each with the leader of the bucket."""
    following = lambda i: F.array(*[F.col(f"s{(2 * i + j) % SKETCHES}") for j in range(3)])
    bands = [F.struct(F.lit(i).alias("i"), F.slice(following(i), 1, size).alias("minima")) for i in range(SKETCHES // 2) for size in (2, 3)]
    buckets = classes.select("node", "n", F.explode(F.array(*bands)).alias("bucket")).select("node", "n", "bucket.i", F.xxhash64("bucket").alias("bucket"))
    leader = F.min_by(F.struct("node", "n"), F.xxhash64("node", "i")).alias("leader")
    leaders = buckets.groupBy("i", "bucket").agg(F.count("*").alias("members"), leader).where("members > 1").drop("members")
    pairs = buckets.join(leaders, ["i", "bucket"]).select("node", "n", "leader")
    pairs = pairs.where((F.col("node") != F.col("leader.node")) & _near(F.col("n"), F.col("leader.n")))
    pairs = pairs.select(F.greatest("node", "leader.node").alias("node"), F.least("node", "leader.node").alias("leader"))
    return pairs.distinct()


def _star_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked."""
    reps = classes.select("node", "rid", "rkey")
    asked = pairs.groupBy("node").agg(F.collect_set("leader").alias("leaders"))
    asking = _texts(docs, reps.join(asked, "node")).withColumn("leader", F.explode("leaders")).drop("leaders")
    heads = _texts(docs, reps.join(pairs.select(F.col("leader").alias("node")).distinct(), "node", "left_semi"))
    heads = heads.select(F.col("node").alias("leader"), F.array(F.struct("node", "text")).alias("members"))
    return _compare(asking, heads, ["leader"])


def _shared_prefixes(docs: DataFrame, scanned: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, node, pos) of the prefixes, without tokens that one class alone holds."""
    counted = scanned.select(F.explode("frequent").alias("f")).groupBy("f.token").agg(F.sum("f.held").alias("held"))
    hot = counted.where(F.col("held") > HOT).orderBy(F.desc("held"), "token").limit(HOT_MOST).select("token")
    late = docs.sparkSession.sparkContext.broadcast(np.sort(hot.toArrow().column("token").to_numpy().view(np.uint64)))

    def run(batch: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found, text, counts = shingles(texts, late.value)
        return pa.RecordBatch.from_arrays([batch.column("node"), _prefixes(found, text, counts)], ["node", "prefix"])

    rows = _texts(docs, classes.select("node", "rid", "rkey")).select("node", "text")
    tokens = map_texts(rows, "node bigint, prefix array<bigint>", run)
    tokens = materialize(tokens.select("node", F.posexplode("prefix").alias("pos", "token")), "jaccard-prefixes")
    # Counted in every task first: a token of all classes is a count, not a window in one task.
    several = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    return materialize(tokens.join(several.hint("shuffle_merge"), "token", "left_semi"), "jaccard-shared")


def _groups(classes: DataFrame, pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """(node, n, component, group, linked, part, alone): linked classes by component, the others by their smallest leader."""
    similar = pairs.groupBy("node").agg(F.min("leader").alias("cluster"))
    named = classes.select("node", "n").join(components(stars), "node", "left").join(similar, "node", "left")
    linked = F.col("component").isNotNull()
    named = named.withColumns(
        {
            "linked": linked,
            "group": F.when(linked, F.col("component") * 2 + 1).otherwise(F.coalesce("cluster", "node") * 2),
            "component": F.coalesce("component", "node"),
        }
    ).drop("cluster")
    sizes = named.groupBy("group").agg(F.ceil(F.count("*") / PART).alias("parts"), (F.count("*") == 1).alias("alone"))
    return named.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts")


def _matrix_links(docs: DataFrame, scanned: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Links (a, b) of classes that are not connected yet: matrix, bound, then the members of qualifying parts."""
    shared = _shared_prefixes(docs, scanned, classes).join(broadcast_if_small(groups), "node")
    shared = materialize(shared, "jaccard-grouped")
    across = shared.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    shared = materialize(shared.join(across.select("token").hint("shuffle_merge"), "token", "left_semi"), "jaccard-across")
    matrix = shared.groupBy("token", F.col("group").alias("group_b"), F.col("part").alias("part_b")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest")
    )
    # every two parts meet from one side, members of a part that are not linked within it
    once = F.struct("group", "part") >= F.struct("group_b", "part_b")
    met = shared.join(matrix, "token").where(
        once
        & ((F.col("group") != F.col("group_b")) | ~F.col("linked") & (~F.col("alone") | (F.col("part") != F.col("part_b"))))
        & (100 * F.col("most") >= PERCENT * F.col("n"))
        & (PERCENT * F.col("least") <= 100 * F.col("n"))
    )
    met = met.groupBy("node", "group_b", "part_b").agg(
        F.count("*").alias("held"),
        F.max(F.least(F.col("n") - F.col("pos"), "rest")).alias("first"),
        F.max("n").alias("n"),
        F.max("most").alias("most"),
        F.min("least").alias("least"),
    )
    # Partners have low to high elements. From the first shared element on there must be room for the overlap; and
    # where one of the two prefixes ends, no more than `held` shared elements were seen, only the rest can add to them.
    low = F.greatest("least", _share(F.col("n")))
    high = F.least("most", F.floor(F.col("n") * 100 / PERCENT + 1e-9))
    enough = (F.col("first") >= _overlap(F.col("n"), low)) & (F.col("held") + _spare(F.col("n"), low, high) >= 0)
    met = materialize(met.where(enough).select("node", "group_b", "part_b"), "jaccard-met")
    if met.isEmpty():
        return None
    # a part that many classes meet is copied, so that no task compares more than about `ASKING` of them with it
    part = ["group_b", "part_b"]
    slices = broadcast_if_small(met.groupBy(*part).agg(F.ceil(F.count("*") / ASKING).cast("int").alias("slices")))
    met = met.join(slices, part).withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    reps = classes.select("node", "rid", "rkey")
    names = groups.select("node", F.col("group").alias("group_b"), F.col("part").alias("part_b")).join(slices, part)
    members = _texts(docs, reps.join(names, "node")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    asked = met.groupBy("node").agg(F.collect_list(F.struct(*part, "slice")).alias("met"))
    asking = _texts(docs, reps.join(asked, "node")).withColumn("met", F.explode("met")).select("node", "text", "met.*")
    return _compare(asking, _members(members, *part, "slice"), [*part, "slice"])


def _components(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, group, component_id) for every row; group numbers components, null for empty sets."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = materialize(_scan(docs), "jaccard-sets")
    sketches = [F.min(f"s{i}").alias(f"s{i}") for i in range(SKETCHES)]
    classes = scanned.where("n > 0").groupBy("f1", "f2").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "key")).alias("rep"), *sketches
    )
    named = classes.withColumns({"node": F.monotonically_increasing_id(), "rid": F.col("rep.doc_id"), "rkey": F.col("rep.key")})
    classes = materialize(named.drop("rep"), "jaccard-classes")  # written, so that the numbers stay

    pairs = materialize(_bucket_pairs(classes), "jaccard-pairs")
    stars = materialize(_star_links(docs, classes, pairs), "jaccard-stars")
    groups = materialize(_groups(classes, pairs, stars), "jaccard-groups")
    more = _matrix_links(docs, scanned, classes, groups)
    if more is not None:
        whole = components(stars.unionByName(materialize(more, "jaccard-links")))
        groups = classes.select("node").join(whole, "node", "left").select("node", F.coalesce("component", "node").alias("group"))
    else:
        groups = groups.select("node", F.col("component").alias("group"))
    named = classes.select("node", "f1", "f2", "first").join(groups, "node")
    least = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = materialize(named.join(least, "group").select("f1", "f2", "group", "component_id"), "jaccard-components")
    return scanned.select("doc_id", "key", "n", "f1", "f2").join(broadcast_if_small(named), ["f1", "f2"], "left").drop("f1", "f2")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return _components(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every component, all columns unchanged; texts without words all stay.

    Of rows with the same id and text one stays.
    """
    rows = _components(docs)
    rows = rows.groupBy("group", "doc_id", "key", (F.col("n") > 0).alias("full")).agg(F.count("*").alias("copies"))
    best = rows.where("full").groupBy("group").agg(F.min(F.struct("doc_id", "key", "copies")).alias("best")).select("best.*")
    best = best.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("copies").alias("__copies"))
    empty = rows.where("NOT full").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.lit(1).cast("long").alias("__copies"))
    best = materialize(best.unionByName(empty), "jaccard-kept")
    key = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    kept = docs.join(broadcast_if_small(best), (F.col("__key") == key) & F.col("__id").eqNullSafe(docs["doc_id"].cast("long")))
    once = kept.where("__copies = 1").unionByName(kept.where("__copies > 1").dropDuplicates(["__id", "__key"]))
    return once.drop("__id", "__key", "__copies")
