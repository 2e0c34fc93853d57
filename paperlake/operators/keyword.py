"""Keyword search: inverted index, boolean matching and BM25 ranking as joins and aggregates.

A question is a table of terms `(query_id, term)`; all its terms are required. Optional columns
add what a search box offers: `alt` numbers alternatives (any may match), `negated` marks terms
that must not occur, and `phrase` with `pos` asks for terms at consecutive places. Tables made
from plain texts by the functions below also carry what `_prepared_terms` would work out.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.tokens import Stem, index_terms, is_stop_word, placed_terms, reduced, words
from paperlake.operators.dedupe import top_per_group
from paperlake.session import broadcast_if_small, data_bytes, is_small, materialize, parts_for, probe, ship_package
from paperlake.sinks.lake import CODEC

TITLE, ABSTRACT = "title", "abstract"
BUCKET = "term_bucket"
_PUSHED_TERMS = 10
#: Terms that stand as a list in the plan of a scan of texts.
_ROW_TERMS = 10_000
#: Candidates that one task joins with the terms of their questions, which makes a row for each.
_TASK_CANDIDATES = 10_000
#: Bytes of text behind one folder of a stored index.
_FOLDER_BYTES = 64 << 20
#: Stands in the place of a term in the one row of a paper that tells its length; no word is empty.
_PAPER = ""
#: A quoted phrase, with its closing quote or up to the end, or what stands between blanks and quotes.
_PIECE = r'-*"[^"]*"?|[^\s"]+'


class WordForms(ValueError):
    """An index whose words were reduced in another way than those of the questions."""


class TextIndex(NamedTuple):
    """Postings `(term, paper_id, title_tf, abstract_tf, positions, dl)` and one row `(n_docs, avg_dl)`.

    An index cut down to the terms of some questions knows the size of that term table.
    """

    postings: DataFrame
    corpus: DataFrame
    stem: Stem = False
    asked_bytes: int | None = None


# --- text analysis ------------------------------------------------------------


def paper_postings(docs: DataFrame, stem: Stem = False, only: list[str] | None = None) -> DataFrame:
    """Every paper's postings (of the terms `only`), one row per (term, paper), and one row per paper with an empty term.

    Title and abstract form one sequence of words. Stop words are not indexed but keep their place, so phrases can tell `a b`
    from `a of b`. All words of a paper stand in one row, so they are sorted and counted there: nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    fields = docs.select("paper_id", words(F.col(TITLE)).alias("title"), words(F.col(ABSTRACT)).alias("abstract"))
    joined = fields.select("paper_id", F.concat("title", "abstract").alias("words"), F.size("title").alias("n_title"))
    rows = joined.select("paper_id", placed_terms(F.col("words"), F.col("n_title"), stem, only).alias("placed"))
    paper = F.struct(F.lit(_PAPER).alias("term"), F.lit(0).cast("long").alias("title_tf"), F.expr("CAST(array() AS array<int>)").alias("positions"))
    rows = rows.select("paper_id", F.col("placed.dl").alias("dl"), F.explode(F.concat("placed.found", F.array(paper))).alias("p"))
    return rows.select(
        F.col("p.term").alias("term"),
        "paper_id",
        F.col("p.title_tf").alias("title_tf"),
        (F.size("p.positions") - F.col("p.title_tf")).alias("abstract_tf"),
        F.col("p.positions").alias("positions"),
        "dl",
    )


def _distinct_words(queries: DataFrame, stem: Stem) -> DataFrame:
    return index_terms(queries, "text", stem=stem).select("query_id", F.array_distinct("terms").alias("terms"))


def question_terms(queries: DataFrame, stem: Stem = False) -> DataFrame:
    """The distinct words of each question, all required."""
    found = _distinct_words(queries, stem)
    return found.select(
        "query_id", F.explode_outer("terms").alias("term"), F.size("terms").alias("required"), F.lit(True).alias("scores")
    ).where("term IS NOT NULL")


def any_terms(queries: DataFrame, stem: Stem = False) -> DataFrame:
    """The distinct words of each question, any of which may match."""
    found = _distinct_words(queries, stem)
    return found.select(
        "query_id", F.posexplode_outer("terms").alias("alt", "term"), F.lit(1).alias("required"), F.lit(True).alias("scores"), F.lit(True).alias("any")
    ).where("term IS NOT NULL")


def phrase_terms(queries: DataFrame, stem: Stem = False) -> DataFrame:
    """The words of each question as one phrase."""
    return _spelt(queries.select("query_id", words(F.col("text")).alias("found")), stem).select("query_id", "term", "pos", F.lit(0).alias("phrase"))


def _spelt(texts: DataFrame, stem: Stem) -> DataFrame:
    """One row for each word in `found` that is indexed, in the forms of the index, with its place."""
    both = texts.withColumn("both", F.arrays_zip(F.col("found").alias("word"), reduced(F.col("found"), stem).alias("term")))
    spelt = both.select(*texts.columns, F.posexplode("both").alias("pos", "both")).select(*texts.columns, "pos", "both.word", "both.term")
    return spelt.where(~is_stop_word("word")).drop("found", "word")


def search_terms(queries: DataFrame, stem: Stem = False) -> DataFrame:
    """What is typed into a search box, as a term table: blanks between words mean all of them, `or` starts an alternative, quotes
    make a phrase, a leading `-` forbids a word or a phrase.

    A quote that is never closed goes on to the end of the text. Bare signs, empty quotes and stop words outside phrases
    count as blanks, so an `or` without words on one side does nothing. Several words without blanks between them (`state-of-the-art`)
    are a phrase. An alternative of forbidden words only matches nothing.
    """
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_PIECE), F.lit(0))
    rows = queries.select("query_id", F.posexplode(pieces).alias("piece", "spelling"))
    before = Window.partitionBy("query_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_or = F.lower("spelling") == "or"
    rows = rows.withColumn("alt", F.count_if(is_or).over(before).cast("int")).where(~is_or)
    rows = rows.select("query_id", "alt", "piece", F.col("spelling").startswith("-").alias("negated"), words(F.col("spelling")).alias("found"))
    spelt = _spelt(rows, stem)
    together = F.count(F.lit(1)).over(Window.partitionBy("query_id", "piece")) > 1
    phrase, pos = F.when(together, F.col("piece")), F.when(together, F.col("pos")).otherwise(0)
    return spelt.select("query_id", "term", "alt", "negated", phrase.alias("phrase"), pos.alias("pos"))


# --- index ---------------------------------------------------------------------


def _totals(rows: DataFrame) -> DataFrame:
    """Number and mean length of the papers whose rows these are."""
    papers = rows.where(F.col("term") == _PAPER)
    return papers.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avg_dl"))


def build_index(docs: DataFrame, stem: Stem = False) -> TextIndex:
    """The inverted index of a table of papers, not yet written."""
    rows = paper_postings(docs, stem)
    return TextIndex(rows.where(F.col("term") != _PAPER), _totals(rows), stem)


def kept_index(rows: DataFrame, stem: Stem = False) -> TextIndex:
    """The index whose rows are those of `paper_postings`, for instance as a companion of a keyed table."""
    return TextIndex(rows.where(F.col("term") != _PAPER), _totals(rows), stem)


def write_index(docs: DataFrame, path: str, stem: Stem = False, buckets: int | None = None) -> TextIndex:
    """Store the index of all papers by hash of the term, in a new folder. Folders follow the bytes of the texts.

    One shuffle of one row per (term, paper). The rebalance hint lets adaptive execution split a
    folder by its bytes, so a term that a large share of the papers holds is written by several tasks.
    """
    spark = docs.sparkSession
    buckets = buckets or parts_for(data_bytes(docs.select("paper_id", TITLE, ABSTRACT)), _FOLDER_BYTES, 16, 4096)
    rows = paper_postings(docs, stem).withColumn(BUCKET, F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    (
        rows.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, "term")
        .write.partitionBy(BUCKET)
        .option("compression", CODEC)
        .parquet(f"{path}/postings")
    )
    totals = _totals(spark.read.parquet(f"{path}/postings"))
    totals.select("*", F.lit(buckets).alias("buckets"), F.lit(str(stem or "")).alias("stem")).coalesce(1).write.parquet(f"{path}/corpus")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> TextIndex:
    """The index stored there."""
    corpus = spark.read.parquet(f"{path}/corpus")
    stem = corpus.first()["stem"]
    postings = spark.read.parquet(f"{path}/postings").where(F.col("term") != _PAPER)
    return TextIndex(postings, corpus, {"": False, "True": True}.get(stem, stem))


def lookup(index: TextIndex, terms: DataFrame) -> TextIndex:
    """The index cut down to the given terms.

    An index stored by term is read only in the folders that can hold the terms (at most one number per
    folder comes to the driver). A handful of terms is pushed into the scan as a filter as well,
    which skips row groups; more are probed by a join. What is left is written once, because
    matching reads it twice.
    """
    wanted = terms.select("term").distinct()
    asked = data_bytes(terms)
    postings = index.postings
    if BUCKET in postings.columns:
        bucket = F.pmod(F.xxhash64("term"), F.lit(index.corpus.first()["buckets"])).cast("int")
        folders = [row[0] for row in wanted.select(bucket).distinct().collect()]
        postings = postings.where(F.col(BUCKET).isin(folders))
    few = [row[0] for row in wanted.limit(_PUSHED_TERMS + 1).collect()]
    if len(few) <= _PUSHED_TERMS:
        return index._replace(postings=postings.where(F.col("term").isin(few)), asked_bytes=asked)
    found = probe(postings, wanted, "term", "paper_id", "left_semi", asked)
    return index._replace(postings=materialize(found.drop(BUCKET), "postings"), asked_bytes=asked)


def scan_index(docs: DataFrame, terms: DataFrame, stem: Stem = False) -> TextIndex:
    """Postings of the given terms straight from the papers, for search without a stored index.

    One pass over the text, without a shuffle: words are counted in the row of their paper (up to `_ROW_TERMS` terms, only
    wanted ones are looked at there; more are probed by a join), and the counts of wanted terms are written to shared scratch space in their final form. The row of each
    paper is written next to them, so the totals are read from storage, whatever tasks were repeated.
    """
    wanted, asked = terms.select("term").where("term IS NOT NULL").distinct(), data_bytes(terms)
    some = [row[0] for row in wanted.limit(_ROW_TERMS + 1).collect()]
    if len(some) <= _ROW_TERMS:
        hits = paper_postings(docs, stem, some)
    else:
        wanted = wanted.unionByName(docs.sparkSession.range(1).select(F.lit(_PAPER).alias("term")))
        hits = probe(paper_postings(docs, stem), wanted, "term", "paper_id", "left_semi", asked)
    hits = materialize(hits, "postings")
    return TextIndex(hits.where(F.col("term") != _PAPER), _totals(hits), stem, asked)


# --- search ----------------------------------------------------------------------


def inverse_frequency(df: Column, n_docs: Column) -> Column:
    """The rarer a term, the more it counts; never negative."""
    return F.log(F.lit(1.0) + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avg_dl: Column) -> Column:
    """What a term adds the more often it occurs, relative to the length of the document."""
    length = F.lit(1.0 - K.BM25_B) + F.lit(K.BM25_B) * dl / avg_dl
    return tf * (K.BM25_K1 + 1.0) / (tf + F.lit(K.BM25_K1) * length)


def _prepared_terms(terms: DataFrame) -> DataFrame:
    """Complete the optional columns; count what each alternative requires.

    `scores` marks one row per (query, term), so a term shared by alternatives counts once.
    """
    defaults = {"alt": F.lit(0), "negated": F.lit(False), "phrase": F.lit(None).cast("int"), "pos": F.lit(0)}
    full = terms.withColumns({c: v for c, v in defaults.items() if c not in terms.columns})
    if {"required", "scores"} <= set(terms.columns):
        return full  # made from the words of a text, where both are known
    full = full.select("query_id", "term", *defaults).distinct()
    alternative = Window.partitionBy("query_id", "alt")
    same_term = Window.partitionBy("query_id", "term").orderBy("negated", "alt", "phrase", "pos")
    return full.withColumns(
        {
            "required": F.count_if(~F.col("negated")).over(alternative),
            "phrase_size": F.count(F.lit(1)).over(Window.partitionBy("query_id", "alt", "negated", "phrase")),
            "scores": ~F.col("negated") & (F.row_number().over(same_term) == 1),
        }
    )


def _phrases_hold(words_found: Column) -> Column:
    """True if for every phrase some place in the document starts all its words."""

    def holds(phrase: Column) -> Column:
        starts = F.transform(
            F.filter(words_found, lambda w: w["phrase"] == phrase),
            lambda w: F.transform(w["positions"], lambda p: p - w["pos"]),
        )
        common = F.reduce(F.slice(starts, 2, F.size(starts)), F.get(starts, F.lit(0)), lambda a, b: F.array_intersect(a, b))
        return F.size(common) > 0

    return F.forall(F.array_distinct(F.transform(words_found, lambda w: w["phrase"])), holds)


def _stands(words_found: Column) -> Column:
    """True if all words of one phrase were found, at consecutive places."""
    return (F.size(words_found) == F.get(words_found, F.lit(0))["phrase_size"]) & _phrases_hold(words_found)


def _candidate_matches(postings: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """Postings of the asked terms, only in papers that hold the rarest required term of an alternative.

    A paper without that term cannot match, so frequent terms cost nothing where they stand alone. Each candidate meets the
    few terms of its question, not all postings of its paper. Many candidates and the postings are dealt out by paper, in
    parts that follow the number of candidates; there they look their terms up in the one row that holds the postings of their
    paper, so that no row for each candidate and term is shuffled.
    """
    rarest = Window.partitionBy("query_id", "alt").orderBy(F.col("rarity").desc_nulls_first(), "term", "pos")
    leads = asked.where("NOT negated").withColumn("place", F.row_number().over(rarest)).where("place = 1")
    hits = probe(postings.select("paper_id", "term"), leads.select("query_id", "term").distinct(), "term", "paper_id", size=size)
    found = materialize(hits.select("paper_id", "query_id").distinct(), "candidates")
    parts = parts_for(found.count(), _TASK_CANDIDATES, 1, 4096)
    papers = found.select("paper_id").distinct()
    if is_small(few := data_bytes(papers)):
        postings = postings.join(broadcast_if_small(papers, few), "paper_id", "left_semi")

    def with_terms(candidates: DataFrame) -> DataFrame:
        key = F.struct("query_id")
        return probe(candidates.withColumn("key", key), asked.withColumn("key", key).drop("query_id"), "key", "paper_id", size=size).drop("key")

    if parts == 1:
        return postings.join(with_terms(found), ["paper_id", "term"])
    found, held = found.repartition(parts, "paper_id"), _held(postings.repartition(parts, "paper_id"))
    # Terms beyond a broadcast meet the candidates by a shuffle, which the postings are kept out of.
    met = with_terms(found.join(held, "paper_id")) if is_small(size) else with_terms(found).join(held, "paper_id")
    return met.withColumn("one", F.explode(F.col("held")[F.col("term")])).select(*met.drop("held").columns, "one.*")


def _held(postings: DataFrame) -> DataFrame:
    """One row per paper with its postings by term; a list of them, as papers of one id add up."""
    values = [c for c in postings.columns if c not in ("paper_id", "term")]
    lists = postings.groupBy("paper_id", "term").agg(F.collect_list(F.struct(*values)).alias("list"))
    return lists.groupBy("paper_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "list"))).alias("held"))


def _alternatives_hold(found: Column, phrases: bool) -> Column:
    """True if some alternative has all its terms, none of the forbidden ones, and its phrases."""

    def holds(alt: Column) -> Column:
        mine = F.filter(found, lambda w: w["alt"] == alt)
        wanted = F.filter(mine, lambda w: ~w["negated"])
        complete = (F.size(wanted) > 0) & (F.size(wanted) == F.get(wanted, F.lit(0))["required"])
        if not phrases:
            return F.coalesce(complete & (F.size(wanted) == F.size(mine)), F.lit(False))
        complete = complete & ~F.exists(mine, lambda w: w["negated"] & w["phrase"].isNull())
        complete = complete & _phrases_hold(F.filter(wanted, lambda w: w["phrase"].isNotNull()))
        forbidden = F.filter(mine, lambda w: w["negated"] & w["phrase"].isNotNull())
        stands = lambda phrase: _stands(F.filter(forbidden, lambda w: w["phrase"] == phrase))
        complete = complete & ~F.exists(F.array_distinct(F.transform(forbidden, lambda w: w["phrase"])), stands)
        return F.coalesce(complete, F.lit(False))

    return F.exists(F.array_distinct(F.transform(found, lambda w: w["alt"])), holds)


def match_terms(index: TextIndex, terms: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Every paper that satisfies a question, with its score -> (query_id, paper_id, score).

    The score is BM25 (Robertson and Zaragoza 2009): per term, its inverse frequency times its
    saturation. The first is worked out on the few asked terms and the second once per posting,
    so that a match only multiplies them. What matches is aggregated once, by question and paper.

    `weights` boost fields by multiplying term counts. An alternative made of negated terms
    only matches nothing.
    """
    boost = {field: F.lit(float((weights or {}).get(field, 1.0))) for field in (TITLE, ABSTRACT)}
    tf = F.col("title_tf") * boost[TITLE] + F.col("abstract_tf") * boost[ABSTRACT]
    corpus = index.corpus.select(F.struct("n_docs", "avg_dl")).scalar()
    has_phrases = "phrase" in terms.columns
    kept = ["paper_id", "term", saturation(tf, F.col("dl"), corpus["avg_dl"]).alias("saturation")]
    postings = index.postings.select(*kept, *(["positions"] if has_phrases else []))
    frequency = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rarity = frequency.select("term", inverse_frequency(F.col("df"), corpus["n_docs"]).alias("rarity"))

    asked = _prepared_terms(terms)
    # The completed table has the rows of the given one and seven narrow columns more.
    size = 4 * (data_bytes(terms) if index.asked_bytes is None else index.asked_bytes)
    asked = asked.join(rarity, "term", "left")
    if {"any", "scores"} <= set(terms.columns):
        matches = probe(postings, asked, "term", "paper_id", size=size)
    else:
        matches = _candidate_matches(postings, asked, size)
    score = F.sum(F.when(F.col("scores"), F.col("rarity") * F.col("saturation")).otherwise(0.0)).alias("score")
    if {"any", "scores"} <= set(terms.columns):
        return matches.groupBy("query_id", "paper_id").agg(score)
    if {"required", "scores"} <= set(terms.columns) and "alt" not in terms.columns:  # all words
        found = matches.groupBy("query_id", "paper_id").agg(score, F.count(F.lit(1)).alias("matched"), F.max("required").alias("required"))
        return found.where("matched = required").drop("matched", "required")
    word = F.struct("alt", "negated", "required", *(["phrase", "phrase_size", "pos", "positions"] if has_phrases else []))
    found = matches.groupBy("query_id", "paper_id").agg(score, F.collect_list(word).alias("found"))
    return found.where(_alternatives_hold(F.col("found"), has_phrases)).drop("found")


def _blocked(postings: DataFrame, blocks: int) -> DataFrame:
    return postings.withColumn("block", F.pmod(F.xxhash64("paper_id"), F.lit(blocks)).cast("long"))


def bounded_search(
    index: TextIndex, terms: DataFrame, k: int = K.CANDIDATES, weights: dict[str, float] | None = None, block_papers: int = 4, seeds: int = 2
) -> DataFrame:
    """`keyword_search` for term tables any of whose words may match, scoring only blocks of papers that can reach the k best.

    Papers lie in small blocks by a hash of their id. The largest saturation of each term in a block bounds what any of its
    papers can score (block-max indexes, Ding and Suel 2011). The blocks with the highest bounds are scored first, `seeds` * k
    of them per question; the k-th best score found there is a threshold, and blocks whose bound is lower are never joined
    to their postings. The result is the same, rank by rank.

    This pays for short questions, which few blocks can answer well. With many words per question the bounds are as many
    rows as half of the postings.
    """
    boost = {field: F.lit(float((weights or {}).get(field, 1.0))) for field in (TITLE, ABSTRACT)}
    tf = F.col("title_tf") * boost[TITLE] + F.col("abstract_tf") * boost[ABSTRACT]
    corpus = index.corpus.first()
    blocks = max(1, corpus["n_docs"] // block_papers)
    value = saturation(tf, F.col("dl"), F.lit(corpus["avg_dl"])).alias("saturation")
    postings = _blocked(index.postings.select("paper_id", "term", value), blocks)
    most = postings.groupBy("term", "block").agg(F.max("saturation").alias("most"), F.count(F.lit(1)).alias("n"))
    most = materialize(most, "maxima")  # beside the postings, and a few of them for a frequent term
    rarity = inverse_frequency(F.col("df"), F.lit(corpus["n_docs"])).alias("rarity")
    frequency = most.groupBy("term").agg(F.sum("n").alias("df")).select("term", rarity)
    asked = terms.select("query_id", "term").distinct().join(broadcast_if_small(frequency), "term")
    size = 2 * (data_bytes(terms) if index.asked_bytes is None else index.asked_bytes)
    met = probe(most.select("term", "block", "most"), asked, "term", "block", size=size)
    met = materialize(met.select("query_id", "term", "block", "rarity", (F.col("rarity") * F.col("most")).alias("part")), "bounds")
    bounds = materialize(met.groupBy("query_id", "block").agg(F.sum("part").alias("bound")), "bounds")

    def scored(chosen: DataFrame) -> DataFrame:
        """Scores of the papers in some blocks of a question; only their postings are joined."""
        wanted = met.join(broadcast_if_small(chosen), ["query_id", "block"], "left_semi").select("query_id", "term", "block", "rarity")
        key = F.struct("term", "block")
        rows = probe(postings.withColumn("key", key).drop("term", "block"), wanted.withColumn("key", key).drop("term", "block"), "key", "paper_id")
        return rows.groupBy("query_id", "paper_id").agg(F.sum(F.col("rarity") * F.col("saturation")).alias("score"))

    first = top_per_group(bounds, ["query_id"], [F.col("bound").desc(), F.col("block")], seeds * k, "place").select("query_id", "block")
    first = materialize(first, "seeds")
    found = materialize(scored(first), "scores")
    reached = top_per_group(found, ["query_id"], [F.col("score").desc()], k, "place").where(F.col("place") == k)
    threshold = broadcast_if_small(reached.select("query_id", F.col("score").alias("least")))
    # Scores count at nine digits, so a bound must be lower by more than that to rule a block out.
    able = bounds.join(threshold, "query_id", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 1e-8))
    rest = able.select("query_id", "block").join(broadcast_if_small(first), ["query_id", "block"], "left_anti")
    return _best(found.unionByName(scored(materialize(rest, "able"))), k)


def _best(matches: DataFrame, k: int) -> DataFrame:
    rounded = matches.withColumn("score", F.round("score", 9))
    best = top_per_group(rounded, ["query_id"], [F.col("score").desc(), F.col("paper_id")], k, "rank_sparse")
    return best.withColumn("rank_sparse", F.col("rank_sparse").cast("long"))


def keyword_search(
    index: TextIndex, terms: DataFrame, k: int = K.CANDIDATES, weights: dict[str, float] | None = None
) -> DataFrame:
    """The k best matches of every question -> (query_id, paper_id, score, rank_sparse).

    Scores are compared at nine digits, so the order in which terms are added cannot change a
    rank; ties go to the smaller id.
    """
    return _best(match_terms(index, terms, weights), k)
