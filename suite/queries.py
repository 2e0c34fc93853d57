"""Every registered query: (spark, sf_dir) -> DataFrame."""

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.constants import NOT_SPECIFIED
from paperlake.functions import cleanse
from paperlake.functions.feedtext import feed_abstract
from paperlake.functions.metadata import in_types_of, json_field, to_variant
from paperlake.functions.tokens import index_terms
from paperlake.functions.vectors import cosine_distance, text_to_vector, vector_to_text
from paperlake.operators import gate as G
from paperlake.operators import keyword as kw
from paperlake.operators.cells import build_cells, cell_search
from paperlake.operators.context import build_context
from paperlake.operators.dedupe import dedupe_latest
from paperlake.operators.dense import LshTable, dense_search, dense_search_approx, write_lsh_table
from paperlake.operators.embed import embed, embed_balanced, embed_in_batches, fuse_text
from paperlake.operators.enrich import CUES, enrich, enrich_in_batches, fill_missing
from paperlake.operators.fusion import rrf
from paperlake.operators.responses import recover_fields
from paperlake.operators.upsert import upsert
from paperlake.plans import pipelines
from paperlake.plans.search import ask, hybrid_search, result_counts, search_table
from paperlake.schemas import SERVING_VARIANT
from paperlake.session import materialize, scratch_path
from paperlake.sinks import table as keyed
from paperlake.sinks.jdbc import staging_rows
from paperlake.sinks.lake import spread, write_lake, write_slices, write_stage
from paperlake.sources.feed import parse_feed, read_feed
from paperlake.sources.lake import read_lake, read_stage
from paperlake.sources.snapshot import clean_papers, read_snapshot
from paperlake.streaming.feed import stream_feed
from suite import views

DIM = 64
LSH_BITS, LSH_TABLES, LSH_PROBES = 6, 3, 26
#: Search without reduced endings and without the grammar of a search box, as the SQL of most queries has it.
PLAIN = {"stem": False}


# --- sources, cleansing ---------------------------------------------------------


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return views.snapshot_records(spark, sf).select(
        F.col("id").alias("paper_id"),
        cleanse.clean_title(F.col("title")).alias("title"),
        cleanse.clean_abstract(F.col("abstract")).alias("abstract"),
        cleanse.clean_categories(F.col("categories")).alias("categories"),
    )


def authors_join(spark: SparkSession, sf: str) -> DataFrame:
    names = F.coalesce(cleanse.author_names(F.col("authors_parsed")), F.col("authors"))
    return views.snapshot_records(spark, sf).select(F.col("id").alias("paper_id"), names.alias("authors"))


def dates_years(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    published = cleanse.iso_date(text)
    return views.table(spark, sf, "orders").select(
        "o_orderkey", published.alias("published_date"), F.year(published).alias("published_year")
    )


def snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    raw = read_snapshot(spark, views.write_snapshot(spark, sf))
    return clean_papers(raw).drop("ingested_at")


def feed_scan(spark: SparkSession, sf: str) -> DataFrame:
    return parse_feed(read_feed(spark, views.write_feed(spark, sf))).drop("ingested_at")


def feed_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_feed(views.feed_items(spark, sf)).drop("ingested_at")


def lake_by_year(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    orders = views.table(spark, sf, "orders").withColumn("published_year", F.year("o_orderdate"))
    write_lake(spread(orders), path)
    recent = read_lake(spark, path, years=(1995, 1997))
    return recent.groupBy("published_year", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


# --- gate -----------------------------------------------------------------------


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return G.gate(views.papers(spark, sf).select("paper_id", "title", "abstract"), G.backfill_rules())


def gate_accept(spark: SparkSession, sf: str) -> DataFrame:
    return G.accepted(_flagged(spark, sf))


def gate_reject(spark: SparkSession, sf: str) -> DataFrame:
    rejects = G.rejected(_flagged(spark, sf))
    return rejects.withColumn("reject_reasons", F.array_join("reject_reasons", ","))


def gate_report(spark: SparkSession, sf: str) -> DataFrame:
    return G.gate_report(_flagged(spark, sf))


def gate_enforced(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters on storage next to the accepted rows, after the breaker has let the batch pass."""
    dlq = scratch_path(spark, "dlq")
    papers, _ = G.enforce(_flagged(spark, sf), 0.02, dlq)
    return papers.select("paper_id", F.lit("lake").alias("went_to")).unionByName(
        spark.read.parquet(dlq).select("paper_id", F.lit("dlq").alias("went_to"))
    )


def daily_gate(spark: SparkSession, sf: str) -> DataFrame:
    pages = views.texts(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("paper_id"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        feed_abstract(F.col("html")).alias("abstract"),
        "url",
    )
    flagged = G.gate(pages, G.daily_rules(url_prefix="https://"))
    return flagged.select("paper_id", "ok", F.array_join("reject_reasons", ",").alias("reject_reasons"))


def serving_constraints(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.when(F.length("abstract") < 2000, F.slice("embedding", 1, DIM - 1)).otherwise(F.col("embedding"))
    long_list = F.when(F.length("abstract") > 3000, F.repeat("categories", 100)).otherwise(F.col("categories"))
    key = F.when(F.length("abstract") % 7 == 0, None).otherwise(F.col("paper_id"))
    bad_json = F.when(F.length("abstract") % 5 == 0, F.concat("metadata", F.lit("}"))).otherwise(F.col("metadata"))
    rows = views.papers(spark, sf).withColumns({"embedding": odd, "categories": long_list, "paper_id": key, "metadata": bad_json})
    flagged = G.gate(rows, G.serving_rules(DIM))
    return flagged.select("paper_id", "ok", F.array_join("reject_reasons", ",").alias("reject_reasons"))


# --- dedupe, upsert ---------------------------------------------------------------


def dedupe_events(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return dedupe_latest(views.table(spark, sf, "events"), ["user_id"], order)


def _customer_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All segments but one are known already; an update arrives for every well-off customer."""
    customers = views.table(spark, sf, "customer").withColumn("touched", F.lit("old"))
    known = customers.where("c_mktsegment <> 'MACHINERY'")
    updates = customers.where("c_acctbal > 4000").withColumns(
        {
            "c_name": F.concat(F.lit("New "), "c_name"),
            "c_acctbal": F.col("c_acctbal") + 1,
            "c_mktsegment": F.lit(None).cast("string"),
            "touched": F.lit("new"),
        }
    )
    return known, updates


def upsert_full(spark: SparkSession, sf: str) -> DataFrame:
    known, updates = _customer_sides(spark, sf)
    return upsert(known, updates, key="c_custkey")


def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    known, updates = _customer_sides(spark, sf)
    return upsert(
        known, updates, key="c_custkey", update_cols=["c_name", "c_acctbal"], touch="touched",
        now=F.lit("now"), invalidate=["c_nationkey"],
    )


def upsert_published(spark: SparkSession, sf: str) -> DataFrame:
    """The full upsert, through a published table whose touched buckets are rewritten."""
    known, updates = _customer_sides(spark, sf)
    path = scratch_path(spark, "customers")
    keyed.publish(known, path, key="c_custkey", buckets=8)
    keyed.merge_into(updates, path)
    return keyed.resolve(spark, path)


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staging rows of papers that arrive twice, the newer copy with other authors."""
    papers = views.papers(spark, sf).withColumnRenamed("metadata", "metadata_json")
    newer = papers.withColumns(
        {"ingested_at": F.expr("ingested_at + INTERVAL 1 DAY"), "authors": F.concat(F.lit("by "), "paper_id")}
    )
    staged = staging_rows(papers.unionByName(newer))
    back = F.aggregate(text_to_vector(F.col("embedding_str")), F.lit(0.0), lambda total, x: total + x)
    return staged.withColumn("embedding_str", F.round(back, 4)).withColumnRenamed("embedding_str", "vector_sum")


# --- vectors ----------------------------------------------------------------------


def vector_text(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors to text and back, element by element."""
    vectors = views.table(spark, sf, "embeddings").withColumn("text", vector_to_text(F.col("embedding")))
    parts = vectors.select("vec_id", F.posexplode(text_to_vector(F.col("text"))).alias("i", "x"))
    return parts.select("vec_id", "i", F.round(F.col("x").cast("double"), 6).alias("x"))


def cosine_to_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of every vector to the mean of its label."""
    vectors = views.table(spark, sf, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg("x").alias("x"))
    center = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("parts"))
    center = center.select("label", F.transform("parts", lambda p: p["x"]).alias("center"))
    distance = cosine_distance(F.col("embedding"), F.col("center"))
    return vectors.join(center, "label").select("vec_id", F.round(distance, 6).alias("distance"))


def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = dense_search(views.papers(spark, sf), views.questions(spark, sf))
    return found.withColumn("distance", F.round("distance", 6))


def dense_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same search block of questions after block, as for more than can be broadcast."""
    found = dense_search(views.papers(spark, sf), views.questions(spark, sf), query_block=25)
    return found.withColumn("distance", F.round("distance", 6))


def _lsh_table(spark: SparkSession, sf: str) -> LshTable:
    return write_lsh_table(views.papers(spark, sf), scratch_path(spark, "lsh"), DIM, bits=LSH_BITS, tables=LSH_TABLES)


def lsh_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = dense_search_approx(_lsh_table(spark, sf), views.questions(spark, sf), probes=LSH_PROBES)
    return found.withColumn("distance", F.round("distance", 6))


def lsh_all_cells(spark: SparkSession, sf: str) -> DataFrame:
    """With every cell probed the approximate search is exact."""
    found = dense_search_approx(_lsh_table(spark, sf), views.questions(spark, sf), probes=1 << LSH_BITS)
    return found.withColumn("distance", F.round("distance", 6))


def cells_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Vector search on product codes of cells, the best ones ranked anew by their vectors."""
    papers = views.papers(spark, sf)
    found = cell_search(build_cells(papers, DIM), papers, views.questions(spark, sf))
    return found.withColumn("distance", F.round("distance", 6))


# --- keyword search -----------------------------------------------------------------


def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return _fields(kw.build_index(views.papers(spark, sf)).postings)


def index_written(spark: SparkSession, sf: str) -> DataFrame:
    """The same index, stored and read back."""
    return _fields(kw.write_index(views.papers(spark, sf), scratch_path(spark, "index")).postings)


def _fields(postings: DataFrame) -> DataFrame:
    """The postings, field by field."""
    title = F.expr("slice(positions, 1, cast(title_tf AS int))")
    rest = F.expr("slice(positions, cast(title_tf AS int) + 1, cast(abstract_tf AS int))")
    field = lambda name, places: F.struct(F.lit(name).alias("field"), places.alias("positions"))
    fields = F.explode(F.array(field("title", title), field("abstract", rest))).alias("f")
    rows = postings.select("term", "paper_id", F.col("dl").cast("long").alias("dl"), fields).where("size(f.positions) > 0")
    places = F.array_join(F.col("f.positions").cast("array<string>"), " ").alias("positions")
    return rows.select("term", "paper_id", "f.field", F.size("f.positions").cast("long").alias("tf"), places, "dl")


def _keyword(spark: SparkSession, sf: str, terms: DataFrame, **options) -> DataFrame:
    index = kw.scan_index(views.papers(spark, sf), terms)
    return kw.keyword_search(index, terms, **options).withColumn("score", F.round("score", 6))


def keyword_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _keyword(spark, sf, kw.question_terms(views.questions(spark, sf)))


def keyword_any(spark: SparkSession, sf: str) -> DataFrame:
    return _keyword(spark, sf, kw.any_terms(views.questions(spark, sf)))


def keyword_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Any word of the item, only in blocks of papers whose bound reaches the 20th score."""
    terms = kw.any_terms(views.questions(spark, sf))
    index = kw.scan_index(views.papers(spark, sf), terms)
    return kw.bounded_search(index, terms).withColumn("score", F.round("score", 6))


def keyword_weighted(spark: SparkSession, sf: str) -> DataFrame:
    terms = kw.any_terms(views.questions(spark, sf))
    return _keyword(spark, sf, terms, weights={"title": 1.0, "abstract": 0.4})


def keyword_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return _keyword(spark, sf, kw.phrase_terms(views.questions(spark, sf)))


def boolean_terms(questions: DataFrame) -> DataFrame:
    """Any sentence of the item, all its words, but not the last word of the item."""
    sentences = questions.select("query_id", "text", F.posexplode(F.split("text", r"\.")).alias("alt", "sentence"))
    found = index_terms(index_terms(sentences, "sentence", "wanted"), "text", "whole")
    wanted = found.select("query_id", "alt", F.explode(F.array_distinct("wanted")).alias("term"), F.lit(False).alias("negated"))
    last = F.element_at("whole", -1).alias("term")
    return wanted.unionByName(found.select("query_id", "alt", last, F.lit(True).alias("negated")))


def keyword_boolean(spark: SparkSession, sf: str) -> DataFrame:
    return _keyword(spark, sf, boolean_terms(views.questions(spark, sf)))


def keyword_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """Any word of the item, plural endings taken off on both sides."""
    terms = kw.any_terms(views.questions(spark, sf), stem=True)
    index = kw.scan_index(views.papers(spark, sf), terms, stem=True)
    return kw.keyword_search(index, terms).withColumn("score", F.round("score", 6))


def keyword_english(spark: SparkSession, sf: str) -> DataFrame:
    """Any word of the item, in English word stems on both sides."""
    terms = kw.any_terms(views.questions(spark, sf), stem="english")
    index = kw.scan_index(views.papers(spark, sf), terms, stem="english")
    return kw.keyword_search(index, terms).withColumn("score", F.round("score", 6))


def search_box(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the items typed with quotes, `or` and `-`: "a b" -e OR c d, or a phrase without another."""
    w = lambda i: F.coalesce(F.get("ws", F.lit(i)), F.lit(""))
    found = views.questions(spark, sf).select("query_id", kw.words(F.col("text")).alias("ws"))
    quoted = lambda i: F.concat(F.lit('"'), w(i), F.lit("  "), w(i + 1), F.lit('"'))
    first = F.concat(quoted(0), F.lit(" -"), w(5), F.lit(" OR "), w(2), F.lit(" - "), w(3))
    second = F.concat(w(6), F.lit(" -"), quoted(7), F.lit(' or "'), w(9), F.lit(" "), w(10))
    typed = found.select("query_id", first.alias("text")).unionByName(found.select((F.col("query_id") + 1000).alias("query_id"), second.alias("text")))
    return _keyword(spark, sf, kw.search_terms(typed))


def keyword_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Both words required, for every two neighbouring words of an item: many matches, so the cut to 20 acts."""
    found = index_terms(views.questions(spark, sf), "text")
    neighbours = F.zip_with(F.expr("slice(terms, 1, size(terms) - 1)"), F.expr("slice(terms, 2, size(terms))"), lambda a, b: F.concat_ws(" ", a, b))
    pairs = found.where("size(terms) > 1").select("query_id", F.posexplode(neighbours).alias("pos", "text"))
    pairs = pairs.select((F.col("query_id") * 1000 + F.col("pos")).alias("query_id"), "text")
    return _keyword(spark, sf, kw.question_terms(pairs))


# --- hybrid search, context ------------------------------------------------------------


def rrf_fuse(spark: SparkSession, sf: str) -> DataFrame:
    papers, questions = views.papers(spark, sf), views.questions(spark, sf)
    terms = kw.any_terms(questions)
    sparse = kw.keyword_search(kw.scan_index(papers, terms), terms)
    return rrf(dense_search(papers, questions), sparse).withColumn("rrf_score", F.round("rrf_score", 9))


def hybrid(spark: SparkSession, sf: str) -> DataFrame:
    questions = views.questions(spark, sf)
    found = hybrid_search(views.papers(spark, sf), questions, terms=kw.question_terms(questions), **PLAIN)
    return found.withColumns({"rrf_score": F.round("rrf_score", 9), "place": F.col("place").cast("long")})


def store_papers(spark: SparkSession, sf: str) -> str:
    """A text index and a keyed table of the papers, in a new folder."""
    papers, base = views.papers(spark, sf), scratch_path(spark, "stored")
    kw.write_index(papers, f"{base}/index", buckets=16)
    keyed.publish(papers, f"{base}/serving", buckets=8)
    return base


def search_stored(spark: SparkSession, sf: str, base: str) -> DataFrame:
    serving, questions = keyed.resolve(spark, f"{base}/serving"), views.questions(spark, sf)
    index = kw.read_index(spark, f"{base}/index")
    found = hybrid_search(serving, questions, index=index, serving=f"{base}/serving", terms=kw.question_terms(questions), **PLAIN)
    return found.withColumns({"rrf_score": F.round("rrf_score", 9), "place": F.col("place").cast("long")})


def hybrid_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Hybrid search on stored tables: a text index, and a keyed table the results are fetched from."""
    return search_stored(spark, sf, store_papers(spark, sf))


def hybrid_boolean(spark: SparkSession, sf: str) -> DataFrame:
    """The boolean questions in the hybrid search; or the whole item as a phrase, whatever is forbidden."""
    questions = views.questions(spark, sf)
    words = boolean_terms(questions).withColumns({"phrase": F.lit(None).cast("int"), "pos": F.lit(0)})
    phrase = kw.phrase_terms(questions).withColumns({"alt": F.lit(1000), "negated": F.lit(False)})
    found = hybrid_search(views.papers(spark, sf), questions, terms=words.unionByName(phrase), **PLAIN)
    return found.withColumns({"rrf_score": F.round("rrf_score", 9), "place": F.col("place").cast("long")})


def search_after_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the papers are published with their index, the rest is merged in four steps, and some get a new title on the way."""
    path, number = scratch_path(spark, "merged"), F.col("paper_id").cast("long")
    papers, questions = views.papers(spark, sf), views.questions(spark, sf)
    renewed = papers.withColumn("title", F.when(number % 5 == 0, F.concat(F.lit("renewed "), "title")).otherwise(F.col("title")))
    keyed.publish(papers.where(number % 3 != 0), path, buckets=8, companions=[pipelines.text_companion(False)])
    for step in range(4):
        changed = renewed.where(((number % 3 == 0) | (number % 5 == 0)) & (number % 4 == step))
        keyed.merge_into(changed, path, pipelines.kept_companions(spark, path))
    found = search_table(spark, path, questions, terms=kw.question_terms(questions))
    return found.withColumns({"rrf_score": F.round("rrf_score", 9), "place": F.col("place").cast("long")})


def search_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Matches per question in the keyword branch, which may be none."""
    questions = views.questions(spark, sf)
    return result_counts(questions, keyword_topk(spark, sf))


def hybrid_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Results per question after fusion."""
    return result_counts(views.questions(spark, sf), hybrid(spark, sf))


def _context(papers: DataFrame, questions: DataFrame, **search) -> DataFrame:
    context = ask(papers, questions, terms=kw.question_terms(questions), **PLAIN, **search)
    matched = F.transform("matched", lambda m: F.concat_ws("|", m["paper_id"], m["published_date"], m["metadata"]))
    return context.select("query_id", "model", "prompt", F.array_join(matched, ";").alias("matched"))


def rag_context(spark: SparkSession, sf: str) -> DataFrame:
    return _context(views.papers(spark, sf), views.questions(spark, sf))


def _variant_table(spark: SparkSession, sf: str) -> str:
    """A keyed table with typed metadata: half of the papers are published, the rest merged with their metadata as text."""
    path, papers = scratch_path(spark, "variant"), views.papers(spark, sf)
    papers = papers.select([F.col(f.name).cast(SERVING_VARIANT[f.name].dataType if f.name != "metadata" else "string") for f in SERVING_VARIANT])
    even = F.col("paper_id").cast("long") % 2 == 0
    keyed.publish(in_types_of(papers.where(even), SERVING_VARIANT), path)
    keyed.merge_into(papers.where(~even), path)
    return path


def rag_context_variant(spark: SparkSession, sf: str) -> DataFrame:
    """`rag_context` from a stored table with typed metadata."""
    path = _variant_table(spark, sf)
    return _context(keyed.resolve(spark, path), views.questions(spark, sf), serving=path)


def metadata_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Papers by the fields of their typed metadata."""
    papers = keyed.resolve(spark, _variant_table(spark, sf))
    fields = [json_field(papers, "metadata", name).alias(name) for name in ("lang", "source", "none")]
    return papers.select(*fields).groupBy("lang", "source", "none").agg(F.count(F.lit(1)).alias("n"))


def rag_no_match(spark: SparkSession, sf: str) -> DataFrame:
    """Context from the keyword branch alone: questions without a match get the fixed sentence."""
    papers, questions = views.papers(spark, sf), views.questions(spark, sf)
    ranked = keyword_topk(spark, sf).where("rank_sparse <= 3").withColumn("place", F.col("rank_sparse"))
    matches = papers.join(ranked.select("query_id", "paper_id", "place"), "paper_id")
    return build_context(questions, matches).select("query_id", "prompt", F.size("matched").cast("long").alias("n"))


# --- enrichment -------------------------------------------------------------------------


def _fusable(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    metadata = F.concat(
        F.lit('{"core_method": "k='), k, F.lit('", "key_findings": "'), F.col("event_type"), F.lit('"}')
    )
    return views.table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("title"),
        F.when(F.col("value") > 10, F.col("props")).alias("abstract"),
        metadata.alias("metadata_json"),
    )


def json_fuse(spark: SparkSession, sf: str) -> DataFrame:
    return fuse_text(_fusable(spark, sf)).select("event_id", "embedding_text")


def json_fuse_variant(spark: SparkSession, sf: str) -> DataFrame:
    """`json_fuse` from metadata that is stored as VARIANT."""
    events = _fusable(spark, sf).withColumn("metadata_json", to_variant(F.col("metadata_json")))
    return fuse_text(materialize(events, "variant")).select("event_id", "embedding_text")


def response_recover(spark: SparkSession, sf: str) -> DataFrame:
    """Raw responses of every kind, chosen by event type and value."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    full = F.concat(
        F.lit('{"core_method": "m'), k, F.lit('", "dataset_used": "'), kind, F.lit('", "key_findings": "f"}')
    )
    response = (
        F.when(kind == "click", F.concat(F.lit("```json\n"), full, F.lit("\n```")))
        .when(kind == "view", F.concat(F.lit("Sure, here it is: "), full))
        .when(kind == "error", F.concat(F.lit('{"core_method": "m'), k, F.lit('", "key_findings": "cut sho')))
        .when(F.col("value") > 20, F.concat(F.lit('{ , "core_method": '), k, F.lit("}")))
        .when(F.col("value") > 10, F.concat(full, F.lit(" and } more")))
        .otherwise(F.concat(F.lit('["'), k, F.lit('"]')))
    )
    events = views.texts(spark, sf, "events").select("event_id", response.alias("response"))
    return recover_fields(events, "response").drop("response")


def _cued_papers(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(
        F.lit("We propose "), "source", F.lit(" nets. Evaluated on "), "lang", F.lit(" texts. We show that "), "text"
    )
    return views.texts(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") != "es", text).otherwise(" \n ").alias("abstract")
    )


def extract_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(_cued_papers(spark, sf)).drop("abstract")


def cue_extractor():
    """The cue phrases as an injected extractor: one JSON text per abstract."""
    patterns = {field: re.compile(pattern, re.ASCII) for field, pattern in CUES.items()}

    def value(match) -> str:
        return (match.group(1).strip(" ") if match else "") or NOT_SPECIFIED

    return lambda texts: [json.dumps({f: value(p.search(text)) for f, p in patterns.items()}) for text in texts]


def enrich_slices(spark: SparkSession, sf: str) -> DataFrame:
    """The same extractor over slices of the papers, of which one had been finished by an earlier run."""
    stage, papers = scratch_path(spark, "slices"), _cued_papers(spark, sf)
    step = lambda part: enrich_in_batches(part, cue_extractor)
    first = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 2
    write_stage(step(papers.where(first)), f"{stage}/slice=2-of-4")
    write_slices(papers, stage, 4, step, key="doc_id")
    return read_stage(spark, stage).drop("abstract")


def enrich_batches(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_in_batches(_cued_papers(spark, sf), cue_extractor).drop("abstract")


def default_fill(spark: SparkSession, sf: str) -> DataFrame:
    labeled = views.texts(spark, sf, "documents").join(views.table(spark, sf, "labels"), "doc_id", "left")
    record = F.when(F.col("quality").isNotNull(), F.to_json(F.struct("quality", "toxic")))
    return fill_missing(labeled.select("doc_id", record.alias("metadata_json")))


def _parts(embedded: DataFrame) -> DataFrame:
    parts = embedded.select("doc_id", F.posexplode("embedding").alias("i", "x")).where("x <> 0")
    return parts.select("doc_id", "i", F.round(F.col("x").cast("double"), 6).alias("x"))


def embed_hash(spark: SparkSession, sf: str) -> DataFrame:
    documents = views.texts(spark, sf, "documents").select("doc_id", "text")
    return _parts(embed(documents, "text", dim=DIM))


def embed_batches(spark: SparkSession, sf: str) -> DataFrame:
    documents = views.texts(spark, sf, "documents").select("doc_id", "text")
    return _parts(embed_in_batches(documents, "text", dim=DIM))


def embed_by_length(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of the documents twice, each encoded once, in batches of like length."""
    documents = views.texts(spark, sf, "documents").select("doc_id", "text")
    return _parts(embed_balanced(documents.unionByName(documents), "text", dim=DIM)).distinct()


# --- whole pipelines -----------------------------------------------------------------------


def pipeline_load(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot to serving table: backfill, metadata, embeddings, loading."""
    base = scratch_path(spark, "pipeline")
    pipelines.run_backfill(spark, views.write_snapshot(spark, sf), f"{base}/lake", f"{base}/dlq", max_error_rate=0.05)
    pipelines.run_metadata(spark, f"{base}/lake", f"{base}/metadata")
    pipelines.run_embeddings(spark, f"{base}/metadata", f"{base}/embeddings", dim=DIM)
    pipelines.run_loading(spark, f"{base}/embeddings", f"{base}/serving", dim=DIM)
    serving = keyed.resolve(spark, f"{base}/serving")
    return serving.select(
        "paper_id", "title", "abstract", "authors", "categories", "url", "published_date", "published_year",
        "metadata", F.size("embedding").cast("long").alias("dim"),
    )


def stage_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Each stage read back: what it holds of every paper."""
    base = scratch_path(spark, "stages")
    papers = clean_papers(read_snapshot(spark, views.write_snapshot(spark, sf)))
    write_lake(papers, f"{base}/lake")
    pipelines.run_metadata(spark, f"{base}/lake", f"{base}/metadata")
    pipelines.run_embeddings(spark, f"{base}/metadata", f"{base}/embeddings", dim=DIM)
    none = F.lit(None).cast("string")
    extras = {"lake": (none, none), "metadata": (F.col("metadata_json"), none), "embeddings": (F.col("metadata_json"), F.size("embedding").cast("string"))}
    held = [
        read_stage(spark, f"{base}/{stage}").select(
            F.lit(stage).alias("stage"), "paper_id", "title", "abstract", "published_year", metadata.alias("metadata"), dim.alias("dim")
        )
        for stage, (metadata, dim) in extras.items()
    ]
    return held[0].unionByName(held[1]).unionByName(held[2])


def _known_papers(spark: SparkSession, sf: str) -> DataFrame:
    """A serving table in which every paper of the secure pages is already known and enriched."""
    from paperlake.schemas import SERVING

    known = feed_parse(spark, sf).where("url LIKE 'https%'").withColumns(
        {
            "title": F.lit("stale"),
            "ingested_at": F.lit("2020-01-01 00:00:00").cast("timestamp"),
            "embedding": F.array(F.lit(1.0)),
            "metadata": F.concat(F.lit("kept "), "paper_id"),
        }
    )
    return known.select([F.col(f.name).cast(f.dataType) for f in SERVING.fields])


def _served(spark: SparkSession, path: str) -> DataFrame:
    return keyed.resolve(spark, path).withColumn("dim", F.size("embedding").cast("long")).drop("embedding")


_NOW = "2026-02-02 00:00:00"


def daily_merge(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "daily")
    keyed.publish(_known_papers(spark, sf), f"{base}/serving")
    pipelines.run_daily(
        spark, views.write_feed(spark, sf), f"{base}/serving", f"{base}/dlq", url_prefix="http",
        now=F.lit(_NOW).cast("timestamp"),
    )
    return _served(spark, f"{base}/serving")


def feed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same feed, arriving file by file."""
    base = scratch_path(spark, "stream")
    keyed.publish(_known_papers(spark, sf), f"{base}/serving")
    stream = stream_feed(
        spark, views.write_feed(spark, sf, files=3), f"{base}/serving", f"{base}/dlq", f"{base}/checkpoint",
        url_prefix="http", now=F.lit(_NOW).cast("timestamp"), max_files=1,
    )
    stream.awaitTermination()
    return _served(spark, f"{base}/serving")


QUERIES = {
    "clean_text": clean_text,
    "authors_join": authors_join,
    "dates_years": dates_years,
    "snapshot_scan": snapshot_scan,
    "feed_scan": feed_scan,
    "feed_parse": feed_parse,
    "lake_by_year": lake_by_year,
    "gate_accept": gate_accept,
    "gate_reject": gate_reject,
    "gate_report": gate_report,
    "gate_enforced": gate_enforced,
    "daily_gate": daily_gate,
    "serving_constraints": serving_constraints,
    "dedupe_latest": dedupe_events,
    "upsert_full": upsert_full,
    "upsert_partial": upsert_partial,
    "upsert_published": upsert_published,
    "staging_rows": staging,
    "vector_text": vector_text,
    "cosine_to_mean": cosine_to_mean,
    "dense_topk": dense_topk,
    "dense_blocks": dense_blocks,
    "lsh_topk": lsh_topk,
    "lsh_all_cells": lsh_all_cells,
    "cells_topk": cells_topk,
    "inverted_index": inverted_index,
    "index_written": index_written,
    "keyword_topk": keyword_topk,
    "keyword_any": keyword_any,
    "keyword_bounded": keyword_bounded,
    "keyword_weighted": keyword_weighted,
    "keyword_phrase": keyword_phrase,
    "keyword_boolean": keyword_boolean,
    "keyword_stemmed": keyword_stemmed,
    "keyword_english": keyword_english,
    "search_box": search_box,
    "keyword_pairs": keyword_pairs,
    "rrf_fuse": rrf_fuse,
    "hybrid_search": hybrid,
    "hybrid_stored": hybrid_stored,
    "hybrid_boolean": hybrid_boolean,
    "search_after_merge": search_after_merge,
    "search_counts": search_counts,
    "hybrid_counts": hybrid_counts,
    "rag_context": rag_context,
    "rag_context_variant": rag_context_variant,
    "metadata_fields": metadata_fields,
    "rag_no_match": rag_no_match,
    "json_fuse": json_fuse,
    "json_fuse_variant": json_fuse_variant,
    "response_recover": response_recover,
    "extract_metadata": extract_metadata,
    "enrich_in_batches": enrich_batches,
    "enrich_slices": enrich_slices,
    "default_fill": default_fill,
    "embed_hash": embed_hash,
    "embed_batches": embed_batches,
    "embed_balanced": embed_by_length,
    "pipeline_load": pipeline_load,
    "stage_tables": stage_tables,
    "daily_merge": daily_merge,
    "feed_stream": feed_stream,
}
