"""The batch jobs: from a snapshot or a feed to the serving table."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.metadata import in_types_of
from paperlake.functions.tokens import Stem
from paperlake.operators import cells
from paperlake.operators import gate as G
from paperlake.operators import keyword as kw
from paperlake.operators.dedupe import dedupe_latest
from paperlake.operators.embed import Encoder, embed, embed_in_batches, fuse_text
from paperlake.operators.enrich import Extractor, enrich, enrich_in_batches, fill_missing
from paperlake.schemas import PAPER, SERVING, SERVING_VARIANT
from paperlake.session import materialize, scratch_scope
from paperlake.sinks import table
from paperlake.sinks.lake import spread, write_lake, write_slices, write_stage
from paperlake.sources.feed import parse_feed, read_feed
from paperlake.sources.lake import read_stage
from paperlake.sources.snapshot import MALFORMED, clean_papers, read_snapshot

#: What is kept with a serving table: the postings of its texts, and the codes of its vectors.
TEXT, CELLS = "text", "cells"
FEED_COLUMNS = [c for c in PAPER.fieldNames() if c not in ("paper_id", "ingested_at")]


def run_backfill(
    spark: SparkSession, snapshot: str, lake: str, dlq: str, max_error_rate: float = K.BACKFILL_ERROR_LIMIT
) -> G.GateReport:
    """Snapshot -> cleansing -> gate -> lake by year. A batch that fails the gate leaves the lake alone."""
    with scratch_scope(spark):
        flagged = G.gate(clean_papers(read_snapshot(spark, snapshot, keep_malformed=True)), G.backfill_rules())
        papers, report = G.enforce(flagged, max_error_rate, dlq)  # dead letters keep the text of malformed lines
        write_lake(papers.drop(MALFORMED), lake)
    return report


def _run_stage(rows: DataFrame, stage: str, step: Callable[[DataFrame], DataFrame], partitions: int | None, slices: int | None) -> None:
    """The step on rows dealt out evenly; written in one go, or in slices that a later call need not run again."""
    spread_step = lambda part: step(spread(part, partitions))
    if slices:
        write_slices(rows, stage, slices, spread_step)
    else:
        write_stage(spread_step(rows), stage)


def run_metadata(
    spark: SparkSession,
    lake: str,
    stage: str,
    extractor: Extractor | None = None,
    partitions: int | None = None,
    batch_rows: int = K.METADATA_BATCH_ROWS,
    slices: int | None = None,
) -> None:
    """Lake -> metadata stage. An injected extractor gets at most `batch_rows` abstracts at a time."""

    def step(papers: DataFrame) -> DataFrame:
        enriched = enrich_in_batches(papers, extractor, "abstract", batch_rows) if extractor else enrich(papers, "abstract")
        return fill_missing(enriched)

    _run_stage(read_stage(spark, lake), stage, step, partitions, slices)


def run_embeddings(
    spark: SparkSession,
    metadata_stage: str,
    stage: str,
    encoder: Encoder | None = None,
    dim: int = K.EMBEDDING_DIM,
    partitions: int | None = None,
    batch_rows: int = K.EMBEDDING_BATCH_ROWS,
    slices: int | None = None,
) -> None:
    """Metadata stage -> embedding stage. An injected encoder gets at most `batch_rows` texts at a time."""

    def step(papers: DataFrame) -> DataFrame:
        texts = fuse_text(papers)
        made = embed_in_batches(texts, "embedding_text", encoder, dim, batch_rows) if encoder else embed(texts, "embedding_text", None, dim)
        return made.drop("embedding_text")

    _run_stage(read_stage(spark, metadata_stage), stage, step, partitions, slices)


def serving_rows(enriched: DataFrame) -> DataFrame:
    """Enriched papers in the columns of the serving table, the newest row of every key."""
    unique = dedupe_latest(enriched, ["paper_id"], [F.col("ingested_at").desc_nulls_last()])
    named = unique.withColumnRenamed("metadata_json", "metadata")
    return named.select([F.col(f.name).cast(f.dataType) for f in SERVING.fields])


def text_companion(stem: Stem = "english") -> table.Companion:
    """Postings by paper bucket, sorted by term."""
    return table.Companion(TEXT, lambda rows: kw.paper_postings(rows, stem), ("term",), {"stem": stem})


def cells_companion(spark: SparkSession, model_path: str) -> table.Companion:
    """Cell and code of every vector by paper bucket, sorted by cell."""
    model = cells.read_model(spark, model_path)
    return table.Companion(CELLS, lambda rows: cells.code_rows(rows, model), ("cell",), {"model": model_path})


def kept_companions(spark: SparkSession, serving: str) -> list[table.Companion]:
    """The companions that a table has, a text index at least."""
    kept = table.settings(spark, serving)
    out = [text_companion(**kept[TEXT]) if TEXT in kept else text_companion()]
    return out + ([cells_companion(spark, kept[CELLS]["model"])] if CELLS in kept else [])


def run_loading(
    spark: SparkSession, stage: str, serving: str, dim: int = K.EMBEDDING_DIM, buckets: int | None = None, stem: Stem | None = None,
    variant: bool = False,
) -> int:
    """Embedding stage -> full-row upsert into the serving table, with its text index and the codes of its vectors.

    Returns the version served. The first load with vectors fits the cells and codebooks, which stay as they are. A row that
    breaks a constraint of the table fails the load, as it would in a database. With `variant` the first load makes a table whose
    metadata are typed values; every later load and feed follows the table.
    """
    rows = read_stage(spark, stage)
    if rows.isEmpty():
        return 0
    with scratch_scope(spark):
        rows, _ = G.enforce(G.gate(serving_rows(rows), G.serving_rules(dim)), 0.0, None)
        companions = kept_companions(spark, serving)
        if stem is not None:
            companions[0] = text_companion(stem)
        if len(companions) == 1 and not rows.where("embedding IS NOT NULL").isEmpty():
            companions.append(cells_companion(spark, cells.write_model(spark, cells.train(rows, dim), f"{serving}/models")))
        if table.exists(spark, serving):
            return table.merge_into(rows, serving, companions)
        rows = in_types_of(rows, SERVING_VARIANT) if variant else rows
        return table.publish(rows, serving, buckets=buckets, companions=companions)


def merge_feed(
    items: DataFrame, serving: str, dlq: str, url_prefix: str, max_error_rate: float, now: Column | None, empty_is_error: bool,
    commit: tuple[str, int] | None = None,
) -> G.GateReport:
    """Feed items -> gate -> partial upsert that keeps vectors and metadata of known papers.

    Papers of the feed are searchable at once: what is kept for search is committed with the table. A merge
    that is lost on the way leaves the table as it was and can run again; one that is repeated under the same `commit` does nothing.
    """
    spark = items.sparkSession
    with scratch_scope(spark):
        flagged = G.gate(parse_feed(items, now), G.daily_rules(url_prefix))
        papers, report = G.enforce(flagged, max_error_rate, dlq, empty_is_error)
        newest = dedupe_latest(papers, ["paper_id"], [F.col("published_date").desc_nulls_last()])
        newest = materialize(newest, "feed")  # read for the folders and each join of the merge
        if not table.exists(spark, serving):
            table.publish(spark.createDataFrame([], SERVING), serving)
        kept = kept_companions(spark, serving)
        table.merge_into(newest, serving, kept, commit, update_cols=FEED_COLUMNS, touch="ingested_at", now=now)
    return report


def run_daily(
    spark: SparkSession,
    landing: str,
    serving: str,
    dlq: str,
    url_prefix: str = K.FEED_URL_PREFIX,
    max_error_rate: float = K.DAILY_ERROR_LIMIT,
    now: Column | None = None,
) -> G.GateReport:
    """All feed files in a landing folder -> serving table. No items at all is an error."""
    return merge_feed(read_feed(spark, landing), serving, dlq, url_prefix, max_error_rate, now, True)
