"""Hybrid search and question context over a table of questions."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.tokens import Stem
from paperlake.operators import cells
from paperlake.operators.context import build_context
from paperlake.operators.dense import dense_search
from paperlake.operators.fusion import best_fused, rrf
from paperlake.operators.keyword import TextIndex, WordForms, kept_index, keyword_search, lookup, scan_index, search_terms
from paperlake.plans.pipelines import CELLS, TEXT
from paperlake.session import broadcast_if_small, materialize
from paperlake.sinks import table

_SHOWN = ("title", "abstract", "url", "published_date")
# Two ids of up to 64 characters, three numbers and the overhead of a row.
_RANKED_ROW_BYTES = 256
#: Ranked papers whose ids stand as a list in the plan of what fetches them.
_LISTED_ROWS = 10_000


def hybrid_search(
    docs: DataFrame,
    queries: DataFrame,
    limit: int = K.SEARCH_LIMIT,
    with_metadata: bool = False,
    index: TextIndex | None = None,
    depth: int = K.CANDIDATES,
    stem: Stem = "english",
    dense: DataFrame | None = None,
    serving: str | None = None,
    terms: DataFrame | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Fused vector and keyword search for every row of `queries` (query_id, text, embedding).

    A question's text is read as `keyword.search_terms` says (all words, quotes, `or`, a leading `-`), in English word stems
    unless `stem` says otherwise; `terms` gives another term table, `weights` boost the fields.

    Only ids and ranks travel through ranking and fusion; titles and texts are fetched at the
    end for the few papers that made it. At scale every branch can work on a stored structure
    instead of a scan of `docs`: `index` is a text index, `dense` the candidates of an
    approximate search, and `serving` the path of a keyed table to fetch the papers from.
    """
    if not 1 <= limit <= K.MAX_SEARCH_LIMIT:
        raise ValueError(f"limit must lie between 1 and {K.MAX_SEARCH_LIMIT}")
    # Written once: the questions are read by several jobs, and their vectors may be costly to make.
    queries = materialize(queries.select("query_id", "text", "embedding"), "questions")
    if index is not None and index.stem != stem:
        raise WordForms(f"the index was built with stem={index.stem}")
    terms = search_terms(queries, stem) if terms is None else terms
    found = lookup(index, terms) if index is not None else scan_index(docs, terms, stem)
    dense = dense_search(docs, queries, depth) if dense is None else dense
    best = best_fused(rrf(dense, keyword_search(found, terms, depth, weights)), limit)
    best = materialize(best, "ranked")
    if serving is not None:
        docs = table.lookup(docs.sparkSession, serving, best)
    return fetch(docs, best, queries.count() * limit, with_metadata)


def search_table(spark: SparkSession, serving: str, queries: DataFrame, rerank: int | None = None, **search) -> DataFrame:
    """`hybrid_search` on a published table and the text index that is committed with it.

    With `rerank` the vector search reads the codes of vectors first, and only that many vectors a question.
    """
    kept = table.settings(spark, serving)
    stem = kept.get(TEXT, {}).get("stem")
    index = kept_index(table.companion(spark, serving, TEXT), stem)
    docs, dense = table.resolve(spark, serving), None
    if rerank is not None:
        codes = cells.CellIndex(table.companion(spark, serving, CELLS), cells.read_model(spark, kept[CELLS]["model"]))
        dense = cells.cell_search(codes, docs, queries, rerank=rerank, serving=serving)
    return hybrid_search(docs, queries, index=index, stem=stem, serving=serving, dense=dense, **search)


def fetch(docs: DataFrame, best: DataFrame, most_rows: int, with_metadata: bool) -> DataFrame:
    """Join the shown columns to at most `most_rows` ranked papers; `best` is read twice.

    The ids of some thousand papers stand as a list in the plan, so other texts are left out before anything moves them.
    """
    if most_rows <= _LISTED_ROWS:
        docs = docs.where(F.col("paper_id").isin([row[0] for row in best.select("paper_id").distinct().collect()]))
    shown = [*_SHOWN, "metadata"] if with_metadata else list(_SHOWN)
    side = broadcast_if_small(best, most_rows * _RANKED_ROW_BYTES)
    return docs.select("paper_id", *shown).join(side, "paper_id").select(
        "query_id", "place", "paper_id", *shown, "rank_dense", "rank_sparse", "rrf_score"
    )


def ask(docs: DataFrame, queries: DataFrame, model_map: Mapping[str, str] | None = None, **search) -> DataFrame:
    """Prompt, target model and matched papers for every question."""
    matches = hybrid_search(docs, queries, limit=K.ASK_LIMIT, with_metadata=True, **search)
    return build_context(queries, matches, model_map)


def result_counts(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Number of results per question, also for those without any."""
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("count"))
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("count", F.lit(0)).alias("count")
    )
