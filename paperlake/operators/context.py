"""Context blocks and prompts from the best matches of each question."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.functions.metadata import json_text


def target_model(tag: Column, model_map: Mapping[str, str] | None = None) -> Column:
    """The model a tag stands for; an unknown or missing tag gets the default model."""
    model_map = model_map or K.MODEL_MAP
    entries = [F.lit(text) for pair in model_map.items() for text in pair]
    known = F.try_element_at(F.create_map(*entries), F.coalesce(tag, F.lit("")))
    return F.coalesce(known, F.lit(model_map[K.DEFAULT_MODEL_TAG]))


def _entry(match: Column) -> Column:
    shown = lambda name: F.coalesce(match[name].cast("string"), F.lit("None"))
    metadata = F.when(
        F.coalesce(match["metadata"], F.lit("")) != "",
        F.concat(F.lit("\nStructured Metadata: "), match["metadata"]),
    ).otherwise("")
    return F.concat(
        F.lit("["), match["place"].cast("string"), F.lit("] Title: "), shown("title"),
        F.lit("\nAbstract: "), shown("abstract"),
        F.lit("\nURL: "), shown("url"),
        F.lit("\n"), metadata, F.lit("\n\n"),
    )


def build_context(queries: DataFrame, matches: DataFrame, model_map: Mapping[str, str] | None = None) -> DataFrame:
    """One row per question -> (query_id, model, prompt, matched).

    `matches` come from a hybrid search with metadata, which bounds the rows per question; it is shown as JSON,
    whether it is kept as text or as VARIANT.
    `queries` may carry a `model_tag`.
    """
    matches = matches.withColumn("metadata", json_text(matches, "metadata"))
    fields = ("place", "paper_id", "title", "abstract", "url", "published_date", "metadata")
    grouped = matches.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("found"))
    summary = F.transform(
        "found",
        lambda m: F.struct(
            m["paper_id"].alias("paper_id"),
            m["title"].alias("title"),
            m["published_date"].cast("string").alias("published_date"),
            m["metadata"].alias("metadata"),
        ),
    )
    context = F.coalesce(F.array_join(F.transform("found", _entry), ""), F.lit(K.NO_MATCH_CONTEXT))
    tag = F.col("model_tag") if "model_tag" in queries.columns else F.lit(None).cast("string")
    asked = queries.select("query_id", F.col("text").alias("question"), target_model(tag, model_map).alias("model"))
    return asked.join(grouped, "query_id", "left").select(
        "query_id",
        "model",
        F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), F.col("question")).alias("prompt"),
        F.coalesce(summary, F.array()).alias("matched"),
    )
