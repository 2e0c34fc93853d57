"""Recover the metadata fields from raw text written by a generator, as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import constants as K


def metadata_json(values: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[values[f].alias(f) for f in K.METADATA_FIELDS]))


def default_metadata(value: str = K.NOT_SPECIFIED) -> Column:
    return metadata_json({f: F.lit(value) for f in K.METADATA_FIELDS})


def _candidate(response: Column) -> Column:
    """The widest `{...}` from the first brace on, with a stray leading comma removed."""
    first = F.instr(response, "{")
    tail = F.when(first > 0, F.substring(response, first, F.length(response))).otherwise(response)
    tail = F.regexp_replace(tail, K.RESPONSE_LEADING_COMMA, "{")
    widest = F.regexp_extract(tail, "(?s)" + K.RESPONSE_WIDEST_OBJECT, 0)
    return F.when(widest != "", widest).otherwise(tail)


def _parsed_object(candidate: Column) -> Column:
    """The candidate as a JSON object, or null. Text after the object makes it invalid."""
    # Inside brackets, anything that follows the object breaks the array or adds an element.
    items = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), candidate, F.lit("]"))), "$", "array<variant>"
    )
    only = F.when(F.size(items) == 1, F.get(items, F.lit(0)))
    return F.when(F.schema_of_variant(only).startswith("OBJECT"), only)


def _field_from_text(response: Column, field: str) -> Column:
    """A quoted value after the field name, also one cut off at the end of the text."""
    pattern = "(?s)" + K.RESPONSE_FIELD.format(field=field)
    return F.when(response.rlike(pattern), F.trim(F.regexp_extract(response, pattern, 1)))


def recover_fields(df: DataFrame, response_col: str) -> DataFrame:
    """Add the metadata fields and `recovered` (`json`, `text` or `none`).

    A valid JSON object is read as such. Otherwise each field is searched in the text. If no
    field is found, all of them say so.
    """
    response = F.coalesce(F.col(response_col), F.lit(""))
    for fence in K.RESPONSE_FENCES:
        response = F.replace(response, F.lit(fence), F.lit(""))
    response = F.regexp_replace(response, r"(?U)^\s+|\s+$", "")
    staged = df.withColumn("__response", response).withColumn("__object", _parsed_object(_candidate(F.col("__response"))))
    from_text = {f: _field_from_text(F.col("__response"), f) for f in K.METADATA_FIELDS}
    staged = staged.withColumn(
        "recovered",
        F.when(F.col("__object").isNotNull(), "json")
        .when(F.coalesce(*from_text.values()).isNotNull(), "text")
        .otherwise("none"),
    )
    for field in K.METADATA_FIELDS:
        value = (
            F.when(F.col("recovered") == "json", F.try_variant_get(F.col("__object"), f"$.{field}", "string"))
            .when(F.col("recovered") == "text", from_text[field])
            .otherwise(K.EXTRACTION_ERROR)
        )
        staged = staged.withColumn(field, F.coalesce(value, F.lit(K.NOT_SPECIFIED)))
    return staged.drop("__response", "__object")
