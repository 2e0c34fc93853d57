"""Metadata of papers as JSON text or as VARIANT: a checked change from one to the other, and readers of both.

VARIANT keeps the value, not the text: keys come back in order of their names, without blanks, and 1.50 as 1.5.
A null stays null, the JSON value null stays a value.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json(text: Column) -> Column:
    """Exactly one JSON value. The parser stops after the first one, so the text is read as the elements of a list."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    second = F.try_variant_get(listed, "$[1]", "variant")
    return (F.trim(text) != "") & listed.isNotNull() & second.isNull()


def to_variant(text: Column) -> Column:
    """The value of a JSON text. Text that isn't exactly one value, repeated keys included, fails the job."""
    shown = F.concat(F.lit("metadata is not one JSON value: "), F.substring(text, 1, 80))
    return F.when(text.isNull() | is_json(text), F.parse_json(text)).otherwise(F.raise_error(shown).cast("variant"))


def is_variant(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.VariantType)


def json_text(df: DataFrame, column: str) -> Column:
    """The column as JSON text."""
    return F.to_json(column) if is_variant(df, column) else F.col(column)


def json_field(df: DataFrame, column: str, name: str) -> Column:
    """One top-level field as text; null where there is none. Of a VARIANT the scan reads that field alone."""
    if is_variant(df, column):
        return F.try_variant_get(column, f"$.{name}", "string")
    return F.get_json_object(column, f"$.{name}")


def in_types_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text parsed where the schema has VARIANT, and VARIANT as text where it has text. A plain cast would do neither."""
    changed = {}
    for name in set(schema.names) & set(df.columns):
        if isinstance(schema[name].dataType, T.VariantType) and isinstance(df.schema[name].dataType, T.StringType):
            changed[name] = to_variant(F.col(name))
        elif isinstance(schema[name].dataType, T.StringType) and is_variant(df, name):
            changed[name] = F.to_json(name)
    return df.withColumns(changed) if changed else df
