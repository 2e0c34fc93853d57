"""Column expressions on float arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_to_text(vector: Column) -> Column:
    """`[a,b,...]`, the text form vector columns are exchanged in; null stays null."""
    return F.concat(F.lit("["), F.array_join(vector, ","), F.lit("]"))


def text_to_vector(text: Column) -> Column:
    return F.from_json(text, "array<float>")


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(a: Column, b: Column) -> Column:
    """`1 - cos(a, b)` in double; null for a null or a zero vector."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))
