import pytest


@pytest.fixture
def documents(spark):
    """Rows with the columns of `documents` from (doc_id, text), and clashing extra columns."""

    def make(rows, source="s", **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(i, t, None, source, len(t or "")) for i, t in rows]
        frame = spark.createDataFrame(data, schema)
        from pyspark.sql import functions as F

        return frame.withColumns({name: F.lit(value) for name, value in extra.items()})

    return make
