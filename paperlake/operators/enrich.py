"""Metadata extraction from abstracts, with a pluggable extractor."""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.operators.responses import default_metadata, metadata_json, recover_fields

# Builds, once per task, a function from a batch of texts to one raw response per text.
Extractor = Callable[[], Callable[[Sequence[str]], Sequence[str | None]]]

# Cue phrases of the built-in extractor; a value runs to the end of its clause.
CUES = {
    "core_method": r"(?i)\b(?:we (?:propose|present|introduce|develop)|using|based on)\s+([^.,;:]+)",
    "dataset_used": r"(?i)\b(?:dataset|data set|data from|benchmark|corpus|evaluated on|trained on)\s+([^.,;:]+)",
    "key_findings": r"(?i)\b(?:we (?:show|find|demonstrate|observe)|results? (?:show|suggest|indicate))\s+(?:that\s+)?([^.;:]+)",
}


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"(?U)^\s*$")


def cue_metadata(text: Column) -> Column:
    """Metadata by cue phrases alone, without leaving the JVM."""
    found = {f: F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), CUES[f], 1)) for f in K.METADATA_FIELDS}
    return metadata_json({f: F.when(v == "", K.NOT_SPECIFIED).otherwise(v) for f, v in found.items()})


def _answers(extract, texts: Sequence[str]) -> list[str | None]:
    """One response per text. If the batch fails, rows are tried alone so one cannot spoil the rest."""
    try:
        answers = list(extract(texts))
        if len(answers) == len(texts):
            return answers
    except Exception:
        if len(texts) == 1:
            return [None]
    return [answer for text in texts for answer in _answers(extract, [text])] if len(texts) > 1 else [None]


def _batched(extractor: Extractor):
    @F.pandas_udf("string")
    def respond(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extract = extractor()
        for texts in batches:
            wanted = texts.notna()
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if wanted.any():
                out[wanted] = _answers(extract, texts[wanted].tolist())
            yield out

    # Declared not deterministic so that the optimizer never calls the extractor twice for a row.
    return respond.asNondeterministic()


def enrich_in_batches(df: DataFrame, extractor: Extractor, text_col: str = "abstract", batch_rows: int = 50) -> DataFrame:
    """`enrich` with an extractor that is handed at most `batch_rows` texts at a time, whatever Arrow's batches are."""

    def cut():
        extract = extractor()

        def run(texts: Sequence[str]) -> list[str | None]:
            return [a for i in range(0, len(texts), batch_rows) for a in _answers(extract, texts[i : i + batch_rows])]

        return run

    return enrich(df, text_col, cut)


def enrich(df: DataFrame, text_col: str = "abstract", extractor: Extractor | None = None) -> DataFrame:
    """Add `metadata_json` with the three metadata fields.

    Blank texts get the default record without being sent to the extractor, responses are
    repaired with column expressions, and a text without a usable response gets the error record.
    """
    text, blank = F.col(text_col), is_blank(F.col(text_col))
    if extractor is None:
        return df.withColumn("metadata_json", F.when(blank, default_metadata()).otherwise(cue_metadata(text)))
    asked = df.withColumn("__answer", _batched(extractor)(F.when(~blank, text)))
    fields = recover_fields(asked, "__answer")
    record = metadata_json({f: F.col(f) for f in K.METADATA_FIELDS})
    return fields.select(*df.columns, F.when(blank, default_metadata()).otherwise(record).alias("metadata_json"))


def fill_missing(df: DataFrame, column: str = "metadata_json") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), default_metadata()))
