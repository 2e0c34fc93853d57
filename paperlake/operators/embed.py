"""Text vectors, with a pluggable encoder."""

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import constants as K
from paperlake.functions.metadata import json_field
from paperlake.functions.tokens import NOT_WORD
from paperlake.session import materialize, probe

# Builds, once per task, a function from a batch of texts to a matrix with one row per text.
Encoder = Callable[[], Callable[[Sequence[str]], np.ndarray]]


def hashing_encoder(dim: int = K.EMBEDDING_DIM) -> Encoder:
    """Signed feature hashing of words (Weinberger et al. 2009): no model, no vocabulary.

    The first four bytes of a word's MD5 name its dimension, the fifth its sign.
    """

    def build():
        @lru_cache(maxsize=1 << 18)
        def place(word: str) -> tuple[int, int]:
            digest = hashlib.md5(word.encode()).digest()
            return int.from_bytes(digest[:4], "big") % dim, 1 - 2 * (digest[4] & 1) if word else 0

        def encode(texts: Sequence[str]) -> np.ndarray:
            lowered = pc.utf8_lower(pa.array(texts, pa.string()))
            split = pc.split_pattern_regex(lowered, NOT_WORD)
            words = split.flatten().dictionary_encode()
            places = np.array([place(w) for w in words.dictionary.to_pylist()], dtype=np.int64).reshape(-1, 2)
            codes = words.indices.to_numpy()
            rows = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
            cells = rows * dim + places[codes, 0]
            return np.bincount(cells, weights=places[codes, 1], minlength=len(texts) * dim).reshape(len(texts), dim)

        return encode

    return build


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms > 0, norms, 1.0)


def _encode_batch(encode, texts: pd.Series) -> np.ndarray:
    return unit_rows(np.asarray(encode(texts.fillna("").tolist()), dtype=np.float64)).astype(np.float32)


def embed(df: DataFrame, text_col: str, encoder: Encoder | None = None, dim: int = K.EMBEDDING_DIM) -> DataFrame:
    """Add `embedding`, a unit vector of the text; a null text is encoded as an empty one."""
    encoder = encoder or hashing_encoder(dim)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for texts in batches:
            yield pd.Series(list(_encode_batch(encode, texts)), index=texts.index)

    # Declared not deterministic so that the optimizer never evaluates it twice for a row.
    return df.withColumn("embedding", vectors.asNondeterministic()(F.col(text_col)))


def embed_in_batches(
    df: DataFrame, text_col: str, encoder: Encoder | None = None, dim: int = K.EMBEDDING_DIM, batch_rows: int = 256
) -> DataFrame:
    """`embed` with whole rows in explicit batches of `batch_rows`, cut inside each Arrow batch."""
    encoder = encoder or hashing_encoder(dim)
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                matrix = _encode_batch(encode, part.column(text_col).to_pandas())
                offsets = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
                yield part.append_column("embedding", pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel())))

    return df.mapInArrow(run, schema)


def embed_balanced(
    df: DataFrame, text_col: str, encoder: Encoder | None = None, dim: int = K.EMBEDDING_DIM, batch_bytes: int = 1 << 16, tasks: int | None = None
) -> DataFrame:
    """`embed` for costly encoders: equal texts are encoded once, in batches of texts of like length.

    Distinct texts are dealt out by a digest, sorted by length in each task, and handed to the encoder in batches of at most
    `batch_bytes` (a longer text is a batch of its own), so a batch costs about the same whatever texts it holds. Vectors
    go back to the rows by the digest, whatever share of the rows one text has.
    """
    encoder = encoder or hashing_encoder(dim)
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    keyed = df.withColumn("__text", digest)
    texts = keyed.select("__text", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.groupBy("__text").agg(F.first("text").alias("text")).withColumn("bytes", F.octet_length("text"))
    texts = (texts.repartition(tasks, "__text") if tasks else texts).sortWithinPartitions("bytes", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for keys, held in _filled(batches, batch_bytes):
            matrix = unit_rows(np.asarray(encode(held), dtype=np.float64)).astype(np.float32)
            offsets = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
            yield pa.record_batch({"__text": pa.array(keys), "embedding": pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))})

    vectors = materialize(texts.mapInArrow(run, "__text string, embedding array<float>"), "vectors")
    row = F.monotonically_increasing_id()
    return probe(keyed.withColumn("__row", row), vectors, "__text", "__row").select(*df.columns, "embedding")


def _filled(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[str], list[str]]]:
    """Keys and texts in batches filled up to a number of bytes, across the batches they come in."""
    keys, texts, total = [], [], 0
    for batch in batches:
        for key, text, size in zip(*(batch.column(c).to_pylist() for c in ("__text", "text", "bytes")), strict=True):
            if keys and total + size > most:
                yield keys, texts
                keys, texts, total = [], [], 0
            keys.append(key)
            texts.append(text)
            total += size
    if keys:
        yield keys, texts


def fuse_text(df: DataFrame) -> DataFrame:
    """Add `embedding_text`: title, abstract and the metadata values, nulls left out. The metadata is JSON text or VARIANT."""
    values = [json_field(df, "metadata_json", f) for f in K.METADATA_FIELDS]
    return df.withColumn("embedding_text", F.concat_ws(K.TEXT_SEPARATOR, "title", "abstract", *values))
