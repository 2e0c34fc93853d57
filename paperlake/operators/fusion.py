"""Reciprocal rank fusion of two ranked candidate lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import constants as K
from paperlake.operators.dedupe import top_per_group


def rrf_score(rank_dense: Column, rank_sparse: Column, k: int = K.RRF_K) -> Column:
    part = lambda rank: F.lit(1.0) / (F.lit(float(k)) + rank)
    return part(rank_dense) + part(rank_sparse)


def rrf(dense: DataFrame, sparse: DataFrame, k: int = K.RRF_K, missing: int = K.MISSING_RANK) -> DataFrame:
    """All candidates of both lists -> (query_id, paper_id, rank_dense, rank_sparse, rrf_score).

    One full outer join carries both ranks; a list that lacks the paper counts as `missing`.
    """
    keys = ["query_id", "paper_id"]
    both = dense.select(*keys, "rank_dense").join(sparse.select(*keys, "rank_sparse"), keys, "full_outer")
    ranked = both.select(
        *keys,
        *[F.coalesce(F.col(c), F.lit(missing).cast("long")).alias(c) for c in ("rank_dense", "rank_sparse")],
    )
    return ranked.withColumn("rrf_score", rrf_score(F.col("rank_dense"), F.col("rank_sparse"), k))


def best_fused(fused: DataFrame, limit: int) -> DataFrame:
    """The best `limit` papers of every question, numbered by `place`; ties go to the smaller id."""
    return top_per_group(fused, ["query_id"], [F.col("rrf_score").desc(), F.col("paper_id")], limit, "place")
