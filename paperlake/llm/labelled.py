"""Labelled rows for the trained operators: which are held out, and a bounded sample to fit on."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a model is fitted on at most (the first ones in a fixed pseudo-random order).
SAMPLE_ROWS = 6000


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text has remainder 2 by 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most `rows` labelled documents that are not held out.

    Rows without an id or with a label other than 0 and 1 are left out; of several labels of one id the
    largest counts, and of several documents of one id the one whose text has the smallest hash. The ids are broadcast: their
    number is bounded by `rows`.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    order = F.struct(F.xxhash64("text"), "text")
    return found.groupBy("doc_id").agg(F.min_by("text", order).alias("text"), F.first("label").alias("label")).select("text", "label")


def platt(margins: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins: damped Newton steps on smoothed labels."""
    n_one = float(labels.sum())
    goal = np.where(labels > 0, (n_one + 1) / (n_one + 2), 1 / (len(labels) - n_one + 2))
    center, scale = float(margins.mean()), float(margins.std()) or 1.0
    x = np.stack([(margins - center) / scale, np.ones(len(margins))], 1)
    ridge = np.array([1e-2, 1e-6])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - goal * z).sum() + (ridge * at * at).sum() / 2)

    at = np.array([0.0, np.log((n_one + 1) / (len(labels) - n_one + 1))])
    for _ in range(rounds):
        p = sigmoid(x @ at)
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step, now, rate = np.linalg.solve(hessian, x.T @ (p - goal) + ridge * at), loss(at), 1.0
        while rate > 1e-6 and loss(at - rate * step) > now:
            rate /= 2
        at = at - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return float(at[0] / scale), float(at[1] - at[0] * center / scale)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
