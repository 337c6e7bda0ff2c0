"""What the operators share: slices of Arrow batches, bounded label samples, folds, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Text bytes that a Python task holds as objects at a time.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def utf8(column: str | Column = "text") -> Column:
    """The bytes of a text, null as empty: what the Arrow functions take."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def slices(batch: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The values of a batch in order, as lists of about `limit` bytes; one longer value is a list of its own."""
    lengths = batch.to_pandas().map(len).to_numpy() if len(batch) else np.zeros(0, dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += int(n)
    if start < len(batch):
        yield batch.slice(start).to_pylist()


def held_out(folds: int, fold: int, doc_id: str = "doc_id") -> Column:
    """Whether a document is in the held-out fold; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def label_sample(labels: DataFrame, label: str, bound: int, usable: Column | None = None) -> DataFrame:
    """At most `bound` rows (doc_id, label 0/1), the first by hash; the largest label where a document has several.

    The bound makes the sample small enough to be broadcast: `bound` rows of 12 bytes.
    """
    rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    if usable is not None:
        rows = rows.where(usable)
    first = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return first.groupBy("doc_id").agg(F.max("label").alias("label"))


def text_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that are equal for rows of the same id and text, null or not, and differ otherwise."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("__id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(doc_id).isNull()).alias("__hash"),
    ]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the bias last. Without rows of both labels, the prior alone."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1.0)
        w[-1] = np.log(p / (1 - p))
        return w
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) / len(y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
