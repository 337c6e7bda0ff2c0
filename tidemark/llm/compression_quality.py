"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

Pieces of labelled texts, bounded in number, train one dictionary for each label. A text is compressed with either; the
size difference, as a share of the larger size, says which label it resembles, and the smaller size for each byte of text
how much it repeats itself. A logistic curve over both, fitted on labelled documents that gave no pieces, makes them a
score between 0 and 1.

Null texts count as empty; an empty text has the difference 0 and so the score of an undecided text. Without labels of
both kinds every score is the share of good labels (one half without any). Rows are scored each on its own, so repeated
rows have equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import fit_logistic, held_out, label_sample, slices, utf8

# Bounds of fitting; all of them are parameters of `train` and `score`.
#: Labelled documents that are looked at; half of them give pieces, half fit the curve.
LABEL_BOUND = 12_000
#: Pieces of text for each dictionary, their bytes, and the bytes of a dictionary.
PIECES, PIECE_BYTES, DICT_BYTES = 1_500, 2_048, 65_536
LEVEL = 3
FOLDS, FOLD = 5, 0


def build_dictionary(pieces: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; of few pieces, the pieces themselves."""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    # 8 bytes are the least that zstandard takes as a dictionary
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    found = _dictionary(raw)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=found, **options) if found else zstandard.ZstdCompressor(level=LEVEL, **options)


def measures(good: bytes, bad: bytes):
    """Spark function: of a text, the normalised difference of its sizes, larger where it resembles good text, and how
    small it gets (the logarithm of the smaller size by the text's)."""

    @arrow_udf("struct<difference:double,ratio:double>")
    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with_good, with_bad = _compressor(good), _compressor(bad)
        for batch in batches:
            difference: list[float] = []
            ratio: list[float] = []
            for texts in slices(batch):
                for text in texts:
                    g, b = len(with_good.compress(text)), len(with_bad.compress(text))
                    difference.append((b - g) / max(b, g) if text else 0.0)
                    ratio.append(math.log(min(b, g) / len(text)) if text else 0.0)
            yield pa.StructArray.from_arrays([pa.array(difference, pa.float64()), pa.array(ratio, pa.float64())], ["difference", "ratio"])

    return sizes.asNondeterministic()


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]

    def score(self, measured: str) -> Column:
        """From the column that `measures` made."""
        difference, ratio, bias = self.weights
        z = F.col(f"{measured}.difference") * difference + F.col(f"{measured}.ratio") * ratio + bias
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))


def _pieces(rows: DataFrame, pieces: int = PIECES, piece_bytes: int = PIECE_BYTES) -> dict[int, list[bytes]]:
    """At most `pieces` pieces of each label, spread over all of the sampled texts by hash."""
    rows = rows.select("doc_id", "label", utf8().alias("b")).where("octet_length(b) > 0")
    at = F.explode(F.sequence(F.lit(1), F.octet_length("b"), F.lit(piece_bytes))).alias("at")
    cut = rows.select("doc_id", "label", "b", at).select("label", F.xxhash64("doc_id", "at").alias("h"), F.substring("b", F.col("at"), piece_bytes).alias("piece"))
    out = {}
    for label in (0, 1):
        got = cut.where(F.col("label") == label).orderBy("h", "piece").limit(pieces).select("piece").collect()
        out[label] = [bytes(r["piece"]) for r in got]
    return out


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", bound: int = LABEL_BOUND, pieces: int = PIECES, piece_bytes: int = PIECE_BYTES,
    dict_bytes: int = DICT_BYTES,
) -> Model:
    """Dictionaries and curve from labelled documents outside the held-out fold.

    At most `bound` labelled documents are looked at, and at most `pieces` pieces of `piece_bytes` make each dictionary of
    `dict_bytes`.
    """
    sample = label_sample(labels, label, bound, ~held_out(FOLDS, FOLD))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    gives = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)) == 0
    cut = _pieces(rows.where(gives), pieces, piece_bytes)
    good, bad = (build_dictionary(cut[kind], dict_bytes) for kind in (1, 0))
    measured = rows.where(~gives).select("doc_id", "label", measures(good, bad)(utf8()).alias("m"))
    got = measured.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("m.difference").alias("d"), F.min("m.ratio").alias("r"))
    got = got.toPandas().sort_values("doc_id")
    weights = fit_logistic(got[["d", "r"]].to_numpy(dtype=float), got["label"].to_numpy(dtype=float), ridge=1e-5)
    return Model(good, bad, tuple(float(w) for w in weights))


def score(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **bounds: int) -> DataFrame:
    """One row per document: `held_out`, `score`, `predicted`. `bounds` are those of `train`."""
    return scored(docs, train(docs, labels, **bounds), threshold=threshold)


def scored(docs: DataFrame, model: Model, *, threshold: float = 0.3) -> DataFrame:
    """What `score` gives, by a model."""
    measured = docs.select("doc_id", measures(model.good, model.bad)(utf8()).alias("__sizes"))
    rows = measured.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), model.score("__sizes").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


