"""Token counts with a digest cache.

A text's digest and the tokenizer's digest are looked up in a stored table of counts. Only distinct texts that are not
there are encoded, and their counts are appended, so a second run over the same texts encodes nothing.

Counting is exact: a count is that of the library for the whole text. The library splits a text at white space before it
merges bytes, and never merges over the start of a run of white space; a task therefore counts the stretches between
single spaces and remembers what each stretch gave. Texts with runs of white space before a space, control characters or
special strings go to the library whole, as do all texts for tokenizers of another make.

Null texts count as empty, of no tokens. Rows may repeat: a text is encoded once, and every row gets its count.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import slices, utf8
from tidemark.operators.joins import BROADCAST_BYTES, measured_bytes, settled
from tidemark.session import scratch_path
from tidemark.sources.tables import read_or_empty

#: Characters of stretches whose counts a task remembers.
REMEMBERED = 16 << 20
CACHE = StructType([StructField("digest", StringType()), StructField("n_tokens", LongType()), StructField("tokenizer", StringType())])

#: What is not left to stretches: white space before a space, and characters that libraries may see differently.
_WHOLE = re.compile("\\s |[\x00\x1c-\x1f\x85]")


#: How texts are counted, part of a tokenizer's digest.
OPTIONS = "no special tokens added, none cut off or filled up"


def file_digest(path: str) -> str:
    """Of the tokenizer's file, the library's version, and the way it is used."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{library} {version(library)}\n{OPTIONS}".encode()).hexdigest()


class Counter:
    """Counts tokens by the library for the file, without special tokens added, cut off or filled up."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered, self.held, self.counts, self.special = remembered, 0, {}, None
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]
            self.by_stretch = False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.encode = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        cut = made.get("pre_tokenizer") or {}
        # the byte-level splitter by itself: white space starts a stretch, and nothing looks back over it
        self.by_stretch = made.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        names = [re.escape(t["content"]) for t in made.get("added_tokens") or ()]
        self.special = re.compile("|".join(names)) if names else None

    def whole(self, text: str) -> bool:
        return not self.by_stretch or _WHOLE.search(text) is not None or (self.special is not None and self.special.search(text) is not None)

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        alone = [i for i, t in enumerate(texts) if self.whole(t)]
        for i, n in zip(alone, self.encode([texts[i] for i in alone]) if alone else ()):
            out[i] = n
        skip = set(alone)
        rest = [i for i in range(len(texts)) if i not in skip]
        if not rest:
            return out
        known = self.counts
        if self.held > self.remembered:
            known.clear()
            self.held = 0
        # a stretch has the space before it; the first of a text has none, and is kept apart by a mark
        split = [texts[i].replace(" ", "\0 ").split("\0") for i in rest]
        new = list({s for stretches in split for s in stretches}.difference(known))
        known.update(zip(new, self.encode(new)))
        self.held += sum(map(len, new))
        for i, stretches in zip(rest, split):
            out[i] = sum(map(known.__getitem__, stretches))
        return out


def counted(path: str) -> Column:
    """Spark function: the tokens of a text's bytes."""

    @arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(path)
        for batch in batches:
            found = [n for texts in slices(batch) for n in counter.count([t.decode("utf-8", "replace") for t in texts])]
            yield pa.array(np.array(found, dtype=np.int64), pa.int64())

    return count.asNondeterministic()


def digest(text: str = "text") -> Column:
    return F.sha2(utf8(text), 256)


def fill_cache(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """Appends the counts of texts that the cache lacks; returns the cache's (digest, n_tokens) of this tokenizer.

    Each missing digest chooses one row to be encoded, by the least id; texts meet their digests by that id, so copies
    do not gather in one task. While the missing ones are few they are broadcast, and no text is moved.
    """
    spark, made = docs.sparkSession, file_digest(path)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), utf8().alias("b"))
    stored = read_cache(spark, cache, made)
    wanted = rows.select(F.sha2("b", 256).alias("digest"), F.struct("no_id", "id").alias("k"))
    missing = wanted.groupBy("digest").agg(F.min("k").alias("k")).join(stored, "digest", "left_anti").select("digest", "k.*")
    missing = settled(missing)
    few = measured_bytes(missing) <= BROADCAST_BYTES
    # many are hashed, as a merge would sort the texts
    chosen = rows.withColumn("digest", F.sha2("b", 256)).join(F.broadcast(missing) if few else missing.hint("shuffle_hash"), ["no_id", "id", "digest"], "left_semi")
    encoded = chosen.select("digest", counted(path)(F.col("b")).alias("n_tokens"))
    # rows that repeat an id with its text are chosen together
    encoded = encoded.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    encoded.select(F.lit(made).alias("tokenizer"), "digest", "n_tokens").write.mode("append").partitionBy("tokenizer").parquet(cache)
    return read_cache(spark, cache, made)


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    return read_or_empty(spark, cache, CACHE).where(F.col("tokenizer") == tokenizer).select("digest", "n_tokens").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, *, limit: int, cache: str | None = None) -> DataFrame:
    """One row per document: `n_bytes`, `n_tokens`, `over_limit`. Without a cache's path the run keeps its own."""
    cache = cache or scratch_path(docs.sparkSession, "token-counts")
    counts = settled(fill_cache(docs, path, cache))  # so that Spark may split the join where a text has very many copies
    rows = docs.select("doc_id", digest().alias("digest"), F.octet_length(utf8()).cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
