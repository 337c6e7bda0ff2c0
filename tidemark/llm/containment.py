"""Benchmark decontamination: which short test items lie inside which documents.

A document contains an item where it has at least 80 % of the item's distinct five-word shingles, wherever they stand.
Items are parted by size: a class holds items of 2^i to 2^(i+1) - 1 shingles. An item's sketch is its smallest shingle
hashes (a bottom-k MinHash), as many as its class needs: of q shingles q - ceil(0.8 q) may be absent, so at least one of
any q - ceil(0.8 q) + 1 is there, and a sketch of that number finds every document that contains the item. A document has no
sketch: being long, it is probed with all its shingle hashes, for a signature of a long document says nothing about a
short passage in it. Candidates are verified by exact containment of the shingles.

Items are the query set; their sketches and shingles go to the tasks in blocks of a bounded number of shingles, one pass
over the documents for each block, whose finds are written before the next block is built. The documents are never shuffled. Words are runs of letters, digits and
non-ASCII characters, lower-cased. Null texts count as empty; items of fewer than five words have no shingle and lie in
no document. Repeated items and documents are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import slices, text_key, utf8
from tidemark.operators.joins import join_small_side
from tidemark.session import scratch_path

WIDTH, SHARE = 5, 0.8
#: Shingles of one block of items: what a task holds of them, some 100 bytes each.
BLOCK_SHINGLES = 500_000
_MASK = (1 << 64) - 1
_FOUND = "struct<item_id:bigint,n_shingles:int,n_shared:int>"
#: Multipliers of a shingle's words, fixed odd numbers.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)

_TABLE = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_TABLE).split()


def needed(shingles: int) -> int:
    """Shingles of an item that a document must have."""
    return max(1, -(-shingles * 8 // 10))


def sketch_size(shingles: int) -> int:
    """Hashes of an item's sketch: enough for the largest item of its size class."""
    largest = (1 << int(shingles).bit_length()) - 1
    return min(shingles, largest - needed(largest) + 1)


class Hasher:
    """64-bit hashes of shingles; a word's hash is kept while it is of use."""

    def __init__(self, most: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def words(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, xxhash.xxh64_intdigest
        if len(known) > self.most:
            known.clear()
        for word in set(words).difference(known):
            known[word] = digest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def shingles(self, words: list[bytes]) -> np.ndarray:
        n = len(words) - WIDTH + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        h = self.words(words)
        out = np.zeros(n, dtype=np.uint64)
        for i in range(WIDTH):
            out += h[i:i + n] * _FACTORS[i]
        out ^= out >> np.uint64(29)
        return out * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """The sketches of some items, and their shingles for verification."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        hasher = Hasher()
        self.ids = [i for i, _ in items]
        self.shingles: list[frozenset[bytes]] = []
        hashes, owners = [], []
        for number, (_, text) in enumerate(items):
            words = words_of(text)
            grams = [b" ".join(words[i:i + WIDTH]) for i in range(len(words) - WIDTH + 1)]
            self.shingles.append(frozenset(grams))
            own = np.unique(hasher.shingles(words))
            kept = own[: sketch_size(len(self.shingles[-1]))] if len(own) else own
            hashes.append(kept)
            owners.append(np.full(len(kept), number, dtype=np.int64))
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hashes, self.owners = joined[order], (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]
        bits = max(16, int(len(joined) * 64).bit_length())
        self.shift = np.uint64(64 - min(bits, 26))
        self.gate = np.zeros(1 << min(bits, 26), dtype=bool)
        self.gate[self.hashes >> self.shift] = True

    def candidates(self, hashes: np.ndarray) -> list[int]:
        """Items of which at least one sketch hash is among these."""
        some = hashes[self.gate[hashes >> self.shift]]
        if not len(some):
            return []
        low, high = np.searchsorted(self.hashes, some), np.searchsorted(self.hashes, some, side="right")
        return sorted({int(o) for a, b in zip(low, high) if b > a for o in self.owners[a:b]})


def search(texts: list[bytes], index: Index, hasher: Hasher) -> list[list[tuple[int | None, int, int]]]:
    """For each text the items that it contains: (item, its shingles, those found)."""
    words = [words_of(t) for t in texts]
    # one pass over all words of the slice; shingles over a border are left out below
    flat = [w for own in words for w in own]
    hashes = hasher.shingles(flat)
    at, out = 0, []
    for own in words:
        n = len(own) - WIDTH + 1
        found = []
        if n > 0:
            items = index.candidates(hashes[at:at + n])
            if items:
                grams = {b" ".join(own[i:i + WIDTH]) for i in range(n)}
                for i in items:
                    size, shared = len(index.shingles[i]), len(index.shingles[i] & grams)
                    if shared >= needed(size):
                        found.append((index.ids[i], size, shared))
        out.append(found)
        at += len(own)
    return out


def _finder(index: Index):
    @arrow_udf(f"array<{_FOUND}>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shingles", pa.int32()), ("n_shared", pa.int32())]))
        for batch in batches:
            rows = [found for texts in slices(batch) for found in search(texts, index, hasher)]
            yield pa.array([[{"item_id": a, "n_shingles": b, "n_shared": c} for a, b, c in row] for row in rows], kind)

    return find.asNondeterministic()


def item_blocks(items: DataFrame, bound: int = BLOCK_SHINGLES) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of about `bound` words, each block on the driver by itself.

    Rows come one partition at a time; an item of more words is a block of its own.
    """
    block: list[tuple[int | None, bytes]] = []
    held = 0
    for row in items.select(F.col("item_id").cast("long").alias("i"), utf8().alias("b")).toLocalIterator():
        text = bytes(row["b"])
        size = len(words_of(text))
        if size < WIDTH:
            continue
        if block and held + size > bound:
            yield block
            block, held = [], 0
        block.append((row["i"], text))
        held += size
    if block:
        yield block


def _found(docs: DataFrame, items: DataFrame, bound: int, columns: list[Column], schema: str) -> DataFrame:
    """`columns` of the documents and `f`, an item found in them, from a table to which each block appends its own.

    A block's rows are written before the next block is built, so that the driver and the tasks hold one at a time.
    """
    path = scratch_path(docs.sparkSession, "containment")
    docs.sparkSession.createDataFrame([], schema).write.parquet(path)

    def append(block: list[tuple[int | None, bytes]]) -> None:
        found = docs.select(*columns, F.explode(_finder(Index(block))(utf8())).alias("f"))
        found.write.mode("append").parquet(path)

    for block in item_blocks(items, bound):
        append(block)
    return docs.sparkSession.read.schema(schema).parquet(path)


def contained(docs: DataFrame, items: DataFrame, *, bound: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs (doc_id, item_id) with `n_shingles` of the item, `n_shared`, and `containment`."""
    found = _found(docs, items, bound, [F.col("doc_id").cast("long").alias("doc_id")], f"doc_id long, f {_FOUND}")
    return found.select("doc_id", "f.*").withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, bound: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that contain no item, with their own columns."""
    found = _found(docs, items, bound, text_key(), f"__id long, __hash long, f {_FOUND}")
    dirty = found.select("__id", "__hash").distinct()
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *text_key())
    clean = join_small_side(keyed, dirty, ["__id", "__hash"], "left_anti")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
