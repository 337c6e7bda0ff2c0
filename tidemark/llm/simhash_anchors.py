"""SimHash near-duplicates, found by covering anchors.

A fingerprint has 64 bits. Fingerprints of at most 3 differing bits differ in at most 1 bit in one of the halves, so
each half is searched for a distance of 1. Anchors of a half are the words of the perfect Hamming code on 31 of its
bits: every value is within 1 bit (the covering radius) of exactly one anchor, its home. A fingerprint goes to every
anchor within 1 + 1 bits, 16 at most; of two linked fingerprints the one is then always found at the home of the other.
An anchor's fingerprints are compared over all 64 bits. Anchors with very many fingerprints are split into pairs of
blocks. Only the links that connect an anchor's fingerprints are passed on, not all its pairs; components are joined in
`components`.

Null and empty texts have no words and the fingerprint zero, linked like any other. Equal texts share a fingerprint and
are one node. Null ids take part; a component's id is the least id that is not null. Rows keep their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tidemark.llm.common import slices, text_key, utf8
from tidemark.llm.components import components
from tidemark.operators.joins import join_small_side, measured_bytes, settled

SEED, SHINGLE = 42, 3
BITS = 3
#: Shingles whose bits are in memory at a time.
PART = 100_000
#: Fingerprints of an anchor that are compared in one block.
BLOCK = 20_000
#: Anchors at distance 0 or 3 of an anchor: those whose home fingerprints can come to it.
_NEAR_ANCHORS = 1 + 31 * 30 // 6
#: Groups up to this size are compared by shifted rows, all groups at once.
_SMALL = 8


def fingerprints(texts: list[bytes], width: int = SHINGLE) -> np.ndarray:
    """SimHash of each text as unsigned 64 bits: XXH64 of word shingles, repeats included, majority of bits."""
    digest = xxhash.xxh64_digest
    digests: list[bytes] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    long: dict[int, int] = {}
    for i, text in enumerate(texts):
        words = text.lower().split()
        n = len(words)
        if n == 0:
            continue
        if n <= width:
            digests.append(digest(b" ".join(words), SEED))
            counts[i] = 1
            continue
        if n > PART:
            long[i] = _in_stretches(words, width)
            continue
        digests += _shingles(words, width)
        counts[i] = n - width + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    out[list(long)] = list(long.values())
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    bits = _bits(digests)
    first = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
    set_bits = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    majority = 2 * set_bits > counts[some][:, None]
    out[some] = np.packbits(majority, axis=1).view(">u8").ravel()
    return out


def _bits(digests: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 8), axis=1)


def _shingles(words: list[bytes], width: int) -> list[bytes]:
    """Digests of the shingles of at least `width` words."""
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = [0, *ends[: n - width].tolist()]
    return [xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())]


def _in_stretches(words: list[bytes], width: int) -> int:
    """The fingerprint of a very long text, its bits counted a stretch of shingles at a time."""
    total, n = np.zeros(64, dtype=np.int64), len(words) - width + 1
    for at in range(0, n, PART):
        total += _bits(_shingles(words[at:min(at + PART, n) + width - 1], width)).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0])


@arrow_udf(LongType())
def _fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        parts = [fingerprints(texts) for texts in slices(batch)]
        yield pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64), pa.int64())


def with_fingerprint(docs: DataFrame, column: str = "fp") -> DataFrame:
    """Signed 64 bits."""
    return docs.withColumn(column, _fingerprint.asNondeterministic()(utf8()))


def _flips() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the bits to flip to reach each anchor within two bits, the home first, and how many there are."""
    flips, count = np.zeros((32, 16), dtype=np.uint64), np.ones(32, dtype=np.int64)
    for s in range(1, 32):
        bit = lambda label: 1 << (label - 1)
        own = [bit(s)] + [bit(i) | bit(i ^ s) for i in range(1, 32) if i < i ^ s]
        flips[s, : len(own)], count[s] = own, len(own)
    return flips, count


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For values of 31 bits: (row, anchor, whether it is the row's home) of all anchors within two bits."""
    flips, count = _flips()
    syndrome = np.zeros(len(half), dtype=np.int64)
    for k in range(5):
        mask = sum(1 << (label - 1) for label in range(1, 32) if label >> k & 1)
        syndrome |= (np.bitwise_count(half & np.uint64(mask)).astype(np.int64) & 1) << k
    many = count[syndrome]
    row = np.repeat(np.arange(len(half)), many)
    at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    return row, half[row] ^ flips[syndrome[row], at], at == 0


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for start in range(0, len(values), 20_000):
            own = values[start:start + 20_000]
            for half in (0, 1):
                row, anchor, home = anchors_of((own >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF))
                key = (anchor | np.uint64(half << 31)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[row].view(np.int64)), pa.array(home)], ["anchor", "fp", "home"])


def linked(values: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Index pairs that connect what is linked among `values`: each reached one with its component's first.

    Every value is compared with those not reached yet, so a dense group costs little more than its size.
    """
    out: list[tuple[int, int]] = []
    left = np.arange(len(values))
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = np.bitwise_count(values[left] ^ values[frontier.pop()]) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                out += [(int(root), int(i)) for i in found]
                frontier += found.tolist()
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by anchor and part; a group may run over several batches."""

    def links(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([start, [len(key)]]))
        useful = (size > 1) & np.logical_or.reduceat(home, start)
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        group = np.repeat(np.arange(len(start)), size)
        small = (useful & (size <= _SMALL))[group]
        v, g = fp[small], group[small]
        for shift in range(1, _SMALL):
            if len(v) <= shift:
                break
            hit = np.flatnonzero((g[shift:] == g[:-shift]) & (np.bitwise_count(v[shift:] ^ v[:-shift]) <= BITS))
            a.append(v[hit])
            b.append(v[hit + shift])
        for i in np.flatnonzero(useful & (size > _SMALL)):
            own = fp[start[i]:start[i] + size[i]]
            pairs = np.array(linked(own), dtype=np.int64).reshape(-1, 2)
            a.append(own[pairs[:, 0]])
            b.append(own[pairs[:, 1]])
        return np.concatenate(a), np.concatenate(b)

    def result(parts) -> pa.RecordBatch:
        key, fp, home = (np.concatenate(p) for p in zip(*parts))
        a, b = links(key, fp, home)
        pairs = np.unique(np.column_stack([a, b]), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "part"))
        key = anchor << 31 | part
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        home = batch.column("home").to_numpy(zero_copy_only=False)
        if held and held[0][0][0] == key[-1]:
            held.append((key, fp, home))
            continue
        cut = int(np.searchsorted(key, key[-1]))  # keys ascend: the last group may go on
        held.append((key[:cut], fp[:cut], home[:cut]))
        if sum(len(k) for k, _, _ in held):
            yield result(held)
        held = [(key[cut:], fp[cut:], home[cut:])]
    if held:
        yield result(held)


def _in_parts(rows: DataFrame, block: int) -> DataFrame:
    """`part` 0, but for anchors with over `block` rows: these are dealt into blocks, every pair of blocks a part."""
    at_home = rows.where("home").groupBy("anchor").count().agg(F.max("count").alias("n")).first()["n"] or 0
    if at_home * _NEAR_ANCHORS <= block:  # then no anchor can have more
        return rows.withColumn("part", F.lit(0).cast("long"))
    hot = settled(rows.groupBy("anchor").count().where(F.col("count") > block).select("anchor", F.ceil(F.col("count") / block).alias("blocks")))
    if hot.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    n, own = F.col("blocks"), F.pmod(F.xxhash64("fp"), F.col("blocks"))
    parts = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda j: F.least(own, j) * n + F.greatest(own, j) + 1)
    dealt = rows.join(hot, "anchor", "left").withColumn("part", F.explode(F.when(n.isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts)))
    # in a part, a home may be in either block, so all of its rows are compared
    return dealt.select("anchor", "fp", (F.col("home") | n.isNotNull()).alias("home"), "part")


def links(values: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """`values` (fp), distinct: pairs (a, b) at 3 or fewer bits that connect all that is linked."""
    rows = _in_parts(values.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean"), block)
    dealt = rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return dealt.mapInArrow(_compare, "a long, b long").distinct()


def _groups(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fp, component_id) from rows (doc_id, fp)."""
    values = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(values, block=block))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # settled, as in `components`: so that Spark may split the join at a root of very many values
    least = settled(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row per document: `fingerprint` (16 hex digits), `component_id`."""
    rows = settled(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"))
    out = rows.join(_groups(rows, block), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One document of each component, that of the least id, with its own columns; of rows that share the id, the text
    of the least hash. Where all ids of a component are null, the text of the least hash stays."""
    rows = settled(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", *text_key(), "fp"))
    grouped = rows.join(_groups(rows, block), "fp").where("doc_id <=> component_id")
    first = grouped.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone")).agg(F.min(F.struct("__id", "__hash")).alias("k"))
    kept = first.select("k.*", F.lit(True).alias("kept"))
    # rows that go, and kept ones that repeat; while these are few no text is moved
    keys = rows.groupBy("__id", "__hash").agg(F.count("*").alias("n"))
    special = settled(keys.join(kept, ["__id", "__hash"], "left").where("kept is null or n > 1").select("__id", "__hash", F.coalesce("kept", F.lit(False)).alias("__again")))
    size, again = measured_bytes(special), special.where("__again")
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *text_key())
    out = join_small_side(keyed, special, ["__id", "__hash"], "left_anti", size=size)
    if not again.isEmpty():
        out = out.unionByName(join_small_side(keyed, again, ["__id", "__hash"], "left_semi", size=size).dropDuplicates(["__id", "__hash"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
