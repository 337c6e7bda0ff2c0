"""Divergence of sources: how differently the sources of a language use its terms, exactly.

A first pass counts in how many documents of its language each term stands and keeps the frequent ones. Kept terms are cut
into shards, and tasks build a minimal perfect hash of each: every key has a slot of its own and no slot is empty. The
second pass counts the terms of each (language, source) in dense arrays of slots. A perfect hash gives any word a slot, so
each hash has its keys with it, and a word counts only where the key of its slot is the word itself.

The hashes are broadcast while all of them are measured to be small; beyond, tasks count their words first and these are
joined to the slots. Either way a shard's counts come together as one matrix of slots by sources, of bounded size.

Null texts, languages and sources are empty. Columns other than these are left out. Rows may repeat; each counts.
Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. Numbers are whole throughout: shares are
`1 + floor(scale * (count + 1) / (N + V))`, and divergences floored for each term. Pairs of sources of one language are the
result itself, so their number grows with the square of its sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import utf8
from tidemark.operators.joins import join_small_side, settled

#: Least documents of a kept term; the parts per which shares are told; ranks of the part `term`.
LEAST_DOCUMENTS, SCALE, TOP = 3, 10**9, 200
#: Cells of a shard's matrix of slots by sources, and the most keys of a shard.
SHARD_CELLS, SHARD_KEYS = 1 << 20, 1 << 14
#: Bytes of all hashes and keys up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: What a task holds: text at a time, different words, and dense counts.
PIECE_BYTES, HELD_WORDS, HELD_SLOTS = 1 << 20, 400_000, 16 << 20

_CUT = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    text, at = text.translate(_CUT), 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE_BYTES else text.find(b" ", at + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


# --- minimal perfect hashes ---------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(keys: list[bytes], seed: int) -> np.ndarray:
    """Two words of a hash for each key."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(k, seed) for k in keys]), dtype="<u8").reshape(-1, 2)


def _places(h: np.ndarray, shift: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mixed(h + shift.astype(np.uint64) * _GOLDEN) % np.asarray(n, dtype=np.uint64)).astype(np.int64)


def perfect_hash(keys: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, shifts of the buckets, order): key `order[slot]` is in a slot. Keys must differ.

    Keys fall into buckets of four or so; from the fullest on, each bucket tries shifts until its keys meet free places.
    Buckets of one key take what is left: their shift is the place itself, told by a sign.
    """
    n, buckets, seed = len(keys), max(1, len(keys) // 4), 0
    while True:
        h = hashed(keys, seed)
        shifts, order, free = np.zeros(buckets, dtype=np.int32), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        bucket = (h[:, 0] % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        sizes = np.diff(starts)
        if all(_placed(b, by_bucket[starts[b]:starts[b + 1]], h, n, shifts, order, free) for b in np.argsort(-sizes, kind="stable") if sizes[b] > 1):
            single = np.flatnonzero(sizes == 1)
            left = np.flatnonzero(free)[:len(single)]
            shifts[single], order[left] = -1 - left, by_bucket[starts[single]]
            return seed, shifts, order
        seed += 1


def _placed(b: int, own: np.ndarray, h: np.ndarray, n: int, shifts: np.ndarray, order: np.ndarray, free: np.ndarray) -> bool:
    tried, step = 0, 16
    while tried < 1 << 20:
        shift = np.arange(tried, tried + step)
        at = _places(h[own, 1][None, :], shift[:, None], n)
        good = free[at].all(axis=1)
        for i in np.flatnonzero(good):
            if len(set(at[i].tolist())) == len(own):
                shifts[b] = shift[i]
                order[at[i]], free[at[i]] = own, False
                return True
        tried, step = tried + step, min(4 * step, 4096)
    return False


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's hash: shifts, and keys in the order of their slots."""
    keys = [bytes(t) for t in rows["term"]]
    seed, shifts, order = perfect_hash(keys)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "shard": [rows["shard"].iloc[0]], "seed": [seed], "shifts": [shifts.tobytes()], "keys": [[keys[i] for i in order]]})


class Slots:
    """The hashes of a language, as arrays over all of its shards."""

    def __init__(self, shards: list):
        shards = sorted(shards, key=lambda s: s["shard"])
        n = np.array([len(s["keys"]) for s in shards])
        self.ids = np.array([s["shard"] for s in shards])
        self.number = int(shards[0]["shards"])
        self.row = np.full(self.number, -1)
        self.row[self.ids] = np.arange(len(shards))
        self.starts = np.concatenate([[0], np.cumsum(n)])
        shifts = [np.frombuffer(s["shifts"], dtype=np.int32) for s in shards]
        self.buckets = np.array([len(x) for x in shifts])
        self.first = np.concatenate([[0], np.cumsum(self.buckets)])[:-1]
        self.shifts = np.concatenate(shifts)
        self.seeds = np.array([s["seed"] for s in shards])
        self.keys = pa.array([k for s in shards for k in s["keys"]], pa.binary())
        self.size = int(self.starts[-1])

    def find(self, words: list[bytes]) -> np.ndarray:
        """The slot of each word over all shards, -1 for words that are no keys."""
        row = self.row[shard_of(words, self.number)]
        out = np.full(len(words), -1)
        for seed in np.unique(self.seeds):
            # nearly always one seed serves all shards
            own = np.flatnonzero((row >= 0) & (self.seeds[row] == seed))
            if not len(own):
                continue
            h, r = hashed([words[i] for i in own], int(seed)), row[own]
            shift = self.shifts[self.first[r] + (h[:, 0] % self.buckets[r].astype(np.uint64)).astype(np.int64)]
            n = np.diff(self.starts)[r]
            at = np.where(shift < 0, -1 - shift, _places(h[:, 1], np.maximum(shift, 0), n))
            slot = self.starts[r] + at
            same = pc.equal(self.keys.take(pa.array(slot)), pa.array([words[i] for i in own], pa.binary()))
            out[own] = np.where(same.to_numpy(zero_copy_only=False), slot, -1)
        return out


def shard_of(words: list[bytes], shards: int) -> np.ndarray:
    """As Spark's `pmod(xxhash64(word), shards)`."""
    h = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64)
    return np.mod(h.view(np.int64), shards)


# --- passes over the documents ------------------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*filled, utf8().alias("text"))


def _counted(batches: Iterator[pa.RecordBatch], by_document: bool) -> Iterator[tuple[tuple[str, str], Counter]]:
    """Words by (language, source), some at a time: how often, or in how many documents."""
    held: dict[tuple[str, str], Counter] = {}
    size = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text")
        for i, key in enumerate(zip(langs, sources)):
            key = (key[0], "") if by_document else key
            own = held.get(key)
            if own is None:
                own = held[key] = Counter()
            before = len(own)
            if by_document:
                own.update(set().union(*terms(texts[i].as_py())))
            else:
                for piece in terms(texts[i].as_py()):
                    own.update(piece)
            size += len(own) - before
            if size > HELD_WORDS:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _rows_of_words(batches: Iterator[pa.RecordBatch], by_document: bool) -> Iterator[pa.RecordBatch]:
    for (lang, source), words in _counted(batches, by_document):
        if words:
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array([source] * n), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["lang", "source", "term", "n"],
            )


def word_rows(docs: DataFrame, *, by_document: bool) -> DataFrame:
    """(lang, source, term, n), summed within a task as far as its memory goes."""
    return _texts(docs).mapInArrow(lambda batches: _rows_of_words(batches, by_document), "lang string, source string, term binary, n long")


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term) of terms in at least so many documents of their language."""
    found = word_rows(docs, by_document=True).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least).select("lang", "term")


def sharded(kept: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled hashes (lang, shard, shards, seed, shifts, keys), and of each language `v`, its kept terms, and `shards`."""
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v")).join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
    keys = F.greatest(F.lit(16), F.least(F.lit(SHARD_KEYS), F.floor(F.lit(SHARD_CELLS) / F.col("sources"))))
    langs = settled(sizes.select("lang", "v", F.ceil(F.col("v") / keys).alias("shards")))
    placed = join_small_side(kept, langs.select("lang", "shards"), ["lang"])
    placed = placed.select("lang", "term", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"))
    built = placed.groupBy("lang", "shard").applyInPandas(_built, "lang string, shard long, seed long, shifts binary, keys array<binary>")
    return settled(join_small_side(built, langs.select("lang", "shards"), ["lang"])), langs


_CELLS = "lang string, source string, shard long, size long, n long, slots binary, counts binary"
_CELL_NAMES = [part.split()[0] for part in _CELLS.split(", ")]


def packed(slots: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sum of counts, and slots and counts as bytes, counts in as few as their largest needs."""
    width = np.min_scalar_type(int(counts.max()) if len(counts) else 0)
    return int(counts.sum()), slots.astype("<u4").tobytes(), counts.astype(width).tobytes()


def unpacked(slots: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(slots, dtype="<u4").astype(np.int64)
    return at, np.frombuffer(counts, dtype=f"<u{len(counts) // max(1, len(at)) or 1}").astype(np.int64)


def _cell_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], _CELL_NAMES)


def slot_counts(docs: DataFrame, hashes: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, source, shard, size, n, slots, counts): what a source has of a shard's terms, and their sum n."""
    key_bytes = F.aggregate("keys", F.lit(0).cast("long"), lambda s, k: s + F.octet_length(k) + 8)
    size = hashes.agg(F.coalesce(F.sum(key_bytes + F.octet_length("shifts")), F.lit(0)).alias("b")).first()["b"]
    if size <= limit:
        by_lang: dict[str, list] = {}
        for row in hashes.toLocalIterator():
            by_lang.setdefault(row["lang"], []).append(row.asDict())
        slots = docs.sparkSession.sparkContext.broadcast({lang: Slots(own) for lang, own in by_lang.items()})
        found = _texts(docs).mapInArrow(lambda batches: _slot_rows(batches, slots.value), _CELLS)
    else:
        keys = hashes.select("lang", "shard", F.size("keys").cast("long").alias("size"), F.posexplode("keys").alias("slot", "term"))
        words = word_rows(docs, by_document=False).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        found = words.join(keys, ["lang", "term"]).select("lang", "source", "shard", "size", F.col("slot").cast("long").alias("slot"), "n").mapInArrow(_packed_rows, _CELLS)
    # a shard's rows are added up as a stream, however many tasks they come from
    return found.repartition("lang", "shard").sortWithinPartitions("lang", "shard").mapInArrow(_summed, _CELLS)


def _slot_rows(batches: Iterator[pa.RecordBatch], slots: dict[str, Slots]) -> Iterator[pa.RecordBatch]:
    dense: dict[tuple[str, str], np.ndarray] = {}
    held = tokens = 0

    def written() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in dense.items():
            starts, ids = slots[lang].starts, slots[lang].ids
            at = np.flatnonzero(counts)
            cuts = np.searchsorted(at, starts)
            rows = [
                (lang, source, int(ids[i]), int(starts[i + 1] - starts[i]), *packed(at[a:b] - starts[i], counts[at[a:b]]))
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b
            ]
            if rows:
                yield _cell_batch(rows)

    for (lang, source), words in _counted(batches, by_document=False):
        own = slots.get(lang)
        if own is None or not words:
            continue
        found = own.find(list(words))
        n, known = np.fromiter(words.values(), dtype=np.int64, count=len(words)), found >= 0
        tokens += int(n.sum())
        more = 0 if (lang, source) in dense else own.size
        if dense and (held + more > HELD_SLOTS or tokens >= 1 << 32):
            yield from written()
            dense, held, tokens, more = {}, 0, int(n.sum()), own.size
        if more:
            # where a single flush counts more than fits, its slots are wider
            dense[lang, source] = np.zeros(own.size, dtype=np.uint32 if tokens < 1 << 32 else np.uint64)
            held += more
        dense[lang, source][found[known]] += n[known].astype(dense[lang, source].dtype)
    yield from written()


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of single slots as rows of many, batch by batch."""
    for batch in batches:
        rows = batch.to_pandas()
        if len(rows):
            yield _cell_batch([
                (*key, *packed(own["slot"].to_numpy(), own["n"].to_numpy())) for key, own in rows.groupby(["lang", "source", "shard", "size"], sort=False)
            ])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, each source's added up in one dense array."""
    current, dense = None, {}

    def written() -> Iterator[pa.RecordBatch]:
        rows = [(*current[:1], source, *current[1:], *packed(at, counts[at])) for source, counts in dense.items() for at in [np.flatnonzero(counts)]]
        if rows:
            yield _cell_batch(rows)

    for batch in batches:
        for lang, source, shard, size, _, slots, counts in zip(*(batch.column(name).to_pylist() for name in _CELL_NAMES)):
            if current != (lang, shard, size):
                yield from written()
                current, dense = (lang, shard, size), {}
            if source not in dense:
                dense[source] = np.zeros(size, dtype=np.int64)
            at, n = unpacked(slots, counts)
            dense[source][at] += n
    yield from written()


# --- divergence ---------------------------------------------------------------------------------------------------


def shares(counts: np.ndarray, total: int, v: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + 1) / (total + v)), exact."""
    if scale * (total + v + 1) < 1 << 63:
        return 1 + scale * (counts + 1) // (total + v)
    return np.array([1 + scale * (int(c) + 1) // (total + v) for c in counts], dtype=np.int64)


def _compared(key: tuple, cells: pd.DataFrame, keys: pd.DataFrame, scale: int, top: int) -> pd.DataFrame:
    """A shard's part of each pair's divergence, and the terms that may be among a source's first."""
    out = {"lang": [], "source": [], "part": [], "item": [], "value": []}
    if keys.empty:
        return pd.DataFrame(out)
    lang, words, v = key[0], [bytes(k) for k in keys["keys"].iloc[0]], int(keys["v"].iloc[0])
    totals = cells[cells["slots"].isna()].sort_values("source")
    sources, n = totals["source"].to_list(), totals["n"].to_list()
    number = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(sources), len(words)), dtype=np.int64)
    for source, slots, found in cells.loc[~cells["slots"].isna(), ["source", "slots", "counts"]].itertuples(index=False):
        at, here = unpacked(bytes(slots), bytes(found))
        counts[number[source], at] = here
    p = np.stack([shares(c, int(total), v, scale) for c, total in zip(counts, n)])
    q = shares(counts.sum(axis=0), sum(int(x) for x in n), v, scale)
    texts = np.array([w.decode("utf-8", "replace") for w in words], dtype=object)
    for i, source in enumerate(sources):
        value = ((p[i] - p) ** 2 // p).sum(axis=1)
        others = [j for j in range(len(sources)) if j != i]
        here = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        f = (p[i][here] - q[here]) ** 2 // q[here]
        first = sorted(range(len(here)), key=lambda k: (-f[k], words[here[k]]))[:top]
        out["source"] += [source] * (len(others) + len(first))
        out["part"] += ["pair"] * len(others) + ["term"] * len(first)
        out["item"] += [sources[j] for j in others] + texts[here[first]].tolist()
        out["value"] += value[others].tolist() + f[first].tolist()
    out["lang"] = [lang] * len(out["source"])
    return pd.DataFrame(out)


def divergence(docs: DataFrame, *, least: int = LEAST_DOCUMENTS, scale: int = SCALE, top: int = TOP, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language its divergence from each other source
    (`pair`), and the first terms that it uses more than its language (`term`)."""
    groups = settled(_texts(docs).select("lang", "source").distinct())
    hashes, langs = sharded(settled(kept_terms(docs, least)), groups)
    counts = settled(slot_counts(docs, hashes, limit))
    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    keys = hashes.join(langs.select("lang", "v"), "lang").select("lang", "shard", "v", "keys")
    # every shard has a row of each source's total, without slots
    nothing = F.lit(None).cast("binary")
    heads = totals.join(hashes.select("lang", "shard"), "lang").select("lang", "source", "shard", "n", nothing.alias("slots"), nothing.alias("counts"))
    cells = counts.select(*heads.columns).unionByName(heads)
    parts = cells.groupBy("lang", "shard").cogroup(keys.groupBy("lang", "shard")).applyInPandas(
        lambda key, left, right: _compared(key, left, right, scale, top), "lang string, source string, part string, item string, value long",
    )
    parts = settled(parts)
    # languages without kept terms have pairs too
    others = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = parts.where("part = 'pair'").unionByName(others).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(by))
    found = ranked(parts.where("part = 'term'")).where(F.col("rank") <= top)
    return ranked(pairs).unionByName(found)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = rf"""with d as (select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') t from documents),
w as (select id, lang, source, {_LOWER.format("unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'))")} term from d),
kept as (select lang, term from w group by all having count(distinct id) >= {LEAST_DOCUMENTS}),
g as (select distinct lang, source from d),
v as (select g.lang, count(k.term) v from (select distinct lang from g) g left join kept k using (lang) group by all),
c as (select lang, source, term, count(*) n from w semi join kept using (lang, term) group by all),
full_c as (select g.lang, g.source, k.term, coalesce(c.n, 0) n from g join kept k using (lang) left join c using (lang, source, term)),
total as (select lang, source, sum(n) big from full_c group by all),
p as (select f.lang, f.source, f.term, f.n, cast(1 + ({SCALE}::hugeint * (f.n + 1)) // (t.big + v.v) as hugeint) p
 from full_c f join total t using (lang, source) join v using (lang)),
q as (select lang, term, cast(1 + ({SCALE}::hugeint * (sum(n) + 1)) // (any_value(b) + any_value(v.v)) as hugeint) q
 from full_c join (select lang, sum(big) b from total group by all) using (lang) join v using (lang) group by all),
pairs as (select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) value
 from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
told as (
 select a.lang, a.source, 'pair' part, b.source item, coalesce(value, 0) value
 from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
 union all select p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // q from p join q using (lang, term) where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
from told qualify part = 'pair' or row_number() over (partition by lang, source, part order by value desc, item) <= {TOP}"""
