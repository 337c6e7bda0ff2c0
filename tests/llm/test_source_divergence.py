"""The recount by perfect hashes against plain counting and SQL."""

import collections
import re

import brute
import duckdb
import numpy as np
import pytest
from edge_cases import edge, edge_rows, nothing  # noqa: F401
from hypothesis import given as cases, settings, strategies as st

from tidemark.llm import registry, source_divergence as D

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text or ""))


def plain(rows, least=3, scale=10**9, top=200):
    """Of (text, lang, source): sorted rows of the contract."""
    rows = [(terms(t), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [(t, s) for t, of, s in rows if of == lang]
        frequency = collections.Counter(t for ts, _ in own for t in set(ts))
        kept = [t for t, n in frequency.items() if n >= least]
        sources = {s for _, s in own}
        counts = {s: collections.Counter(t for ts, of in own if of == s for t in ts) for s in sources}
        whole = collections.Counter(t for ts, _ in own for t in ts)

        def shares(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + scale * (of[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(counts[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            more = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = connection.execute(f"select {', '.join(COLUMNS)} from ({D.ORACLE})").fetchall()
    assert got(registry.QUERIES["op13_source_divergence"](spark, sf_dir)) == sorted(want)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_edge_cases(spark, edge, edge_rows, nothing, limit):
    assert D.divergence(nothing, limit=limit).count() == 0
    assert got(D.divergence(edge, limit=limit)) == plain([(r[1], r[2], r[3]) for r in edge_rows])


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_small_shards_and_memory(spark, monkeypatch, limit):
    """Many shards, flushes in between, ties, groups without terms, a low rank."""
    for name, value in {"SHARD_KEYS": 20, "HELD_WORDS": 15, "HELD_SLOTS": 30, "PIECE_BYTES": 7}.items():
        monkeypatch.setattr(D, name, value)
    random = np.random.default_rng(7)
    words = [f"{'äb'[i % 2]}{'x' * (i % 5)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(" ".join(random.choice(words, 25)).upper() if i % 3 else "1 2", f"l{i % 2}" if i % 7 else None, f"s{i % 5}") for i in range(120)] + [("", "l0", "empty"), ("rare", "alone", "a"), ("", "alone", None)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert got(D.divergence(frame, top=7, limit=limit)) == plain(rows, top=7)


@settings(max_examples=60, deadline=None)
@cases(st.sets(st.binary(min_size=1, max_size=6), min_size=1, max_size=400))
def test_hash_is_perfect_and_minimal(keys):
    keys = sorted(keys)
    seed, shifts, order = D.perfect_hash(keys)
    assert sorted(order.tolist()) == list(range(len(keys)))
    shard = {"shard": 0, "shards": 1, "seed": seed, "shifts": shifts.tobytes(), "keys": [keys[i] for i in order]}
    slots = D.Slots([shard])
    assert sorted(slots.find(keys).tolist()) == list(range(len(keys)))
    assert (slots.find([k + b"no" for k in keys if k + b"no" not in keys] or [b"1234567"]) == -1).all()


def test_shards_are_those_of_spark(spark):
    words = ["a", "é", "word", "x" * 100]
    want = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("pmod(xxhash64(cast(w as binary)), 13)").collect()]
    assert D.shard_of([w.encode() for w in words], 13).tolist() == want


def test_shares_are_exact():
    big = 10**12
    assert D.shares(np.array([0, 5, big - 1]), big, 7, 10**9).tolist() == [1 + 10**9 * (c + 1) // (big + 7) for c in (0, 5, big - 1)]
