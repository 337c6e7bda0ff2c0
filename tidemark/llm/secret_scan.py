"""Secret scan: fixed patterns, and how many owners and repositories hold each candidate value.

Candidates are the values that the patterns find and bare long tokens that look like keys. Their hashes are counted over
the corpus by distinct owner and by distinct repository of an owner. A value of few owners that looks random is live; one
that many owners hold was copied from an example. Bare tokens that are live become spans of the kind `owned`; the
patterns' spans always stay.

Null texts count as empty; a null owner counts as one owner. Rows of the same id and text are reported alike, each once.
Values themselves are never returned, only their places and, inside, their hashes.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import slices, text_key, utf8
from tidemark.operators.joins import settled

# The patterns and least lengths of the base kinds, in the order of spans that start together.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "owned")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: Bare tokens: long, with a letter and a digit.
BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LEAST_BARE, LEAST_ENTROPY = 20, 2.5
#: A value that more owners hold is an example that was copied.
MAX_OWNERS = 3
MASK = "[SECRET]"

_PLACES = ("rank", "start", "end", "value_start", "value_end")
_CANDIDATE = StructType([*(StructField(n, IntegerType()) for n in _PLACES), StructField("hash", StringType()), StructField("random", BooleanType())])


def looks_random(value: str) -> bool:
    """A letter and a digit, and characters as mixed as those of a key."""
    if not (re.search("[A-Za-z]", value) and re.search("[0-9]", value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in map(value.count, set(value))) >= LEAST_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, int, int, str, bool]]:
    """(rank of the kind, start, end, start and end of the value, hash of the value, whether it looks random) by start."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, *m.span(), *m.span(2), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(1, *m.span(), *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    long = any(len(w) >= LEAST_BARE for w in text.split())
    if long:
        found += [(2, *m.span(), *m.span(), m[0]) for m in HEX.finditer(text)]
        # inside of a pattern's span a token is no finding of its own
        bare = outside([m for m in BARE.finditer(text) if looks_random(m[0])], sorted((a, b) for _, a, b, *_ in found))
        found += [(3, *m.span(), *m.span(), m[0]) for m in bare]
    found.sort(key=lambda f: (f[1], f[0]))
    return [(*f[:5], hashlib.sha256(f[5].encode()).hexdigest(), f[0] == 1 or looks_random(f[5])) for f in found]


def outside(matches: list[re.Match], spans: list[tuple[int, int]]) -> list[re.Match]:
    """Matches, in order, that touch none of the spans, sorted by start. Both lists are walked once."""
    free, at, reach = [], 0, 0
    for m in matches:
        # of the spans that begin before the match ends, the farthest end tells
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][1])
            at += 1
        if reach <= m.start():
            free.append(m)
    return free


@arrow_udf(ArrayType(_CANDIDATE))
def _candidates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([*((n, pa.int32()) for n in _PLACES), ("hash", pa.string()), ("random", pa.bool_())]))
    for batch in batches:
        rows = [candidates(t.decode("utf-8", "replace")) for texts in slices(batch) for t in texts]
        yield pa.array([[dict(zip((*_PLACES, "hash", "random"), c)) for c in row] for row in rows], kind)


def ownership(found: DataFrame) -> DataFrame:
    """From rows (owner, repository, hash): `owners` and `repositories` of each hash."""
    pairs = found.select("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).distinct()
    by_owner = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def _spans(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda c: F.concat_ws(":", F.element_at(kinds, c["rank"] + 1), c["start"], c["end"])), ",")


def owned(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """All rows (doc_id, key, owner, repository, found)."""
    found = _candidates.asNondeterministic()(utf8()).alias("found")
    return docs.select("doc_id", *text_key(), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), found)


def judged(
    docs: DataFrame, owner: Column, repository: Column, *, max_owners: int = MAX_OWNERS, corpus: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All rows (doc_id, key, found), and by key the candidates with `live` and `copied`. Owners are counted over `docs`,
    and over `corpus` too where it is given: what `docs` were chosen from."""
    rows = settled(owned(docs, owner, repository))
    each = rows.where(F.size("found") > 0).select("__id", "__hash", "owner", "repository", F.explode("found").alias("c"))
    holders = each.select("owner", "repository", "c.hash")
    if corpus is not None:
        more = owned(corpus, owner, repository).select("owner", "repository", F.explode("found").alias("c"))
        holders = holders.unionByName(more.select("owner", "repository", "c.hash"))
    # settled, so that Spark may split the join where very many rows hold one value
    counts = settled(ownership(holders))
    known = each.select("__id", "__hash", "c.*").join(counts, "hash")
    few = F.col("owners") <= max_owners
    item = F.struct("start", "rank", "end", "value_start", "value_end", (few & F.col("random")).alias("live"), (~few).alias("copied"), "owners", "repositories")
    return rows, known.groupBy("__id", "__hash").agg(F.array_sort(F.collect_set(item)).alias("judged"))


def scan(docs: DataFrame, *, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: counts and hash of the patterns' spans, all spans, and how many candidates are live and copied.

    By default the source is the owner, and a language of a source a repository.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("lang") if repository is None else repository
    rows, known = judged(docs, owner, repository, max_owners=max_owners)
    base = F.filter("found", lambda c: c["rank"] < 3)
    count = lambda rank: F.size(F.filter("found", lambda c: c["rank"] == rank)).cast("long")
    out = rows.join(known, ["__id", "__hash"], "left").withColumn("all", F.filter("judged", lambda c: (c["rank"] < 3) | c["live"]))
    number = lambda test: F.coalesce(F.size(F.filter("judged", test)), F.lit(0)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_spans(base), 256).alias("base_sha256"),
        F.coalesce(_spans(F.col("all")), F.lit("")).alias("spans"), number(lambda c: c["live"]).alias("n_live"), number(lambda c: c["copied"]).alias("n_copied"),
    )


@arrow_udf(StringType())
def _masked(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for raw, found in zip(text.to_pylist(), spans.to_pylist()):
        value, at, parts = raw.decode("utf-8", "replace"), 0, []
        for a, b in sorted((s["value_start"], s["value_end"]) for s in found or ()):
            if b <= at:
                continue
            if a >= at:
                parts += [value[at:a], MASK]
            at = b
        out.append("".join([*parts, value[at:]]))
    return pa.array(out, pa.string())


def mask_live(
    docs: DataFrame, *, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS, corpus: DataFrame | None = None,
) -> DataFrame:
    """All documents, with live values replaced by a mark; texts without one stay as they are.

    Owners are counted over `docs` and over `corpus`, what they were chosen from: where copies of an example were removed,
    the one that is left has one owner only. Only documents with a candidate are shuffled with their text.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("lang") if repository is None else repository
    _, known = judged(docs, owner, repository, max_owners=max_owners, corpus=corpus)
    live = known.select("__id", "__hash", F.filter("judged", lambda c: c["live"]).alias("__live")).where(F.size("__live") > 0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn("__n", F.size(_candidates.asNondeterministic()(utf8())))
    clean = keyed.where("__n = 0").select(*columns)
    some = keyed.where("__n > 0").select(*columns, *text_key()).join(live, ["__id", "__hash"], "left")
    text = F.when(F.col("__live").isNull(), F.col("text")).otherwise(_masked(utf8(), F.col("__live"))).alias("text")
    return clean.unionByName(some.select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns]))
