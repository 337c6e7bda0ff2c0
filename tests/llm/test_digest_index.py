"""Exact deduplication against an index: SQL, edge cases, several batches."""

import collections
import hashlib

import brute
import duckdb
import pytest
from edge_cases import edge, edge_rows, nothing  # noqa: F401

from tidemark.llm import digest_index, registry
from tidemark.llm.digest_index import DigestIndex, deduplicate

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def sha(text):
    return hashlib.sha256(brute.lower(text or "").encode()).hexdigest()


def plain(rows):
    """Of (doc_id, text): sorted rows of the contract; of rows that tie one is kept."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[sha(text)].append(i)
    out = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        place = ids.index(keep)
        out += [(i, keep, len(ids), at == place, digest) for at, i in enumerate(ids)]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = connection.execute(f"select {', '.join(COLUMNS)} from ({digest_index.oracle()})").fetchall()
    assert got(registry.QUERIES["op12_digest_index"](spark, sf_dir)) == sorted(want, key=repr)


def test_edge_cases(spark, folder, edge, edge_rows, nothing):
    index = DigestIndex(spark, f"{folder}/index", buckets=3)
    assert deduplicate(nothing, index, batch="none").count() == 0 == index.read().count()
    assert got(deduplicate(edge, index, batch="first")) == plain([r[:2] for r in edge_rows])
    same = [(None, "Ä b"), (None, "Ä B"), (3, "ä b")]
    assert got(deduplicate(spark.createDataFrame(same, "doc_id long, text string"), index, batch="second")) == plain(same)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_later_batches_meet_what_the_index_has(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(digest_index, "join_small_side", lambda *a, f=digest_index.join_small_side: f(*a, limit=limit))
    types = "doc_id long, text string"
    first = spark.createDataFrame([(1, "One"), (5, "one"), (2, "two")], types)
    second = spark.createDataFrame([(9, "ONE"), (7, "three"), (6, "Three")], types)
    index = DigestIndex(spark, f"{folder}/index", buckets=4)
    assert got(deduplicate(first, index, batch="a")) == sorted([(1, 5, 2, False, sha("one")), (5, 5, 2, True, sha("one")), (2, 2, 1, True, sha("two"))], key=repr)
    want = sorted([(9, 5, 1, False, sha("one")), (7, 7, 2, True, sha("three")), (6, 7, 2, False, sha("three"))], key=repr)
    again = DigestIndex(spark, f"{folder}/index")  # its number of buckets is found
    assert again.buckets == 4
    assert got(deduplicate(second, again, batch="b")) == want
    # a batch that runs again gets the same answer and adds nothing
    assert got(deduplicate(second, again, batch="b")) == want
    assert again.read().count() == 3
    packed = again.compacted(f"{folder}/packed", buckets=2)
    assert sorted(map(tuple, packed.read().collect())) == sorted(map(tuple, again.read().collect()))
    with pytest.raises(ValueError):
        DigestIndex(spark, f"{folder}/index", buckets=5)


def test_plan_merges_in_the_buckets_of_the_index(spark, folder):
    index = DigestIndex(spark, f"{folder}/index", buckets=4)
    deduplicate(spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string"), index, batch="a")
    lacking = index.lacking(spark.createDataFrame([(b"x" * 32,)], "digest binary"))
    plan = lacking._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # of the new digests alone
    assert lacking.count() == 1
