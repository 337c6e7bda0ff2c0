"""Scores of learned operators against plain versions: the model is taken as it was trained, all else is done anew."""

import hashlib
import math
import random
import re
import time

import brute
import duckdb
import numpy as np
import pytest
import zstandard
from edge_cases import edge, edge_rows, labels, nothing  # noqa: F401
from hypothesis import given as cases, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import compression_quality, license_diagonals, mixing, recurrent_lm, secret_scan, simhash_anchors, token_counts, toxicity_crf
from tidemark.llm.common import read


def inputs(spark, sf_dir, edge, labels):
    folder = sf_dir.replace("sf0.001", "sf0.01")  # the smallest has too few labels to learn from
    return [(read(spark, folder, "documents"), read(spark, folder, "labels")), (edge, labels)]


def curve(z):
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def compared(got, want):
    got, want = by_row(map(tuple, got)), by_row(want)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and all(a == b or isinstance(a, float) and math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9) for a, b in zip(g[1:], w[1:])), (g, w)


def test_compression_scores(spark, sf_dir, edge, labels):
    for docs, known in inputs(spark, sf_dir, edge, labels):
        model = compression_quality.train(docs, known)

        def sizes(text):
            out = []
            for raw in (model.good, model.bad):
                given = {"dict_data": zstandard.ZstdCompressionDict(raw)} if len(raw) >= 8 else {}
                plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False} if given else {}
                out.append(len(zstandard.ZstdCompressor(level=3, **given, **plain).compress(text)))
            return out

        want = []
        for row in docs.select("doc_id", "text").collect():
            text = (row["text"] or "").encode()
            difference = ratio = 0.0
            if text:
                good, bad = sizes(text)
                difference, ratio = (bad - good) / max(bad, good), math.log(min(bad, good) / len(text))
            p = curve(model.weights[0] * difference + model.weights[1] * ratio + model.weights[2])
            want.append((row["doc_id"], p, int(p >= 0.3), brute.held(row["doc_id"], 5, 0)))
        compared(compression_quality.scored(docs, model).select("doc_id", "score", "predicted", "held_out").collect(), want)


def test_fitting_bounds_are_parameters(spark, edge, labels):
    small = compression_quality.train(edge, labels, pieces=1, piece_bytes=64, dict_bytes=128)
    assert len(small.good) <= 128 and len(small.bad) <= 128
    rows = compression_quality._pieces(edge.selectExpr("doc_id", "text", "cast(doc_id % 2 as int) label"), 2, 16)
    assert all(len(pieces) <= 2 and all(len(p) <= 16 for p in pieces) for pieces in rows.values())


def plain_marginals(chain, words):
    """Forward-backward one token at a time."""
    energy = [math.exp(max(-30.0, min(30.0, chain.energy(w)))) for w in words]
    m01, m10, m11 = (math.exp(m) for m in chain.moves)
    forward, backward = [], []
    for t, e in enumerate(energy):
        a, b = (1.0, math.exp(chain.start) * e) if t == 0 else (forward[-1][0] + forward[-1][1] * m10, (forward[-1][0] * m01 + forward[-1][1] * m11) * e)
        forward.append((a / (a + b), b / (a + b)))
    after = (1.0, 1.0)
    for t in range(len(words) - 1, -1, -1):
        backward.append(after)
        c = energy[t] * after[1]
        after = (after[0] + m01 * c, m10 * after[0] + m11 * c)
        after = (after[0] / sum(after), after[1] / sum(after))
    backward.reverse()
    return [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(forward, backward)]


def test_toxicity_scores_and_places(spark, sf_dir, edge, labels):
    for docs, known in inputs(spark, sf_dir, edge, labels):
        model = toxicity_crf.train(docs, known)
        want, places = [], 0
        for row in docs.select("doc_id", "text").collect():
            text = row["text"] or ""
            p = plain_marginals(model.chain, text.encode().lower().split())
            most, expected = max(p, default=0.0), sum(p)
            most = min(max(most, 1e-6), 1 - 1e-6)
            a, b, c = model.weights
            score = curve(a * math.log(most / (1 - most)) + b * math.log1p(expected) + c)
            spans = ",".join(f"{m.start()}:{m.end()}" for m, x in zip(re.finditer(brute.SPACES, text), p) if x >= 0.5)
            places += bool(spans)
            want.append((row["doc_id"], score, int(score >= 0.5), spans))
        compared(toxicity_crf.scored(docs, model).select("doc_id", "score", "predicted", "spans").collect(), want)
        assert places or docs is edge


NUMBER = st.floats(-9, 9)


@settings(max_examples=60, deadline=None)
@cases(NUMBER, NUMBER, st.tuples(NUMBER, NUMBER, NUMBER), st.lists(st.integers(0, 3000), min_size=1, max_size=4))
def test_texts_without_cues_are_run_whole(bias, start, moves, lengths):
    chain = toxicity_crf.Chain({}, bias, start, moves)
    tagger = toxicity_crf.Tagger(chain)
    full = [toxicity_crf._summary(p) for p in tagger._run([np.full(n, bias) for n in lengths])]
    got = tagger.summaries([b"w " * n for n in lengths])
    assert np.allclose(got, full, rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("moves", [(-7, -7, 0.5), (-9, -9, 2.0), (-6, -6, 3.0)])
def test_slow_chains(moves):
    chain = toxicity_crf.Chain({}, 0.0, 0.0, moves)
    p = plain_marginals(chain, [b"w"] * 4000)
    assert np.allclose(toxicity_crf.Tagger(chain).summaries([b"w " * 4000]), [(max(p), sum(p))])


def test_cues_are_those_of_most_evidence(spark):
    texts = [(f"bad{i} here" if i % 2 else f"fine{i} there {'x' * (i % 9)} word", i % 2) for i in range(400)]
    rows = spark.createDataFrame([(t.encode(), label) for t, label in texts], "b binary, label int")
    found = toxicity_crf.find_cues(rows, 200, 200)
    assert b"=here" in found and b"=there" not in found
    counts = {c.decode() for c in toxicity_crf.find_cues(rows, 200, 200, bound=1)}
    assert len(counts) <= 1


def vocabulary(spark, words, head):
    return recurrent_lm.vocabulary(spark.createDataFrame([(w.encode(), n) for w, n in words], "word binary, n long"), head)


def test_head_is_filled_up_to_its_limit(spark, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "WORDS", 20)
    words = [("", 7), *((f"w{i}", 1) for i in range(50))]
    assert len(vocabulary(spark, words, 40).head) == 40 + 1
    assert len(vocabulary(spark, words, 50).head) == len(vocabulary(spark, words, 10**6).head) == 50 + 1
    assert len(vocabulary(spark, words, 3).head) == 18 + 1  # the network's words at least
    mixed = [("", 9), *((f"m{i}", 1000 - i // 3) for i in range(90))]
    got = vocabulary(spark, mixed, 31)
    assert len(got.head) == 31 + 1 and {f"m{i}".encode() for i in range(30)} < set(got.head)
    assert got.tokens == 9 + sum(n for _, n in mixed[1:]) and got.types == 91
    assert got.counts.tolist()[1:] == sorted(got.counts.tolist()[1:], reverse=True) or got.counts[1] == 9
    assert len(vocabulary(spark, [("", 1)], 5).head) == 1


def test_many_findings_in_one_text_are_walked_once():
    text = " ".join(f"{i:040x} key{i:037x}zQ" for i in range(20_000))
    started = time.perf_counter()
    found = secret_scan.candidates(text)
    assert time.perf_counter() - started < 5 and len(found) >= 20_000


def test_tokens_in_a_pattern_are_no_findings_of_their_own():
    source = random.Random(4)
    for _ in range(300):
        text = "".join(source.choice("ab ") for _ in range(80))
        matches = list(re.finditer("a+", text))
        spans = sorted((a, a + source.randrange(1, 12)) for a in (source.randrange(80) for _ in range(source.randrange(8))))
        want = [m.span() for m in matches if not any(a < m.end() and m.start() < b for a, b in spans)]
        assert [m.span() for m in secret_scan.outside(matches, spans)] == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_owner_counts_may_be_split(spark, edge):
    _, known = secret_scan.judged(edge, edge["source"], edge["lang"])
    plan = plan_of(known)
    join = plan[plan.index("Join"):]
    # of both sides of the join, nothing but rows that were kept before comes before the exchange
    assert plan.count("Scan ExistingRDD") == 2 and "distinct" not in join.lower()


def test_copied_examples_stay_where_copies_were_removed(spark):
    key = "sk1234567890abcdefXYZ99"
    rows = [(i, f"the same words around {key} of an example", "en", f"src{i}") for i in range(8)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    left = corpus.where("doc_id = 3")
    assert secret_scan.mask_live(left).first()["text"] != rows[3][1]
    assert secret_scan.mask_live(left, corpus=corpus).first()["text"] == rows[3][1]


def test_licenses_lower_only_ascii(spark):
    rows = [(1, "Under The MIT license"), (2, "under the MİT license"), (3, "under the mit licenſe under the MIT License")]
    got = {r["doc_id"]: (r["n_base"], r["n_words"]) for r in license_diagonals.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 4), 2: (0, 4), 3: (1, 8)}
    kelvin = license_diagonals.scan(spark.createDataFrame([(1, "a K b")], "doc_id long, text string"), [("k", "a k b", True)])
    assert kelvin.first()["n_base"] == 0


def test_licenses_move_no_words(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(license_diagonals, "join_small_side", lambda large, small, on, how: large.join(small, list(on), how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(license_diagonals.scan(read(spark, sf_dir, "documents")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and "words" not in "".join(exchanged).replace("n_words", "")
    below = plan[plan.rindex("SortMergeJoin"):]
    assert "n_words" in below


def test_known_texts_are_not_moved(spark, sf_dir, folder, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path, docs = public_tokenizers.path("byte_bpe_50k.json"), read(spark, sf_dir, "documents")
    cache = f"{folder}/cache"
    first = sorted(map(tuple, token_counts.token_counts(docs, path, limit=512, cache=cache).collect()))
    seen = []
    real = token_counts.counted
    monkeypatch.setattr(token_counts, "counted", lambda p: lambda column: seen.append(1) or real(p)(column))
    plans = []
    write = type(docs.write).parquet

    def spy(self, *args, **kwargs):
        plans.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(type(docs.write), "parquet", spy)
    assert sorted(map(tuple, token_counts.token_counts(docs, path, limit=512, cache=cache).collect())) == first
    (plan,) = [p for p in plans if "count(" in p]
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan
    assert spark.read.parquet(cache).count() == len({r["text"] for r in docs.select("text").collect()})
    assert token_counts.file_digest(path) != hashlib.sha256(open(path, "rb").read()).hexdigest()


def test_mixture_of_repeated_ids_equals_sql(spark, sf_dir, edge, folder):
    options = {"share": 0.6, "epochs": 3, "seed": 7}
    given = read(spark, sf_dir, "documents")
    again = given.where("doc_id % 3 = 0").unionByName(given.where("doc_id % 10 = 0").withColumn("source", F.lit("src1")))
    for name, documents in (("repeated", given.unionByName(again)), ("edges", edge.select(given.columns))):
        documents.write.parquet(f"{folder}/{name}")
        connection = duckdb.connect()
        connection.execute(f"create view documents as select * from '{folder}/{name}/*.parquet'")
        result = connection.execute(mixing.oracle(**options))
        names = [d[0] for d in result.description]
        got = mixing.mix(spark.read.parquet(f"{folder}/{name}"), mixing.domain_tree(), **options).select(*names)
        assert by_row(map(tuple, got.collect())) == by_row(result.fetchall())


def test_ranges_of_a_leaf_are_cut_until_small(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    monkeypatch.setattr(mixing, "RANGE_DIGITS", 1)
    options = {"share": 0.6, "epochs": 3, "seed": 7}
    docs = read(spark, sf_dir, "documents")
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    result = connection.execute(mixing.oracle(**options))
    names = [d[0] for d in result.description]
    assert by_row(map(tuple, mixing.mix(docs, mixing.domain_tree(), **options).select(*names).collect())) == by_row(result.fetchall())


def test_long_texts_are_fingerprinted_in_stretches(monkeypatch):
    source = random.Random(3)
    texts = [" ".join(source.choice(["a", "bc", "Def", "é"]) for _ in range(n)).encode() for n in (2, 3, 40, 41, 97, 98, 99, 100, 101, 500)]
    want = [brute.fingerprint(t.decode()) for t in texts]
    for part in (1, 7, 98, 10**6):
        monkeypatch.setattr(simhash_anchors, "PART", part)
        assert simhash_anchors.fingerprints(texts).tolist() == want


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_one_row_of_each_group_stays(spark, edge, edge_rows, monkeypatch, limit):
    monkeypatch.setattr(simhash_anchors, "join_small_side", lambda *a, f=simhash_anchors.join_small_side, **k: f(*a, **k, limit=limit))
    prints = [brute.fingerprint(r[1]) for r in edge_rows]
    groups = brute.component_ids([r[0] for r in edge_rows], prints)
    got = simhash_anchors.keep_one(edge)
    assert got.columns == edge.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    by_group = {}
    for row, print_, group in zip(edge_rows, prints, groups):
        by_group.setdefault(group if group is not None else ("alone", print_), []).append((row[0], row[1]))
    assert len(kept) == len(by_group)
    for group, members in by_group.items():
        (own,) = [k for k in kept if k in members and (k[0] == group or not isinstance(group, int))]
        assert own[0] == (group if isinstance(group, int) else None)
