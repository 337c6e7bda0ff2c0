"""Operators on pairs and mixtures, and the pipeline, against plain versions and SQL."""

import re

import brute
import duckdb
import pandas as pd
import pytest
from checks.compare import oracle, rows_of
from edge_cases import edge, edge_rows, labels, nothing  # noqa: F401
from pyspark.sql import functions as F
from test_documents import same

import corpus_pipeline
from tidemark.llm import containment, mixing, quality_rules, registry, secret_scan
from tidemark.llm.common import read


def pairs(spark, sf_dir):
    docs, items = (read(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return [tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()]


def test_containment(spark, sf_dir, edge, edge_rows, nothing):
    docs, items = pairs(spark, sf_dir)
    columns = ["doc_id", "item_id", "n_shingles", "n_shared"]
    want = brute.contained(docs, items)
    assert want
    same(registry.QUERIES["op6_containment"](spark, sf_dir).select(*columns).collect(), want)
    item_rows = [(1, "word3 and word4 AND word5, and (word6) and"), (1, "word3 and word4 AND word5, and (word6) and"), (2, "four words, no shingle"), (3, None), (None, "six seven eight nine ten one two three"), (4, "")]
    items = spark.createDataFrame(item_rows, "item_id long, text string")
    for bound in (500_000, 1):
        got = containment.contained(edge, items, bound=bound)
        same(got.select(*columns).collect(), brute_pairs := [(d, i, a, b) for d, i, a, b in contained_rows(edge_rows, item_rows)])
        assert brute_pairs
    kept = containment.drop_contaminated(edge, items, bound=1)
    assert kept.columns == edge.columns and kept.count() == len(edge_rows) - len([r for r in edge_rows if contained_rows([r], item_rows)])
    assert containment.contained(nothing, items).count() == 0 and containment.contained(edge, nothing.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def contained_rows(edge_rows, item_rows):
    return [(d[0], i[0], a, b) for d in edge_rows for i in item_rows for _, _, a, b in brute.contained([(0, d[1])], [(0, i[1])])]


def test_one_block_of_items_at_a_time(spark, edge):
    """No plan has more than one block, and each block's finds are written before the next is built."""
    items = spark.createDataFrame([(i, f"word{i} one two three four five") for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x word{i} one two three four five y") for i in range(6)], "doc_id long, text string")
    found, kept = containment.contained(docs, items, bound=1), containment.drop_contaminated(docs, items, bound=1)
    for frame in (found, kept):
        assert frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") <= 1
    assert sorted((r["doc_id"], r["item_id"]) for r in found.where("containment = 1").collect()) == [(i, i) for i in range(4)]
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]


def test_partly_contained_items(spark):
    item = " ".join(f"t{i}" for i in range(24))  # 20 shingles
    tail = lambda cut: " ".join(f"t{i}" for i in range(24 - cut))
    docs = [(1, "x " * 5000 + item + " y" * 5000), (2, tail(4)), (3, tail(5)), (4, " ".join(item.split()[:12]) + " gap " + " ".join(item.split()[8:]))]
    got = containment.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert {r["doc_id"]: r["n_shared"] for r in got.collect()} == {1: 20, 2: 16, 4: 20}


def test_sketches_are_large_enough():
    for size in range(1, 5000):
        assert containment.sketch_size(size) >= min(size, size - containment.needed(size) + 1)


def test_mixing_equals_oracle(spark, sf_dir, edge, edge_rows, nothing):
    connection = oracle(sf_dir)
    frame = registry.QUERIES["op8_mixing"](spark, sf_dir)
    relation = connection.execute(registry.ORACLE["op8_mixing"])
    names = [c[0] for c in relation.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, relation.fetchall())
    unique = {r[0]: r for r in edge_rows if r[0] is not None}.values()
    for share in (0.0, 0.4, 1.0, 2.5):
        docs = edge.sparkSession.createDataFrame(list(unique), "doc_id long, text string, lang string, source string, n_chars long")
        got = mixing.mix(docs, mixing.domain_tree(), share=share, epochs=2, seed=3)
        documents = pd.DataFrame(list(unique), columns=docs.columns)  # noqa: F841
        want = duckdb.connect().execute(mixing.oracle(share, 2, 3))
        assert rows_of(got.columns, got.collect()) == rows_of([c[0] for c in want.description], want.fetchall())
    assert mixing.mix(nothing, mixing.domain_tree(), share=0.5, epochs=2, seed=3).count() == 0
    copies = mixing.mix_documents(edge, mixing.domain_tree(), share=1.0, epochs=2, seed=3)
    assert copies.columns == [c for c in edge.columns if c != "epoch"] + ["epoch"] and copies.count() > 0


def fill_plainly(given, children):
    """Repeatedly deals what is left among children that are not full; (capacity, weight) to shares."""
    got = {k: 0.0 for k in range(len(children))}
    left = float(given)
    open_ = {k for k, (_, w) in enumerate(children) if w > 0}
    while left > 1e-9 and open_:
        weight = sum(children[k][1] for k in open_)
        dealt, now = 0.0, set(open_)
        for k in open_:
            part = min(left * children[k][1] / weight, children[k][0] - got[k])
            got[k] += part
            dealt += part
            if got[k] >= children[k][0] - 1e-9:
                now.discard(k)
        left, open_ = left - dealt, now
        if dealt < 1e-9:
            break
    return got


@pytest.mark.parametrize("given", [0, 7, 100, 1000, 5000])
def test_filling(spark, given):
    children = [(100, 1), (5, 3), (700, 2), (0, 1), (50, 0), (900, 4)]
    rows = [("f", f"c{k}", c, w, given) for k, (c, w) in enumerate(children)]
    frame = spark.createDataFrame(rows, "family string, node string, capacity long, weight long, given long")
    got = {r["node"]: r["budget"] for r in mixing.fill(frame, ["family"], "node").collect()}
    plain = fill_plainly(given, children)
    assert all(abs(got[f"c{k}"] - plain[k]) <= 1 and got[f"c{k}"] <= children[k][0] for k in plain)
    assert sum(got.values()) == min(given, sum(c for c, w in children if w))


def test_shortages_stay_in_the_family(spark):
    """A language that lacks tokens gives to its sibling before another domain gets anything."""
    rows = [(i, "a " * 10, "en", "src0", 20) for i in range(10)] + [(100, "a", "de", "src0", 1)] + [(200 + i, "a " * 10, "en", "src1", 20) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs, mixing.domain_tree(), share=0.4, epochs=3, seed=1)
    taken = {(r["domain"], r["language"]): r["budget"] for r in got.select("domain", "language", "budget").distinct().collect()}
    total = int(0.4 * (101 + 300))
    assert taken["d0", "de"] == 3 and taken["d0", "en"] + 3 == total * 4 // 7 and abs(taken["d1", "en"] - total * 3 / 7) <= 1


def test_nothing_is_given_for_leaves_without_weight(spark):
    """A domain is not given tokens that only a language of weight 0 could take."""
    rows = [(i, "a " * 10, "en", "src0", 20) for i in range(30)] + [(100, "a", "de", "src0", 1)] + [(200 + i, "a " * 10, "de", "src1", 20) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    domain, language, origin = mixing.domain_tree()
    levels = [mixing.Level("domain", domain.value, F.lit(1)), mixing.Level("language", language.value, F.when(F.col("language") == "en", 0).otherwise(1)), origin]
    got = mixing.mix(docs, levels, share=0.4, epochs=1, seed=1)
    taken = {(r["domain"], r["language"]): r["budget"] for r in got.select("domain", "language", "budget").distinct().collect()}
    total = int(0.4 * 601)
    assert taken == {("d0", "de"): 1, ("d1", "de"): total - 1}


def plain_pipeline(spark, sf_dir):
    """(doc_id, epoch, text) by plain code; only the learned rules are taken from the library."""
    docs = {r["doc_id"]: r for r in read(spark, sf_dir, "documents").collect()}
    rules = quality_rules.fit_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))

    def good(text):
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute.statistics(text)
        n_upper, n_marks, n = len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)), max(n_words, 1)
        value = {"mean_word": word_chars / n, "symbol_ratio": n_symbols / n, "dup_ratio": n_dup_lines / n, "repeat_ratio": n_repeat_words / n, "upper_ratio": n_upper / max(word_chars, 1), "mark_ratio": n_marks / n}
        holds = lambda f, op, t: value[f] <= t if op == "<=" else value[f] >= t
        return not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not any(all(holds(*c) for c in r.conditions) for r in rules)

    kept = [d for d, r in docs.items() if good(r["text"])]
    components = brute.component_ids(kept, [brute.fingerprint(docs[d]["text"]) for d in kept])
    kept = [d for d, c in zip(kept, components) if d == c]
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    dirty = {d for d, *_ in brute.contained([(d, docs[d]["text"]) for d in kept], items)}
    kept = [d for d in kept if d not in dirty]
    owners = {}
    for d in kept:
        for c in secret_scan.candidates(docs[d]["text"]):
            owners.setdefault(c[5], set()).add(docs[d]["source"])
    rows = []
    for d in kept:
        text = docs[d]["text"]
        for c in sorted(secret_scan.candidates(text), key=lambda c: -c[3]):
            if c[6] and len(owners[c[5]]) <= secret_scan.MAX_OWNERS and text[c[3]:c[4]] != secret_scan.MASK and secret_scan.MASK not in text[c[3]:c[4]]:
                text = text[:c[3]] + secret_scan.MASK + text[c[4]:] if text[c[3]:c[4]] == docs[d]["text"][c[3]:c[4]] else text
        rows.append((d, text, docs[d]["lang"], docs[d]["source"]))
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])  # noqa: F841
    texts = {r[0]: r[1] for r in rows}
    chosen = duckdb.connect().execute("select doc_id, epoch from (" + mixing.oracle(**registry.MIX) + ")").fetchall()
    return [(d, e, texts[d]) for d, e in chosen]


def test_pipeline(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*read(spark, sf_dir, "documents").columns, "epoch"]
    same(got.select("doc_id", "epoch", "text").collect(), plain_pipeline(spark, sf_dir))
    assert got.where("n_chars <> char_length(text)").count() == 0


def test_stages_keep_columns_and_take_edge_cases(spark, sf_dir, edge, nothing):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edge, nothing):
            got = stage(spark, docs, sf_dir)
            got.collect()
            assert name == "mixture" or got.columns == docs.columns
