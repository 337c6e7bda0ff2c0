"""Quality rules: text statistics, a fixed base rule, and a decision list learned by sequential covering.

The list is learned from a bounded sample of labelled statistics: rules are conjunctions of thresholds, grown on two
thirds of the sample by information gain, pruned on the other third, and kept only where precise there. It is applied as
one ordered Spark conditional expression.

Null and empty texts have no words and fail the base rule. Without labels of both kinds the list is empty and the base
rule decides alone. Repeated rows are judged each on its own; the list depends on the labels' rows, not on their order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import label_sample, slices, utf8

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
#: What conditions are on: name, SQL over the statistics. All are ratios, so that a long text is judged as a short one.
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_ratio": "n_symbols / greatest(n_words, 1)",
    "dup_ratio": "n_dup_lines / greatest(n_words, 1)",
    "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
    "upper_ratio": "n_upper / greatest(word_chars, 1)",
    "mark_ratio": "n_marks / greatest(n_words, 1)",
}
LABEL_BOUND = 20_000
MIN_WORDS = 50

_KIND = {"space": np.zeros(256, bool), "symbol": np.zeros(256, bool), "upper": np.zeros(256, bool), "mark": np.zeros(256, bool)}
_KIND["space"][list(b" \t\n\x0b\x0c\r")] = True
_KIND["symbol"][list(b"#*$%&|<>")] = True
_KIND["upper"][65:91] = True
_KIND["mark"][list(b"!?")] = True


def _repeats(texts: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Words, and words inside a repeated window of three, of each text."""
    ids: dict[bytes, int] = {}
    codes: list[int] = []
    counts: list[int] = []
    number = ids.setdefault
    for text in texts:
        words = text.split()
        counts.append(len(words))
        codes += [number(w, len(ids)) for w in words]
    repeated = np.zeros(len(texts), dtype=np.int64)
    n = len(codes)
    if n < 3:
        return counts, repeated
    word = np.array(codes, dtype=np.int64)
    text_of = np.repeat(np.arange(len(texts)), counts)
    inside = np.flatnonzero(text_of[:-2] == text_of[2:])
    if not len(inside):
        return counts, repeated
    v = len(ids)
    pairs, pair = np.unique(word[inside] * v + word[inside + 1], return_inverse=True)
    # a text number, a pair number and a word number each stay below a slice's bytes, so their product fits 64 bits
    key = (text_of[inside] * len(pairs) + pair) * v + word[inside + 2]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    at = inside[twice]
    for shift in range(3):
        covered[at + shift] = True
    np.add.at(repeated, text_of[covered], 1)
    return counts, repeated


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    worded = [line for line in lines if line.strip()]
    return len(worded) - len(set(worded))


def statistics(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of STATS for some texts."""
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)

    def total(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return run[ends] - run[starts]

    space = _KIND["space"][buffer]
    n_words, repeated = _repeats(texts)
    return [
        np.array(n_words, dtype=np.int64), total(~space & ((buffer & 0xC0) != 0x80)), total(_KIND["symbol"][buffer]),
        np.array([_dup_lines(t) for t in texts], dtype=np.int64), repeated, total(_KIND["upper"][buffer]),
        total(_KIND["mark"][buffer]),
    ]


@arrow_udf(StructType([StructField(s, LongType()) for s in STATS]))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        parts = [statistics(texts) for texts in slices(batch)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(STATS)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(STATS))


def with_statistics(docs: DataFrame, column: str = "__stats") -> DataFrame:
    # not deterministic for the optimiser only: a filter on the result would else run the function twice
    return docs.withColumn(column, _statistics.asNondeterministic()(utf8()))


def base_failed(stats: str = "__stats") -> Column:
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > 50 * n)


@dataclass(frozen=True)
class Rule:
    """Rejects where all conditions (feature, "<=" or ">=", threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float
    covered: int

    def sql(self, stats: str = "__stats") -> str:
        text = " and ".join(f"({FEATURES[f]}) {op} {threshold!r}D" for f, op, threshold in self.conditions)
        for name in sorted(STATS, key=len, reverse=True):
            text = text.replace(name, f"{stats}.{name}")
        return text


def _holds(x: np.ndarray, conditions) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for j, op, threshold in conditions:
        out &= x[:, j] <= threshold if op == "<=" else x[:, j] >= threshold
    return out


def _grow(x: np.ndarray, bad: np.ndarray, cuts: int, longest: int) -> list[tuple[int, str, float]]:
    conditions: list[tuple[int, str, float]] = []
    inside = np.ones(len(x), dtype=bool)
    while len(conditions) < longest and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for j in range(x.shape[1]):
            # thresholds half way between values, at quantiles of either class
            values = np.unique(np.concatenate([
                np.quantile(x[inside & kind, j], np.linspace(0, 1, cuts)) for kind in (bad, ~bad) if (inside & kind).any()
            ]))
            for threshold in (values[1:] + values[:-1]) / 2:
                for op in ("<=", ">="):
                    now = inside & (x[:, j] <= threshold if op == "<=" else x[:, j] >= threshold)
                    p, n = (bad & now).sum(), (~bad & now).sum()
                    g = p * (np.log2((p + 1e-12) / (p + n + 1e-12)) - np.log2(p0 / (p0 + n0))) if p else 0
                    if g > gain:
                        best, gain = (j, op, float(threshold)), g
        if best is None:
            break
        conditions.append(best)
        inside &= _holds(x, [best])
    return conditions


def learn_rules(
    x: np.ndarray, bad: np.ndarray, part: np.ndarray, *, cuts: int = 24, longest: int = 4, most: int = 12, precision: float = 0.9,
) -> list[Rule]:
    """An ordered list of rules for the bad rows. `part`: 0 and 1 grow, 2 prunes."""
    names = list(FEATURES)
    grow, prune = part != 2, part == 2
    rules: list[Rule] = []

    def worth(conditions) -> float:
        now = _holds(x[prune], conditions)
        p, n = (bad[prune] & now).sum(), (~bad[prune] & now).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rules) < most and bad[grow].any():
        conditions = _grow(x[grow], bad[grow], cuts, longest)
        while len(conditions) > 1:
            shorter = [conditions[:i] + conditions[i + 1:] for i in range(len(conditions))]
            candidate = max(shorter, key=worth)
            if worth(candidate) < worth(conditions):
                break
            conditions = candidate
        if not conditions:
            break
        now = _holds(x, conditions)
        p, n = int((bad & now).sum()), int((~bad & now).sum())
        if p == 0:
            break
        if (worth(conditions) + 1) / 2 >= precision and p / (p + n) >= precision:
            rules.append(Rule(tuple((names[j], op, t) for j, op, t in conditions), p / (p + n), p))
            grow, prune = grow & ~now, prune & ~now
        else:  # nothing precise starts here; go on without the rows it was grown for
            grow = grow & ~(now & bad)
            most -= 1
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, *, bound: int = LABEL_BOUND, **options) -> list[Rule]:
    """Rules from the statistics of at most `bound` labelled documents."""
    sample = label_sample(labels, "quality", bound)
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    features = [F.expr(sql.replace("n_", "__stats.n_").replace("word_chars", "__stats.word_chars")).cast("double").alias(f) for f, sql in FEATURES.items()]
    rows = rows.select("doc_id", "label", *features).groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("label", *FEATURES)])
    got = rows.toPandas().sort_values("doc_id")
    if got.empty:
        return []
    part = (got["doc_id"].to_numpy() * 2654435761 >> 7) % 3
    return learn_rules(got[list(FEATURES)].to_numpy(dtype=float), got["label"].to_numpy() == 0, part, **options)


def decision(rules: list[Rule], stats: str = "__stats") -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        out = F.when(F.expr(rules[i - 1].sql(stats)), i).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, *, bound: int = LABEL_BOUND) -> DataFrame:
    """One row per document: the statistics, `base_failed`, the `rule` that rejects it, `kept`."""
    rules = fit_rules(docs, labels, bound=bound)
    rows = with_statistics(docs.select("doc_id", "text")).select("doc_id", "__stats")
    rows = rows.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return rows.select("doc_id", "__stats.*", "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def keep_good(docs: DataFrame, labels: DataFrame, *, bound: int = LABEL_BOUND) -> DataFrame:
    """The documents that neither the base rule nor the list rejects, with their own columns."""
    rules = fit_rules(docs, labels, bound=bound)
    rows = with_statistics(docs).where(~base_failed() & decision(rules).isNull())
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
