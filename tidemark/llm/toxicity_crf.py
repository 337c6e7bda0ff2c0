"""Toxicity by a linear-chain conditional random field.

Labels are of documents; tokens get theirs from them. Cues, words and beginnings of words that stand in toxic documents
far more often than elsewhere, and in many different surroundings, so that copies of one document make none, mark the
tokens of toxic documents. A two-state chain is trained on stretches of labelled tokens by gradients of its likelihood.
For a text, forward-backward gives each token's marginal probability to be toxic; the largest and the expected number of
toxic tokens become the document's score by a logistic curve, and tokens of at least one half are the offending spans.

Fitting uses a bounded sample of labelled documents, of whose features those of most evidence and of whose stretches the
first by hash (all three bounds are parameters); scoring uses every whole text. Null texts count as empty, which have
the score of no toxic token. Without labels of both kinds every score is the share of toxic labels. Repeated rows have
equal scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import fit_logistic, held_out, label_sample, slices, utf8
from tidemark.operators.joins import settled

#: Bounds of fitting, parameters of `train` and `score`: labelled documents, cues, and stretches of tokens.
LABEL_BOUND, CUE_BOUND, STRETCHES = 12_000, 5_000, 6_000
STRETCH = 32
FOLDS, FOLD = 5, 0
#: Least evidence (likelihood ratio, over documents and over surroundings) of a cue.
EVIDENCE = 25.0
#: Least marginal of an offending word.
LEAST = 0.5
_STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: bytes) -> list[bytes]:
    """The word without marks at its ends, and its beginnings of four to six bytes."""
    core = word.strip(_STRIP)
    return [b"=" + core, *(core[:n] for n in (4, 5, 6) if len(core) >= n)] if core else []


def evidence(n_toxic: int, n_clean: int) -> Column:
    """Likelihood ratio of a feature's rate among toxic against clean, from `toxic` and `clean`; negative where clean has
    the higher rate."""
    toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
    total, whole = toxic + clean, float(n_toxic + n_clean)
    part = lambda k, n: F.when(k > 0, k * F.log(k / (total * (n / whole)))).otherwise(0.0)
    g = 2 * (part(toxic, n_toxic) + part(clean, n_clean))
    return F.when(toxic / n_toxic > clean / n_clean, g).otherwise(-g)


def _counted(rows: DataFrame, wanted: frozenset[bytes] | None) -> DataFrame:
    """(feature, toxic, clean): documents that have a feature; with `wanted`, different surroundings that these have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = iter(batch.column("label").to_pylist())
            for texts in slices(batch.column("b")):
                out: list[tuple[bytes, int, int]] = []
                for text in texts:
                    words, label = text.lower().split(), next(labels)
                    if wanted is None:
                        out += [(f, 0, label) for f in {f for w in set(words) for f in features(w)}]
                        continue
                    around = [b"", *words, b""]
                    out += {(f, xxhash.xxh64_intdigest(around[i] + b" " + around[i + 2]) >> 1, label) for i, w in enumerate(words) for f in features(w) if f in wanted}
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())], ["feature", "around", "label"])

    each = rows.select("b", "label").mapInArrow(count, "feature binary, around long, label int")
    each = each if wanted is None else each.distinct()
    return each.groupBy("feature").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def find_cues(rows: DataFrame, n_toxic: int, n_clean: int, bound: int = CUE_BOUND) -> list[bytes]:
    """At most `bound` features, those of most evidence."""

    def strong(counts: DataFrame) -> list[bytes]:
        told = counts.withColumn("evidence", evidence(n_toxic, n_clean)).where(F.col("evidence") >= EVIDENCE)
        return [bytes(row["feature"]) for row in told.orderBy(F.desc("evidence"), F.desc("toxic"), "feature").limit(bound).select("feature").collect()]

    first = strong(_counted(rows, None))
    return sorted(strong(_counted(rows, frozenset(first)))) if first else []


@dataclass(frozen=True)
class Chain:
    """Two states, clean and toxic. Energies of toxic against clean; moves from clean to clean are 0."""

    cues: dict[bytes, float]
    bias: float
    start: float
    moves: tuple[float, float, float]  # clean to toxic, toxic to clean, toxic to toxic

    def energy(self, word: bytes) -> float:
        return self.bias + sum(self.cues.get(f, 0.0) for f in features(word))


def forward_backward(energy: np.ndarray, length: np.ndarray, start: float, moves) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sequences in the columns of `energy` (place, sequence): marginals of toxic, the expected moves, log Z."""
    m01, m10, m11 = np.exp(moves[0]), np.exp(moves[1]), np.exp(moves[2])
    steps, n = energy.shape
    e = np.exp(np.clip(energy, -30, 30))
    a0, a1, scale = np.empty((steps, n)), np.empty((steps, n)), np.ones((steps, n))
    x0, x1 = np.ones(n), np.exp(start) * e[0] if steps else np.ones(n)
    for t in range(steps):
        if t:
            y0, y1 = a0[t - 1] + a1[t - 1] * m10, (a0[t - 1] * m01 + a1[t - 1] * m11) * e[t]
            on = t < length
            x0, x1 = np.where(on, y0, a0[t - 1]), np.where(on, y1, a1[t - 1])
        s = x0 + x1
        a0[t], a1[t] = x0 / s, x1 / s
        scale[t] = np.where(t < length, s, 1.0)
    b0, b1 = np.ones(n), np.ones(n)
    marginal, pairs = np.zeros((steps, n)), np.zeros((3, n))
    for t in range(steps - 1, -1, -1):
        on = t < length
        p = a1[t] * b1
        marginal[t] = np.where(on, p / (a0[t] * b0 + p), 0.0)
        if t:
            c0, c1 = b0, e[t] * b1
            z = np.where(on, (a0[t - 1] * (c0 + m01 * c1) + a1[t - 1] * (m10 * c0 + m11 * c1)), 1.0)
            for k, move in enumerate((a0[t - 1] * m01 * c1, a1[t - 1] * m10 * c0, a1[t - 1] * m11 * c1)):
                pairs[k] += np.where(on, move / z, 0.0)
            d0, d1 = (c0 + m01 * c1) / scale[t], (m10 * c0 + m11 * c1) / scale[t]
            b0, b1 = np.where(on, d0, b0), np.where(on, d1, b1)
    return marginal, pairs, np.log(scale).sum(axis=0)


def fit_chain(stretches: list[tuple[list[bytes], list[int]]], cues: list[bytes], *, steps: int = 120, rate: float = 0.15, ridge: float = 1e-4) -> Chain:
    """Maximum likelihood by Adam over all stretches at a time."""
    number = {c: i for i, c in enumerate(cues)}
    n = len(stretches)
    longest = max((len(w) for w, _ in stretches), default=0)
    if not n or not longest:
        return Chain({}, -8.0, 0.0, (0.0, 0.0, 0.0))
    length = np.array([len(w) for w, _ in stretches])
    gold = np.zeros((longest, n))
    cue, at_t, at_i = [], [], []
    for i, (words, labels) in enumerate(stretches):
        gold[: len(labels), i] = labels
        for t, w in enumerate(words):
            for f in features(w):
                if f in number:
                    cue.append(number[f])
                    at_t.append(t)
                    at_i.append(i)
    cue, at_t, at_i = np.array(cue, dtype=int), np.array(at_t, dtype=int), np.array(at_i, dtype=int)
    inside = np.arange(longest)[:, None] < length
    follows = inside[1:]
    gold_moves = np.array([
        ((1 - gold[:-1]) * gold[1:] * follows).sum(), (gold[:-1] * (1 - gold[1:]) * follows).sum(), (gold[:-1] * gold[1:] * follows).sum(),
    ])
    k = len(cues)
    w = np.zeros(k + 5)  # cues, bias, start, moves
    w[k] = -2.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        energy = np.full((longest, n), w[k])
        np.add.at(energy, (at_t, at_i), w[cue])
        marginal, pairs, _ = forward_backward(energy, length, w[k + 1], w[k + 2:])
        off = (marginal - gold) * inside
        g = np.concatenate([
            np.bincount(cue, off[at_t, at_i], k) if len(cue) else np.zeros(k), [off.sum(), off[0].sum()], pairs.sum(axis=1) - gold_moves,
        ]) / n + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Chain({c: float(x) for c, x in zip(cues, w[:k])}, float(w[k]), float(w[k + 1]), tuple(float(x) for x in w[k + 2:]))


class Uncued:
    """Marginals of texts without a cue. All places have one energy, so what comes from the left depends on a place's
    distance from the start alone, and what comes from the right on that from the end."""

    def __init__(self, chain: Chain):
        e, (m01, m10, m11) = np.exp(np.clip(chain.bias, -30, 30)), np.exp(chain.moves)
        self.left = _Repeated(lambda x: (x[0] + x[1] * m10, (x[0] * m01 + x[1] * m11) * e), (1.0, float(np.exp(chain.start) * e)))
        self.right = _Repeated(lambda x: (x[0] + m01 * e * x[1], m10 * x[0] + m11 * e * x[1]), (1.0, 1.0))
        self.known: dict[int, tuple[float, float]] = {}

    def marginals(self, n: int) -> np.ndarray:
        a, b = self.left.first(n), self.right.first(n)[::-1]
        toxic = a[:, 1] * b[:, 1]
        return toxic / (a[:, 0] * b[:, 0] + toxic)

    def summary(self, n: int) -> tuple[float, float]:
        if n not in self.known:
            self.known[n] = _summary(self.marginals(n))
        return self.known[n]


class _Repeated:
    """Shares of two numbers under the same step again and again; once a step changes nothing, no other does."""

    def __init__(self, step, start: tuple[float, float]):
        self.step, self.grid = step, np.array([self._scaled(start)])

    @staticmethod
    def _scaled(x: tuple[float, float]) -> tuple[float, float]:
        return x[0] / (x[0] + x[1]), x[1] / (x[0] + x[1])

    def first(self, n: int) -> np.ndarray:
        if len(self.grid) < n:
            more, last = [], tuple(self.grid[-1].tolist())
            wanted = 2 * n - len(self.grid)
            while len(more) < wanted:
                after = self._scaled(self.step(last))
                if after == last:
                    break
                more.append(after)
                last = after
            still = np.tile(last, (wanted - len(more), 1))
            self.grid = np.concatenate([self.grid, np.array(more).reshape(-1, 2), still])
        return self.grid[:n]


def _summary(p: np.ndarray) -> tuple[float, float]:
    return (float(p.max()), float(p.sum())) if len(p) else (0.0, 0.0)


class Tagger:
    """Marginals of whole texts; words' energies are remembered, up to `most` bytes of words."""

    def __init__(self, chain: Chain, most: int = 16 << 20):
        self.chain, self.most, self.held = chain, most, 0
        self.known: dict[bytes, float] = {}
        self.uncued = Uncued(chain)

    def _run(self, energies: list[np.ndarray]) -> list[np.ndarray]:
        """Marginals; sequences of like length are run together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(energies)
        order = sorted((i for i in range(len(energies)) if len(energies[i])), key=lambda i: len(energies[i]))
        start = 0
        while start < len(order):
            stop, shortest = start, len(energies[order[start]])
            while stop < len(order) and len(energies[order[stop]]) <= 2 * shortest and (stop - start + 1) * len(energies[order[stop]]) <= 1_000_000:
                stop += 1
            own = order[start:max(stop, start + 1)]
            length = np.array([len(energies[i]) for i in own])
            grid = np.full((length.max(), len(own)), self.chain.bias)
            for k, i in enumerate(own):
                grid[: length[k], k] = energies[i]
            marginal = forward_backward(grid, length, self.chain.start, self.chain.moves)[0]
            for k, i in enumerate(own):
                out[i] = marginal[: length[k], k]
            start += len(own)
        return out

    def energies(self, text: bytes) -> np.ndarray:
        words, known = text.lower().split(), self.known
        if self.held > self.most:
            known.clear()
            self.held = 0
        for word in set(words).difference(known):
            known[word] = self.chain.energy(word)
            self.held += len(word)
        return np.fromiter(map(known.__getitem__, words), dtype=float, count=len(words))

    def marginals(self, texts: list[bytes]) -> list[np.ndarray]:
        return self._run([self.energies(t) for t in texts])

    def summaries(self, texts: list[bytes]) -> list[tuple[float, float]]:
        return [found[:2] for found in self.findings(texts)]

    def findings(self, texts: list[bytes], least: float = LEAST) -> list[tuple[float, float, str]]:
        """The largest marginal, the expected number of toxic tokens, and the places of toxic tokens of each text."""
        out: list[tuple[float, float, str]] = []
        cued, energies = [], []
        for i, text in enumerate(texts):
            e = self.energies(text)
            if (e != self.chain.bias).any():
                cued.append(i)
                energies.append(e)
                out.append((0.0, 0.0, ""))
                continue
            most, expected = self.uncued.summary(len(e))
            out.append((most, expected, _said(_places(text, self.uncued.marginals(len(e)), least)) if most >= least else ""))
        for i, p in zip(cued, self._run(energies)):
            out[i] = (*_summary(p), _said(_places(texts[i], p, least)))
        return out


def _places(text: bytes, p: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Start, end (code points, exclusive) and marginal of the toxic words of a text."""
    if not (p >= least).any():
        return []
    # the words are those of the bytes, which split at the same characters
    return [(*w.span(), float(x)) for w, x in zip(_WORD.finditer(text.decode("utf-8", "replace")), p) if x >= least]


def _said(places: list[tuple[int, int, float]]) -> str:
    return ",".join(f"{start}:{end}" for start, end, _ in places)


def _summarised(chain: Chain):
    @arrow_udf("struct<most:double,expected:double,spans:string>")
    def summarise(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(chain)
        kinds = {"most": pa.float64(), "expected": pa.float64(), "spans": pa.string()}
        for batch in batches:
            rows = [s for texts in slices(batch) for s in tagger.findings(texts)]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], list(kinds))

    return summarise.asNondeterministic()


@dataclass(frozen=True)
class Model:
    chain: Chain
    weights: tuple[float, float, float]


def _levels(most: np.ndarray, expected: np.ndarray) -> np.ndarray:
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(most / (1 - most)), np.log1p(expected)])


def _stretches(rows: DataFrame, cues: list[bytes], bound: int = STRETCHES) -> list[tuple[list[bytes], list[int]]]:
    """Stretches of labelled tokens, half of them with a toxic one where there are enough; the first by hash."""
    known = frozenset(cues)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = iter(batch.column("label").to_pylist())
            for texts in slices(batch.column("b")):
                words_out, labels_out = [], []
                for text in texts:
                    words, label = text.lower().split(), next(labels)
                    own = bytes(49 if label and any(f in known for f in features(w)) else 48 for w in words)
                    for at in range(0, len(words), STRETCH):
                        words_out.append(b" ".join(words[at:at + STRETCH]))
                        labels_out.append(own[at:at + STRETCH].decode())
                yield pa.RecordBatch.from_arrays([pa.array(words_out, pa.binary()), pa.array(labels_out, pa.string())], ["words", "tags"])

    pieces = rows.select("b", "label").mapInArrow(cut, "words binary, tags string").distinct()
    out = []
    for some in (True, False):
        chosen = pieces.where(F.col("tags").contains("1") == some).orderBy(F.xxhash64("words"), "words", "tags").limit(bound // 2)
        out += [(bytes(r["words"]).split(b" "), [int(c) for c in r["tags"]]) for r in chosen.collect()]
    return out


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", bound: int = LABEL_BOUND, cue_bound: int = CUE_BOUND, stretch_bound: int = STRETCHES,
) -> Model:
    """From labelled documents outside the held-out fold; of those, one third fits the curve and the rest the chain.

    At most `bound` labelled documents, `cue_bound` cues (those of most evidence) and `stretch_bound` stretches are fitted on.
    """
    sample = label_sample(labels, label, bound, ~held_out(FOLDS, FOLD))
    rows = settled(docs.select("doc_id", utf8().alias("b")).join(F.broadcast(sample), "doc_id"))
    curve = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0
    counts = {r["label"]: r["count"] for r in rows.where(~curve).groupBy("label").count().collect()}
    cues = find_cues(rows.where(~curve), counts[1], counts[0], cue_bound) if counts.get(0) and counts.get(1) else []
    chain = fit_chain(_stretches(rows.where(~curve), cues, stretch_bound) if cues else [], cues)
    measured = rows.where(curve).select("doc_id", "label", _summarised(chain)(F.col("b")).alias("s"))
    got = measured.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("s.most").alias("most"), F.min("s.expected").alias("expected")).toPandas().sort_values("doc_id")
    weights = fit_logistic(_levels(got["most"].to_numpy(dtype=float), got["expected"].to_numpy(dtype=float)), got["label"].to_numpy(dtype=float), ridge=1e-3)
    return Model(chain, tuple(float(w) for w in weights))


def score(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, bound: int = LABEL_BOUND, cue_bound: int = CUE_BOUND, stretch_bound: int = STRETCHES,
) -> DataFrame:
    """One row per document: `held_out`, `score`, `predicted`, and `spans`, the offending words' places `start:end`."""
    return scored(docs, train(docs, labels, bound=bound, cue_bound=cue_bound, stretch_bound=stretch_bound), threshold=threshold)


def scored(docs: DataFrame, model: Model, *, threshold: float = 0.5) -> DataFrame:
    """What `score` gives, by a model."""
    rows = docs.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), _summarised(model.chain)(utf8()).alias("__s"))
    most = F.greatest(F.least(F.col("__s.most"), F.lit(1 - 1e-6)), F.lit(1e-6))
    a, b, c = model.weights
    z = F.log(most / (1 - most)) * a + F.log1p("__s.expected") * b + c
    rows = rows.select("doc_id", "held_out", (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))).alias("score"), F.col("__s.spans").alias("spans"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def toxic_spans(docs: DataFrame, model: Model, *, least: float = LEAST) -> DataFrame:
    """(doc_id, spans): places (code points, end exclusive) and marginals of the toxic words of each document."""

    @arrow_udf("array<struct<start:int,end:int,p:double>>")
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(model.chain)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            rows = [
                [dict(zip(("start", "end", "p"), place)) for place in _places(text, p, least)]
                for texts in slices(batch) for text, p in zip(texts, tagger.marginals(texts))
            ]
            yield pa.array(rows, kind)

    return docs.select("doc_id", tag.asNondeterministic()(utf8()).alias("spans"))
