"""Language-model scores by a gated recurrent network with a class-factored output.

Tokens are the words of a text, A-Z lower-cased, and one end. The network's words are the most frequent ones; any other
token is its `rare` word, times the token's smoothed share of all rare tokens, so every text has a probability. The
output softmax is over classes of words, then over the words of the class.

Counts and training cover every training document. Counts are grouped in Spark. Training goes over the documents once, in
three rounds: in a round each task trains on its own documents, by backpropagation truncated to windows through which the
state is carried, and the tasks' weights are averaged, as many tokens as each saw; so the model depends on how the
documents are dealt to tasks, which is by the input's splits. Scoring carries the state of a text
from window to window, so its likelihood is that of the complete text. Words outside the broadcast head of the vocabulary
are looked up by a join.

Null texts count as empty: the end alone. Repeated rows are scored alike. Without training documents every token is
unknown and the network is its initial self.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import held_out, utf8
from tidemark.operators.joins import settled
from tidemark.session import scratch_path

#: Words of the network (with rare and end), in classes of equal size; width of its state.
CLASSES, CLASS_SIZE, STATE = 32, 32, 16
WORDS = CLASSES * CLASS_SIZE
#: Words whose counts every task holds; all others are joined.
HEAD = 300_000
LANES, WINDOW = 512, 16
RATE = 0.01
LIMIT = 4.0  # of a weight: keeps energies below what float32 can raise e to
RARE, END = 0, 1
END_WORD = b""
FOLDS, FOLD = 7, 2
#: Of eight parts of the training documents, those of each round.
ROUNDS = ((0,), (1, 2), (3, 4, 5, 6, 7))
_SLICE = 12 << 20
#: What scoring gives of a text: its tokens, those in the head, those not in the network; log-likelihood by the network; sums of
#: log10(count + 1) of the head's words, and of those not in the network; the words outside of the head, and how often.
OUT = pa.struct([
    *((n, pa.int64()) for n in ("n_tokens", "n_known", "n_rare")), *((n, pa.float64()) for n in ("network", "logs", "rare_logs")),
    ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())),
])


# --- the network -------------------------------------------------------------------------------------------------


@dataclass
class Network:
    """inputs: a word's part of the three gates; inner: the state's part; cls, out: the two softmaxes."""

    inputs: np.ndarray  # (words, 3 state)
    inner: np.ndarray  # (state, 3 state)
    inner_bias: np.ndarray  # (3 state)
    cls: np.ndarray  # (classes, state)
    cls_bias: np.ndarray
    out: np.ndarray  # (classes, size, state)
    out_bias: np.ndarray  # (classes, size)

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.inner, self.inner_bias, self.cls, self.cls_bias, self.out, self.out_bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts]).astype(np.float32)

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        h = STATE
        return [(WORDS, 3 * h), (h, 3 * h), (3 * h,), (CLASSES, h), (CLASSES,), (CLASSES, CLASS_SIZE, h), (CLASSES, CLASS_SIZE)]

    @classmethod
    def unpacked(cls, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for shape in cls.shapes():
            n = math.prod(shape)
            parts.append(np.array(flat[at:at + n], dtype=np.float32).reshape(shape))
            at += n
        return cls(*parts)

    @classmethod
    def initial(cls, counts: np.ndarray, seed: int = 17) -> Network:
        """Small random weights; the softmax biases say the words' frequencies."""
        random = np.random.default_rng(seed)
        parts = [random.normal(0, 0.1, s).astype(np.float32) for s in cls.shapes()]
        share = np.zeros(WORDS)
        share[: len(counts)] = counts
        share = ((share + 0.5) / (share + 0.5).sum()).reshape(CLASSES, CLASS_SIZE)
        parts[2][:] = 0
        parts[4][:] = np.log(share.sum(axis=1) * CLASSES)
        parts[6][:] = np.log(share / share.sum(axis=1, keepdims=True) * CLASS_SIZE)
        return cls(*parts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


class Buffers:
    """Arrays that are used again window after window: new ones of this size would be new pages each time."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        found = self.held.get(name)
        if found is None or found.shape != shape:
            found = self.held[name] = np.empty(shape, dtype=np.float32)
        return found


def run(net: Network, state: np.ndarray, words: np.ndarray, keep: Buffers | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States after each of `words` (step, lane) and the last one. An end as input starts from nothing.

    With `keep`, what the way back needs is put there: states before, gates z and r, new states and their own part.
    """
    steps, lanes = words.shape
    h2 = 2 * STATE
    gates = net.inputs[words]
    on = (words != END).astype(np.float32)[:, :, None]
    states = np.empty((steps, lanes, STATE), dtype=np.float32)
    if keep is not None:
        before, zrs, news, owns = (keep(n, steps, lanes, w) for n, w in (("before", STATE), ("zr", h2), ("new", STATE), ("own", STATE)))
    for t in range(steps):
        state = state * on[t]
        a = state @ net.inner
        a += net.inner_bias
        zr = _sigmoid(gates[t, :, :h2] + a[:, :h2])
        new = np.tanh(gates[t, :, h2:] + zr[:, STATE:] * a[:, h2:])
        if keep is not None:
            before[t], zrs[t], news[t], owns[t] = state, zr, new, a[:, h2:]
        state = new + zr[:, :STATE] * (state - new)
        states[t] = state
    return states, state


def _by_class(classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each class with the places of its words."""
    order = np.argsort(classes, kind="stable")
    at = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if at[c + 1] > at[c]:
            yield c, order[at[c]:at[c + 1]]


def _weights(states: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e to the energies, and their sums."""
    e = states @ rows.T
    e += bias
    np.exp(e, out=e)
    return e, e @ np.ones(e.shape[1], dtype=e.dtype)


def log_likelihood(net: Network, states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Natural logarithms of the words' probabilities after the states."""
    classes, places = np.divmod(words, CLASS_SIZE)
    e, total = _weights(states, net.cls, net.cls_bias)
    out = np.log(e[np.arange(len(words)), classes] / total)
    for c, own in _by_class(classes):
        e, total = _weights(states[own], net.out[c], net.out_bias[c])
        out[own] += np.log(e[np.arange(len(own)), places[own]] / total)
    return out


def gradients(net: Network, state: np.ndarray, words: np.ndarray, targets: np.ndarray, keep: Buffers | None = None) -> tuple[list[np.ndarray], float, np.ndarray]:
    """Of the mean negative log-likelihood of a window: for each part, the loss, and the state to go on with."""
    keep = keep or Buffers()
    states, last = run(net, state, words, keep)
    kept = keep.held
    steps, lanes = words.shape
    n, h2 = steps * lanes, 2 * STATE
    flat, goal = states.reshape(n, STATE), targets.ravel()
    rows = np.arange(n)
    classes, places = np.divmod(goal, CLASS_SIZE)
    e, total = _weights(flat, net.cls, net.cls_bias)
    e /= total[:, None]
    loss = -float(np.log(e[rows, classes]).sum())
    e[rows, classes] -= 1
    ones = np.ones(n, dtype=np.float32)
    d_cls, d_cls_bias = e.T @ flat, ones @ e
    d_flat = e @ net.cls
    d_out, d_out_bias = np.zeros_like(net.out), np.zeros_like(net.out_bias)
    for c, own in _by_class(classes):
        mine, here = flat[own], rows[: len(own)]
        e, total = _weights(mine, net.out[c], net.out_bias[c])
        e /= total[:, None]
        loss -= float(np.log(e[here, places[own]]).sum())
        e[here, places[own]] -= 1
        d_out[c], d_out_bias[c] = e.T @ mine, ones[: len(own)] @ e
        d_flat[own] += e @ net.out[c]
    d_states = d_flat.reshape(steps, lanes, STATE)
    # what does not depend on later steps, for all steps at a time
    z, r = kept["zr"][:, :, :STATE], kept["zr"][:, :, STATE:]
    shape = (steps, lanes, STATE)
    by_new, by_z, by_r, rest = (keep(n, *shape) for n in ("by_new", "by_z", "by_r", "rest"))
    np.subtract(1, z, out=rest)
    np.multiply(kept["new"], kept["new"], out=by_new)
    np.subtract(1, by_new, out=by_new)
    by_new *= rest
    np.subtract(kept["before"], kept["new"], out=by_z)
    by_z *= z
    by_z *= rest
    np.subtract(1, r, out=by_r)
    by_r *= r
    by_r *= kept["own"]
    on = (words != END).astype(np.float32)[:, :, None]
    d_gates, d_own = (keep(n, steps, lanes, 3 * STATE) for n in ("d_gates", "d_own"))
    back = np.zeros((lanes, STATE), dtype=np.float32)
    inner = np.ascontiguousarray(net.inner.T)
    for t in range(steps - 1, -1, -1):
        d = d_states[t] + back
        gates, own = d_gates[t], d_own[t]
        d_new = np.multiply(d, by_new[t], out=gates[:, h2:])
        np.multiply(d, by_z[t], out=own[:, :STATE])
        np.multiply(d_new, by_r[t], out=own[:, STATE:h2])
        np.multiply(d_new, r[t], out=own[:, h2:])
        back = own @ inner
        d *= z[t]
        back += d
        back *= on[t]
    d_gates[:, :, :h2] = d_own[:, :, :h2]
    d_own = d_own.reshape(n, 3 * STATE)
    d_inner = kept["before"].reshape(n, STATE).T @ d_own
    d_inputs = np.zeros_like(net.inputs)
    order = np.argsort(words.ravel(), kind="stable")
    sorted_words = words.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]]))
    d_inputs[sorted_words[first]] = np.add.reduceat(d_gates.reshape(n, 3 * STATE)[order], first, axis=0)
    parts = [d_inputs, d_inner, ones @ d_own, d_cls, d_cls_bias, d_out, d_out_bias]
    return [p / n for p in parts], loss / n, last


class Trainer:
    """Adam over windows; documents of a slice lie end to end in lanes of equal length."""

    def __init__(self, net: Network, rate: float = RATE):
        self.net, self.rate, self.step, self.tokens = net, rate, 0, 0
        self.keep = Buffers()
        self.m, self.v = [np.zeros_like(p) for p in net.parts], [np.zeros_like(p) for p in net.parts]

    def learn(self, tokens: np.ndarray) -> None:
        """Token numbers of documents, each with its end."""
        lanes = max(1, min(LANES, len(tokens) // WINDOW))
        length = -(-len(tokens) // lanes)
        grid = np.full(lanes * length, END, dtype=np.int32)
        grid[: len(tokens)] = tokens
        grid = np.ascontiguousarray(grid.reshape(lanes, length).T)
        before = np.vstack([np.full((1, lanes), END, dtype=np.int32), grid[:-1]])
        state = np.zeros((lanes, STATE), dtype=np.float32)
        for t in range(0, length, WINDOW):
            found, _, state = gradients(self.net, state, before[t:t + WINDOW], grid[t:t + WINDOW], self.keep)
            self._move(found)
        self.tokens += len(tokens)

    def _move(self, found: list[np.ndarray]) -> None:
        self.step += 1
        rate = self.rate * math.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for p, g, m, v in zip(self.net.parts, found, self.m, self.v):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= rate * m / (np.sqrt(v) + 1e-8)
            np.clip(p, -LIMIT * 3 if p.ndim == 1 else -LIMIT, LIMIT * 3 if p.ndim == 1 else LIMIT, out=p)


def score_texts(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each text, given as token numbers with the end; the state runs through the whole text."""
    total = np.zeros(len(texts))
    order = sorted((i for i in range(len(texts)) if len(texts[i])), key=lambda i: -len(texts[i]))
    if not order:
        return total
    # longest first to the shortest lane
    heap = [(0, k) for k in range(min(LANES, len(order)))]
    lanes: list[list[int]] = [[] for _ in heap]
    for i in order:
        n, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (n + len(texts[i]), k))
    lanes.sort(key=lambda own: -sum(len(texts[i]) for i in own))
    arranged = [i for own in lanes for i in own]
    flat = np.concatenate([texts[i] for i in arranged])
    length = np.array([sum(len(texts[i]) for i in own) for own in lanes])
    offset = np.cumsum(length) - length
    found = np.empty(len(flat), dtype=np.float32)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[offset] = END
    state = np.zeros((len(lanes), STATE), dtype=np.float32)
    held_states, held_places, held = [], [], 0
    for t in range(0, int(length.max()), WINDOW):
        active = int(np.searchsorted(-length, -t, side="left"))  # lengths descend
        step = np.arange(t, min(t + WINDOW, int(length.max())))[:, None]
        place = offset[:active] + np.minimum(step, length[:active] - 1)
        states, state = run(net, state[:active], before[place])
        good = step < length[:active]
        held_states.append(states[good])
        held_places.append(place[good])
        held += len(held_places[-1])
        if held >= 1 << 15:
            at = np.concatenate(held_places)
            found[at] = log_likelihood(net, np.concatenate(held_states), flat[at])
            held_states, held_places, held = [], [], 0
    if held:
        at = np.concatenate(held_places)
        found[at] = log_likelihood(net, np.concatenate(held_states), flat[at])
    starts = np.cumsum([0, *[len(texts[i]) for i in arranged[:-1]]])
    total[arranged] = np.add.reduceat(found, starts, dtype=np.float64)
    return total


# --- the corpus --------------------------------------------------------------------------------------------------


def _pieces(batch: pa.Array, limit: int = _SLICE) -> Iterator[pa.Array]:
    """Parts of a batch of about `limit` bytes."""
    ends = np.cumsum(pc.binary_length(batch).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        held = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, A-Z lower-cased, one after the other, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = split.flatten()
    text_of = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end makes an empty one
    if not real.all():
        words, text_of = words.filter(pa.array(real)), text_of[real]
    return words, np.bincount(text_of, minlength=len(texts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in _pieces(batch.column("b")):
            counts = pc.value_counts(_words(texts)[0])
            words = pa.concat_arrays([counts.field("values").cast(pa.binary()), pa.array([END_WORD], pa.binary())])
            n = pa.concat_arrays([counts.field("counts").cast(pa.int64()), pa.array([len(texts)], pa.int64())])
            yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens; the end is the empty word."""
    partial = docs.select(utf8().alias("b")).mapInArrow(_count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """The head of the words by count, the network's first; counts of all."""

    head: dict[bytes, int]  # number of a word; below WORDS it is the network's
    counts: np.ndarray  # by number; RARE has none
    tokens: int
    types: int
    rare_tokens: int
    rare_types: int

    def network_counts(self) -> np.ndarray:
        out = self.counts[:WORDS].astype(float)
        out[RARE] = self.rare_tokens
        return out


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """`counts` is computed before. The head, the `head` most frequent words or all, goes to the driver; it has room for
    the network's words at least. Words of one count are taken by hash."""
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
    # where the head ends is found from histograms, so that no more than the head itself goes to the driver
    rows, room, parts = counts.where(F.octet_length("word") > 0), max(head, WORDS - 2), []
    place = F.xxhash64("word")
    for bucket in (-F.floor(F.log2("n") * 64), -F.col("n"), F.shiftright(place, 44), place):
        within, rest, room = _first_buckets(rows, bucket, room)
        parts.append(within)
        if rest is None:
            break
        rows = rest
    else:
        parts.append(rows.orderBy("word").limit(room))  # words of one count and one hash
    found = [part.select("word", "n").toArrow() for part in parts]
    top = sorted(((n, word) for table in found for n, word in zip(table.column("n").to_pylist(), table.column("word").to_pylist())), key=lambda r: (-r[0], r[1]))
    ends = counts.where(F.octet_length("word") == 0).first()
    words = {END_WORD: END} | {word: i for i, (_, word) in enumerate(top, END + 1)}
    numbers = np.array([0, ends["n"] if ends else 0, *[n for n, _ in top]], dtype=np.int64)
    own = numbers[:WORDS]
    return Vocabulary(words, numbers, whole["n"], whole["types"], whole["n"] - int(own.sum()), whole["types"] - int((own > 0).sum()))


def _first_buckets(rows: DataFrame, bucket: Column, room: int) -> tuple[DataFrame, DataFrame | None, int]:
    """The rows of the first buckets that there is room for, those of the one that it ends in (or nothing where all have
    room), and the room left for these."""
    sizes = rows.groupBy(bucket.alias("bucket")).count()
    if room <= 0:
        return rows.limit(0), None, 0
    before = 0
    for row in sizes.orderBy("bucket").toLocalIterator():
        if before + row["count"] > room:
            return rows.where(bucket < F.lit(row["bucket"])), rows.where(bucket == F.lit(row["bucket"])), room - before
        before += row["count"]
    return rows, None, room - before


def _numbers(texts: pa.Array, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Numbers of all tokens of some texts, each text's end included, and where each text starts; the different words,
    and the word of each token (-1 for an end). Only different words are looked up."""
    words, n = _words(texts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    different = coded.dictionary.cast(pa.binary())
    number = np.fromiter(map(known.get, different.to_pylist(), repeat(RARE)), dtype=np.int32, count=len(different))
    place = np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)  # moved by the ends before
    word = np.full(len(codes) + len(n), -1, dtype=np.int64)
    word[place] = codes
    out = np.full(len(word), END, dtype=np.int32)
    out[place] = number[codes]
    return out, np.cumsum(n + 1) - (n + 1), different, word


def _trained(docs: DataFrame, flat: np.ndarray, known: dict[bytes, int], rate: float) -> DataFrame:
    """One row for each task that saw documents: its weights times its tokens, and its tokens."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Network.unpacked(flat), rate)
        for batch in batches:
            for texts in _pieces(batch.column("b")):
                trainer.learn(_numbers(texts, known)[0])
        if trainer.tokens:
            yield _weighted(trainer.net.packed().astype(np.float64) * trainer.tokens, trainer.tokens)

    return docs.select(utf8().alias("b")).mapInArrow(train, "weights binary, tokens long")


def _weighted(weights: np.ndarray, tokens: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([tokens], pa.int64())], ["weights", "tokens"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights, tokens = None, 0
    for batch in batches:
        for w, n in zip(batch.column("weights").to_pylist(), batch.column("tokens").to_pylist()):
            own = np.frombuffer(w, dtype=np.float64)
            weights, tokens = own.copy() if weights is None else weights + own, tokens + n
    if tokens:
        yield _weighted(weights, tokens)


def averaged(rows: DataFrame, most: int = 64) -> np.ndarray | None:
    """The weights by token; many tasks' rows are added up in tasks until at most `most` go to the driver."""
    rows = settled(rows)
    n = rows.rdd.getNumPartitions()
    while n > most:
        n = -(-n // most)
        rows = settled(rows.coalesce(n).mapInArrow(_added, rows.schema))
    got = rows.collect()
    tokens = sum(r["tokens"] for r in got)
    return sum(np.frombuffer(bytes(r["weights"]), dtype=np.float64) for r in got) / tokens if tokens else None


def train(docs: DataFrame, words: Vocabulary) -> np.ndarray:
    """Weights of a network trained on all of `docs`, each once."""
    flat = Network.initial(words.network_counts()).packed()
    known = {w: i for w, i in words.head.items() if i < WORDS}
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(8))
    for number, parts in enumerate(ROUNDS):
        got = averaged(_trained(docs.where(part.isin(*parts)), flat, known, RATE / (1 + number)))
        flat = flat if got is None else got.astype(np.float32)
    return flat


def _score_part(net: Network, head: dict[bytes, int], counts: np.ndarray, logs: np.ndarray, texts: pa.Array) -> list[pa.Array]:
    """The columns of OUT for some texts."""
    numbers, start, different, word = _numbers(texts, head)
    size = np.diff(np.append(start, len(numbers)))
    rare, outside = numbers >= WORDS, numbers == RARE
    total = lambda values: np.add.reduceat(values, start)
    whole = [size, total((counts[numbers] > 0).astype(np.int64)), total((rare | outside).astype(np.int64))]
    sums = [total(logs[numbers]), total(np.where(rare, logs[numbers], 0.0))]
    text_of = np.repeat(np.arange(len(size)), size)
    pairs, times = np.unique(text_of[outside] * max(len(different), 1) + word[outside], return_counts=True)
    owner, code = np.divmod(pairs, max(len(different), 1))
    ends = pa.array(np.searchsorted(owner, np.arange(len(size) + 1)).astype(np.int32))
    likely = score_texts(net, np.split(np.where(rare, RARE, numbers).astype(np.int32), start[1:]))
    return [
        *[pa.array(c, pa.int64()) for c in whole], *[pa.array(c, pa.float64()) for c in (likely, *sums)],
        pa.ListArray.from_arrays(ends, different.take(pa.array(code))), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
    ]


def _scored(flat: np.ndarray, words: Vocabulary) -> Column:
    """Spark function: of a text, what the network and the head give, and the words that are not in the head."""
    kind = "struct<n_tokens:bigint,n_known:bigint,n_rare:bigint,network:double,logs:double,rare_logs:double,words:array<binary>,times:array<int>>"

    @arrow_udf(kind)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net, head = Network.unpacked(flat), words.head
        counts, logs = words.counts, np.log10(words.counts + 1.0)
        names = ["n_tokens", "n_known", "n_rare", "network", "logs", "rare_logs", "words", "times"]
        for batch in batches:
            parts = [_score_part(net, head, counts, logs, texts) for texts in _pieces(batch)]
            if parts:
                yield pa.concat_arrays([pa.StructArray.from_arrays(part, names) for part in parts])
            else:
                yield pa.array([], OUT)

    return score.asNondeterministic()(utf8())


def score(docs: DataFrame, *, folds: int = FOLDS, fold: int = FOLD, head: int = HEAD) -> DataFrame:
    """One row per document: counts of tokens and known ones, the unigram `base_score` and the network's `score`."""
    spark = docs.sparkSession
    out = held_out(folds, fold)
    counts = settled(word_counts(docs.where(~out)))
    words = vocabulary(counts, head)
    flat = train(docs.where(~out), words)
    path = scratch_path(spark, "lm-scores")
    # written once: the row numbers stay as they are, and the long lists of words need not be in memory
    docs.select("doc_id", out.alias("held_out"), F.monotonically_increasing_id().alias("row"), _scored(flat, words).alias("s")).write.parquet(path)
    rows = spark.read.parquet(path)
    outside = rows.select("row", F.explode(F.arrays_zip("s.words", "s.times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    known = outside.join(counts, "word")
    sums = known.groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"))
    rows = rows.select("doc_id", "held_out", "row", *[F.col(f"s.{c}").alias(f"s_{c}") for c in ("n_tokens", "n_known", "n_rare", "network", "logs", "rare_logs")]).join(sums, "row", "left")
    more = F.coalesce("logs", F.lit(0.0))
    base = F.col("s_logs") + more - F.col("s_n_tokens") * math.log10(words.tokens + words.types + 1)
    rare = F.col("s_rare_logs") + more - F.col("s_n_rare") * math.log10(words.rare_tokens + words.rare_types + 1)
    return rows.select(
        "doc_id", "held_out", F.col("s_n_tokens").alias("n_tokens"), (F.col("s_n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("s_network") / math.log(10) + rare).alias("score"),
    )
