"""Repair of a conversation's structure by its cheapest sequence of edits.

A conversation is well-formed when the initials of its roles are `(s?(ua)+)?`. Rows are kept, given another role or deleted,
and empty turns are inserted; a blank or repeated row must go, a truncated one is better deleted than kept. Of the cheapest
sequences of edits the one whose letters (K, R, D, I) come first is taken.

The edits of each state of the dynamic program are a persistent string: linked nodes that share their prefixes, with
ancestors at powers of two and a rolling hash. Two strings of the same cost are compared by searching their longest common
prefix over these ancestors. A prefix that the hashes call equal is verified edit by edit, unless both share the node.

Rows meet once, by conversation, sorted by turn. A task reads them as a stream: what all states have in common is decided,
leaves the program and is given out, so a conversation is not held whole. States that can no longer win are dropped. A
conversation of which nothing is decided before its end (all rows blank, say) is held as far as its edits and texts go.

Rows without a turn come first; rows of one turn are ordered by role and text. A null role or text counts as one space. A
null conversation is one as well. A role that is empty, or whose initial is not one of `s`, `u`, `a`, can't be kept. Rows
may repeat: the second is a duplicate. Columns other than conv_id, turn, role, text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Rows and text bytes that may be undecided before a task looks for what is decided.
PENDING_ROWS, PENDING_BYTES = 256, 1 << 20
#: Rows of a batch that a task holds as objects at a time, by bytes of text.
HELD_BYTES = 2 << 20

# Costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# White space, and ends of a whole text.
SPACES, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")

START, SYSTEM, USER, ASSISTANT = range(4)
_KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_TURN = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}

_BASE, _MODULUS = 911382323, (1 << 61) - 1

SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPAIR = [
    StructField("place", LongType()), StructField("edit", StringType()), StructField("role", StringType()), StructField("text", StringType()),
    *(StructField(name, LongType()) for name in SUMMARY), StructField("audit", StringType()),
]


class Edits:
    """A string of edits: its last one, and the strings that are 1, 2, 4, ... edits shorter."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, edit: str = "", parent: Edits | None = None, *, depth: int = 0, hash: int = 0):
        self.edit = edit
        if parent is None:
            self.depth, self.hash, self.up = depth, hash, ()
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * _BASE + ord(edit)) % _MODULUS
        up, step = [parent], 0
        while len(up[step].up) > step:
            up.append(up[step].up[step])
            step += 1
        self.up = tuple(up)

    def prefix(self, depth: int) -> Edits:
        node, gap, step = self, self.depth - depth, 0
        while gap:
            if gap & 1:
                node = node.up[step]
            gap >>= 1
            step += 1
        return node

    def since(self, start: Edits) -> str:
        """The edits after a prefix."""
        out, node = [], self
        while node is not start:
            out.append(node.edit)
            node = node.up[0]
        return "".join(reversed(out))


def same(a: Edits, b: Edits) -> bool:
    """Whether strings of one length are equal. Equal hashes are not trusted."""
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.edit != b.edit or not a.up:
            return False
        a, b = a.up[0], b.up[0]
    return True


def shared(a: Edits, b: Edits) -> tuple[Edits, Edits, Edits]:
    """The longest common prefix of two strings of one length, and the nodes that follow it in each; for equal strings, themselves."""
    if same(a, b):
        return a, a, b
    step = len(a.up) - 1
    while step >= 0:
        if step < len(a.up) and not same(a.up[step], b.up[step]):
            a, b = a.up[step], b.up[step]
        step -= 1
    return a.up[0], a, b


def before(a: Edits, b: Edits) -> bool:
    """Whether string a is less than b."""
    depth = min(a.depth, b.depth)
    _, x, y = shared(a.prefix(depth), b.prefix(depth))
    return a.depth < b.depth if same(x, y) else x.edit < y.edit


class Program:
    """The cheapest edits of one conversation, row by row; `settle` gives out what is decided."""

    def __init__(self):
        self.root = Edits()
        self.states: list[tuple[int, Edits] | None] = [(0, self.root), None, None, None]
        self._insert()

    def _offer(self, states: list, state: int, cost: int, parent: Edits, edit: str) -> None:
        known = states[state]
        if known is None or cost < known[0]:
            states[state] = (cost, Edits(edit, parent))
        elif cost == known[0]:
            node = Edits(edit, parent)
            if before(node, known[1]):
                states[state] = (cost, node)

    def _insert(self) -> None:
        # a user's turn first, so that an assistant's may follow it; two insertions more lead back at a higher cost
        for state in (START, SYSTEM, ASSISTANT, USER):
            if found := self.states[state]:
                self._offer(self.states, _TURN[state], found[0] + INSERT, found[1], "I")

    def row(self, initial: str, *, must_go: bool, truncated: bool) -> None:
        after: list[tuple[int, Edits] | None] = [None] * 4
        more = TRUNCATED if truncated else 0
        for state, found in enumerate(self.states):
            if found is None:
                continue
            cost, node = found
            self._offer(after, state, cost + DELETE, node, "D")
            if must_go:
                continue
            if (kept := _KEEP[state].get(initial)) is not None:
                self._offer(after, kept, cost + more, node, "K")
            self._offer(after, _TURN[state], cost + more + RENAME, node, "R")
        self.states = after
        self._insert()
        # whatever follows START or SYSTEM can follow ASSISTANT too, but for a system's turn, which is then deleted
        if last := self.states[ASSISTANT]:
            if (start := self.states[START]) and start[0] > last[0] + DELETE:
                self.states[START] = None
            if (system := self.states[SYSTEM]) and system[0] > last[0]:
                self.states[SYSTEM] = None

    def settle(self) -> str:
        """The edits that all states have in common; they leave the program."""
        live = [found[1] for found in self.states if found]
        common = live[0]
        for node in live[1:]:
            depth = min(common.depth, node.depth)
            common = shared(common.prefix(depth), node.prefix(depth))[0]
        decided = common.since(self.root)
        if decided:
            # the rest is built anew, as its ancestors would keep what has left
            self.root = Edits(depth=common.depth, hash=common.hash)
            made = {id(common): self.root}

            def anew(node: Edits) -> Edits:
                path = []
                while id(node) not in made:
                    path.append(node)
                    node = node.up[0]
                found = made[id(node)]
                for old in reversed(path):
                    found = made[id(old)] = Edits(old.edit, found)
                return found

            self.states = [found and (found[0], anew(found[1])) for found in self.states]
        return decided

    def finish(self) -> tuple[int, str]:
        """Least cost, and what was not given out yet of the edits."""
        best = self.states[START]
        if (last := self.states[ASSISTANT]) and (best is None or last[0] < best[0] or last[0] == best[0] and before(last[1], best[1])):
            best = last
        return best[0], best[1].since(self.root)


class Conversation:
    """A conversation's rows one by one; `turns` gives out repaired turns as they are decided."""

    def __init__(self):
        self.program, self.pending, self.bytes = Program(), [], 0
        self.look_rows, self.look_bytes = PENDING_ROWS, PENDING_BYTES
        self.state, self.place, self.audit = START, 0, []
        self.counts = dict.fromkeys(SUMMARY, 0)
        self.low = self.high = self.last = None
        self.turns_seen, self.initial = 0, None

    def add(self, turn: int | None, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> Iterator[tuple]:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns_seen += turn != self.last
            self.high = self.last = turn
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        self.program.row(initial, must_go=fault in ("blank", "duplicate"), truncated=fault == "truncated")
        self.pending.append((role, text))
        self.bytes += len(text)
        if len(self.pending) >= self.look_rows or self.bytes >= self.look_bytes:
            yield from self._turns(self.program.settle())
            # where little was decided the next look comes later, so that looking stays cheap
            self.look_rows = max(PENDING_ROWS, 2 * len(self.pending))
            self.look_bytes = max(PENDING_BYTES, 2 * self.bytes)

    def _turns(self, edits: str) -> Iterator[tuple]:
        """Edited rows, deleted ones too, which have no place."""
        self.audit.append(edits)
        used = 0
        for edit in edits:
            role, text = "", ""
            if edit != "I":
                role, text = self.pending[used]
                used += 1
                self.bytes -= len(text)
            if edit == "K":
                self.state = _KEEP[self.state][role[:1]]
            elif edit != "D":
                self.state = _TURN[self.state]
                role = _ROLE[self.state]
            if edit != "D":
                yield (self.place, edit, role, text)
                self.place += 1
        del self.pending[:used]

    def end(self) -> Iterator[tuple]:
        self.counts["cost"], edits = self.program.finish()
        yield from self._turns(edits)
        self.counts["gaps"] = 0 if self.low is None else self.high - self.low + 1 - self.turns_seen


def with_faults(rows: DataFrame) -> DataFrame:
    """`blank`, `truncated` and `duplicate` for rows of conv_id, turn, role, text, sorted by turn within tasks by conversation."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    last = F.substring(trimmed, -1, 1)
    flagged = rows.withColumns({"blank": trimmed == "", "truncated": ~last.isin(*ENDS), "__text": F.sha2(F.col("text").cast("binary"), 256)})
    # one exchange by conversation serves the duplicates' window too
    own = flagged.repartition("conv_id")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    seen = F.row_number().over(Window.partitionBy("conv_id", "live", "role", "__text").orderBy(F.col("turn").asc_nulls_first()))
    return own.withColumn("duplicate", seen > 1).drop("__text").sortWithinPartitions("conv_id", *order, "duplicate")


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of about `HELD_BYTES` of text."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        if held and held + n > HELD_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def _repair(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    empty = (None,) * (len(SUMMARY) + 1)
    current, own, out, held = None, None, [], 0

    def told(key, turns: Iterator[tuple]) -> None:
        nonlocal held
        for turn in turns:
            out.append((key, *turn, *empty))
            held += len(turn[3])

    def close() -> None:
        told(current, own.end())
        out.append((current, None, None, None, None, *own.counts.values(), "".join(own.audit)))

    def written() -> pa.RecordBatch:
        nonlocal held
        columns = list(zip(*out))
        made = pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)
        out.clear()
        held = 0
        return made

    for whole in batches:
        for batch in _by_bytes(whole):
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                key, turn, role, text, live, blank, truncated, duplicate = row
                if own is None or key != current:
                    if own is not None:
                        close()
                    current, own = key, Conversation()
                if live:
                    told(key, own.add(turn, role, text, blank, duplicate, truncated))
                if held > HELD_BYTES or len(out) > 10_000:
                    yield written()
    if own is not None:
        close()
    if out:
        yield written()


def repair(rows: DataFrame, *, live: Column | None = None) -> DataFrame:
    """Repaired turns in order, and after those of a conversation one row of its counts, least cost and edits.

    `rows` has conv_id, turn, role, text; rows that are not `live` only name their conversation. A turn has `place`
    (from 0), `edit`, `role` and `text`; the row of counts has none of them. Rows of a conversation stay together and in
    this order, as nothing is shuffled after the repair.
    """
    live = F.lit(True) if live is None else live
    filled = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], live.alias("live"))
    ready = with_faults(filled).select("conv_id", "turn", "role", "text", "live", "blank", "truncated", "duplicate")
    schema = StructType([ready.schema["conv_id"], *REPAIR])
    arrow = _arrow(schema)
    return ready.mapInArrow(lambda batches: _repair(batches, arrow), schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def turns(repaired: DataFrame) -> DataFrame:
    return repaired.where("place is not null").select("conv_id", "place", "edit", "role", "text")


def audits(repaired: DataFrame) -> DataFrame:
    return repaired.where("place is null").select("conv_id", *SUMMARY, "audit")


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    import hashlib

    digest = hashlib.sha256()
    for whole in batches:
        out = []
        for row in whole.to_pylist():
            if row["place"] is None:
                out.append((row["conv_id"], *(row[name] for name in SUMMARY), row["audit"], digest.hexdigest()))
                digest = hashlib.sha256()
            else:
                digest.update(("\n" if row["place"] else "").encode() + f"{row['role']}:{row['text']}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def with_digest(repaired: DataFrame) -> DataFrame:
    """Each conversation's counts, cost and edits, and the SHA-256 of its repaired turns, `role:text` joined by line breaks.

    The turns are read as a stream in the order in which `repair` gives them; nothing may come between that moves rows.
    """
    fields = repaired.schema
    schema = StructType([fields["conv_id"], *(fields[name] for name in SUMMARY), fields["audit"], StructField("repaired_sha256", StringType())])
    arrow = _arrow(schema)
    return repaired.mapInArrow(lambda batches: _digests(batches, arrow), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows broken by the checksum of `conv_id:turn`, in twenty classes: dropped (`live` false), emptied, without ends of
    sentences, repeated, or said by the user; the other classes stay."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    broken = F.when(kind == 1, "").when(kind == 2, F.translate(text, "".join(ENDS), "")).otherwise(text)
    said = F.when(kind == 4, "user").otherwise(role)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.select("conv_id", "turn", said.alias("role"), broken.alias("text"), (kind != 0).alias("live"), copies.alias("copies"))
    return kept.select("conv_id", "turn", "role", "text", "live", F.explode("copies").alias("copy")).drop("copy")
