"""The repair of conversations against a plain version that keeps every string whole."""

import hashlib
import itertools
import random
import re
import zlib

from hypothesis import given as cases, settings, strategies as st

from tidemark.llm import conversation_audit as A, registry
from tidemark.llm.common import read

FORM = re.compile(r"(s?(ua)+)?")
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}


def text_of(value):
    return " " if value is None else str(value)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, edits) of rows (initial, must go, truncated), by whole strings for each state."""
    def insert(states):
        for state in (0, 1, 3, 2):
            if state in states:
                cost, edits = states[state]
                to = MOVES[state][NEXT[state]]
                new = (cost + 5, edits + "I")
                if to not in states or new < states[to]:
                    states[to] = new
        return states

    states = insert({0: (0, "")})
    for initial, must_go, truncated in rows:
        offers = []
        for state, (cost, edits) in states.items():
            offers.append((state, cost + 2, edits + "D"))
            if not must_go:
                more = 5 if truncated else 0
                if initial in MOVES[state]:
                    offers.append((MOVES[state][initial], cost + more, edits + "K"))
                offers.append((MOVES[state][NEXT[state]], cost + more + 1, edits + "R"))
        states = {}
        for state, cost, edits in offers:
            if state not in states or (cost, edits) < states[state]:
                states[state] = (cost, edits)
        insert(states)
    return min(found for state, found in states.items() if state in (0, 3))


def enumerated(rows, most):
    """The same by trying every string of edits up to a length."""
    best = None
    for n in range(most + 1):
        for edits in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(rows):
                continue
            cost, initials, at, fine = 0, "", 0, True
            for e in edits:
                if e == "I":
                    cost += 5
                    initials += "a" if initials.endswith("u") else "u"
                    continue
                initial, must_go, truncated = rows[at]
                at += 1
                if e == "D":
                    cost += 2
                    continue
                fine &= not must_go
                cost += 5 * truncated + (e == "R")
                initials += initial if e == "K" else "a" if initials.endswith("u") else "u"
            if fine and FORM.fullmatch(initials) and (best is None or (cost, "".join(edits)) < best):
                best = cost, "".join(edits)
    return best


def plain(rows):
    """Rows (conv_id, turn, role, text) to the contract's rows."""
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    convs = {}
    for row in damaged(rows):
        convs.setdefault(row[0], []).append(row)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [t for _, t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, program = set(), [], []
        for _, _, role, text in own:
            letters = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            program.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a + b not in ("su", "ua", "au") for (a, *_), (b, *_) in itertools.pairwise(program))
        cost, edits = cheapest(program)
        repaired, state, at = [], 0, 0
        for e in edits:
            if e != "I":
                role, text = own[at][2:]
                at += 1
            if e == "K":
                state = MOVES[state][role[:1]]
                repaired.append(f"{role}:{text}")
            elif e in "RI":
                to = NEXT[state]
                state = MOVES[state][to]
                repaired.append(f"{ROLES[to]}:{text if e == 'R' else ''}")
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conversation(frame):
    rows = frame.select("conv_id", *COLUMNS).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def query(rows):
    damage = A.damaged(rows)
    return A.with_digest(A.repair(damage, live=damage["live"]))


def test_query_equals_plain_version(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rows = [tuple(r) for r in read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert by_conversation(registry.QUERIES["op11_conversation_audit"](spark, folder)) == plain(rows)


TYPES = "conv_id long, turn long, role string, text string"


def test_edge_cases(spark):
    long = "very long " * 200_000 + "end."
    rows = [
        (None, None, None, None), (None, 0, "user", "a."), (None, 1, "assistant", "b"), (1, 5, "user", "x."), (1, 5, "user", "x."), (1, None, "assistant", "y!"),
        (2, 0, "", "empty role."), (2, 1, "tool", "other role."), (3, 0, "system", "s."), (3, 1, "system", "t."), (4, 9, "user", long), (4, 10, "assistant", long),
        (5, 0, "user", " \t\n\x0b\x0c\r"), (6, 0, "user", " "), (6, 3, "assistant", "é"), (7, 1, "user", "same."), (7, 1, "assistant", "same."), (7, 1, "user", "other."),
    ] + [(8, i, "user" if i % 2 else "assistant", f"{i}" + "." * (i % 3)) for i in range(1200)] + [(9, i, "user", "") for i in range(700)]
    frame = spark.createDataFrame(rows, TYPES).selectExpr("*", "'mine' as live", "'mine' as place", "'mine' as blank")
    assert by_conversation(query(frame)) == plain(rows)
    assert query(spark.createDataFrame([], TYPES)).count() == 0


def test_turns_are_the_repaired_texts(spark):
    rows = [(1, 0, "user", "one."), (1, 1, "user", "two."), (1, 2, "assistant", "three."), (2, 0, "user", "no end"), (3, 0, "user", "a."), (3, 1, "user", "b."), (4, 0, "system", "s."), (4, 1, "user", "u."), (4, 2, "user", "v")]
    out = A.repair(spark.createDataFrame(rows, TYPES))
    assert [tuple(r) for r in A.turns(out).orderBy("conv_id", "place").collect()] == [
        (1, 0, "K", "user", "two."), (1, 1, "K", "assistant", "three."), (3, 0, "K", "user", "a."), (3, 1, "R", "assistant", "b."), (4, 0, "R", "user", "s."), (4, 1, "R", "assistant", "u."),
    ]
    assert {r["conv_id"]: (r["audit"], r["cost"]) for r in A.audits(out).collect()} == {1: ("DKK", 2), 2: ("D", 2), 3: ("KR", 1), 4: ("RRD", 4)}


ROW = st.tuples(st.sampled_from("suat"), st.booleans(), st.booleans())


def run(rows, every=None):
    program, out = A.Program(), ""
    for i, (initial, must_go, truncated) in enumerate(rows):
        program.row(initial, must_go=must_go, truncated=truncated)
        if every and i % every == 0:
            out += program.settle()
    cost, rest = program.finish()
    return cost, out + rest


@settings(max_examples=300, deadline=None)
@cases(st.lists(ROW, max_size=40), st.integers(1, 7))
def test_program_equals_whole_strings(rows, every):
    assert run(rows) == run(rows, every) == cheapest(rows)


@settings(max_examples=25, deadline=None)
@cases(st.lists(ROW, max_size=4))
def test_plain_version_is_the_least_of_all(rows):
    assert cheapest(rows) == enumerated(rows, 8)


def test_colliding_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(A, "_MODULUS", 2)
    source = random.Random(5)
    for _ in range(200):
        rows = [(source.choice("suat"), source.random() < 0.2, source.random() < 0.3) for _ in range(source.randrange(60))]
        assert run(rows, 5) == cheapest(rows)


def test_what_is_decided_leaves_the_program():
    program = A.Program()
    most = 0
    for i in range(20_000):
        program.row("ua"[i % 2], must_go=i % 17 == 0, truncated=i % 11 == 0)
        if i % 256 == 0:
            program.settle()
            most = max(most, *(s[1].depth - program.root.depth for s in program.states if s))
    assert most < 600


def test_strings_compare_as_strings():
    source = random.Random(1)
    root = A.Edits()

    def made(text):
        node = root
        for e in text:
            node = A.Edits(e, node)
        return node

    for _ in range(500):
        a, b = ("".join(source.choice("DI") for _ in range(source.randrange(12))) for _ in range(2))
        assert A.before(made(a), made(b)) == (a < b)
