"""Plain versions of the contracts, one text or one table at a time."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

SPACES = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(SPACES, text or "")


def statistics(text):
    text = text or ""
    own = words(text)
    windows = collections.Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(SPACES, line):
            dup += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def fingerprint(text):
    own = words(lower(text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] or [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(ids, prints, bits=3):
    """The least id that each row reaches."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return [least.get(find(i)) for i in range(len(prints))]


def license_places(text, phrases):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places, labels = [], set()
    for label, phrase, counted in phrases:
        phrase = phrase.split()
        for i in range(len(own) - len(phrase) + 1) if counted else ():
            if own[i:i + len(phrase)] == phrase:
                places.append(i)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secret_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def held(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def unigrams(rows):
    """(n_tokens, n_known, train_tokens, base_score) by row of (doc_id, text)."""
    tokens = [lower(text or "").encode().split() + [b""] for _, text in rows]
    counts = collections.Counter(w for (i, _), own in zip(rows, tokens) if not held(i, 7, 2) for w in own)
    n, v = sum(counts.values()), len(counts)
    return [(len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)) for own in tokens]


def five_shingles(text):
    cleaned = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", " ", (text or "").lower())
    own = cleaned.split(" ")
    own = [w for w in own if w]
    return {" ".join(own[i:i + 5]) for i in range(len(own) - 4)}


def contained(docs, items):
    return sorted(
        (d, i, len(s), len(s & t)) for d, text in docs for t in [five_shingles(text)] for i, item in items
        for s in [five_shingles(item)] if s and 10 * len(s & t) >= 8 * len(s)
    )
