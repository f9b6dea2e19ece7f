"""Plain versions of the operators, for comparison on small tables."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_components(rows):
    """doc_id -> (set size, smallest reachable id) for unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    common = Counter()
    for ids in by.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_quality(text):
    text = text or ""
    w = words(text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if triples[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
        seen.add(line)
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


KINDS = (
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 6),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    ("hex", re.compile(r"([0-9a-f]+)"), 24),
)


def base_secrets(text):
    """Counts per kind, digest, spans."""
    spans, counts = [], []
    for k, (_, pattern, least) in enumerate(KINDS):
        own = [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if len(m[1]) >= least]
        counts.append(len(own))
        spans += own
    listed = ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
    return *counts, sha256(listed.encode()).hexdigest(), listed


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
