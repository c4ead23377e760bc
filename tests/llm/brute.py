"""Plain single-machine versions of the operators' contracts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n=5):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def closure(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_duplicates(rows, percent):
    """``{id: (set size, component)}`` of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    links = []
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in inverted[x] if j > i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                links.append((i, j))
    of = closure(sets, links)
    return {i: (len(sets[i]), of[i]) for i in sets}


def without_repeats(rows, length):
    """``{id: (kept bytes, removed, spans)}`` of rows with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        out[i] = (kept, sum(covered), len(re.findall(b"\1+", bytes(covered))))
    return out
