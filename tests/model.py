"""A plain-Python model of the text, index, link and crawl rules, used only
to check the Spark operators on hand-made pages."""

from __future__ import annotations

import re
from collections import defaultdict


def lines(text: str) -> list[str]:
    parts = text.split("\n")
    if parts and parts[-1] == "":
        parts = parts[:-1]
    return parts


def is_markup(line: str) -> bool:
    return len(line) >= 2 and line[0] == "<"


def indexable(text: str) -> list[tuple[int, int, str]]:
    """(row, line_no, line)"""
    out = []
    for line_no, line in enumerate(lines(text)):
        if not is_markup(line):
            out.append((len(out), line_no, line))
    return out


def terms(line: str) -> list[str]:
    return [t for t in line.split(" ") if t != ""]


def postings(pages: dict[str, str]) -> dict[tuple[str, str], tuple[int, list[int]]]:
    acc: dict[tuple[str, str], list] = {}
    for path, text in pages.items():
        for row, _, line in indexable(text):
            for t in terms(line):
                fr, rows = acc.setdefault((t, path), [0, []])
                acc[(t, path)][0] = fr + 1
                if row not in rows:
                    rows.append(row)
    return {k: (v[0], sorted(v[1])) for k, v in acc.items()}


def bwl(text: str) -> tuple[int, int, int]:
    data = text.encode("utf-8")
    w = l = 0
    prev = ord(" ")
    for c in data:
        if c == ord(" ") and prev not in (ord(" "), ord("\n")):
            w += 1
        elif c == ord("\n"):
            l += 1
            if prev not in (ord("\n"), ord(" ")):
                w += 1
        prev = c
    return len(data), w, l


def links(text: str) -> list[str]:
    """Anchor targets: after each literal ``<a href=`` the second run of
    non-quote characters (quote-delimited tokens), whole lines."""
    out = []
    for line in text.split("\n"):
        pos = line.find("<a href=")
        while pos >= 0:
            toks = [s for s in line[pos:].split('"') if s != ""]
            if len(toks) < 2:
                break
            out.append(toks[1])
            pos = line.find("<a href=", pos + len(toks[1]))
    return out


def strip_parent(u: str) -> str:
    return u[3:] if u.startswith("../") else u


def crawl(pages: dict[str, tuple[str, bool]], start: str) -> dict[str, tuple[int, int, int]]:
    """path -> (depth, status, bytes)"""
    def fetch(key):
        p = strip_parent(strip_parent(key))
        if p not in pages:
            return p, 404, 0
        text, readable = pages[p]
        return (p, 200, len(text.encode())) if readable else (p, 403, 0)

    seen = {start: 0}
    order = [start]
    i = 0
    while i < len(order):
        key = order[i]
        i += 1
        p, status, _ = fetch(key)
        if status != 200:
            continue
        for dst in links(pages[p][0]):
            k = strip_parent(dst)
            if k not in seen:
                seen[k] = seen[key] + 1
                order.append(k)
    out = {}
    for key, depth in seen.items():
        _, status, nbytes = fetch(key)
        out[key] = (depth, status, nbytes)
    return out


def search(pages: dict[str, str], words: list[str]) -> set[tuple[str, int]]:
    hits = set()
    for path, text in pages.items():
        for row, _, line in indexable(text):
            if set(terms(line)) & set(words):
                hits.add((path, row))
    return hits


def running(rows: list[tuple], key, order, value) -> dict:
    acc = defaultdict(int)
    out = {}
    for r in sorted(rows, key=lambda r: (key(r), order(r))):
        acc[key(r)] += value(r)
        out[r] = acc[key(r)]
    return out
