"""Brute-force versions of what the operators compute."""

from __future__ import annotations

import re
from itertools import combinations

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(text: str | None, width: int = 5) -> set:
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(width)]))


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0


def classes(nodes, links) -> dict:
    """Least member of each connected component."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def near_classes(texts: dict) -> dict:
    sets = {k: shingles(t) for k, t in texts.items()}
    links = [
        (a, b) for a, b in combinations(sorted(texts), 2) if texts[a] == texts[b] or jaccard(sets[a], sets[b]) >= 0.8
    ]
    return classes(texts, links)


def altered(base: list[str], places: list[int], mark: str) -> str:
    out = list(base)
    for p in places:
        out[p] = f"{mark}{p}"
    return " ".join(out)


def docs_of(spark, rows):
    """Documents with a column whose name clashes with names used inside the operators."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, content string, node long, row long, id long"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 2, 3) for i, t in rows], schema)
