"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, k: int) -> frozenset:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(k)]))


def components(ids, links) -> dict:
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(texts: dict, k: int, percent: int) -> dict:
    sets = {i: shingles(text, k) for i, text in texts.items()}
    links, seen = [], {}
    for a in sorted(sets):
        shared = Counter(b for gram in sets[a] for b in seen.get(gram, ()))
        for b, both in shared.items():
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
        for gram in sets[a]:
            seen.setdefault(gram, []).append(a)
    return components(sets, links)
