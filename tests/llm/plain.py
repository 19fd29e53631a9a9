"""The operators' results by brute force, over plain Python values."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(texts: list[str | None], size: int, percent: int) -> list[int]:
    """For each text the first text that it reaches through links; all pairs that share a shingle are compared."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for j, shared in Counter(j for s in own for j in holders[s]).items():
            if 100 * shared >= percent * (len(own) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(i)
    return [find(i) for i in range(len(texts))]


def without_frequent_lines(docs: list[dict], ratio: float, min_pages: int) -> list[str | None]:
    pages = Counter(d["source"] for d in docs)
    seen = Counter((d["source"], l) for d in docs for l in {l.strip(" ") for l in (d["text"] or "").split("\n")} if l)
    bad = {k for k, n in seen.items() if n >= min_pages and n > pages[k[0]] * ratio}
    keep = lambda d: "\n".join(l for l in d["text"].split("\n") if (d["source"], l.strip(" ")) not in bad)
    return [None if d["text"] is None else keep(d) for d in docs]


def edits(item: bytes, text: bytes) -> int:
    """Fewest edits that turn some piece of ``text`` into ``item``."""
    cost = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, cost = cost, [i]
        for j, b in enumerate(text, 1):
            cost.append(min(before[j - 1] + (a != b), before[j] + 1, cost[-1] + 1))
    return min(cost)


def repeated(texts: dict[int, str], words: int) -> set[int]:
    """Ids of the texts that hold a run of so many words, with what is between them, that another text holds."""
    holders = defaultdict(set)
    for i, t in texts.items():
        spans = [m.span() for m in WORD.finditer(t or "")]
        for (start, _), (_, end) in zip(spans, spans[words - 1 :]):
            holders[t[start:end]].add(i)
    return set().union(*(h for h in holders.values() if len(h) > 1))
