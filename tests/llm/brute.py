"""Plain re-statements of the contracts, independent of the library."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, k):
    w = words(ascii_lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_components(docs, k, hundredths=80):
    """docs: [(id, text)] -> {id: (set size, component)} from all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                shared[min(a, b), max(a, b)] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= hundredths * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeated_words(docs, size):
    """docs: [(id, text)] -> {id: (n words, removed, kept words)}."""
    first = {}
    texts = {i: words(t) for i, t in docs}
    for i in sorted(texts):
        w = texts[i]
        for s in range(len(w) - size + 1):
            first.setdefault(tuple(w[s:s + size]), (i, s))
    out = {}
    for i, w in texts.items():
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] < (i, s):
                gone[s:s + size] = [True] * size
        out[i] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out
