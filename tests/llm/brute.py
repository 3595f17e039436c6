"""Plain versions of operators, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_components(docs, size=4):
    """doc_id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = {}
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for doc, s in sorted(sets.items()):
        for other, both in Counter(o for x in s for o in holders[x] if o < doc).items():
            if 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(docs, window=13):
    """doc_id -> (words, removed, kept words joined) by a dictionary of all windows."""
    first = {}
    words = {d: WORD.findall(t or "") for d, t in docs}
    for d, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < d:
                gone[k : k + window] = [True] * window
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out
