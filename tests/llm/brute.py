"""Plain restatements to hold the operators against."""

import re
from collections import defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(UP))


def shingle_set(text, width=5):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def jaccard_components(docs, width=5):
    """{doc_id: (size, component)} by testing every pair that shares a shingle."""
    sets = {d: shingle_set(t, width) for d, t in docs}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = {(a, b) for l in where.values() for i, a in enumerate(l) for b in l[i + 1 :]}
    for a, b in pairs:
        i = len(sets[a] & sets[b])
        if 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}
