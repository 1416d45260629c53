"""Plain-Python versions of the operators' rules, for small fixtures."""

import re
from collections import Counter, defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def space_words(t):
    return SPACE.findall((t or "").translate(AZ))


def alnum_words(t):
    return ALNUM.findall((t or "").translate(AZ))


def windows(items, k=13):
    """window (tuple) -> set of item ids"""
    out = defaultdict(set)
    for i, t in items:
        w = alnum_words(t)
        for a in range(max(len(w) - k + 1, 1 if w else 0)):
            out[tuple(w[a:a + k])].add("" if i is None else str(i))
    return out


def contamination(text, win):
    w = alnum_words(text)
    hit, ids = set(), set()
    for k in {len(x) for x in win}:
        for a in range(len(w) - k + 1):
            if (found := win.get(tuple(w[a:a + k]))):
                hit.update(range(a, a + k))
                ids |= found
    return len(w), len(hit), ids


def one_edit(a, b):
    """Whether two word lists are within one inserted, deleted or replaced word."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, l = sorted((a, b), key=len)
    return any(l[:i] + l[i + 1:] == s for i in range(len(l)))


def dropped_lines(docs, least=5, fuzzy=10):
    """docs: (id, hash, text) -> {(id, hash): set of line numbers}"""
    occ = []
    for d, h, t in set(docs):
        if t is None:
            continue
        for i, line in enumerate(t.split("\n")):
            w = space_words(line)
            if len(w) >= least:
                occ.append(((d is None, d if d is not None else 0, h, i), (d, h), i, w))
    occ.sort(key=lambda o: o[0])
    out = defaultdict(set)
    first = {}
    for o, key, i, w in occ:
        first.setdefault(tuple(w), o)
    late = {a for a in first if len(a) >= fuzzy for b in first if len(b) >= fuzzy and first[b] < first[a] and one_edit(list(a), list(b))}
    for o, key, i, w in occ:
        if first[tuple(w)] != o or tuple(w) in late:
            out[key].add(i)
    return out


def shingles(t, k=5):
    w = space_words(t)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1 if w else 0))}


def near_components(texts, percent=75):
    """list of texts -> list of component numbers (least index)"""
    sets = [shingles(t) for t in texts]
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                k = len(sets[i] & sets[j])
                if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                    a, b = find(i), find(j)
                    comp[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """{source: words} -> {source: target}, resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total > cap * sizes[s]}
        if not full:
            out.update({s: left * w[s] / total for s in open_})
            break
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def count(tokens):
    return Counter(tokens)
