"""Plain versions of what the operators compute, for small fixtures."""

from __future__ import annotations

import re
from collections import Counter


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def multiset_similarity(a, b, n=5):
    def shingles(text):
        w = words(text)
        return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else Counter()

    x, y = shingles(a), shingles(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


def smallest_reached(ids, linked):
    """{id: smallest id it reaches} for a symmetric relation over distinct ids."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def cut_repeats(texts, n):
    """(words, words left) per text: words in windows of n words that begin elsewhere too are gone."""
    split = [words(t) for t in texts]
    windows = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if windows[tuple(w[i : i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


def water_levels(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again; sizes is {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    rest = float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        open_ -= over
    return target
