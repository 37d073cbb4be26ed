"""Plain single-process versions of the operators, for small tables."""

import re
from collections import Counter

A_TO_Z = {i: i + 32 for i in range(65, 91)}


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))


def shingle_set(text, k=5):
    w = spaced(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard_components(texts, percent=75):
    """[(n_shingles, index of the first text reached)] of a list of texts."""
    sets = [shingle_set(t) for t in texts]
    inverted, parent = {}, list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in inverted[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def contamination(text, items, size=13):
    """(n_words, n_hit, sorted item ids) of a text against [(id, text)]."""
    w, hit, found = alnum(text), set(), set()
    for item, words in ((i, alnum(t)) for i, t in items):
        n = min(size, len(words))
        windows = {tuple(words[j:j + n]) for j in range(len(words) - n + 1)} if n else set()
        for j in range(len(w) - n + 1 if n else 0):
            if tuple(w[j:j + n]) in windows:
                hit.update(range(j, j + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)
