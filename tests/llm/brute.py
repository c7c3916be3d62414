"""Plain versions of what the operators compute."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def similar(a, b):
    return bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b)


def groups(texts):
    """Smallest index of each text's group and its number of links."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(texts)
    for i in range(len(texts)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(k) for k in range(len(texts))], links


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def keep_lines(rows, least=10):
    """Flags of kept lines for (doc_id, text) rows; a null id stands after all others."""
    order = lambda i: (i is None, i or 0)
    first: dict = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= least and (k not in first or order(doc_id) < order(first[k])):
                first[k] = doc_id
    return [[len(key(line)) < least or first[key(line)] == doc_id for line in (text or "").split("\n")] for doc_id, text in rows]


def contaminated(text, items, window=13):
    """(n_words, n_hit, sorted ids, verdict)."""
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(window, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item_id)
    return len(w), len(hit), sorted(x for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)
