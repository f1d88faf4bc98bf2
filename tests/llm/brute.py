"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
import string

WORD = re.compile("[^\x20\x09-\x0d]+")
SMALL = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def components(rows, width, percent):
    """[(doc_id, n, component)] of (doc_id, text) rows, as a sorted list."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (
                    len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    key = lambda r: [(x is not None, x or 0) for x in r]
    return sorted(((doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id)
                   for i, (doc_id, _) in enumerate(rows)), key=key)
