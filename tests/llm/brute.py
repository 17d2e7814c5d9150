"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_duplicates(docs, percent):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def contaminated(docs, items, size=13):
    """{doc_id: (n_words, n_hit, item ids)}"""
    windows = {}
    for item, text in items:
        words = PLAIN_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        words = PLAIN_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for window, owners in windows.items():
            n = len(window)
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    found |= owners
        out[doc] = (len(words), len(hit), sorted(found))
    return out


def without_repeats(docs, min_words=50):
    """{doc_id: text} of (doc_id, text) rows, distinct ids."""
    runs = []
    for doc, text in docs:
        lines = list(enumerate((text or "").split("\n")))
        lines = [(i, line, len(WORD.findall(line))) for i, line in lines if WORD.search(line)]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                words = [w for _, _, w in lines[a : b + 1]]
                shorter = sum(words[:-1]) < min_words or sum(words[1:]) < min_words
                if sum(words) >= min_words and shorter:
                    content = tuple(line for _, line, _ in lines[a : b + 1])
                    minimal = sum(words[:-1]) < min_words or sum(words[1:]) < min_words
                    if minimal:
                        runs.append((content, doc, lines[a][0], lines[b][0]))
    first = {}
    for content, doc, a, b in runs:
        first[content] = min(first.get(content, (doc, a, b)), (doc, a, b))
    gone = {}
    for content, doc, a, b in runs:
        doc1, _, b1 = first[content]
        if doc != doc1 or a > b1:
            gone.setdefault(doc, set()).update(range(a, b + 1))
    out = {}
    for doc, text in docs:
        left = [x for i, x in enumerate((text or "").split("\n")) if i not in gone.get(doc, ())]
        out[doc] = None if text is None else "\n".join(left)
    return out
