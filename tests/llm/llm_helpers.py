"""Brute-force versions that the tests share."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BLANKS = "[\x20\x09-\x0d]+"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text)


def words(text):
    return [word for word in re.split(BLANKS, ascii_lower(text or "")) if word]


def shingles(text, size=5):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def components_of(sets):
    """Smallest id reachable by links between the sets of shingles."""
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}
