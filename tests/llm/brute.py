"""Plain versions of the text operators for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def groups(ids, links):
    """The smallest id reachable from each."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_copies(docs, width):
    sets = {i: shingles(t, width) for i, t in docs}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    return sets, groups(sets, links)


def contaminated(docs, items, width=5):
    out = set()
    for d, text in docs:
        have = shingles(text, width)
        for i, item in items:
            want = shingles(item, width)
            if want and 5 * len(have & want) >= 4 * len(want):
                out.add((d, i))
    return out


def late_lines(docs, least=5):
    """(id, line) of lines that go; docs in order of id."""
    seen, out = defaultdict(list), set()
    for i, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            s = frozenset(words(line))
            if len(s) < least:
                continue
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen["all"]):
                out.add((i, k))
            seen["all"].append(s)
    return out
