"""Plain versions of the operators' results, for small inputs."""

import hashlib
import re
from collections import Counter


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, words):
    lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def linked(rows, words, least):
    """doc_id -> (number of shingles, component) by comparing all pairs."""
    sets = {i: shingles(t, words) for i, t in rows}
    union = Union(sets)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if least[1] * inter >= least[0] * (len(sets[a]) + len(sets[b]) - inter):
                    union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def repeats(texts, length=200):
    """(bytes, removed, runs, hash of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * (len(d) + 1)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(1 for a, b in zip([False, *gone], gone) if b and not a)
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in _PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) for c in reversed(digits)]
            luhn = sum(doubled[0::2]) + sum(sum(divmod(2 * d, 10)) for d in doubled[1::2])
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out
