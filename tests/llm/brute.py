"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def order(rows):
    """Rows by id, null last; rows that share an id in the order given."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def cover(sequences, length):
    """For each (id, sequence) in order: which places are covered by an earlier seen window."""
    seen, out = set(), []
    for _, seq in sequences:
        gone = [False] * len(seq)
        for i in range(len(seq) - length + 1):
            key = tuple(seq[i:i + length])
            if key in seen:
                gone[i:i + length] = [True] * length
            seen.add(key)
        out.append(gone)
    return out


def substring(rows, window=20):
    docs = [(i, (t or "").encode().split()) for i, t in order(rows)]
    return sorted(((i, len(w), sum(g), sha(b" ".join(x for x, y in zip(w, g) if not y)))
                   for (i, w), g in zip(docs, cover(docs, window))), key=str)


def suffix(rows, length=100):
    docs = [(i, (t or "").encode()) for i, t in order(rows)]
    out = []
    for (i, b), g in zip(docs, cover(docs, length)):
        spans = sum(1 for k, x in enumerate(g) if x and (k == 0 or not g[k - 1]))
        out.append((i, len(b), sum(g), spans, sha(bytes(x for x, y in zip(b, g) if not y))))
    return sorted(out, key=str)


def shingles(text, k=5):
    words = (text or "").translate(ASCII_LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def near(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    lowest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            lowest[find(k)] = min(i, lowest.get(find(k), i))
    return sorted(((i, len(sets[k]), lowest.get(find(k)), i == lowest.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def contamination(rows, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    wanted = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            wanted.setdefault(tuple(w[i:i + size]), set()).add("" if name is None else str(name))
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in wanted}:
            for a in range(len(w) - size + 1):
                if own := wanted.get(tuple(w[a:a + size])):
                    hit.update(range(a, a + size))
                    found |= own
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return sorted(out, key=str)


def exact(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    out = []
    for t, ids in texts.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(t.encode())) for i in ids]
    return sorted(out, key=str)
