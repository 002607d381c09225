"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            self.up[n] = self.up[self.up[n]]
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def bag(text, size=5):
    w = ALNUM.findall(lower(text))
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def jaccard(a, b):
    shared = sum((a & b).values())
    return shared / max(sum(a.values()) + sum(b.values()) - shared, 1)


def near_duplicates(docs):
    """{doc_id: component} of {doc_id: text}."""
    bags = {i: bag(t) for i, t in docs.items()}
    union = Union(docs)
    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= 0.8:
                union.join(a, b)
    return {i: union.find(i) for i in ids}


def repeats(docs, window=13):
    """{row: (words, removed, hash)} of a list of (doc_id, text)."""
    words = [SPACED.findall(t or "") for _, t in docs]
    ids = [float("inf") if i is None else i for i, _ in docs]
    least = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(ids, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def contamination(docs, items, window=10):
    """[(words, hits, items, hash)] of texts against (item_id, text)."""
    wins = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    sizes = {len(k) for k in wins}
    out = []
    for text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found)))))
    return out


def base_spans(text):
    """Base spans of op5, with the letters of the keywords spelled out."""
    either = "".join
    word = lambda s: either(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    keys = "|".join(word(k) for k in ("password", "passwd", "secret", "token", "api")) + word("")
    keys = keys.replace(word("api"), word("api") + "_?" + word("key"))
    assign = re.compile(f"({keys})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def cosine_links(rows, cosine=0.93):
    """{vec_id: (links, component)} of (vec_id, embedding, label) with distinct ids."""
    ok = []
    for i, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v or []], float)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            ok.append((i, x / np.sqrt((x * x).sum()), label))
    degree, union = Counter(), Union([r[0] for r in rows])
    for n, (i, x, a) in enumerate(ok):
        for j, y, b in ok[:n]:
            if a == b and len(x) == len(y) and float(x @ y) >= cosine:
                degree[i] += 1
                degree[j] += 1
                union.join(i, j)
    return {r[0]: (degree[r[0]], union.find(r[0])) for r in rows}
