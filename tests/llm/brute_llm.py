"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {n: root(n) for n in nodes}


def chat(turns):
    """turns: (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def repeats(docs, width):
    """docs: (doc_id, text) -> {doc_id: (n_words, n_removed, kept_sha256)}"""
    words = {d: (t or "").encode().split() for d, t in docs}
    seen = Counter(tuple(w[i:i + width]) for w in words.values() for i in range(len(w) - width + 1))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def records(pages):
    """pages: (page_id, html) -> {page_id: (payload_bytes, digest, type, refers_to)}"""
    raw = {p: (h or "").encode() for p, h in pages}
    first = {}
    for p in sorted(raw):
        first.setdefault(raw[p], p)
    out = {}
    for p, b in raw.items():
        revisit = len(b) >= 100 and first[b] != p
        out[p] = (len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None)
    return out


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(docs, k=4, percent=80):
    """docs: (doc_id, text) -> {doc_id: (n_shingles, component_id)}; all pairs that share a shingle."""
    sets = {d: shingles(t, k) for d, t in docs}
    rep = {}
    for d in sorted(sets):
        rep.setdefault(frozenset(sets[d]), d)
    inverted = defaultdict(list)
    for s, d in rep.items():
        for x in s:
            inverted[x].append(d)
    shared = Counter()
    for ds in inverted.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                shared[min(a, b), max(a, b)] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    links += [(d, rep[frozenset(s)]) for d, s in sets.items() if s]
    found = components(sets, links)
    return {d: (len(sets[d]), found[d]) for d in sets}


def cosines(rows, threshold=0.93):
    """rows: (vec_id, vector, label) -> {vec_id: (n_links, component_id)}"""
    good = [(i, np.array(v, dtype=np.float64), lab) for i, v, lab in rows
            if lab is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for lab in {x[2] for x in good}:
        own = [x for x in good if x[2] == lab]
        m = np.stack([v / np.linalg.norm(v) for _, v, _ in own])
        close = m @ m.T >= threshold - 1e-12
        links += [(own[a][0], own[b][0]) for a, b in zip(*np.nonzero(np.triu(close, 1)), strict=True)]
    n = Counter(x for pair in links for x in pair)
    found = components([r[0] for r in rows], links)
    return {r[0]: (n[r[0]], found[r[0]]) for r in rows}
