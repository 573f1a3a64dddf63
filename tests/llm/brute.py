"""Plain versions of the operators' rules, for comparison on small tables."""

from __future__ import annotations

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(text, size=5):
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def roots(nodes, edges):
    """Node -> smallest node that it can reach."""
    near = {n: {n} for n in nodes}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for node in sorted(nodes):
        if node in root:
            continue
        stack = [node]
        while stack:
            n = stack.pop()
            if n not in root:
                root[n] = node
                stack.extend(near[n])
    return root


def jaccard_components(rows, num=80, den=100, size=5):
    """doc_id -> (n_shingles, component_id) of (doc_id, text) rows."""
    sets = {doc_id: shingles(text, size) for doc_id, text in rows}
    holders = {}
    for doc_id, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(doc_id)
    common = {}
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b:
                    common[a, b] = common.get((a, b), 0) + 1
    edges = [
        (a, b)
        for (a, b), i in common.items()
        if den * i >= num * (len(sets[a]) + len(sets[b]) - i)
    ]
    root = roots(sets, edges)
    return {d: (len(s), root[d]) for d, s in sets.items()}
