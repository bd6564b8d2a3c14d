"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def exact(rows):
    """(doc_id, text) -> {doc_id: (keep_id, group_size, kept, sha256)}"""
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    return {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm}


def shingles(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not found:
        return set()
    size = min(words, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def near(rows, words, percent=80):
    """(doc_id, text) -> {doc_id: (n_shingles, component_id, kept)}; looks at every pair with a common shingle."""
    sets = {i: shingles(t, words) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    common = Counter()
    for ids in by.values():
        ids.sort()
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                common[ids[a], ids[b]] += 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def earliest_deadline(weights, slots):
    """The source of every slot, by looking at all sources in each slot (weights are whole slots of a period)."""
    total, done, out = sum(weights.values()), Counter(), []
    for t in range(slots):
        open_ = [(-(-(done[s] + 1) * total // w), s) for s, w in weights.items() if done[s] * total // w <= t]
        s = min(open_)[1]
        done[s] += 1
        out.append(s)
    return out


def crc32(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
