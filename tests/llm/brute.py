"""The operators' results by the plainest means, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_duplicates(documents, percent=85):
    """doc_id, size, component and kept of each (doc_id, text), in order; sets are compared pairwise."""
    sets = [shingles(text) for _, text in documents]
    head = list(range(len(documents)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                head[top(i)] = top(j)
    members = defaultdict(list)
    for i in range(len(documents)):
        members[top(i)].append(documents[i][0])
    least = {t: min((x for x in ids if x is not None), default=None) for t, ids in members.items()}
    return [
        (doc_id, len(sets[i]), least[top(i)], doc_id == least[top(i)])
        for i, (doc_id, _) in enumerate(documents)
    ]


def repeated_bytes(documents, length=400):
    """doc_id, bytes, removed, spans and digest of what is left."""
    bodies = [(i, (t or "").encode()) for i, t in documents]
    seen = Counter(b[j : j + length] for _, b in bodies for j in range(len(b) - length + 1))
    out = []
    for doc_id, b in bodies:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_scores(documents):
    """doc_id, held out, tokens, known tokens, training tokens and base score."""
    texts = [(i, [*words(t), b" end"]) for i, t in documents]
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in texts}
    count = Counter(w for i, t in texts if not held[i] for w in t)
    total, kinds = sum(count.values()), len(count)
    return [
        (
            i,
            held[i],
            len(t),
            sum(count[w] > 0 for w in t),
            total,
            sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in t),
        )
        for i, t in texts
    ]
