"""Suffix array and common prefixes of one shard of bytes, in numpy."""

from __future__ import annotations

import numpy as np


def _words(data: np.ndarray) -> np.ndarray:
    """At each position the next eight bytes as one big-endian number (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out |= padded[i : i + len(data)].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Sorted suffixes by Larsson and Sadakane's refinement.

    Suffixes are first grouped by eight bytes.  A round sorts each group that is left by the group of
    the suffix ``depth`` bytes on, which doubles the sorted depth; suffixes alone in their group
    are done and not looked at again.
    """
    n = len(data)
    first = _words(data)
    # A suffix shorter than eight bytes is padded with zeros and must come before longer ones.
    order = np.lexsort((np.minimum(n - np.arange(n), 8), first))
    keys, short = first[order], np.minimum(n - order, 8)
    heads = np.concatenate([[True], (keys[1:] != keys[:-1]) | (short[1:] != short[:-1])])[:n]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, slots, 0))
    depth = 8
    alone = heads & np.concatenate([heads[1:], [True]])[:n]
    slots = slots[~alone]
    while len(slots):
        at = order[slots]
        on = at + depth
        following = np.where(on < n, rank[np.minimum(on, n - 1)], -1)
        keys = rank[at] * (n + 1) + following + 1
        by = np.argsort(keys, kind="stable")
        at, keys = at[by], keys[by]
        order[slots] = at
        heads = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[at] = np.maximum.accumulate(np.where(heads, slots, 0))
        slots = slots[~(heads & np.concatenate([heads[1:], [True]]))]
        depth *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place in ``order`` the bytes shared with the suffix before it; 0 at the first.

    Kasai's rule in text order: where the bytes before a suffix and before its predecessor agree,
    its common prefix is that of the suffix one byte earlier, less one.  Only the other
    positions are compared, eight bytes at a time, all at once.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    compared = (before <= 0) | (here == 0)
    inner = np.flatnonzero(~compared)
    compared[inner] = data[inner - 1] != data[before[inner] - 1]
    start = np.flatnonzero(compared & (before >= 0))
    length = np.zeros(n, np.int64)
    words = _words(data)
    active, other, done = start, before[start], np.zeros(len(start), np.int64)
    index = np.arange(len(start))
    total = np.zeros(len(start), np.int64)
    while len(index):
        limit = n - np.maximum(active, other) - done
        a, b = np.minimum(active + done, n - 1), np.minimum(other + done, n - 1)
        differ = words[a] ^ words[b]
        same = np.full(len(index), 8, np.int64)
        found = differ != 0
        # position of the first differing byte, from the highest set bit
        top = differ[found]
        bytes_same = np.zeros(len(top), np.int64)
        for i in range(1, 8):
            bytes_same += (top >> np.uint64(64 - 8 * i)) == 0
        same[found] = bytes_same
        same = np.minimum(same, np.maximum(limit, 0))
        total[index] += same
        more = (same == 8) & (limit > 8)
        index, active, other, done = index[more], active[more], other[more], done[more] + 8
    length[start] = total
    last = np.maximum.accumulate(np.where(compared, here, 0))
    length = np.maximum(length[last] - (here - last), 0)
    length[before < 0] = 0
    return length[order]
