"""Multikey quicksort of suffixes, all segments of a level partitioned together."""

from __future__ import annotations

import numpy as np


def words_of(buffer: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place as one number, most significant byte first; zeros follow the end."""
    out = np.zeros(len(buffer), np.uint64)
    padded = np.concatenate([buffer, np.zeros(7, np.uint8)]).astype(np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(buffer)]
    return out


def multikey_quicksort(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts suffixes by their first ``depth`` bytes.

    ``words`` come from ``words_of``, ``starts`` are the places of the suffixes. Returns the suffixes in order and for
    each place of that order the first place of its run of equal suffixes.

    A segment holds suffixes that agree so far. Each round takes a pivot word of every open segment and splits the
    segment into the smaller, equal and larger part; the equal part goes on to its next word. Parts of one suffix and
    parts that have no words left are done.
    """
    steps = [*range(0, depth - 7, 8)]
    if not steps or steps[-1] + 8 < depth:
        steps.append(max(0, depth - 8))  # the last word overlaps the one before
    offsets = np.array(steps, np.int64)
    draw = np.random.default_rng(1)
    n = len(starts)
    order, run = np.arange(n), np.arange(n)
    slot, item, level = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    head = np.zeros(n, bool)
    head[:1] = True
    while len(slot) > 1:
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(slot)))
        word = words[starts[item] + offsets[level]]
        pivot = np.repeat(word[first + (draw.random(len(first)) * size).astype(np.int64)], size)
        less, equal = word < pivot, word == pivot
        more = ~(less | equal)
        base = np.repeat(first, size)
        rank = {}
        for name, part in (("less", less), ("equal", equal), ("more", more)):
            total = np.cumsum(part)
            rank[name] = total - 1 - np.repeat((total - part)[first], size), np.repeat(np.add.reduceat(part.astype(np.int64), first), size)
        to = base + np.where(less, rank["less"][0], rank["less"][1] + np.where(equal, rank["equal"][0], rank["equal"][1] + rank["more"][0]))
        kind, new_item, new_level = (np.empty(len(slot), np.int64) for _ in range(3))
        kind[to] = less * 0 + equal * 1 + more * 2
        new_item[to], new_level[to] = item, level + equal
        item, level = new_item, new_level
        order[slot] = item
        head = head | np.concatenate([[True], kind[1:] != kind[:-1]])
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(slot)))
        done = level[first] == len(offsets)
        ended = np.repeat(done, size)
        run[slot[ended]] = np.repeat(slot[first], size)[ended]
        open_ = np.repeat(~done & (size > 1), size)
        slot, item, level, head = slot[open_], item[open_], level[open_], head[open_]
    return order, run
