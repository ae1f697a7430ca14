"""Suffix arrays of byte strings by two-stage sorting, and common prefixes.

A suffix is of type B if it is smaller than its successor, the suffix one byte
further, and of type A otherwise.  Only B suffixes are sorted directly.  A scan
over the buckets (suffixes with the same first byte) in ascending order then
induces the others: if suffix j is in place, suffix j - 1 of type A is the next
one of its bucket.  A bucket is taken as a whole, so the work is done on arrays.

Suffixes are ordered by their first ``depth`` bytes at least; beyond the end
stand zeros.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def padded(text: np.ndarray, depth: int) -> np.ndarray:
    return np.concatenate([text, np.zeros(depth + 2 * WORD, np.uint8)])


def words_at(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes from each place of a padded text, as numbers in their order."""
    views = np.lib.stride_tricks.sliding_window_view(text, WORD)
    return np.ascontiguousarray(views[places]).view(">u8").ravel().astype(np.uint64)


def type_b(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor."""
    n = len(text)
    after = np.append(text[1:], 0)
    differs = text != after
    differs[-1:] = True  # the empty suffix is smaller than the last one
    smaller = text < after
    smaller[-1:] = False
    decides = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    return smaller[decides]


def sorted_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Places of a padded text by the ``depth`` bytes that follow them."""
    key = words_at(text, places)
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    same = key[1:] == key[:-1]  # as its left neighbour
    for done in range(WORD, depth, WORD):
        if not same.any():
            break
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        run = np.cumsum(np.append(True, ~same))[tied]
        key = words_at(text, places[tied] + done)
        order = np.lexsort((key, run))
        places[tied] = places[tied[order]]
        key = key[order]
        still = (key[1:] == key[:-1]) & (run[1:] == run[:-1])
        same[:] = False
        same[tied[:-1]] = still  # tied elements of a run are neighbours
    return places


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in order."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    direct = sorted_directly(padded(text, depth), np.flatnonzero(type_b(text)), depth)
    borders = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))  # follows from the empty suffix
    out = []
    for byte in range(256):
        block = waiting[byte]
        newest = np.concatenate(block) if block else np.zeros(0, np.int64)
        block = [newest]
        while len(newest):  # type A, in the same bucket as its successor
            before = newest[newest > 0] - 1
            newest = before[text[before] == byte]
            block.append(newest)
        placed = np.concatenate([*block, direct[borders[byte] : borders[byte + 1]]])
        out.append(placed)
        before = placed[placed > 0] - 1
        first = text[before]
        later = first > byte
        before, first = before[later], first[later]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for piece in np.split(before, cuts):
            if len(piece):
                waiting[text[piece[0]]].append(piece)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that the suffixes at neighbouring places share, up to ``depth``."""
    full = padded(text, depth)
    left, right = places[:-1], places[1:]
    length = np.zeros(len(left), np.int64)
    going = np.arange(len(left))
    for done in range(0, depth, WORD):
        apart = words_at(full, left[going] + done) ^ words_at(full, right[going] + done)
        equal = apart == 0
        # Leading bytes without a set bit.
        bits = np.frexp((apart >> np.uint64(8)).astype(np.float64))[1]  # of the upper seven bytes
        length[going] = done + np.where(equal, WORD, np.maximum(56 - bits, 0) // 8)
        going = going[equal]
    return np.minimum(length, depth)
