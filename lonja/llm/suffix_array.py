"""Two-stage suffix sorting of a set of strings, vectorised over whole buckets.

The strings stand one after the other, each closed by a 0 byte; the 0 bytes sort by position. Suffixes
smaller than their successor are sorted directly; every other suffix then follows from the order of its
successor, by one scan over the buckets of first characters in ascending order.
"""

from __future__ import annotations

import numpy as np


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), ">u8", padded, strides=(1,)).astype(np.uint64)


def _masked(keys: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Without the bytes behind the string's end, where fewer than eight are left."""
    drop = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
    short = drop > 0
    keys = keys.copy()
    keys[short] = np.where(drop[short] >= 64, 0, (keys[short] >> (drop[short] & np.uint64(63))) << (drop[short] & np.uint64(63)))
    return keys


def _direct(chosen: np.ndarray, keys: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The positions in the order of their suffixes: rounds of eight more bytes for those still tied."""
    if len(chosen) == 0:
        return chosen
    first = _masked(keys[chosen], left[chosen])
    order = np.argsort(first)
    result, first = chosen[order], first[order]
    slots, depth = np.arange(len(result)), 8
    new = np.ones(len(result), bool)
    new[1:] = first[1:] != first[:-1]
    group = np.maximum.accumulate(np.where(new, slots, 0))
    while True:
        tied = np.zeros(len(group), bool)
        same = group[1:] == group[:-1]
        tied[1:] = same
        tied[:-1] |= same
        # The strings of one group end together; their suffixes are equal and stand by position.
        ended = tied & (left[result[slots]] < depth)
        if ended.any():
            own, places = slots[ended], result[slots[ended]]
            result[own] = places[np.lexsort((places, group[ended]))]
        tied &= ~ended
        if not tied.any():
            return result
        slots, group = slots[tied], group[tied]
        places = result[slots]
        key = _masked(keys[np.minimum(places + depth, len(keys) - 1)], left[places] - depth)
        # Sort by group and key at once: the keys' dense ranks fit beside the group's number.
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
        both = group.astype(np.uint64) << np.uint64(32) | rank
        order = np.argsort(both)
        result[slots], both = places[order], both[order]
        # Within a group the slots stay the same; each new value opens a group at its first slot.
        new = np.append(True, both[1:] != both[:-1])
        group = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        depth += 8


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """All positions in suffix order. ``left``: characters up to the closing 0 of the position's string."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    # Equal neighbours have the type of the next position where the character changes.
    change = np.where(step != 0, np.arange(n), n - 1)
    change = np.minimum.accumulate(change[::-1])[::-1]
    smaller = (step[change] > 0) & (text > 0)
    keys = eight_bytes(text)
    direct = _direct(np.flatnonzero(smaller), keys, left)
    heads = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    buckets = []
    for letter in range(256):
        if letter == 0:
            bucket = np.flatnonzero(text == 0)
        else:
            parts, wave = [], np.concatenate(waiting[letter]) if waiting[letter] else direct[:0]
            while len(wave):
                parts.append(wave)
                before = wave[wave > 0] - 1
                wave = before[text[before] == letter]
            bucket = np.concatenate([*parts, direct[heads[letter] : heads[letter + 1]]])
        if not len(bucket):
            continue
        buckets.append(bucket)
        before = bucket[bucket > 0] - 1
        letters = text[before]
        larger = letters > letter
        before, letters = before[larger], letters[larger]
        order = np.argsort(letters, kind="stable")
        before, letters = before[order], letters[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for part in np.split(before, cuts) if len(before) else ():
            waiting[text[part[0]]].append(part)
    return np.concatenate(buckets) if buckets else direct


def repeated(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Positions whose next ``length`` characters also start at another position (none across a closing 0)."""
    order = suffix_array(text, left)
    order = order[left[order] >= length]
    if len(order) < 2:
        return order[:0]
    keys = eight_bytes(text)
    # Common prefix of neighbours, eight characters at a time, up to the wanted length.
    alive = np.arange(len(order) - 1)
    for depth in [*range(0, length - 7, 8), length - 8] if length >= 8 else []:
        alive = alive[keys[order[alive] + depth] == keys[order[alive + 1] + depth]]
    if length < 8:
        for depth in range(length):
            alive = alive[text[order[alive] + depth] == text[order[alive + 1] + depth]]
    found = np.zeros(len(order), bool)
    found[alive] = found[alive + 1] = True
    return np.sort(order[found])
