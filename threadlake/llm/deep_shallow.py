"""Sorting suffixes by their first bytes, shallow by multikey quicksort, deep by blind tries.

Suffixes of repetitive text share long prefixes, which make comparing sorts slow. The
shallow part is a multikey quicksort whose characters are words of eight bytes: a quicksort
on one character, and only what is equal in it goes on to the next, down to a small depth.
What is still equal there forms groups with a long common prefix. These are ordered by blind
tries, which hold places and bytes of branches only, so that one comparison with one suffix
tells where another belongs. The tries of all groups grow at once, a level in a round.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16
WORD = 8


def padded(data: np.ndarray) -> np.ndarray:
    """``data`` with the bytes behind it that reading whole words needs."""
    return np.concatenate([data, np.zeros(WORD, np.uint8)])


def words(data: np.ndarray, places: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` bytes at each place as big-endian numbers."""
    every = np.ndarray(len(data) - WORD + 1, ">u8", data, strides=(1,))
    found = every[places].astype(np.uint64)
    return found >> np.uint64(8 * (WORD - wanted)) if wanted < WORD else found


def sort_suffixes(data: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their first ``length`` bytes, and which differ from the one before.

    ``data`` is ``padded``; every start has ``length`` bytes behind it. Equal ones stay in
    the order given.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order, fresh = _multikey(data, starts, min(shallow, length))
    if shallow < length:
        _blind_tries(data, starts, order, fresh, min(shallow, length), length)
    return order, fresh


def _multikey(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.arange(len(starts))
    fresh = np.zeros(len(starts), bool)
    fresh[0] = True
    places = np.arange(len(starts))  # where in the order there is something left to sort
    group = np.zeros(len(starts), np.int64)
    for at in range(0, depth, WORD):
        character = words(data, starts[order[places]] + at, min(WORD, depth - at))
        # Quicksort on the character; parts that were apart before stay apart.
        by = np.argsort(character, kind="stable") if at == 0 else np.lexsort((character, group))
        order[places] = order[places][by]
        character, group = character[by], group[by]
        differs = np.ones(len(places), bool)
        differs[1:] = (character[1:] != character[:-1]) | (group[1:] != group[:-1])
        fresh[places] |= differs
        group = np.cumsum(differs)
        again = _not_alone(differs)
        places, group = places[again], group[again]
        if not len(places):
            break
    return order, fresh


def _not_alone(differs: np.ndarray) -> np.ndarray:
    """Which members belong to a group of two or more, given where groups begin."""
    last = np.append(differs[1:], True)
    return ~(differs & last)


def _blind_tries(
    data: np.ndarray, starts: np.ndarray, order: np.ndarray, fresh: np.ndarray, depth: int, length: int
) -> None:
    """Order what is equal to ``depth`` in place.

    In a round each group's first suffix is the leaf that a blind search of its trie ends at.
    Comparing with it gives the place and byte where another suffix branches off; equal
    branches are the groups of the next round, and what equals the leaf is done.
    """
    places = np.flatnonzero(_not_alone(fresh))
    while len(places):
        member = order[places]
        begins = np.flatnonzero(fresh[places])
        sizes = np.diff(np.append(begins, len(places)))
        leaf = np.repeat(member[begins], sizes)
        common, branch, smaller = _compare(data, starts[member], starts[leaf], depth, length)
        # Along the leaf, what is smaller branches off ever later, what is larger ever earlier.
        place = np.where(smaller, common, 2 * length - common)
        key = np.where(common < length, place * 256 + branch, length * 256)
        group = np.repeat(np.arange(len(begins)), sizes)
        by = np.lexsort((key, group))
        order[places] = member[by]
        key, group = key[by], group[by]
        differs = np.ones(len(places), bool)
        differs[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        fresh[places] = differs
        places = places[_not_alone(differs) & (key != length * 256)]


def _compare(
    data: np.ndarray, ours: np.ndarray, leaves: np.ndarray, depth: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common bytes with the leaf, our byte behind them, and whether it is the smaller one."""
    common = np.full(len(ours), length, np.int64)
    branch = np.zeros(len(ours), np.int64)
    smaller = np.zeros(len(ours), bool)
    equal = np.flatnonzero(ours != leaves)
    for at in range(depth, length, WORD):
        wanted = min(WORD, length - at)
        one = words(data, ours[equal] + at, wanted)
        two = words(data, leaves[equal] + at, wanted)
        unlike = one != two
        rows = equal[unlike]
        if len(rows):
            # The first differing byte is that of the highest bit of the difference.
            mixed = one[unlike] ^ two[unlike]
            first = wanted - 1 - (np.frexp(_top(mixed).astype(np.float64))[1] - 1) // 8
            common[rows] = at + first
            branch[rows] = data[ours[rows] + common[rows]]
            smaller[rows] = one[unlike] < two[unlike]
        equal = equal[~unlike]
        if not len(equal):
            break
    return common, branch, smaller


def _top(words: np.ndarray) -> np.ndarray:
    """Numbers with the same highest bit that a double holds without rounding up."""
    return np.where(words >> np.uint64(53) > 0, words & ~np.uint64((1 << 11) - 1), words)
