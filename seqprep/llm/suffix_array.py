"""Suffix arrays of one shard in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Larsson-Sadakane refinement: (suffixes in the order of their first ``depth`` bytes at least, rank).

    The first round sorts by eight bytes; each later round doubles the sorted
    prefix and touches only the groups that are not yet split into single suffixes.
    Equal suffixes share a rank (the first place of their group).
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + n]
    # A suffix shorter than eight bytes can tie with one that goes on with zeros: such ties are never real windows.
    order = np.argsort(word, kind="stable")
    sorted_words = word[order]
    fresh = np.empty(n, bool)
    fresh[:1], fresh[1:] = True, sorted_words[1:] != sorted_words[:-1]
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(fresh, place, 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    reach = 8
    while reach < depth:
        last = np.append(fresh[1:], True)
        open_places = np.flatnonzero(~(fresh & last))
        if not len(open_places):
            break
        suffixes = order[open_places]
        ahead = suffixes + reach
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        key = rank[suffixes] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        key, suffixes = key[by], suffixes[by]
        order[open_places] = suffixes
        fresh[open_places[1:]] |= key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[suffixes] = first[open_places]
        reach *= 2
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int, lanes: int = 4096) -> np.ndarray:
    """Kasai: for each place its common prefix with the place before, up to ``depth``.

    The text is cut into lanes that run in step; along a lane a common prefix is
    at least the one of the position before, less one.
    """
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[place - 1], -1)
    found = np.zeros(n, np.int64)
    size = -(-n // lanes)
    at = np.arange(0, n, size)
    stop = np.minimum(at + size, n)
    height = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        mine, its = at + height, other + height
        tied = (other >= 0) & (rank[other] == rank[at])
        same = ~tied & (other >= 0) & (height < depth) & (mine < n) & (its < n)
        same &= text[np.minimum(mine, n - 1)] == text[np.clip(its, 0, n - 1)]
        done = ~same
        found[place[at[done]]] = np.where(tied, depth, height)[done]
        height = np.where(same, height + 1, np.where(tied, 0, np.maximum(height - 1, 0)))
        at = at + done
        going = at < stop
        if not going.all():
            at, stop, height = at[going], stop[going], height[going]
    return found
