"""Burrows-Wheeler transforms of small string collections, and their merge.

The merge is iterative interleave refinement: Z says for each place of the
merged transform from which shard its suffix comes. Sorted by the first h
symbols, the suffixes' predecessors are read off the transforms in that order
and dealt stably by symbol, which sorts by h + 1 symbols; no suffix is compared
with another again. A round takes two symbols at once. Along the way, places that
begin a new group of suffixes with a common prefix of h symbols are marked, so
after ``depth`` symbols the groups are the intervals of suffixes that share them.
"""

from __future__ import annotations

import numpy as np

END = 0  # sorts before all bytes; the byte b is the symbol b + 1, so 255 is never a byte of these strings


MOST_SHARDS = 250
PAIR = 2


def transform(strings: np.ndarray, offs: np.ndarray, shard: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transforms of several shards, one behind the other.

    ``strings`` are symbols, ``offs`` the strings' offsets, ``shard`` the shard of each string, ascending.
    Returns the two symbols before each suffix, the suffixes' starts in order (with
    an end of string each: offsets count it), and each place's shard. Suffixes
    of a shard are sorted by their first ``depth`` symbols.
    """
    n = len(offs) - 1
    size = np.diff(offs)
    closed = np.insert(strings, offs[1:], END)  # each string and its end
    begin = offs[:-1] + np.arange(n)
    total = len(closed)
    at = np.arange(total) - np.repeat(begin, size + 1)  # place in the string; before its begin stands its end
    last = np.repeat(size, size + 1)
    back = [closed[np.arange(total) - k + np.where(at >= k, 0, last + 1)] for k in (1, PAIR)]
    before = back[0].astype(np.uint16) | (back[1].astype(np.uint16) << np.uint16(8))
    padded = np.concatenate([closed, np.zeros(depth + 8, np.uint8)])
    left = last - at  # symbols up to the end
    words = np.zeros(total, np.uint64)  # eight symbols from each place on, none beyond the end
    for k in range(8):
        words = (words << np.uint64(8)) | np.where(left >= k, padded[k : k + total], 0).astype(np.uint64)
    words = np.concatenate([words, np.zeros(depth + 8, np.uint64)])
    own = np.repeat(shard, size + 1).astype(np.uint8)
    word = lambda i, k: np.where(left[i] >= k, words[i + k], 0)
    every = np.arange(total)
    order = np.lexsort((word(every, 8), words[:total], own))
    # only suffixes of a shard that share sixteen symbols need more of them
    a, b = order[1:], order[:-1]
    tie = (own[a] == own[b]) & (words[a] == words[b]) & (word(a, 8) == word(b, 8))
    some = np.zeros(total, bool)
    some[1:] |= tie
    some[:-1] |= tie
    at = np.flatnonzero(some)
    if len(at):
        i = order[at]
        group = np.cumsum(np.concatenate([[True], ~tie]))[at]
        order[at] = i[np.lexsort((*(word(i, k) for k in range((depth - 1) // 8 * 8, 8, -8)), group))]
    return before[order], order, own[order]


def merge(before: np.ndarray, shard: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all shards' suffixes, and the groups that share ``depth`` symbols (an even number).

    ``before`` and ``shard`` as ``transform`` gives them. Returns for each merged
    place its index in the concatenated transforms, and its group.
    """
    n = len(before)
    z = shard.copy()
    group = np.zeros(n, np.int32)
    place, every = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32)
    new = np.zeros(n, bool)
    for _ in range(depth // PAIR):
        symbol = before[place]
        deal = np.argsort(symbol, kind="stable")
        z, s, g = z[deal], symbol[deal], group[deal]
        np.not_equal(s[1:], s[:-1], out=new[1:])
        new[1:] |= g[1:] != g[:-1]
        group = np.cumsum(new, dtype=np.int32)
        place[np.argsort(z, kind="stable")] = every  # a shard's suffixes keep their order
        if n and group[-1] == n - 1:
            break  # every suffix stands alone
    return place, group
