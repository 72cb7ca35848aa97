"""Burrows-Wheeler transforms of shards of strings, merged by iterative interleave refinement.

Each string ends in a terminator that is less than any byte; terminators are ordered by string and equal to none but
themselves. A shard's rows are its suffixes in the order of their first `depth` bytes (prefix doubling, within the
shard alone), its transform the byte before each row. The merge never compares or sorts suffixes of different shards:
it holds an interleave, which only says which shard the next row is from, at first one shard after the other. Each
round reads the shards' transforms through the interleave, each in its own order, and deals the rows stably by that
byte, a backward step for all rows; the interleave is then right for one byte more. Where neighbours first fall into
different intervals in round h + 1, their common prefix has h bytes, so after `depth` rounds the common prefixes are
known up to `depth`, and the stretches without a lesser one are the intervals of repeated substrings.
"""

from __future__ import annotations

import numpy as np

PACKED, FEW, SHARD_BYTES = 7, 3, 1 << 16


class Shard:
    """rows: suffix starts in sorted order; transform: the byte before each; string: of each position; starts, ends: the strings' first bytes and terminators."""

    def __init__(self, strings: list[bytes], depth: int):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        self.ends = np.cumsum(sizes) - 1
        self.starts = self.ends - sizes + 1
        self.n, self.strings = int(sizes.sum()), len(strings)
        self.text = np.zeros(self.n, np.int64)
        inner = np.ones(self.n, bool)
        inner[self.ends] = False
        self.text[inner] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        self.string = np.repeat(np.arange(self.strings), sizes)
        last = self.ends[self.string]
        here = np.arange(self.n)
        key = np.zeros(self.n, np.int64)  # the first symbols, nothing after a terminator
        for k in range(PACKED):
            at = here + k
            key = key << 9 | np.where(at <= last, self.text[np.minimum(at, self.n - 1)], 0)
        width = PACKED
        order = np.argsort(key)
        order[: self.strings] = self.ends  # only terminators have key 0
        sorted_key = key[order]
        new = np.append(0, sorted_key[1:] != sorted_key[:-1])
        new[: self.strings] = 1
        rank = np.empty(self.n, np.int64)
        rank[order] = np.cumsum(new)
        while width < depth:
            # beyond its terminator a suffix is alone already: what follows doesn't matter
            key = rank * (self.n + 1) + rank[np.minimum(here + width, last)]
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
            width *= 2
        self.rows = order
        # each row's byte before, plus 1; 0 where a string starts
        before = np.where(order == self.starts[self.string[order]], 0, self.text[np.maximum(order - 1, 0)])
        self.transform = before.astype(np.uint16)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, row in it, common prefix with the suffix before, `depth` for that or more) of all suffixes in merged order."""
    strings = np.array([s.strings for s in shards])
    kind = np.uint8 if len(shards) <= 256 else np.uint16
    ends = np.repeat(np.arange(len(shards), dtype=kind), strings)  # the terminators' rows come first, shard by shard
    interleave = np.repeat(np.arange(len(shards), dtype=kind), [s.n for s in shards])
    # bytes by their place among those in use, in one byte where they fit: that is dealt in one pass
    counts = np.bincount(np.concatenate([s.transform for s in shards]), minlength=257)
    counts[0] = 0  # string starts
    used = np.flatnonzero(counts)
    place = np.zeros(257, np.uint8 if len(used) < 256 else np.uint16)
    place[used] = np.arange(1, len(used) + 1)
    transforms = [place[s.transform] for s in shards]
    total, first = len(interleave), len(ends)
    heads = np.concatenate([np.arange(first), first + np.cumsum(counts[used]) - counts[used]])  # where the bytes' rows begin is the same in all rounds
    interval = np.zeros(total, np.int32)
    common = np.zeros(total, np.min_scalar_type(depth))  # rounds that don't yet tell a row from the one before it
    before = np.empty(total, place.dtype)
    new = np.ones(total, bool)
    for _ in range(depth):
        # a shard's rows lie in the interleave in the shard's own order: its transform fills them one after the other
        if len(shards) <= FEW:
            for k, x in enumerate(transforms):
                before[interleave == k] = x
        else:
            before[np.argsort(interleave, kind="stable")] = np.concatenate(transforms)
        dealt = np.argsort(before, kind="stable")[first:]  # a step back: by the byte before, then as they stood; string starts lead nowhere
        was = interval[dealt]
        np.not_equal(was[1:], was[:-1], out=new[first + 1 :])
        new[heads] = True
        common += ~new
        interleave = np.concatenate([ends, interleave[dealt]])
        np.cumsum(new, dtype=np.int32, out=interval)
    order = np.argsort(interleave, kind="stable")
    row = np.empty(total, np.int64)
    row[order] = np.concatenate([np.arange(s.n) for s in shards])
    return interleave, row, common


def repeated_windows(strings: list[bytes], low: np.ndarray, width: int, shard_bytes: int = SHARD_BYTES) -> list[list[int]]:
    """For each string, the starts of its `width`-byte windows that also start in a string of a lower `low`."""
    string, start = repeats(strings, low, width, shard_bytes)
    cut = np.searchsorted(string, np.arange(len(strings) + 1))
    starts = start.tolist()
    return [starts[a:b] for a, b in zip(cut, cut[1:])]


def repeats(strings: list[bytes], low: np.ndarray, width: int, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of these windows, in order."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges, size = [0], 0
    for i, s in enumerate(strings):
        if size and size + len(s) > shard_bytes:
            edges.append(i)
            size = 0
        size += len(s) + 1
    edges.append(len(strings))
    shards = [Shard(strings[a:b], width) for a, b in zip(edges, edges[1:])]
    shard, row, common = merge(shards, width)
    string, start, left = (np.empty(len(shard), np.int64) for _ in range(3))
    for k, (s, at) in enumerate(zip(shards, edges)):
        mine = shard == k
        place = s.rows[row[mine]]
        string[mine] = s.string[place] + at
        start[mine] = place - s.starts[s.string[place]]
        left[mine] = s.ends[s.string[place]] - place
    # an interval of suffixes that share `width` bytes: no lesser common prefix within
    heads = np.flatnonzero(common < width)
    heads = heads if len(heads) and heads[0] == 0 else np.append(0, heads)
    own = np.asarray(low, np.int64)[string]
    least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.append(heads, len(own))))
    hit = np.flatnonzero((least < own) & (left >= width))
    hit = hit[np.lexsort((start[hit], string[hit]))]
    return string[hit], start[hit]
