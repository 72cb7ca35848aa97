"""Anchors: each window of a sequence is given the least hashed gram inside it (the leftmost of equals), so equal
windows have equal anchors wherever they start. Consecutive windows with one anchor are a run, some tens to one."""

from __future__ import annotations

import numpy as np

from loomline.llm.textops import U64

_POSITION = 26


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """The position of the least of each `width` consecutive values, the leftmost of equals (by the upper 38 bits where positions fit beside them)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    have = 1
    if len(values) < 1 << _POSITION:
        low = U64((1 << _POSITION) - 1)
        best = (values & ~low) | np.arange(len(values), dtype=U64)
        while have < width:
            step = min(have, width - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        return (best & low).astype(np.int64)
    values, best = values >> U64(_POSITION), np.arange(len(values))
    while have < width:
        step = min(have, width - have)
        a, b = best[:-step], best[step:]
        best = np.where(values[a] <= values[b], a, b)
        have += step
    return best


def runs(grams: np.ndarray, per: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, number of windows, anchor position) of each run; grams[i] hashes `gram` symbols from i, per holds the documents' offsets."""
    anchor = sliding_argmin(grams, window - gram + 1)
    length = np.diff(per)
    valid = np.zeros(len(anchor) + 1, bool)
    fits = np.flatnonzero(length >= window)
    step = np.zeros(len(anchor) + 2, np.int8)
    np.add.at(step, per[fits], 1)
    np.add.at(step, per[fits] + length[fits] - window + 1, -1)
    valid = np.cumsum(step[:-1], dtype=np.int8)[: len(anchor)] > 0
    if not valid.any():
        z = np.zeros(0, np.int64)
        return z, z, z, z
    edge = ~valid
    edge[0] = True
    edge[1:] |= anchor[1:] != anchor[:-1]
    edge[1:] |= ~valid[:-1]
    at = np.flatnonzero(edge)
    n = np.diff(np.append(at, len(anchor)))
    runs_at = valid[at]
    start = at[runs_at]
    return np.searchsorted(per, start, "right") - 1, start, n[runs_at], anchor[start]
