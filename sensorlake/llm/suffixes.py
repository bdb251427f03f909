"""Suffix arrays to a fixed depth, in numpy.

Larsson and Sadakane's refinement: suffixes are grouped by their first bytes; each round sorts the
members of every group of more than one by the group of the suffix further on, and so doubles the
depth. Common prefixes follow Kasai's walk: the one of a suffix is at least that of the suffix before
it, less one. The walk runs in many lanes at once, each over its own part of the text.
"""

from __future__ import annotations

import numpy as np

_LANES = 1 << 14


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian number; zeros follow the end."""
    at = np.zeros(len(data) + 8, np.uint64)
    at[: len(data)] = data
    for step in (1, 2, 4):
        at[: len(at) - step] = (at[: len(at) - step] << np.uint64(8 * step)) | at[step:]
    return at[: len(data)]


def _sorted_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where each run of equal ones begins in it, and how long the run is."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = sorted_[1:] != sorted_[:-1]
    begin = np.flatnonzero(fresh)
    return order, begin, np.diff(np.append(begin, len(keys)))


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The places in the order of their first `depth` bytes (at least 8), and their packed bytes.

    Places that agree to that depth stand in no particular order.
    """
    eight = packed(data)
    total = len(data)
    order, begin, size = _sorted_groups(eight)
    rank = np.empty(total + 1, np.int64)
    rank[total] = -1  # beyond the end
    rank[order] = np.repeat(begin, size)
    open_ = np.repeat(size > 1, size)  # by place in `order`: groups of several
    at = np.flatnonzero(open_)
    known = 8
    while known < depth and len(at):
        step = min(known, depth - known)
        members = order[at]
        # A group's number is the place of its first member, so groups stay where they are.
        keys = rank[members] * (total + 1) + rank[np.minimum(members + step, total)] + 1
        sub, begin, size = _sorted_groups(keys)
        order[at] = members[sub]
        rank[order[at]] = np.repeat(at[begin], size)
        at = at[np.repeat(size > 1, size)]
        known += step
    return order, eight


def common_prefixes(order: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """For each place in `order` how many bytes, up to `depth`, it shares with the one before."""
    total = len(order)
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.full(total, -1)
    before[order[1:]] = order[:-1]
    rank = np.full(total + 1, -1)
    rank[order] = np.arange(total)
    shared = np.zeros(total, np.int64)
    lane = max(-(-total // _LANES), 1)
    starts = np.arange(0, total, lane)
    length = np.zeros(len(starts), np.int64)
    other = np.full(len(starts), -1)
    padded = np.append(eight, np.zeros(depth + 8, np.uint64))
    for step in range(lane):
        here = starts + step
        here = here[here < total]
        length = length[: len(here)]
        # Suffixes that agree to the full depth are in no order further on, so what follows the one before
        # may not come before what follows this one.
        follows = (length < depth) | (rank[other[: len(here)] + 1] < rank[here])
        length = np.where(follows, np.maximum(length - 1, 0), 0)
        other = before[here]
        length[other < 0] = 0
        active = np.flatnonzero((other >= 0) & (length < depth))
        while len(active):
            reach = length[active]
            differ = padded[here[active] + reach] ^ padded[other[active] + reach]
            # The highest bit as a float's exponent; the next one is cleared, so that it is not rounded up.
            high = (differ & ~(differ >> np.uint64(1))).astype(np.float64).view(np.int64) >> 52
            length[active] = reach + np.where(differ == 0, 8, (1023 + 63 - high) >> 3)
            active = active[(differ == 0) & (reach + 8 < depth)]
        length = np.minimum(length, depth)
        # Beyond the end there are only the zeros of the padding.
        length = np.minimum(length, total - np.maximum(here, other))
        shared[here] = length
    return shared[order]
