"""Suffix arrays by induced sorting, in numpy, and common prefixes from them.

Suffixes are S or L as they are smaller or larger than the next one; an S
suffix after an L is leftmost-smaller. Substrings between leftmost-smaller
places are sorted by inducing, named, and sorted as a string of names, one name
split into two digits where names are many, so that every level has few
buckets; a string of fewer than ``INDUCED`` names ends the recursion and is
sorted by doubling. A last induction orders all suffixes. Inducing goes bucket by bucket:
what a bucket holds induces in one vector step, and again as long as it adds to
itself, so time is linear with few steps.
"""

from __future__ import annotations

import numpy as np

#: Names up to which a level is sorted as it is.
FEW_NAMES = 512
#: Length of a string of names from which on it is sorted by induction; steps of
#: a shorter one would be too small to be worth a bucket each.
INDUCED = 1 << 17


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text`` (integers of at least 1)."""
    if not len(text):
        return np.zeros(0, np.int64)
    return _sorted(np.append(text, 0).astype(np.int32))[1:]


def _sorted(t: np.ndarray) -> np.ndarray:
    """Suffix array of ``t``, which ends with its only 0."""
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    ends = np.flatnonzero(t[1:] != t[:-1])
    small = np.ones(n, bool)
    small[:-1] = np.repeat(t[ends] < t[ends + 1], np.diff(ends, prepend=-1))
    least = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    order = _induce(t, small, least[np.argsort(t[least], kind="stable")])
    if len(least) > 1:
        place = np.full(n, -1, np.int32)
        place[least] = np.arange(len(least), dtype=np.int32)
        first = place[order]
        first = first[first >= 0]  # leftmost-smaller substrings in order
        names = np.empty(len(least), np.int32)
        names[first] = np.cumsum(np.concatenate([[0], _differ(t, least, first)]))
        by = first if names.max() + 1 == len(names) else _by_names(names)
        order = _induce(t, small, least[by])
    return order


def _differ(t: np.ndarray, least: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each substring, in order, differs from the one before."""
    length = np.diff(least, append=least[-1])
    a, b = least[order[1:]], least[order[:-1]]
    steps = length[order[1:]]
    out = steps != length[order[:-1]]
    at = np.flatnonzero(~out)
    offset = 0
    while len(at):
        same = t[a[at] + offset] == t[b[at] + offset]
        out[at[~same]] = True
        at = at[same & (offset < steps[at])]
        offset += 1
    return out


def _by_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names that ends with its only 0."""
    most = int(names.max()) + 1
    if len(names) < INDUCED:
        return _by_doubling(names)
    if most <= FEW_NAMES:
        return _sorted(names)
    base = int(np.ceil(np.sqrt(most)))
    digits = np.zeros(2 * len(names) - 1, np.int32)
    digits[:-1:2] = names[:-1] // base + 1
    digits[1::2] = names[:-1] % base + 1
    order = _sorted(digits)[1:]
    return np.concatenate([np.array([len(names) - 1], np.int32), order[order & 1 == 0] >> 1])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """The same order, by ranks of 1, 2, 4, ... names until all differ."""
    n, width = len(names), 1
    rank = names.astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
        if rank[order[-1]] == n - 1:
            return order.astype(np.int32)
        width *= 2


def _induce(t: np.ndarray, small: np.ndarray, least: np.ndarray) -> np.ndarray:
    """All suffixes from leftmost-smaller ones, which come in order of their
    first letter: L from the front, then S from the back."""
    n = len(t)
    counts = np.bincount(t)
    ends = np.cumsum(counts)
    starts = ends - counts
    large = np.bincount(t[~small], minlength=len(counts))
    seeds = np.bincount(t[least], minlength=len(counts))
    out = np.empty(n, np.int32)
    letters = t[least]
    out[ends[letters] - seeds[letters] + np.arange(len(least)) - (np.cumsum(seeds) - seeds)[letters]] = least
    buckets = np.flatnonzero(counts).tolist()
    heads, tails = starts.copy(), ends.copy()
    tails[0] = 0  # the end of the text, placed already
    # What each place induces: the letter before it where that suffix is L (S),
    # or -1. One lookup for a place instead of two.
    narrow = np.int16 if len(counts) < 32768 else np.int32
    behind = np.empty(n, narrow)
    behind[0] = -1

    def push(found: np.ndarray, at: np.ndarray, way: int) -> None:
        letter = behind[found]
        keep = letter >= 0
        letter, before = letter[keep], found[keep] - 1
        if not len(before):
            return
        sizes = np.bincount(letter)
        used = np.flatnonzero(sizes)
        if len(used) > 1:
            by = np.argsort(letter, kind="stable")
            before = before[by]
        sizes = sizes[used]
        if len(used) < 16:
            done = 0
            for c, k in zip(used.tolist(), sizes.tolist(), strict=True):
                if way > 0:
                    out[at[c] : at[c] + k] = before[done : done + k]
                else:
                    out[at[c] - k : at[c]] = before[done : done + k][::-1]
                done += k
        else:
            rank = np.arange(len(before)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out[np.repeat(at[used], sizes) + rank if way > 0 else np.repeat(at[used] - 1, sizes) - rank] = before
        at[used] += way * sizes

    behind[1:] = np.where(small[:-1], -1, t[:-1])
    for c in buckets:
        at = starts[c]
        while at < heads[c]:
            at, found = heads[c], out[at : heads[c]].copy()
            push(found, heads, 1)
        if seeds[c]:
            push(out[ends[c] - seeds[c] : ends[c]], heads, 1)
    behind[1:] = np.where(small[:-1], t[:-1], -1)
    for c in reversed(buckets):
        at = ends[c]
        while at > tails[c] and c:
            at, found = tails[c], out[tails[c] : at][::-1].copy()
            push(found, tails, -1)
        if large[c]:
            push(out[starts[c] : starts[c] + large[c]][::-1].copy(), tails, -1)
    return out


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of ``text``, the length of the prefix that its suffix
    shares with the one before it in ``order`` (the first: 0).

    Where both are preceded by the same letter, the value is one less than that
    of the place before; only the other places are compared."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int32)
    before = np.empty(n, np.int32)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    padded = np.zeros(n + 8, np.uint16)
    padded[:n] = text
    words = np.empty(n + 4, np.uint64)  # four letters from each place on
    for shift in range(4):
        part = np.frombuffer(padded, np.uint64, (n + 8 - shift) // 4, 2 * shift)
        words[shift::4] = part[: len(words[shift::4])]
    fresh = np.ones(n, bool)
    some = np.flatnonzero(before[1:] > 0) + 1
    fresh[some] = text[some - 1] != text[before[some] - 1]
    at = np.flatnonzero(fresh & (before >= 0))
    done = np.zeros(n, np.int32)
    while len(at):
        differ = words[at + done[at]] ^ words[before[at] + done[at]]
        whole = differ == 0
        part = differ[~whole]
        done[at[~whole]] += (
            (part & np.uint64(0xFFFF) == 0).astype(np.int32)
            + (part & np.uint64(0xFFFFFFFF) == 0)
            + (part & np.uint64(0xFFFFFFFFFFFF) == 0)
        )
        at = at[whole]
        done[at] += 4
    places = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(fresh, places, 0))
    return np.maximum(done[last] - (places - last), 0)
