"""Suffix arrays of a task's texts by induced sorting, and their permuted common prefixes."""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size, those of bytes, are induced bucket by bucket, larger ones (of reduced texts) by ranges of buckets.
SMALL_ALPHABET = 257


def _run_ends(text: np.ndarray) -> np.ndarray:
    """For each position the last one of its run of equal symbols."""
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    return np.repeat(ends, np.diff(ends, prepend=-1))


def _types(text: np.ndarray, run_ends: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last is larger than the empty one."""
    smaller = np.zeros(len(text), bool)
    inside = run_ends < len(text) - 1
    ends = run_ends[inside]
    smaller[inside] = text[ends] < text[ends + 1]
    return smaller


def _deal(queues: list[list[np.ndarray]], symbols: np.ndarray, entries: np.ndarray) -> None:
    """Append the entries to the queues of their symbols, in order."""
    order = np.argsort(symbols, kind="stable")
    symbols, entries = symbols[order], entries[order]
    cuts = np.flatnonzero(np.diff(symbols)) + 1
    for part, symbol in zip(np.split(entries, cuts), symbols[np.concatenate([[0], cuts])]):
        queues[symbol].append(part)


def _induce_arrays(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones in order, a bucket at a time."""
    none = np.zeros(0, np.int64)
    seed_queues: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    if len(seeds):
        _deal(seed_queues, text[seeds], seeds)
    larger_queues: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    larger_queues[text[-1]].append(np.array([len(text) - 1]))  # before the empty suffix
    larger: list[np.ndarray] = []
    for c in range(alphabet):
        whole = []
        part = np.concatenate(larger_queues[c]) if larger_queues[c] else none
        while len(part):
            whole.append(part)
            before = part[part > 0] - 1
            before = before[~smaller[before]]
            symbols = text[before]
            same = symbols == c
            if not same.all():
                _deal(larger_queues, symbols[~same], before[~same])
            part = before[same]
        for seed in seed_queues[c]:
            before = seed - 1
            if len(before):
                _deal(larger_queues, text[before], before)
        larger.append(np.concatenate(whole) if whole else none)
    smaller_queues: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    out: list[np.ndarray] = []
    for c in range(alphabet - 1, -1, -1):
        whole = []
        part = np.concatenate(smaller_queues[c]) if smaller_queues[c] else none
        while len(part):
            whole.append(part)
            before = part[part > 0] - 1
            before = before[smaller[before]]
            symbols = text[before]
            same = symbols == c
            if not same.all():
                _deal(smaller_queues, symbols[~same], before[~same])
            part = before[same]
        part = larger[c][::-1]
        before = part[part > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _deal(smaller_queues, text[before], before)
        if whole:
            out.append(np.concatenate(whole))
        out.append(part)
    return np.concatenate(out)[::-1]


def _ranges(need: np.ndarray) -> list[int]:
    """Borders of ranges of buckets, upwards from 0, none of which holds a bucket that another one of it needs."""
    borders, low = [0], 0
    for bucket, needed in enumerate(need.tolist()):
        if needed >= low:  # a needed bucket lies before the one that needs it
            borders.append(bucket)
            low = bucket
    return [*borders, len(need)]


def _induce_ranges(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """The same for alphabets about as large as the text, by ranges of buckets.

    Suffixes of a bucket stand in the order of their runs of equal symbols and
    of the suffixes behind these. Buckets whose suffixes need no bucket of the
    same range are dealt at once, about sqrt(alphabet) ranges in usual texts
    (one for each bucket at worst).
    """
    n = len(text)
    run_ends = _run_ends(text)
    sizes = np.bincount(text, minlength=alphabet)
    begin = np.cumsum(sizes) - sizes
    begin_smaller = begin + np.bincount(text[~smaller], minlength=alphabet)
    rank = np.full(n + 1, -1, np.int64)  # the empty suffix comes first
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    symbols = text[seeds]
    rank[seeds] = begin_smaller[symbols] + np.arange(len(seeds)) - np.searchsorted(symbols, symbols)
    for upwards in (True, False):
        own = np.flatnonzero(smaller != upwards)
        run = run_ends[own] - own  # short ones come first among the larger, last among the smaller
        code = text[own] * (n + 1) + (run if upwards else n - run)
        order = np.argsort(code, kind="stable")
        own, code = own[order], code[order]
        symbols, behind = text[own], run_ends[own] + 1
        cuts = np.searchsorted(symbols, np.arange(alphabet + 1))
        place = (begin if upwards else begin_smaller)[symbols] - cuts[symbols] + np.arange(len(own))
        code = np.cumsum(np.diff(code, prepend=code[:1]) != 0) * (n + 1)
        waits = behind < n
        waits[waits] = smaller[behind[waits]] != upwards  # placed in this pass, too
        if upwards:
            need = np.full(alphabet, -1)
            np.maximum.at(need, symbols[waits], text[behind[waits]])
            borders = _ranges(need)
        else:
            need = np.full(alphabet, -1)
            np.maximum.at(need, alphabet - 1 - symbols[waits], alphabet - 1 - text[behind[waits]])
            borders = [alphabet - b for b in _ranges(need)]
        edges = cuts[borders].tolist()
        for low, high in zip(edges[:-1], edges[1:]):
            low, high = min(low, high), max(low, high)
            if low < high:
                at = np.argsort(code[low:high] + rank[behind[low:high]])
                rank[own[low:high][at]] = place[low:high]
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Positions of all suffixes of `text` (integers below `alphabet`) in lexicographic order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    induce = _induce_arrays if alphabet <= SMALL_ALPHABET else _induce_ranges
    smaller = _types(text, _run_ends(text))
    marks = np.zeros(n, bool)
    marks[1:] = smaller[1:] & ~smaller[:-1]
    leftmost = np.flatnonzero(marks)
    if len(leftmost) < 2:
        return induce(text, smaller, leftmost, alphabet)
    # Sort the leftmost-smaller substrings by one induction and name them; equal ones share a name.
    order = induce(text, smaller, leftmost, alphabet)
    order = order[marks[order]]
    number = np.full(n, -1)
    number[leftmost] = np.arange(len(leftmost))
    ends = np.append(leftmost[1:] + 1, n)
    lengths = ends - leftmost
    a, b = number[order[:-1]], number[order[1:]]
    same = (lengths[a] == lengths[b]) & (ends[a] < n) & (ends[b] < n)
    reach, active = 0, np.flatnonzero(same)
    while len(active):
        x, y = leftmost[a[active]] + reach, leftmost[b[active]] + reach
        equal = text[x] == text[y]
        same[active[~equal]] = False
        reach += 1
        active = active[equal & (lengths[a[active]] > reach)]
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 < len(leftmost):
        reduced = np.empty(len(leftmost), np.int64)
        reduced[number[order]] = names
        order = leftmost[suffix_array(reduced, int(names[-1]) + 1)]
    return induce(text, smaller, order, alphabet)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position the symbols its suffix shares with the one before it in `order`, up to `room` symbols.

    Only positions whose value does not follow from the one before are
    compared; elsewhere it is one less.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    fresh = np.ones(n, bool)
    i = np.arange(1, n)
    known = (before[1:] > 0) & (before[:-1] >= 0)
    i = i[known]
    fresh[i] = (text[i - 1] != text[before[i] - 1]) | (before[i - 1] != before[i] - 1) | (room[i - 1] != room[i] + 1)
    places = np.flatnonzero(fresh & (before >= 0))
    shared = np.zeros(n, np.int64)
    active, reach = places, 0
    while len(active):
        other = before[active] + reach
        own = active + reach
        fits = (room[active] > reach) & (other < n) & (own < n)
        active, other, own = active[fits], other[fits], own[fits]
        equal = text[own] == text[other]
        active = active[equal]
        reach += 1
        shared[active] = reach
    base = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return np.maximum(shared[base] - (np.arange(n) - base), 0)
