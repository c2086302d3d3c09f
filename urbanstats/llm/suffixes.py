"""Suffix arrays by linear grouping, after Baier (2016).

The group of a suffix is its longest Lyndon prefix: the suffix up to the next one that
is smaller. Groups stand in the order of these words, and within a group suffixes stand
in the order of what follows the word, which starts in a lower group. So once the groups
are known, each group's order is emitted from those below it; no text is renamed.

The work is done side by side for many short texts in one array: the pointers to smaller
suffixes for one character of every text at a time, and the emission for all groups
whose lower groups are done.
"""

import numpy as np


def join_texts(texts):
    """One array of bytes, each text ended by 0; the places where texts start and end.

    The texts' own bytes must not be 0.
    """
    raw = np.frombuffer(b"".join(t + b"\0" for t in texts) + bytes(16), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    return raw, ends - lengths, ends


def _eights(raw):
    """For every place the eight bytes from there as one number, first byte highest."""
    n = len(raw) - 8
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out |= raw[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def next_smaller(raw, eights, starts, ends):
    """For every suffix the place of the next smaller one of the same text.

    From the right end of all texts at once: what follows a character is either smaller,
    or part of its Lyndon word, and then the end of that part's own word is next. The
    0 at the end of a text is smaller than all in it.
    """
    out = np.zeros(len(raw), np.int64)
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    lengths = ends - starts
    for t in range(1, int(lengths.max(initial=0)) + 1):
        here = ends[: np.searchsorted(-lengths, -t, side="right")] - t
        after = here + 1
        out[here] = after
        left = np.flatnonzero(raw[after] >= raw[here])
        while len(left):
            i, j = here[left], out[here[left]]
            larger = raw[j] > raw[i]
            tie = np.flatnonzero(raw[j] == raw[i])
            # Equal first characters: compare eight at a time; the 0 ends it.
            a, b = i[tie], j[tie]
            while len(tie):
                x, y = eights[a], eights[b]
                larger[tie[y > x]] = True
                same = x == y
                tie, a, b = tie[same], a[same] + 8, b[same] + 8
            left, j = left[larger], j[larger]
            out[here[left]] = out[j]
    return out


def lyndon_groups(eights, places, smaller):
    """Number of the group of each place: the rank of its Lyndon word; and the order.

    Words are compared eight characters at a time; those that are alike so far and go on
    are compared further.
    """
    lengths = smaller[places] - places
    order, new = np.arange(len(places)), np.zeros(len(places), bool)
    new[:1] = True
    # Where in ``order`` words are compared further, and which group they are in so far.
    at, group, depth = np.arange(len(places)), np.zeros(len(places), np.int64), 0
    while len(at):
        who = order[at]
        rest = np.minimum(lengths[who] - depth, 8)
        shift = (8 * np.maximum(8 - rest, 1)).astype(np.uint64)
        key = eights[np.minimum(places[who] + depth, len(eights) - 1)]
        # Less than eight characters: the others as 0, which comes first.
        key = np.where(rest == 8, key, np.where(rest > 0, key >> shift << shift, 0))
        inner = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, group))
        order[at] = who[inner]
        key, group = key[inner], group[inner]
        cut = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        new[at] |= cut
        first = np.flatnonzero(cut)
        size = np.diff(np.r_[first, len(at)])
        depth += 8
        group = np.repeat(np.arange(len(first)), size)
        on = (np.repeat(size, size) > 1) & (lengths[order[at]] >= depth)
        # Words that all end here are one group; nothing is left to compare.
        on &= np.repeat(np.maximum.reduceat(lengths[order[at]], first), size) > depth
        at, group = at[on], group[on]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order, np.flatnonzero(new)


def emit_order(places, smaller, number, order, first, n):
    """The suffixes in order: each group from the order of what follows its word.

    ``first`` is where each group starts. A word that repeats is followed by its own
    group: fewer repeats come first, as what follows them is lower. Suffixes that are
    equal to the ends of their texts keep an arbitrary order.
    """
    group_at = np.full(n, -1, np.int64)
    group_at[places] = number
    size = np.diff(np.r_[first, len(order)])
    exit_, repeats = smaller[places], np.zeros(len(places), np.int64)
    again = np.flatnonzero(group_at[exit_] == number)
    while len(again):
        repeats[again] += 1
        exit_[again] = smaller[exit_[again]]
        again = again[group_at[exit_[again]] == number[again]]
    rank = np.full(n, -1, np.int64)  # the ends of texts are lowest
    alone = size[number] == 1
    rank[places[alone]] = first[number[alone]]
    below = group_at[exit_]
    waits = (below >= 0) & (size[below] > 1) & ~alone
    waiting = np.bincount(number[waits], minlength=len(first))
    sources = np.flatnonzero(waits)
    sources = sources[np.argsort(below[sources], kind="stable")]
    bound = np.searchsorted(below[sources], np.arange(len(first) + 1))
    ready = np.flatnonzero((waiting == 0) & (size > 1))
    while len(ready):
        who = order[_ranges(first[ready], size[ready])]
        inner = np.lexsort((rank[exit_[who]], repeats[who], number[who]))
        rank[places[who[inner]]] = _ranges(first[ready], size[ready])
        told = sources[_ranges(bound[ready], bound[ready + 1] - bound[ready])]
        groups, counts = np.unique(number[told], return_counts=True)
        waiting[groups] -= counts
        ready = groups[waiting[groups] == 0]
    array = np.empty(len(places), np.int64)
    array[rank[places]] = places
    return array


def _ranges(starts, counts):
    """start, start + 1, ... for each start, as often as its count says."""
    ends = np.cumsum(counts)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)


def suffix_array(texts):
    """Places of all suffixes of the texts in order; the joined text and where each starts."""
    raw, starts, ends = join_texts(texts)
    eights = _eights(raw)
    smaller = next_smaller(raw, eights, starts, ends)
    places = np.flatnonzero(raw[:-16])
    if not len(places):
        return places, raw, starts
    number, order, first = lyndon_groups(eights, places, smaller)
    return emit_order(places, smaller, number, order, first, len(raw)), raw, starts
