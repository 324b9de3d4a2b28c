"""Suffix arrays of many short texts at once, by linear grouping construction.

The suffixes of a text are first grouped by their Lyndon prefix (the longest prefix that is a Lyndon word), then each
group's order is emitted.

* Grouping: groups start as the suffixes with the same first symbol and are processed from the highest down. For each
  suffix of the group at hand the nearest place to its left whose group is still lower is its previous-smaller pointer.
  The Lyndon prefixes of the suffixes pointed at grow by the prefix of the group: those pointed at by the same number
  of its members leave their group together for a new one that ranks right above it, more pointers ranking higher.
* Emitting: from the lowest suffix up, the suffix before each emitted one, and what its pointers lead to until a place
  that is already emitted, take the next free place of their group.

No names are sorted again and nothing is recursive. All short texts of a batch take a step together, so that a step is
a few array operations over as many texts as still have groups; texts never look at each other. Texts longer than
``LONG`` symbols, of which there are few, take the same steps one after the other.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np

#: Symbols from which a text is handled alone: a step for all texts of a batch costs as much as some of its own.
LONG = 400


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, in a row."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def lyndon_groups(symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the first slot of its group in the order of its text, and its previous-smaller pointer or -1."""
    n, lengths = len(symbols), np.diff(begins)
    text = np.repeat(np.arange(len(lengths)), lengths)
    low = begins[:-1][text]
    order = np.lexsort((symbols, text))
    firsts = _runs(text[order], symbols[order])
    sizes = np.diff(np.append(firsts, n))
    group, slot, size, start_of = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64), np.empty(n, np.int64)
    group[order] = np.repeat(firsts, sizes)
    slot[order] = np.arange(n)
    size[firsts] = sizes
    start_of[firsts + sizes - 1] = firsts
    before = np.full(n, -1, np.int64)
    moving = np.zeros(n, bool)
    ends = begins[1:][lengths > 0] - 1
    borders = begins[:-1][lengths > 0]
    while len(ends):
        at = start_of[ends]
        members = order[_spread(at, ends - at + 1)]
        # Nearest place to the left in a lower group: done places lead on by their pointers, the group's own by one.
        here, limit, own = members - 1, low[members], group[members]
        open_rows = np.arange(len(members))
        while len(open_rows):
            j = here[open_rows]
            inside = j >= limit[open_rows]
            open_rows, j = open_rows[inside], j[inside]
            higher = group[j] >= own[open_rows]
            open_rows, j = open_rows[higher], j[higher]
            here[open_rows] = np.where(group[j] == own[open_rows], j - 1, before[j])
        here[here < limit] = -1
        before[members] = here
        places, counts = np.unique(here[here >= 0], return_counts=True)
        if len(places):
            old = group[places]
            by = np.lexsort((counts, old))
            places, counts, old = places[by], counts[by], old[by]
            # Movers fill the last slots of their group, those with more pointers further up.
            heads = _runs(old)
            many = np.diff(np.append(heads, len(old)))
            groups = old[heads]
            slots = _spread(groups + size[groups] - many, many)
            moving[places] = True
            leave = slot[places]
            vacated = leave[leave < np.repeat(groups + size[groups] - many, many)]
            there = order[slots]
            pushed = there[~moving[there]]
            moving[places] = False
            order[vacated], slot[pushed] = pushed, vacated
            order[slots], slot[places] = places, slots
            size[groups] -= many
            rest = groups[size[groups] > 0]
            start_of[rest + size[rest] - 1] = rest
            parts = _runs(old, counts)
            held = np.diff(np.append(parts, len(old)))
            news = slots[parts]
            group[places] = np.repeat(news, held)
            size[news] = held
            start_of[news + held - 1] = news
        more = at > borders
        ends, borders = at[more] - 1, borders[more]
    return group, before


def _one_order(symbols: list[int]) -> list[int]:
    """The order of the suffixes of one text, by the same steps."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    group, slot, before, size, start_of = [0] * n, [0] * n, [-1] * n, [0] * n, [0] * n
    for at, i in enumerate(order):
        slot[i] = at
        group[i] = group[order[at - 1]] if at and symbols[order[at - 1]] == symbols[i] else at
        size[group[i]] += 1
        start_of[at] = group[i]
    end = n - 1
    while end >= 0:
        at = start_of[end]
        pointed: dict[int, int] = {}
        for i in sorted(order[at : end + 1]):
            j = i - 1
            while j >= 0 and group[j] >= at:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        # Groups are read before any changes.
        moves = sorted((group[p], count, p) for p, count in pointed.items())
        for old, rows in groupby(moves, key=lambda x: x[0]):
            movers = list(rows)
            stop = old + size[old]
            base = stop - len(movers)
            going = {p for _, _, p in movers}
            pushed = [x for x in order[base:stop] if x not in going]
            for to, x in zip([slot[p] for p in going if slot[p] < base], pushed, strict=True):
                order[to], slot[x] = x, to
            size[old] -= len(movers)
            if size[old]:
                start_of[base - 1] = old
            last, head = None, base
            for to, (_, count, p) in enumerate(movers, base):
                order[to], slot[p] = p, to
                if count != last:
                    last, head = count, to
                    size[head] = 0
                group[p] = head
                size[head] += 1
                start_of[to] = head
        end = at - 1
    out, free, done = [0] * n, list(range(n)), [False] * n
    out[0], done[n - 1] = n - 1, True
    for rank in range(n):
        j = out[rank] - 1
        while j >= 0 and not done[j]:
            out[free[group[j]]] = j
            free[group[j]] += 1
            done[j] = True
            j = before[j]
    return out


def suffix_orders(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The places of each text in the order of the suffixes that start there.

    ``symbols`` holds all texts in a row, text t from ``begins[t]`` to ``begins[t + 1]``. The last symbol of each text
    must be smaller than all its others. The result has the places of text t in the same range.
    """
    lengths = np.diff(begins)
    long = np.flatnonzero(lengths > LONG)
    if len(long):
        out = np.empty(len(symbols), np.int64)
        for t in long:
            low, high = begins[t], begins[t + 1]
            out[low:high] = np.array(_one_order(symbols[low:high].tolist())) + low
        short = np.flatnonzero(lengths <= LONG)
        places = _spread(begins[short], lengths[short])
        packed = np.concatenate([[0], np.cumsum(lengths[short])])
        inner = suffix_orders(symbols[places], packed)
        # Places of the packed texts are moved back to where the texts begin.
        shift = np.repeat(begins[short] - packed[:-1], lengths[short])
        out[places] = inner + shift
        return out
    group, before = lyndon_groups(symbols, begins)
    out = np.full(len(symbols), -1, np.int64)
    free = np.arange(len(symbols))
    done = np.zeros(len(symbols), bool)
    texts = np.argsort(-lengths, kind="stable")
    texts = texts[lengths[texts] > 0]
    lasts = begins[texts + 1] - 1
    out[begins[texts]] = lasts
    done[lasts] = True
    descending = -lengths[texts]
    for rank in range(int(lengths.max(initial=0))):
        texts = texts[: np.searchsorted(descending[: len(texts)], -rank)]
        low = begins[texts]
        j = out[low + rank] - 1
        j = j[j >= low]
        while len(j):
            j = j[~done[j]]
            to = free[group[j]]
            out[to] = j
            free[group[j]] = to + 1
            done[j] = True
            j = before[j]
            j = j[j >= 0]
    return out
