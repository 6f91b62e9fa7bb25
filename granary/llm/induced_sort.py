"""Suffix array and common prefixes by external induced sorting (after Bingmann, Fischer and Osipov, 2013).

A text of symbols is a run of regions, each closed by a 0; every 0 is a symbol of its own, the earlier one the smaller. Suffixes
are of type S or L as they are before or behind the suffix after them; an S behind an L is a seed. The seeds are sorted by naming
the pieces between them and sorting the text of the names in the same way (``sorted_suffixes`` calls itself). Two sweeps then
induce all other suffixes: a suffix taken from the queue puts the one before it into the queue under that one's first symbol,
together with the prefix it shares with the one put there last. That prefix is one more than the least common prefix between the
two inducing suffixes, so common prefixes come out of the sweeps and no pair of suffixes is compared by its text.

The queue takes its keys in order and gives the entries of a key in the order they came, so a file with one area for each key is
all it needs; entries beyond ``MEMORY`` bytes lie in an unnamed file that the operating system pages, like a spill of a sort.
Neighbouring keys are taken together as far as none of them puts anything among them, which leaves few steps even where the
names are as many as the pieces.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes of one queue that stay in memory.
MEMORY = 64 << 20


def _space(size: int, memory: int) -> np.ndarray:
    """Entries of a queue: suffix and common prefix."""
    if 8 * size <= memory:
        return np.zeros((2, size), np.int32)
    with tempfile.TemporaryFile() as file:  # the name goes at once, the space when the array does
        return np.memmap(file, np.int32, "w+", shape=(2, size))


class BucketQueue:
    """A queue of ``(suffix, common prefix)`` by symbol: ``size[c]`` entries will come for symbol ``c``."""

    def __init__(self, size: np.ndarray, memory: int):
        self.first = np.concatenate(([0], np.cumsum(size)))
        self.filled = self.first[:-1].copy()
        self.suffix, self.shared = _space(int(self.first[-1]), memory)

    def push(self, keys: np.ndarray, suffix: np.ndarray, shared: np.ndarray) -> None:
        """Entries sorted by key, those of a key in their order; the first of all for a key shares nothing."""
        if not len(keys):
            return
        begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        count = np.diff(np.concatenate((begin, [len(keys)])))
        heads = keys[begin]
        place = np.repeat(self.filled[heads] - begin, count) + np.arange(len(keys))
        self.suffix[place] = suffix
        shared = np.where(place == np.repeat(self.first[heads], count), 0, shared)
        self.shared[place] = shared
        self.filled[heads] += count

    def until_now(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts and places of the entries that have come for the symbols ``low`` to before ``high``."""
        count = self.filled[low:high] - self.first[low:high]
        return count, _ranges(self.first[low:high], count)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from ``first[k]`` on, ``count[k]`` of them, one range behind the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - count), count)


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``values[low + 1 : high + 1]`` for each pair, by tables over powers of two."""
    out = np.zeros(len(low), np.int32)
    width = high - low
    level, table = 0, values
    left = width > 0
    while left.any():
        here = left & (width < (2 << level))
        if here.any():
            a, b = low[here] + 1, high[here] - (1 << level) + 1
            out[here] = np.minimum(table[a], table[b])
            left &= ~here
            if not left.any():
                break
        table = np.minimum(table[: -(1 << level)], table[1 << level :])
        level += 1
    return out


def _sweep(key: np.ndarray, takes: np.ndarray, run: np.ndarray, back: np.ndarray, seeds: np.ndarray, seed_shared: np.ndarray, symbols: int, memory: int) -> BucketQueue:
    """One sweep over the symbols ``0 .. symbols`` of ``key``, from what is before to what is behind.

    ``takes``: the suffixes to induce; ``seeds``: known suffixes in order, behind the induced ones of their symbol, with what
    each shares with the one before it; ``run``: how often a suffix repeats its first symbol.
    """
    queue = BucketQueue(np.bincount(key[takes], minlength=symbols), memory)
    seed_count = np.bincount(key[seeds], minlength=symbols)
    seed_first = np.concatenate(([0], np.cumsum(seed_count)))
    low, step = 0, 1
    while low < symbols:
        high = min(symbols, low + step)
        count, place = queue.until_now(low, high)
        known = seed_count[low:high]
        total = count + known
        if not total.any():
            low, step = high, step * 2
            continue
        # The entries of each symbol: induced ones, then seeds.
        ends = np.cumsum(total)
        size = int(ends[-1])
        induced = _ranges(ends - total, count)
        seeded = _ranges(ends - known, known)
        suffix = np.empty(size, np.int64)
        shared = np.empty(size, np.int32)
        suffix[induced], shared[induced] = queue.suffix[place], queue.shared[place]
        own = slice(int(seed_first[low]), int(seed_first[high]))
        suffix[seeded], shared[seeded] = seeds[own], seed_shared[own]
        shared[(ends - total)[total > 0]] = 0
        seam = np.flatnonzero((count > 0) & (known > 0))
        if len(seam):
            at = (ends - known)[seam]
            shared[at] = np.minimum(run[suffix[at - 1]], run[suffix[at]])
        before = suffix - 1
        pushes = (before >= 0) & takes[before]
        to = key[before]
        symbol = np.repeat(np.arange(low, high), total)
        pushes &= to >= symbol
        if high - low > 1:
            least = np.full(high - low, symbols)
            some = np.flatnonzero(total)
            least[some] = np.minimum.reduceat(np.where(pushes, to, symbols), (ends - total)[some])
            # The longest run of symbols that put nothing among themselves.
            good = int((np.minimum.accumulate(least) > np.arange(low, high)).sum())
            if good == 0:
                step = 1
                continue
            step = step * 2 if good == high - low and step < symbols else good
            size, high = int(ends[good - 1]), low + good
            suffix, shared, before, to, pushes = suffix[:size], shared[:size], before[:size], to[:size], pushes[:size]
        elif (to[pushes] == low).any():
            _repeat(queue, low, back, suffix[: int(count[0])], shared[: int(count[0])])
            count, place = queue.until_now(low, high)
            n = int(count[0])
            mine, with_ = queue.suffix[place], queue.shared[place]
            tail_suffix, tail_shared = suffix[size - int(known[0]) :], shared[size - int(known[0]) :].copy()
            if len(tail_suffix):
                tail_shared[0] = min(int(run[mine[-1]]), int(run[tail_suffix[0]])) if n else 0
            suffix, shared = np.concatenate((mine, tail_suffix)).astype(np.int64), np.concatenate((with_, tail_shared))
            before = suffix - 1
            to = key[before]
            pushes = (before >= 0) & takes[before] & (to > low)
            step = 2
        else:
            step = 2
        _push(queue, np.flatnonzero(pushes), before, to, shared)
        low = high
    return queue


def _push(queue: BucketQueue, rows: np.ndarray, before: np.ndarray, to: np.ndarray, shared: np.ndarray) -> None:
    """Put the suffixes before the ``rows`` of a batch into the queue."""
    if not len(rows):
        return
    rows = rows[np.argsort(to[rows], kind="stable")]
    keys = to[rows]
    between = np.zeros(len(rows), np.int32)
    same = np.flatnonzero(keys[1:] == keys[:-1]) + 1
    # Where the batch goes over to another symbol nothing is shared, so the least between the two is 0 there.
    between[same] = _least_between(shared, rows[same - 1], rows[same])
    queue.push(keys, before[rows].astype(np.int32), between + 1)


def _repeat(queue: BucketQueue, symbol: int, back: np.ndarray, suffix: np.ndarray, shared: np.ndarray) -> None:
    """Suffixes of one symbol that put further ones under the same symbol: the runs of that symbol, all at once.

    The g-th suffixes of the runs come after the (g - 1)-th, in the order of ``suffix``, those whose run is as long. Two neighbours
    among them share g symbols more than the suffixes they come from; the first one and the one before it share g symbols.
    """
    left = back[suffix]
    row = np.repeat(np.arange(len(suffix)), left)
    step = _ranges(np.ones(len(suffix), np.int64), left)
    order = np.argsort(step, kind="stable")
    row, step = row[order], step[order]
    between = np.zeros(len(row), np.int32)
    same = np.flatnonzero(step[1:] == step[:-1]) + 1
    between[same] = _least_between(shared, row[same - 1], row[same])
    queue.push(np.full(len(row), symbol), (suffix[row] - step).astype(np.int32), between + step)


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which suffixes are of type S, how often each repeats its first symbol, and how often that symbol stands before it."""
    n = len(text)
    change = np.flatnonzero(np.concatenate((text[1:] != text[:-1], [True])))
    lengths = np.diff(np.concatenate(([-1], change)))
    last = np.repeat(change, lengths)  # where the run of each place ends
    small = np.zeros(n, bool)
    inner = last < n - 1
    small[inner] = text[last[inner]] < text[last[inner] + 1]
    small |= text == 0
    run = last - np.arange(n) + 1
    return small, run.astype(np.int32), (np.repeat(lengths, lengths) - run).astype(np.int32)


def _names(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> tuple[np.ndarray, bool]:
    """A number for the piece from each seed to the next, in the order of the pieces, and how many there are, each 0 for itself.

    A piece is compared by symbol and type, some symbols in one number at a time; only pieces that are still equal go on.
    """
    bits = (2 * symbols + 1).bit_length()
    per = max(1, 63 // bits)
    signs = text.astype(np.int64) * 2 + small + 1
    ends = np.append(seeds[1:], seeds[-1] + 1)
    ends[text[seeds] == 0] = seeds[text[seeds] == 0]  # a closing 0 stands for itself
    name = np.zeros(len(seeds), np.int64)
    open_ = np.arange(len(seeds))
    done = 0
    while len(open_):
        chunk = np.zeros(len(open_), np.int64)
        for k in range(done, done + per):
            at = seeds[open_] + k
            inside = at <= ends[open_]
            chunk = (chunk << bits) | np.where(inside, signs[np.minimum(at, len(text) - 1)], 0)
        done += per
        order = np.lexsort((chunk, name[open_]))
        a, b = name[open_][order], chunk[order]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        begin = np.concatenate(([True], a[1:] != a[:-1]))
        # A new name is the old one and the number of rows before it under that name, so names stay in order.
        place = np.arange(len(a))
        offset = np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(begin, place, 0))
        name[open_[order]] = a + offset
        group = np.cumsum(fresh) - 1
        more = (np.bincount(group)[group] > 1) & (seeds[open_[order]] + done <= ends[open_[order]])
        open_ = np.sort(open_[order][more])
    _, dense = np.unique(name, return_inverse=True)
    return dense.astype(np.int64), int(dense.max()) + max(1, int((text[seeds] == 0).sum()))


def sorted_suffixes(text: np.ndarray, symbols: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes of ``text`` in order, and what each shares with the one before it (a 0 is shared by none).

    ``text`` ends with 0; ``symbols`` is more than its largest symbol.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    small, run, back = _types(text)
    run[text == 0] = 0
    seeds = np.flatnonzero((small & np.concatenate(([False], ~small[:-1]))) | (text == 0))
    # Order the seeds: by their names, or by the order of the text of the names.
    name, kinds = _names(text, small, seeds, symbols)
    if 4 * kinds >= 3 * len(name):
        order, names_shared = _mostly_different(name)
    else:
        order, names_shared = sorted_suffixes(name, int(name.max()) + 1, memory)
    ordered = seeds[order]
    seed_shared = np.zeros(len(seeds), np.int32)
    if len(seeds) > 1:
        # Equal names stand for as many symbols as lie between their seeds; behind them one piece decides.
        seed_shared[1:] = _shared(text, seeds, order, names_shared)
    large = ~small
    up = _sweep(text, large, run, back, ordered, seed_shared, symbols, memory)
    # The way down is the way up with the symbols turned round; the induced L, turned round as well, are its seeds.
    turned = symbols - 1 - text
    large_order = up.suffix[::-1].astype(np.int64)
    large_shared = np.zeros(len(large_order), np.int32)
    large_shared[1:] = up.shared[:0:-1]
    takes = small & (text > 0)
    zeros = np.flatnonzero(text == 0)
    down = _sweep(turned, takes, run, back, large_order, large_shared, symbols, memory)
    # Of each symbol the L, then the S from least to greatest.
    suffix = np.empty(n, np.int64)
    shared = np.zeros(n, np.int32)
    count_l, count_s = np.diff(up.first), np.diff(down.first)[::-1]
    count_s[0] = len(zeros)
    ends = np.cumsum(count_l + count_s)
    of_l, of_s = _ranges(ends - count_l - count_s, count_l), _ranges(ends - count_s, count_s)
    suffix[of_l], shared[of_l] = up.suffix, up.shared
    of_s = of_s[len(zeros) :]
    suffix[: len(zeros)] = zeros
    suffix[of_s] = down.suffix[::-1]
    backward = np.zeros(len(of_s), np.int32)
    if len(of_s):
        backward[1:] = down.shared[:0:-1]  # what an entry of the way down shares with the one before it there, behind it here
    shared[of_s] = backward
    seam = np.flatnonzero((count_l > 0) & (count_s > 0))
    seam = seam[seam > 0]
    at = (ends - count_s)[seam]
    shared[at] = np.minimum(run[suffix[at - 1]], run[suffix[at]])
    first = np.flatnonzero((count_l + count_s) > 0)
    shared[(ends - count_l - count_s)[first]] = 0
    shared[: len(zeros)] = 0
    return suffix, shared


def _shared(text: np.ndarray, seeds: np.ndarray, order: np.ndarray, names_shared: np.ndarray) -> np.ndarray:
    """What each seed shares with the one before it in ``order``, given how many names they share."""
    a, b, names = order[:-1], order[1:], names_shared[1:].astype(np.int64)
    known = seeds[a + names] - seeds[a]
    x, y = seeds[a] + known, seeds[b] + known
    return (known + _alike(text, x, y)).astype(np.int32)


def _alike(text: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols each pair of suffixes shares; only for pairs that soon differ. A 0 ends every suffix."""
    out = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x))
    step = 0
    while len(open_):
        p = text[x[open_] + step]
        open_ = open_[(p == text[y[open_] + step]) & (p != 0)]
        out[open_] += 1
        step += 1
    return out


def _mostly_different(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of a text of names most of which occur once: only equal ones look at the names behind them."""
    zeros = np.flatnonzero(name == 0)
    rank = name + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    order = np.argsort(rank, kind="stable")
    # Ranks with gaps: the place of the first of all equal ones.
    sorted_ = rank[order]
    fresh = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(name)), 0))
    rank[order] = first
    equal = np.bincount(first, minlength=len(name))[first] > 1
    open_, width = order[equal], 1
    while len(open_):
        behind = rank[open_ + width]
        by = np.lexsort((behind, rank[open_]))
        rows, own, next_ = open_[by], rank[open_][by], behind[by]
        fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (next_[1:] != next_[:-1])))
        begin = np.concatenate(([True], own[1:] != own[:-1]))
        place = np.arange(len(rows))
        offset = np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(begin, place, 0))
        rank[rows] = own + offset
        group = np.cumsum(fresh) - 1
        open_ = rows[np.bincount(group)[group] > 1]
        width *= 2
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(len(name), np.int32)
    shared[1:] = _alike(name, order[:-1], order[1:])
    return order, shared
