"""Best-fit packing of token sequences by bin completion (Korf) over length counts.

Documents become pieces: only those above ``capacity`` tokens are cut, into full pieces and a shorter first one. Pieces
of one length are alike, so the search runs over the counts per length: ``capacity`` numbers, whatever the input.

Bin completion takes the longest length left and looks for the fillings of its bin that no other filling dominates: a
filling is dominated if lengths of another can be swapped in, one for one or two for one, to waste less with what is left.
Undominated fillings are tried in the order of their waste; best fit gives the first incumbent. A filling is applied as
often as the counts allow before the next search, so the number of searches depends on the lengths, not on the
documents. A branch ends when the waste so far plus the least waste that the rest must have (the total of the rest against
whole bins, and the lengths that fit with nothing) reaches the incumbent's.

Fillings are then dealt to pieces by rank: every piece knows how many pieces of its length come before it, from counts per
task, so no window and no shuffle sees all pieces of a length. Each task looks its places up in the list of
fillings, which is as small as the search.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from granary.llm.tokens import encoder
from granary.llm.words import lean, pieces
from granary.session import materialise

CAPACITY = 1024
END = 2
#: Fillings looked at for one bin, and bins searched beyond the first incumbent.
FILLINGS = 6
NODES = 20_000


def completions(top: int, counts: np.ndarray, capacity: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of a bin that holds ``top``, least waste first.

    A depth-first search over lengths in falling order; only the longest that fit are taken up at each depth. What it finds is
    put through the dominance tests, and a dominated filling gives way to the one that dominates it.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    left = counts.copy()
    left[top] -= 1
    steps = [0]

    def grow(chosen: tuple[int, ...], free: int, cap: int) -> None:
        steps[0] += 1
        lengths = np.flatnonzero(left[1 : min(free, cap) + 1])[::-1] + 1
        if not len(lengths):
            found.append((free, chosen))
            return
        for x in lengths[: 3 if len(chosen) < 4 else 1].tolist():
            if found and min(found)[0] == 0 and len(found) >= most or steps[0] > 400:
                return
            left[x] -= 1
            grow((*chosen, x), free - x, x)
            left[x] += 1
            if x == free:
                break  # nothing wastes less than a full bin

    # One length that fills the bin dominates every other filling with a shorter longest length.
    free = capacity - top
    if free and left[free]:
        return [(top, free)]
    # Two lengths that fill the bin exactly.
    exact = []
    lengths = np.flatnonzero(left[1 : free + 1]) + 1
    for x in lengths[::-1].tolist():
        y = free - x
        if y > x or y < 1:
            continue
        if left[y] >= (2 if x == y else 1):
            exact.append((top, x, y))
            if len(exact) >= most:
                return exact
    if exact:
        return exact
    grow((top,), free, free)
    best: dict[tuple[int, ...], int] = {}
    for _, chosen in sorted(set(found), key=lambda item: (item[0], tuple(-x for x in item[1]))):
        chosen = undominated(chosen, counts, capacity)
        best[chosen] = capacity - sum(chosen)
        if len(best) == most:
            break
    return sorted(best, key=lambda chosen: (best[chosen], tuple(-x for x in chosen)))


def undominated(filling: tuple[int, ...], counts: np.ndarray, capacity: int) -> tuple[int, ...]:
    """``filling`` after all swaps that dominate it: a longer length for one of its lengths, one length for two of them.

    A packing with the filling stays one if the swapped lengths change places, so the filling that takes the longer one is as
    good. The first length, which the bin is searched for, stays. Each swap wastes less or leaves fewer lengths, so they end.
    """
    top, *rest = filling
    left = counts.copy()
    for x in filling:
        left[x] -= 1
    free = capacity - sum(filling)

    while rest:
        have = np.append(0, np.flatnonzero(left > 0))
        once, times = np.unique(rest, return_counts=True)
        first, second = np.triu_indices(len(once))
        real = (first != second) | (times[first] > 1)
        olds = [(x,) for x in once.tolist()] + list(zip(once[first[real]].tolist(), once[second[real]].tolist(), strict=True))
        sizes = np.concatenate((once, once[first[real]] + once[second[real]]))
        # The longest length left that fits in the place; one that stands for one length has to exceed it.
        longest = have[np.searchsorted(have, sizes + free, "right") - 1]
        better = np.flatnonzero(longest >= sizes + (np.arange(len(sizes)) < len(once)))
        if not len(better):
            break
        k = int(better[0])
        for x in olds[k]:
            rest.remove(x)
            left[x] += 1
        rest.append(int(longest[k]))
        left[longest[k]] -= 1
        free -= int(longest[k] - sizes[k])
    return (top, *sorted(rest, reverse=True))


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: whole bins of all lengths, and the waste of lengths above a half that nothing left can fill."""
    counts = np.pad(counts, (0, capacity + 1 - len(counts)))
    half = capacity // 2
    lengths = np.arange(capacity + 1)
    below = np.cumsum(counts * lengths)
    above = np.append(np.cumsum(counts[::-1])[::-1], 0)
    # For each k: lengths above capacity - k take no length of k or more, so those need room elsewhere.
    k = np.arange(1, half + 1)
    large = above[capacity - k + 1]
    middle = above[half + 1] - large
    room = middle * capacity - (below[capacity - k] - below[half])
    small = below[half] - below[k - 1]
    bins = large + middle + np.maximum(0, -((room - small) // capacity))
    return max(-(-int(below[-1]) // capacity), int(bins.max(initial=0)))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often: each bin takes the longest length that fits, again and again."""
    left, out = counts.copy(), []
    while True:
        some = np.flatnonzero(left)
        if not len(some):
            return out
        chosen, free = [], capacity
        use = left.copy()
        while True:
            fits = np.flatnonzero(use[1 : free + 1])
            if not free or not len(fits):
                break
            x = int(fits[-1]) + 1
            chosen.append(x)
            use[x] -= 1
            free -= x
        times = _apply(left, tuple(chosen))
        out.append((tuple(chosen), times))


def _apply(left: np.ndarray, filling: tuple[int, ...]) -> int:
    """Use the filling as often as the counts allow; the counts are lowered."""
    lengths, need = np.unique(filling, return_counts=True)
    times = int((left[lengths] // need).min())
    left[lengths] -= need * times
    return times


def pack_counts(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often each, for ``counts[length]`` pieces; as few bins as the search finds within ``nodes`` bins."""
    counts = counts.astype(np.int64)
    incumbent = best_fit(counts, capacity)
    fewest = sum(t for _, t in incumbent)
    bound = least_bins(counts, capacity)
    spent = [0]

    # Depth first with limited discrepancy: the path of first choices, then paths that leave it once, and so on.
    stack = [(counts.copy(), None, 0, 0)]
    while stack and spent[0] < nodes and fewest > bound:
        left, path, used, late = stack.pop()
        while True:
            if used + least_bins(left, capacity) >= fewest:
                break
            some = np.flatnonzero(left)
            if not len(some):
                fewest = used
                incumbent = []
                while path is not None:
                    incumbent.append(path[0])
                    path = path[1]
                incumbent.reverse()
                break
            spent[0] += 1
            if spent[0] >= nodes:
                break
            options = completions(int(some[-1]), left, capacity)
            for rank, option in enumerate(options[1:], 1):
                if late + rank <= 2 and len(stack) < 200:
                    other = left.copy()
                    times = _apply(other, option)
                    stack.append((other, ((option, times), path), used + times, late + rank))
            left = left.copy()
            times = _apply(left, options[0])
            path = ((options[0], times), path)
            used += times
    return incumbent


def _tokenized(path: str, capacity: int, end: int):
    """Rows (doc_id, piece, start, length, ids_crc32, part, rank); ``rank`` counts pieces of this length in the task."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = encoder(path)
        seen = np.zeros(capacity + 1, np.int64)
        last = np.uint32(end).tobytes()
        for batch in batches:
            for rows in pieces(batch, limit=1 << 20):
                out = []
                for row, ids in enumerate(coder.encode([t or "" for t in rows.column(1).to_pylist()])):
                    ids += last
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    a, piece = 0, 0
                    while a < n:
                        b = a + (first if not a else capacity)
                        out.append((row, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), int(seen[b - a])))
                        seen[b - a] += 1
                        a, piece = b, piece + 1
                row, piece, start, length, crc, rank = (np.array(c, np.int64) for c in zip(*out, strict=True))
                yield pa.record_batch(
                    [rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc), pa.array(np.full(len(row), part, np.int32)), pa.array(rank)], names
                )

    return lean(tokenize, tokens=True)


class Places:
    """Where the n-th piece of a length goes: runs of ranks per length."""

    def __init__(self, fillings: list[tuple[tuple[int, ...], int]], capacity: int):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken = np.zeros(capacity + 1, np.int64)
        sequence = 0
        for filling, times in fillings:
            offset = 0
            lengths, need = np.unique(filling, return_counts=True)
            share = dict(zip(lengths.tolist(), need.tolist(), strict=True))
            place = {x: [] for x in share}
            for x in filling:
                place[x].append(offset)
                offset += x
            for x, offsets in place.items():
                for k, o in enumerate(offsets):
                    rows.setdefault(x, []).append((int(taken[x]) + k * times, times, sequence, o))
                taken[x] += times * share[x]
            sequence += times
        self.by_length = {x: np.array(r, np.int64).T for x, r in rows.items()}

    def look_up(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for x in np.unique(length).tolist():
            here = np.flatnonzero(length == x)
            first, _, base, place = self.by_length[x]
            run = np.searchsorted(first, rank[here], "right") - 1
            sequence[here] = base[run] + rank[here] - first[run]
            offset[here] = place[run]
        return sequence, offset


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of ``docs(doc_id, text)``.

    A document's ids are those of the tokenizers file at ``path``, then ``end``; a null or empty text has the end id only.
    Sequences hold ``capacity`` ids at most and their pieces stand gapless from 0. Repeated rows are packed as rows of their
    own, a null ``doc_id`` stays null. Other columns are not read. An empty table gives no row.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = materialise(texts.mapInArrow(_tokenized(path, capacity, end), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"), "pieces")
    # One row per task and length, at most ``capacity`` of them for a task.
    sizes = cut.groupBy("part", "length").agg((F.max("rank") + 1).alias("size"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))), "offsets")
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in offsets.groupBy("length").agg(F.sum("size")).collect():
        counts[length] = count
    places = Places(pack_counts(counts, capacity), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.look_up(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = cut.join(offsets.drop("size"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
