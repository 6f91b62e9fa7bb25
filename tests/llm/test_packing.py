import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from granary.llm.packing import best_fit, completions, least_bins, pack_counts, packed, undominated

PATH = public_tokenizers.path("byte_bpe_50k.json")


def bins(fillings):
    return sum(times for _, times in fillings)


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def fewest(lengths, capacity):
    """All ways, on a handful of pieces."""
    best = len(lengths)

    def put(k, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if k == len(lengths):
            best = len(loads)
            return
        for i in range(len(loads)):
            if loads[i] + lengths[k] <= capacity:
                put(k + 1, [*loads[:i], loads[i] + lengths[k], *loads[i + 1 :]])
        put(k + 1, [*loads, lengths[k]])

    put(0, [])
    return best


def test_search_uses_every_piece_and_finds_the_least():
    pick = random.Random(1)
    for _ in range(60):
        capacity = pick.choice([20, 50])
        lengths = sorted((pick.randint(1, capacity) for _ in range(pick.randint(1, 9))), reverse=True)
        counts = counts_of(lengths, capacity)
        found = pack_counts(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for filling, times in found:
            assert sum(filling) <= capacity
            np.add.at(used, list(filling), times)
        assert (used == counts).all()
        best = fewest(lengths, capacity)
        assert least_bins(counts, capacity) <= best == bins(found)


def test_no_filling_is_dominated():
    pick = random.Random(2)
    for _ in range(300):
        capacity = pick.choice([20, 50, 100])
        counts = counts_of([pick.randint(1, capacity) for _ in range(pick.randint(1, 40))], capacity)
        top = int(np.flatnonzero(counts)[-1])
        for filling in completions(top, counts, capacity):
            left = counts.copy()
            np.subtract.at(left, list(filling), 1)
            assert filling[0] == top and (left >= 0).all() and sum(filling) <= capacity
            free = capacity - sum(filling)
            for size, gone in itertools.chain(((1, (x,)) for x in filling[1:]), ((2, p) for p in itertools.combinations(filling[1:], 2))):
                low, high = sum(gone) + (size == 1), sum(gone) + free
                assert not left[low : high + 1].any(), (filling, gone)
    assert undominated((10, 4, 3), counts_of([10, 7, 4, 3], 18), 18) == (10, 7)
    assert undominated((10, 4), counts_of([10, 6, 5, 4], 16), 16) == (10, 6)
    assert undominated((10,), counts_of([10], 16), 16) == (10,)


def test_lengths_that_fit_with_nothing_raise_the_bound():
    # The total asks for 3 bins; none of the lengths above a half takes another.
    assert least_bins(counts_of([6, 6, 6, 6, 5], 10), 10) == 5
    assert least_bins(counts_of([], 10), 10) == 0


def test_search_beats_best_fit_where_that_errs():
    # Best fit pairs 6+4 and is left with odd ends; 6+2+2 and 4+3+3 fill every bin.
    counts = counts_of([6, 4, 3, 3, 2, 2], 10)
    assert bins(pack_counts(counts, 10)) == least_bins(counts, 10) == 2 <= bins(best_fit(counts, 10))


def test_undominated_fillings():
    counts = counts_of([7, 3, 2, 1], 10)
    assert completions(7, counts, 10) == [(7, 3)]


def test_many_pieces_need_few_searches():
    lengths = np.random.default_rng(1).integers(1, 1024, 300_000)
    counts = counts_of(lengths, 1024)
    found = pack_counts(counts)
    assert len(found) < 4000 and bins(found) <= least_bins(counts, 1024) * 1.002


def check(found, docs):
    library = Tokenizer.from_file(PATH)
    rows = sorted(found.collect(), key=lambda r: (str(r.doc_id), r.piece))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for (doc, _), pieces in itertools.groupby(rows, key=lambda r: (r.doc_id, None)):
        if doc is None or doc == 6:
            continue  # several rows under one id
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], np.uint32)
        at = 0
        for k, p in enumerate(pieces):
            assert (p.piece, p.start) == (k, at) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            assert p.length == (1024 if k else (len(ids) - 1) % 1024 + 1)
            at += p.length
        assert at == len(ids)
    for _, members in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for p in members:
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= max(-(-total // 1024) * 1.01 + 1, 1)


def test_awkward_documents(awkward):
    found = packed(awkward, PATH)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(found, awkward)
    assert found.where("piece = 0").count() == awkward.count()


def test_nothing(nothing):
    assert packed(nothing, PATH).count() == 0
