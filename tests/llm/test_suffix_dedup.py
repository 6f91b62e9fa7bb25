import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from granary.llm.induced_sort import sorted_suffixes
from granary.llm.suffix_dedup import WINDOW, removed_repeats, repeated_windows, without_repeats
from granary.llm.tables import table
from tests.llm.conftest import DOCUMENTS, SF_SMALL, words


def brute_force(rows):
    data = [(t or "").encode() for _, t in rows]
    starts = defaultdict(list)
    for d, raw in enumerate(data):
        for k in range(len(raw) - WINDOW + 1):
            starts[hash(raw[k : k + WINDOW])].append((d, k))
    gone = [np.zeros(len(raw) + 1, bool) for raw in data]
    for places in starts.values():
        if len(places) > 1:
            for d, k in places:
                gone[d][k : k + WINDOW] = True
    out = []
    for (doc_id, _), raw, g in zip(rows, data, gone, strict=True):
        kept = bytes(np.frombuffer(raw, np.uint8)[~g[:-1]])
        spans = int((g[:-1] & ~np.concatenate(([False], g[:-2]))).sum()) if raw else 0
        out.append((doc_id, len(raw), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(docs, **how):
    got = removed_repeats(docs, **how)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("most", [4096, 1])
def test_documents_against_brute_force(spark, most):
    docs = table(spark, SF_SMALL, "documents")
    want = brute_force(plain(docs))
    assert rows_of(docs, most=most) == want and sum(r[2] > 0 for r in want) > 10


@pytest.mark.parametrize("most", [4096, 3])
def test_shared_passages(spark, most):
    """A passage in many texts, at the edges of texts, beside itself, with single bytes changed; runs of one letter; near copies."""
    pick = random.Random(7)
    passage = words(1, 110)
    rows = [(k, f"{words(100 + k, pick.randrange(60))} {passage} {words(200 + k, pick.randrange(60))}") for k in range(30)]
    rows += [(50, passage), (51, passage + passage), (52, passage[:399]), (53, passage[1:401]), (54, "x" + passage[1:400] + "y")]
    rows += [(60, "a" * 5000), (61, "a" * 399), (62, "ab" * 700 + "c"), (63, "é" * 900), (64, "b" * 400), (65, "b" * 400)]
    base = words(3, 900)
    for k in range(12):
        cut = sorted(pick.sample(range(len(base)), 4))
        rows.append((70 + k, "".join(c if i not in cut else "#" for i, c in enumerate(base))))
    docs = spark.createDataFrame([(i, t, None, None, None, *["x"] * 6) for i, t in rows], DOCUMENTS)
    assert rows_of(docs, most=most) == brute_force(rows)


def test_awkward_rows(spark, awkward, nothing):
    assert rows_of(awkward) == brute_force(plain(awkward))
    assert rows_of(nothing) == []


def test_kept_texts(spark):
    passage = words(1, 110)
    rows = [(1, f"one {passage} two"), (2, f"six {passage} four"), (3, None), (4, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in without_repeats(docs).collect()) == [(1, "onetwo"), (2, "sixfour"), (3, ""), (4, "short")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=25), min_size=1, max_size=8), st.sampled_from([0, 1 << 20]))
def test_induced_sort_against_sorting(regions, memory):
    text = [x for r in regions for x in [*r, 0]]
    ends = [k for k, x in enumerate(text) if x == 0]
    stop = lambda i: next(e for e in ends if e >= i)
    order = sorted(range(len(text)), key=lambda i: (text[i : stop(i)] + [0], i))

    def shared(i, j):
        k = 0
        while text[i + k] == text[j + k] != 0:
            k += 1
        return k

    suffix, common = sorted_suffixes(np.array(text), 4, memory)
    assert list(suffix) == order and list(common) == [0] + [shared(a, b) for a, b in zip(order, order[1:], strict=False)]


def test_runs_of_windows():
    a = bytes(range(256)) + bytes(range(0, 256, 2))
    region, first, count = repeated_windows([b"x" + a, a[5:], b"y" * 50], window=40)
    assert list(zip(region.tolist(), first.tolist(), count.tolist(), strict=True)) == [(0, 6, len(a) - 44), (1, 0, len(a) - 44), (2, 0, 11)]
