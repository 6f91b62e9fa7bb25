import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import jaccard_join
from granary.llm.jaccard_join import EDGES, _meetings, jaccard_components, signatures, without_near_duplicates
from tests.llm.conftest import words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_force(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            same_id = sets[a][0] is not None and sets[a][0] == sets[b][0]
            if x and y and (same_id or 100 * len(x & y) >= 75 * len(x | y)) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if k == old else k for k in label]
    least = {}
    for (i, _), k in zip(sets, label, strict=True):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    return sorted(((i, len(s), None if i is None else least.get(k, i) if s else i) for (i, s), k in zip(sets, label, strict=True)), key=str)


def family(seed, n, members, edits):
    pick, base = random.Random(seed), words(seed, n).split()
    out = []
    for _ in range(members):
        text = base.copy()
        for _ in range(pick.randint(0, edits)):
            text[pick.randrange(len(text))] = f"new{pick.randrange(10_000)}"
        out.append(" ".join(text[: pick.randint(int(0.9 * n), n)]))
    return out


def documents():
    texts = []
    for seed, (n, members, edits) in enumerate([(8, 12, 1), (15, 12, 1), (40, 25, 2), (120, 25, 5), (400, 20, 14), (30, 10, 0)]):
        texts += family(seed, n, members, edits)
    passage = words(77, 60)
    texts += [f"{words(200 + k, 30 + k)} {passage} {words(300 + k, 20)}" for k in range(40)]
    texts += [None, "", "  ", "a", "A", "a b", "x y z u", "x y z u", "x y z u v", None]
    random.Random(5).shuffle(texts)
    return [(k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("block, group", [(3000, 2000), (7, 3)])
def test_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    rows = documents()
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_small_batches_find_the_same(spark, monkeypatch):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(jaccard_join, "BATCH", 500)  # on the driver: more buckets
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == brute_force(rows)


def test_null_and_repeated_ids(spark):
    base, other = words(1, 60), words(2, 60)
    rows = [(5, base), (5, other), (5, base), (7, other), (None, base), (None, words(3, 20)), (9, words(4, 30)), (3, other + " tail"), (None, None), (11, None)]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_similar_sets_share_a_signature():
    draw = np.random.default_rng(3)
    for size in [4, 5, 7, 9, 16, 33, 70, 150, 400, 1500]:
        for _ in range(60 if size < 100 else 10):
            # As far apart as the threshold allows: common = 0.75 * union.
            union = draw.integers(1, 1 << 63, size, dtype=np.uint64)
            gone = size - -(-75 * size // 100)
            left = int(draw.integers(0, gone + 1))
            a, b = np.sort(union[left:]), np.sort(np.concatenate((union[:left], union[gone:])) if left else union[gone:])
            common = len(np.intersect1d(a, b))
            if len(a) == 0 or 100 * common < 75 * len(np.union1d(a, b)) or np.array_equal(a, b):
                continue
            assert len(np.intersect1d(signatures(a, 75), signatures(b, 75))), (size, left)
    assert (np.diff(EDGES[75]) > 0).all()


def test_subsets_of_partitions_are_enumerated():
    draw = np.random.default_rng(4)
    for size in [12, 60, 300]:
        s = np.sort(draw.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        key, ranges, spare = next(m for m in _meetings(size, 75) if m[0] % 2 == 0)
        # At most k // 2 partitions differ by more than one shingle, so more than the spare ones differ by one at most.
        differing = 25 * 2 * int(EDGES[75][key // 2]) // 175
        assert ranges - differing // 2 == spare + 1
        # One shingle less in each of so many partitions leaves a common signature, though no partition may be left whole.
        common = np.intersect1d(signatures(s, 75), signatures(np.delete(s, np.arange(0, size, 8)), 75))
        assert len(common)


def test_a_passage_in_all_texts_makes_no_large_task(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP", 40)
    group = spark.range(1000).selectExpr("id as set_id", "id % 2 as group_id").withColumn("members", F.lit(500).cast("long"))
    tasks = {}
    for r in jaccard_join._paired(group, "group_id", jaccard_join.GROUP).collect():
        tasks.setdefault(r.task, ([], []))[r.side].append(r.set_id)
    assert max(len(a) + len(b) for a, b in tasks.values()) < 3 * 40
    compared = [frozenset(p) for a, b in tasks.values() for p in (itertools.product(a, b) if b else itertools.combinations(a, 2))]
    assert len(compared) == len(set(compared)) == 2 * 500 * 499 // 2
    # 150 texts that share a passage, and near copies of a few: the links are those of the brute force.
    passage = words(9, 24)
    texts = [f"{passage} {words(1000 + k, 180)}" for k in range(150)]
    rows = list(enumerate(texts + [t.rsplit(" ", 3)[0] for t in texts[::15]]))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_awkward_documents(awkward, nothing):
    found = jaccard_components(awkward)
    want = brute_force([(r.doc_id, r.text) for r in awkward.collect() if r.doc_id != 4])
    assert sorted(map(tuple, found.where("doc_id is null or doc_id <> 4").collect()), key=str) == want
    assert jaccard_components(nothing).count() == 0
    kept = without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "8", "9", "None", "None"]
    assert without_near_duplicates(nothing).count() == 0


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", "z"), (2, "a b c d e f", "y"), (4, "a b c d e f", "x"), (3, None, "w")], "doc_id long, text string, component_id string")
    assert sorted(map(tuple, without_near_duplicates(docs).collect())) == [(2, "a b c d e f", "y"), (3, None, "w")]


def test_one_row_of_each_group_without_ids(spark):
    base, other = words(1, 60), words(2, 60)
    rows = [(None, base, "a")] * 3 + [(None, base + " more", "b"), (None, other, "c"), (7, other + " tail", "d"), (9, other, "e"), (None, None, "f"), (None, "", "g"), (None, words(3, 30), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    kept = without_near_duplicates(docs)
    marks = sorted(r.mark for r in kept.collect())
    assert kept.columns == docs.columns and marks[1:] == ["d", "f", "g", "h"] and marks[0] in ("a", "b")


def test_clashing_names_keep_their_values(spark):
    rows = [(None, words(1, 30), "a", 7, 8), (None, words(1, 30), "a", 7, 8), (1, words(2, 30), "b", 9, 1), (2, words(2, 30), "c", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, _mark int, _clean int")
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
