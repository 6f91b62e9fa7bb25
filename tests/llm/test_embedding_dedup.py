import numpy as np
import pytest

from granary.llm import embedding_dedup
from granary.llm.embedding_dedup import itq, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute_force(rows, least=0.98):
    good = [(k, np.array(v, np.float64)) for k, (_, v, label, _) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    label = list(range(len(rows)))
    links = [0] * len(rows)
    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if k == old else k for k in label]
    first = {}
    for k, row in zip(label, rows, strict=True):
        if row[0] is not None:
            first[k] = min(row[0], first.get(k, row[0]))
    return {row[0]: (n, first[k], first[k] == row[0]) for row, n, k in zip(rows, links, label, strict=True) if row[0] is not None}


def vectors(n=500, size=64):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((n, size))
    rows = [(k, centres[k].astype(np.float32).tolist(), k % 3, None) for k in range(n)]
    for k in range(120):  # neighbours at cosines around the threshold
        other = centres[k] + draw.standard_normal(size) * draw.uniform(0.02, 0.22)
        rows.append((n + k, other.astype(np.float32).tolist(), k % 3, "x"))
    for k in range(90):  # one large group
        rows.append((2 * n + k, (centres[1] + draw.standard_normal(size) * 0.08).astype(np.float32).tolist(), 1, "x"))
    rows += [(3 * n + k, rows[7][1], 1, None) for k in range(4)]
    return rows


@pytest.mark.parametrize(("share", "block"), [(64, 2000), (1, 20)])
def test_recall_against_brute_force(spark, monkeypatch, share, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "SHARE", share)
    rows = vectors()
    want = brute_force(rows)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = {r.vec_id: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] <= want[k][0] for k in want)  # nothing below the threshold, no pair twice
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[k][1:] == want[k][1:] for k in want) >= 0.98 * len(want)


def test_recall_of_pairs_at_the_threshold(spark):
    """One scheme at every size: what is measured here on pairs at a cosine of 0.98 to 0.981 holds for any number of rows."""
    draw = np.random.default_rng(11)
    a = draw.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = draw.standard_normal(a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = draw.uniform(0.98001, 0.981, (len(a), 1))
    other = cosine * a + np.sqrt(1 - cosine**2) * b
    rows = [(k, v.tolist(), 1) for k, v in enumerate(np.concatenate((a, other)))]
    found = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4))
    assert found.where("n_links > 0").count() >= 0.97 * len(rows)


def test_first_shared_table_of_a_pair():
    code = np.array([0, 0xFF, 0xFFFF, 1 << 63], np.uint64)
    for other in code[1:]:
        shared = [t for t in range(28) if embedding_dedup._meets(code[:1], np.array([other]), 64 << 22 | t << 16)[0]]
        assert len(shared) == (np.bitwise_count(other) <= 14)
    assert embedding_dedup._meets(code[:1], code[1:2], 64 << 22 | 7 << 16)[0]  # chunks 1 and 2, after the seven tables of chunk 0


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, None), (3, [1.0, 0.0], 2, None), (4, [1.0, 0.0], None, None), (5, None, 1, None), (6, [0.0, 0.0], 1, None), (7, [1.0, None], 1, None),
        (8, [nan, 1.0], 1, None), (9, [inf, 1.0], 1, None), (10, [], 1, None), (11, [1.0, 0.0, 0.0], 1, None), (12, [1.0, 0.0], 1, "y"), (None, [1.0, 0.0], 1, None), (13, [-1.0, 0.0], 1, None),
        (14, [3e38, 0.0], 1, None), (15, [0.0, -0.0], 1, None), (16, [1e-30, 0.0], 1, None),
    ]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = {r.vec_id: tuple(r)[1:] for r in found.collect() if r.vec_id is not None}
    assert got == brute_force(rows)
    alone = [r for r in found.collect() if r.vec_id is None]
    assert len(alone) == 1 and (alone[0].n_links, alone[0].component_id, alone[0].kept) == (5, None, False)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rotation_is_learned():
    draw = np.random.default_rng(1)
    sample = draw.standard_normal((2000, 16)) * np.linspace(3, 0.3, 16)
    centre, projection = itq(sample, 16)
    assert np.allclose(projection.T @ projection, np.eye(16), atol=1e-8)
    turned, plain = (sample - centre) @ projection, sample - centre
    loss = lambda v: ((v - np.where(v >= 0, 1, -1)) ** 2).sum()
    assert loss(turned) < loss(plain)
