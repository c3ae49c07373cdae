import numpy as np
import pytest

from tessera.llm import embedding
from tests.llm.test_simhash import slow_components

SCHEMA = "vec_id long, embedding array<float>, vec string, n_links int"


def run(spark, vectors, **params):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 0) for i, v in vectors], SCHEMA).repartition(5)
    return embedding.embedding_near_dedup(df, **params).collect()


def test_against_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((300, 48))
    rows = [(i, v) for i, v in enumerate(base)]
    for i in range(300, 420):
        v = base[i % 40]
        rows.append((i, v + rng.standard_normal(48) * np.linalg.norm(v) / 48**0.5 * rng.choice([0.05, 0.2, 0.32, 0.4])))
    rows += [(500 + i, base[3]) for i in range(30)] + [(600 + i, base[4] * 2.0) for i in range(3)]
    rows = [(i, np.asarray(v, np.float32)) for i, v in rows]
    got = {r.vec_id: r for r in run(spark, rows)}
    x = np.stack([v for _, v in rows]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [i for i, _ in rows]
    assert [got[i].n_links for i in ids] == near.sum(axis=1).tolist()
    at = {i: k for k, i in enumerate(ids)}
    root = slow_components(ids, lambda a, b: near[at[a], at[b]])
    assert {i: got[i].component_id for i in ids} == root
    assert all(got[i].kept == (root[i] == i) for i in ids)


@pytest.mark.parametrize("width, functions", [(3, 2), (64, 2), (64, 3), (100, 3), (64, 4)])
def test_recall_at_the_threshold(width, functions):
    rng = np.random.default_rng(10)
    a = rng.standard_normal((3000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, width))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + (1 - 0.95**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = np.zeros(3000, bool)
    for t in range(embedding.tables_for(width, functions, 0.95)):
        x, y = embedding.buckets(a, t, functions), embedding.buckets(b, t, functions)
        met |= ((x == y[:, :1]) | (y == x[:, :1])).any(axis=1)
    assert met.mean() >= 0.99


def test_lengths_have_functions_of_their_own(spark, monkeypatch):
    asked = set()
    candidates = embedding._candidates
    monkeypatch.setattr(embedding, "_candidates", lambda reps, functions, threshold: asked.update(functions.items()) or candidates(reps, functions, threshold))
    rng = np.random.default_rng(11)
    rows = [(i, rng.standard_normal(64)) for i in range(400)] + [(400, [1.0]), (401, [1.0, 2.0]), (402, [1.0, 2.02])]
    got = {r.vec_id: r for r in run(spark, rows)}
    assert asked == {(64, 2), (1, 2), (2, 2)}
    assert got[400].n_links == 0 and got[401].n_links == got[402].n_links == 1


def test_many_functions_probe_the_nearest_buckets():
    x = np.random.default_rng(12).standard_normal((300, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert embedding.buckets(x, 0, 30).shape == (300, embedding.PROBES)  # 4^30 combinations
    assert (embedding.buckets(x, 0, 30)[:, :1] == embedding.buckets(x, 0, 30, probes=1)).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0, 0.0]),
           (9, [1.0, 1.01]), (7, [1.0, 1.0]), (10, [1e30, 1e30]), (11, [1e-30, 1e-30]), (12, [-0.0, 1.0]), (13, [0.0, 1.0])]
    got = {}
    for r in run(spark, odd):
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert all(got[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 8))
    assert got[None] == [(0, None, True)]
    assert got[7] == [(4, 7, True)] * 2 and got[9] == got[10] == got[11] == [(4, 7, False)]
    assert got[12] == [(1, 12, True)] and got[13] == [(1, 12, False)]


def test_empty(spark):
    assert run(spark, []) == []
