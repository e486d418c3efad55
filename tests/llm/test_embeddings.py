"""Small-world graphs against all cosines."""
import numpy as np
import pytest

from tests.llm.conftest import SF, by_id
from tillwork.llm import common, hnsw, vectors
from tillwork.llm.components import components


def plain(rows, least=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                links[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= least
    label = list(range(n))
    changed = True
    while changed:
        new = [min([label[i], *(label[j] for j in np.flatnonzero(links[i]))]) for i in range(n)]
        changed, label = new != label, new
    smallest = {}
    for (v, _), x in zip(rows, label):
        if v is not None:
            smallest[x] = min(v, smallest.get(x, v))
    return [(v, int(links[i].sum()), smallest.get(label[i]) if ok[i] else v) for i, (v, _) in enumerate(rows)]


def test_near(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.25 * (i % 5)).tolist()) for i in range(260)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] + [1.0] * 15),
             (305, [float("inf")] + [1.0] * 15), (306, rows[7][1]), (307, rows[7][1]), (308, [x * 4 for x in rows[7][1]]),
             (309, [1e-200] * 16), (310, [1.0] * 16), (311, [1.0] * 3), (312, [2.0] * 3), (313, [0.0] * 16), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as label", "2 as _key", "3 as dim")
    got = vectors.near(df, least_shards=3)
    want = sorted(plain(rows))
    assert by_id(got, "vec_id", "n_links", "component_id") == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.collect())
    assert not vectors.near(df.limit(0)).count()


def test_test_table(spark):
    df = common.table(spark, SF, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.5).sum(axis=1) - 1
    got = dict(by_id(vectors.near(df, least=0.5, least_shards=4), "vec_id", "n_links"))
    found = sum(got.values())
    assert found >= 0.97 * want.sum() and all(got[v] <= n for (v, _), n in zip(rows, want))


def planted(groups, sparse, dim, seed):
    """Dense groups, as many vectors by themselves, and pairs at about the threshold."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=dim) + rng.normal(size=(g, dim)) * 0.2 for g in groups]
    alone = rng.normal(size=(sparse, dim))
    mates = alone[:sparse // 4]
    close = mates + rng.normal(size=mates.shape) * 0.45
    v = np.concatenate([*parts, alone, close])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def true_links(v, least=0.9):
    links = v @ v.T >= least
    np.fill_diagonal(links, False)
    return links


@pytest.mark.parametrize("groups, sparse", [((700,), 800), ((40, 60, 90), 1000), ((1500,), 300), ((), 600)])
def test_links_of_dense_groups_and_sparse_pairs(groups, sparse):
    v = planted(groups, sparse, 32, 6)
    graph = hnsw.Graph.load(v, hnsw.build(v, seed=1).dump())
    truth = true_links(v)
    got = np.zeros_like(truth)
    for q, r in hnsw.links_within(graph, 0.9):
        assert not got[q, r].any()  # each once
        got[q, r] = True
    assert (got == got.T).all() and not (got & ~truth).any()
    assert got.sum() >= 0.99 * truth.sum() and truth.sum() > 0
    half = len(v) // 2
    other = hnsw.Graph.load(v[half:], hnsw.build(v[half:], seed=2).dump())
    between = sum(len(q) for q, _ in hnsw.links_between(other, v[:half], 0.9))
    assert 0.99 * truth[:half, half:].sum() <= between <= truth[:half, half:].sum()


def test_the_audit_sees_true_pairs():
    v = planted((), 1000, 32, 3)
    graph = hnsw.build(v, seed=1)
    width, recall, pairs = hnsw.audited_width(graph, v, 0.9, True)
    assert pairs >= 50 and recall >= 0.99 and width < len(v)
    # a graph that has lost its links is noticed, and all vectors are gone through
    broken = hnsw.Graph(v, [(n, np.full_like(a, -1)) for n, a in graph.levels])
    assert hnsw.audited_width(broken, v, 0.9, True)[:2] == (max(w for w in [32 * 2 ** k for k in range(9)] if w < 2 * len(v)), 1.0)


def test_planted_groups_at_the_threshold(spark):
    """A group of a third of all, one of 300, pairs at the threshold: nearly every link, and both ends agree."""
    v = planted((2000, 300), 3000, 32, 8).astype(np.float32)
    order = np.random.default_rng(1).permutation(len(v))
    df = spark.createDataFrame([(int(i), v[k].tolist()) for i, k in enumerate(order)], "vec_id long, embedding array<float>")
    got = by_id(vectors.near(df, least_shards=3), "vec_id", "n_links", "component_id")
    exact = v[order].astype(np.float64)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    truth = true_links(exact)
    assert 0.99 * truth.sum() <= sum(n for _, n, _ in got) <= truth.sum()
    assert all(n <= truth[i].sum() for i, n, _ in got) and sum(n for _, n, _ in got) % 2 == 0
    assert len({c for i, _, c in got if truth[i].sum() > 500}) == 1


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = dict(by_id(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert all(got[i] == 1 for i in range(1, 201)) and all(got[i] == 1000 for i in range(1000, 1300)) and got[5001] == 5000
