import numpy as np

from footfall.llm import embedding_dedup as E
from tests.conftest import SF_ORACLE
from tests.llm import brute


def _brute(vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hit = unit @ unit.T >= 0.95
    return hit.sum(axis=1) - 1, brute.components(list(range(len(unit))), lambda a, b: hit[a, b])


def test_recall_against_brute_force(spark):
    base = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").limit(300).collect()
    rng = np.random.default_rng(8)
    vectors = [np.array(r.embedding, np.float32) for r in base]
    for k in range(0, 120):  # near copies, a large group of them, exact copies
        v = vectors[0 if k < 60 else k].astype(float)
        noise = rng.standard_normal(len(v)) * np.linalg.norm(v) / np.sqrt(len(v))
        vectors.append((v + noise * rng.choice([0.0, 0.05, 0.2, 0.3])).astype(np.float32) * np.float32(rng.choice([1, 3])))
    table = np.array(vectors, float)
    links, roots = _brute(table)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = sorted(E.embedding_components(df, tile_rows=16, codewords=8).collect(), key=lambda r: r.vec_id)
    assert sum(r.n_links for r in got) >= 0.97 * links.sum() > 0
    assert all(r.n_links <= n for r, n in zip(got, links))  # none below the similarity
    assert sum(r.component_id == root for r, root in zip(got, roots)) >= 0.97 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_every_length_has_its_index(spark):
    """Two lengths with near pairs, and norms whose squares overflow or vanish."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for size, first, scale in ((6, 0, 1.0), (10, 1000, 1e200), (3, 2000, 1e-200)):
        base = rng.standard_normal((40, size))
        near = base + rng.standard_normal(base.shape) * 0.01
        table = np.vstack([base, near]) * scale
        links, roots = _brute(table / scale)
        for i, v in enumerate(table):
            rows.append((first + i, v.tolist()))
            want[first + i] = (links[i], first + roots[i])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_components(df, tile_rows=16).collect()}
    assert set(got) == set(want) and sum(got[k] == want[k] for k in want) >= 0.97 * len(want)
    assert all(got[k][0] <= want[k][0] for k in want) and sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())


def test_codewords_follow_the_rows():
    assert [E.codewords_for(n) for n in (1, 10_000, 50_000, 10**9, 10**12)] == [8, 32, 55, 1024, 1024]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5, "x"), (2, [1.0, 0.001], 5, "y")],
                               "vec_id long, embedding array<double>, weight int, own string")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in E.embedding_components(df).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, []),
            (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, [1.0, 0.0]),
            (None, [0.0, -0.0, 5.0]), (None, [0.0, 0.0, 5.0]), (11, [1.0, 0.0, 0.001])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, label int, key string")
    out = E.embedding_components(df).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] * 2 and got[11] == [(3, 1, False)]
    for alone in (3, 4, 5, 6, 7, 8, 9, 10):
        assert got[alone] == [(0, alone, True)]
    assert got[None] == [(1, None, True)] * 2  # equal vectors, no id in the component
    assert E.embedding_components(df.limit(0)).count() == 0
    assert E.embedding_components(df.where("vec_id = 4")).count() == 1
