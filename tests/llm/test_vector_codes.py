import math
import random

import numpy as np
import pytest

from footfall.llm import vector_codes as V


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows: (id, label, vector) of one length -> {id: (code, error)}, codebooks."""
    rows = sorted((r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])),
                  key=lambda r: (r[0], r[2]))
    width = len(rows[0][2]) // parts
    cut = [[tuple(math.floor(scale * x) for x in v[p * width:(p + 1) * width]) for p in range(parts)] for _, _, v in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(p, c[p])[0], []).append(c[p])
            books[p] = [tuple(sum(x) // len(own[i]) for x in zip(*own[i])) if i in own else e
                        for i, e in enumerate(books[p])]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    return [(r[0], "".join(f"{i:02x}" for i, _ in f), sum(d for _, d in f)) for r, f in zip(rows, found)], books


def vectors(n, seed=3, size=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = [(i, rng.choice([0, 1, None]), [x + rng.gauss(0, 0.05) for x in rng.choice(centres)]) for i in range(n)]
    return rows + [(n + i, 0, rows[5][2]) for i in range(60)]  # copies


def test_equal_to_plain_k_means(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 100)
    monkeypatch.setattr(V, "LEAF_POINTS", 8)
    rows = vectors(500)
    rows += [(9001, 1, None), (9002, 1, [None] * 8), (9003, 1, [math.inf] + [0.0] * 7), (9004, None, [math.nan] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    codes, books = V.compress(df, entries=16, rounds=3)
    want, want_books = plain(rows, entries=16, rounds=3)
    got = codes.collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted(want)
    assert books[8] == want_books
    label = {r[0]: r[1] for r in rows}
    sums = {x: sum(e for i, _, e in want if label[i] == x) for x in (0, 1, None)}
    assert all(r.label_error == sums[r.label] and r.codebooks_sha256 == V.codebook_digest(want_books) for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_tree_covers_and_assigns_exactly(seed):
    rng = np.random.default_rng(seed)
    points = np.floor(rng.normal(0, 300, (1500, 5)) if seed % 2 else rng.integers(-4, 4, (1500, 3))).astype(float)
    tree = V.anchors_tree(points)
    assert sorted(tree["order"].tolist()) == list(range(1500)) and (tree["points"] == points[tree["order"]]).all()
    for lo, hi, s, c, r in zip(tree["lo"], tree["hi"], tree["sums"], tree["centres"], tree["radii"]):
        own = tree["points"][lo:hi]
        assert (own.sum(axis=0) == s).all() and np.sqrt(((own - c) ** 2).sum(axis=1)).max() <= r + 1e-6
    inner = tree["left"] >= 0
    assert (tree["hi"][tree["left"][inner]] == tree["lo"][tree["right"][inner]]).all()
    entries = [tuple(int(x) for x in points[i]) for i in rng.integers(0, 1500, 40)] * 2  # with copies
    codes, sums, counts = V.assign(tree, entries)
    far = ((tree["points"][:, None, :] - np.array(entries, float)[None]) ** 2).sum(axis=2)
    assert (codes == far.argmin(axis=1)).all() and counts.sum() == 1500
    assert all((sums[e] == tree["points"][codes == e].sum(axis=0)).all() for e in range(len(entries)))


def test_balls_are_owned_whole():
    """Well separated clusters: no point is compared by itself."""
    rng = np.random.default_rng(1)
    points = np.vstack([rng.integers(0, 5, (300, 4)) + 1000 * c for c in range(6)]).astype(float)
    tree = V.anchors_tree(points)
    hidden = dict(tree, points=np.full_like(tree["points"], np.nan))
    codes, _, _ = V.assign(hidden, [(1000 * c + 2,) * 4 for c in range(6)])
    assert (codes == tree["points"][:, 0] // 1000).all()


def test_edge_rows(spark):
    rows = [(1, "a", [0.1] * 4, "x"), (1, "a", [0.1] * 4, "x"), (None, None, [0.5] * 4, "x"), (2, "b", [1e30, -1e30, 0.0, 1.0], "x"),
            (3, "b", [0.25] * 6, None), (4, "c", [], "x"), (5, "c", None, "x"), (6, "c", [1e300] * 4, "x")]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>, code string")
    codes, books = V.compress(df)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in codes.collect()), key=str)
    # Five entries: ids 1, 1, 2, 6 and null last; a copy's code is the lower index.
    assert got == sorted([(1, "00000000", 0, 0), (1, "00000000", 0, 0), (2, "02020202", 0, 0), (6, "03030303", 0, 0),
                          (None, "04040404", 0, 0), (3, "00000000", 0, 0), (4, "00000000", 0, 0)], key=str)
    assert sorted(books) == [0, 4, 6] and len(books[6][0][0]) == 2
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert V.compress(empty)[0].count() == 0


def test_limbs():
    for x in (0, 1, -1, 2 ** 40, -2 ** 200 + 7, 10 ** 45):
        assert sum(v << (V.LIMB_BITS * p) for p, v in V._limbs(x)) == x
