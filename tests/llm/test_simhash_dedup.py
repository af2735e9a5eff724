import math
import random

from pyspark.sql import functions as F

from footfall.llm import simhash_dedup as S
from tests.conftest import SF_SMALL
from tests.llm import brute


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    prints = [brute.simhash(r.text) for r in rows]
    roots = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for r, root in zip(rows, roots):
        smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    want = {r.doc_id: (_signed(p), smallest[root]) for r, p, root in zip(rows, prints, roots)}
    got = {r.doc_id: (r.fp, r.component_id) for r in S.simhash_components(docs).collect()}
    assert got == want


def test_grid_join_finds_every_pair_within_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:
        for distance in range(1, 6):
            prints.add(b ^ sum(1 << k for k in rng.sample(range(64), distance)))
    prints = sorted(_signed(p) for p in prints)
    nodes = spark.createDataFrame([(p, p) for p in prints], "fp long, comp long")
    got = [tuple(sorted((r.a, r.b))) for r in S._cross_links(nodes, 4, 7).collect()]
    want = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert sorted(got) == sorted(want)  # each once
    p, q = F.col("fp"), F.col("other")
    pairs = spark.createDataFrame([(rng.choice(prints), rng.choice(prints)) for _ in range(200)], "fp long, other long")
    for r in pairs.select("*", S.manhattan(S.embedding(p), S.embedding(q)).alias("m")).collect():
        counts = [[(x >> 2 * k & 3).bit_count() for k in range(32)] for x in (r.fp, r.other)]
        assert r.m == sum(abs(a - b) for a, b in zip(*counts))


def test_crowded_cells_are_dealt_to_tiles_without_losing_a_pair(spark):
    # Fingerprints whose popcounts are all one, so every grid has a single cell.
    rng = random.Random(8)
    prints = {sum((1 + rng.getrandbits(1)) << 2 * k for k in range(32)) for _ in range(40)}
    prints |= {p ^ sum(3 << 2 * k for k in rng.sample(range(32), n)) for p in list(prints) for n in (1, 2, 3)}
    prints = sorted(map(_signed, prints))
    nodes = spark.createDataFrame([(p, p) for p in prints], "fp long, comp long")
    want = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert len(want) > 50
    for tile in (10, 4096):
        got = [tuple(sorted((r.a, r.b))) for r in S._cross_links(nodes, 4, 7, tile).collect()]
        assert sorted(got) == sorted(want)  # each once
    cells = S._cells(nodes, [(0, 1, 2)], S.group_masks(7))
    left, right = S._tiled(cells, 10)
    for side in (left, right):
        counts = side.groupBy("tile_x", "tile_y").count().collect()
        assert len(counts) == math.ceil(len(prints) / 10) ** 2 and max(r["count"] for r in counts) <= 30


def test_groups_follow_the_number_of_fingerprints():
    chosen = [S.groups_for(10 ** k, 4) for k in range(12)]
    assert chosen == sorted(chosen) and chosen[0] == S.LEAST_GROUPS and chosen[10] >= 10
    assert S.groups_for(100, 0) == 7 and S.groups_for(10 ** 6, 31) == 32


def test_edge_rows(spark, edge_docs, no_docs):
    rows = S.simhash_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    # Without words: fingerprint 0, and all linked; the id-less null text too.
    assert by_id[5] == by_id[6] == by_id[8] == {(0, 5)} and (0, 5) in by_id[None]
    assert len(by_id[1]) == 1 and {c for _, c in by_id[2]} == {1}
    kept = S.one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and 2 not in ids and 6 not in ids and 5 in ids  # rows of one id stay together
    assert ids.count(None) == 2  # the group of one of them has no other id
    assert S.simhash_components(no_docs).count() == 0 and S.one_per_group(no_docs).count() == 0
