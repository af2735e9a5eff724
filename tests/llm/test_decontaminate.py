import random

import numpy as np
import pytest

from footfall.llm import decontaminate as D
from tests.conftest import SF_SMALL
from tests.llm import brute


def _cases(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len(r.text) < 1500][:12]
    rng, out = random.Random(4), list(docs)
    for k in range(30):
        words = rng.choice(items)[1].split()
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = rng.choice(["zzz", words[0]])
        if k % 5 == 0:
            words.insert(rng.randrange(len(words)), "extra")
        if k % 7 == 0:
            words = [w.upper() + "," for w in words]
        base = rng.choice(docs).split()
        at = rng.randrange(len(base) + 1)
        out.append(" ".join(base[:at] + words + base[at:]))
    out.append(items[0][1] + " " + items[1][1])
    return items, out


def test_equal_to_brute_force(spark):
    items, texts = _cases(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, k): s for i, t in enumerate(texts) for k, s in brute.contained(t, items).items()}
    assert any(s < 1 for s in want.values()) and len(want) > 8
    for part_chars in (8_000_000, 1500):  # one part, several parts
        got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(docs, benchmark, part_chars=part_chars).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    kept = {r.doc_id for r in D.drop_contaminated(docs, benchmark, part_chars=1500).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}


def test_multi_index_holds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    index = D.SizeIndex(9, [(k, rng.integers(0, 2**63, 5, dtype=np.uint64)) for k in range(40)], 23)
    prints = index.prints[rng.integers(0, 40, 300)].copy()
    for i in range(300):
        for b in rng.choice(64, i % 30, replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(b)
    want = {(i, k) for i in range(300) for k in range(40) if int(prints[i] ^ index.prints[k]).bit_count() <= 23}
    window, item, distance = index.within_radius(prints)
    assert set(zip(window.tolist(), item.tolist())) == want and distance.max() <= 23


def test_edge_rows(spark, edge_docs, no_docs):
    benchmark = spark.createDataFrame(
        [(1, "alpha beta gamma delta epsilon zeta"), (2, "Alpha, beta, gamma, delta, epsilon; zeta!"), (3, None), (4, ""),
         (None, "other words"), (5, "lorem ipsum dolor lorem ipsum dolor lorem ipsum dolor")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated(edge_docs, benchmark).collect()),
                 key=lambda p: (p[0], p[1] or 0))
    assert got == [(1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (3, None), (7, 5)]
    out = D.drop_contaminated(edge_docs, benchmark)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count() - 5
    assert D.contaminated(edge_docs, benchmark.limit(0)).count() == 0
    assert D.contaminated(no_docs, benchmark).count() == 0 and D.drop_contaminated(no_docs, benchmark).count() == 0


def test_similar_windows_are_within_the_radius():
    """Edited items of similarity 0.8 and more, of 30 to 120 words: their fingerprints
    differ in at most 23 bits, and the index holds a part of all other pairs only."""
    rng, near = random.Random(3), []
    for _ in range(600):
        words = rng.choices(range(5000), k=rng.randrange(30, 121))
        edited = list(words)
        edited[rng.randrange(len(words))] = -1
        cache = {}
        a, b = (D.shingle_hashes(D._word_hashes([str(w) for w in x], cache), 5) for x in (words, edited))
        if D._similarity(D.Counter(a.tolist()), D.Counter(b.tolist())) >= 0.8:
            near.append(int(D.simhashes(a[None])[0] ^ D.simhashes(b[None])[0]).bit_count())
    assert len(near) > 400 and max(near) <= 23
    values = np.random.default_rng(5)
    index = D.SizeIndex(40, [(k, values.integers(0, 2**63, 36, dtype=np.uint64)) for k in range(201)], 23)
    prints = values.integers(0, 2**63, 500, dtype=np.uint64)
    blocks = prints.view(np.uint8).reshape(-1, 8)[:, ::-1]
    held = index.near[0][blocks[:, 0]]
    for b in range(1, D.BLOCKS):
        held = held | index.near[b][blocks[:, b]]
    share = np.unpackbits(held, axis=1, count=201).mean()
    assert 0.6 < share < 0.8  # eight blocks of 37 / 256 each: the price of 23 bits
    assert index.near.nbytes == 8 * 256 * 26  # a bit, not a byte, for an item
