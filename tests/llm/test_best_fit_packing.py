import json
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from footfall.llm import best_fit_packing as P  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece."""
    rooms, bins = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [b for b, r in enumerate(rooms) if r >= lengths[i]]
        if not fits:
            rooms.append(capacity)
            fits = [len(rooms) - 1]
        b = min(fits, key=lambda b: rooms[b])
        rooms[b] -= lengths[i]
        bins[i] = b
    return len(rooms)


def fewest(lengths, capacity):
    """Exact by search."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= lengths[i]:
                rest = list(rooms)
                rest[rest.index(r)] -= lengths[i]
                place(i + 1, rest)
        place(i + 1, rooms + [capacity - lengths[i]])

    place(0, [])
    return best[0]


def check_layout(lengths, bins, offsets, made, capacity):
    own = {}
    for n, b, o in zip(lengths, bins, offsets):
        own.setdefault(b, []).append((o, n))
    assert sorted(own) == list(range(made))
    for places in own.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity


@pytest.mark.parametrize("seed", range(6))
def test_packing_equals_one_by_one_and_bounds_hold(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 64 if seed % 2 else 40) for _ in range(400)]
    bins, offsets, made = P.best_fit_decreasing(lengths, 64)
    check_layout(lengths, bins, offsets, made, 64)
    assert made == one_by_one(lengths, 64)
    assert P.lower_bound(np.bincount(lengths, minlength=65), 64) <= made
    for _ in range(60):
        few = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        assert P.lower_bound(np.bincount(few, minlength=21), 20) <= fewest(few, 20)


def test_dual_feasible_functions_beat_the_volume():
    counts = np.zeros(1025, int)
    counts[513] = 10
    assert P.lower_bound(counts) == 10          # no two fit
    counts = np.zeros(1025, int)
    counts[342] = 9
    assert P.lower_bound(counts) == 5           # two in a sequence, by u(2)
    assert P.best_fit_decreasing([342] * 9)[2] == 5


def test_ids_equal_the_library(library):
    rng = random.Random(5)
    texts = ["", "<|endoftext|> a", "zq" * 2000, " " * 3000, "\x1c\x85\xa0 don't  \r\n\t'll 123é日本"]
    texts += ["".join(rng.choice(" 'sadeté1_.,\n\t\x1c\x85\xa0ßж日​") for _ in range(rng.randrange(60))) for _ in range(500)]
    vocabulary = P.Vocabulary(PATH, PATTERN)
    assert [vocabulary.ids(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(vocabulary.ranks) == 50_256 and json.load(open(PATH))["model"]["vocab"]["!"] == vocabulary.ranks[b"!"]


def check_packed(rows, texts, library, capacity=1024):
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and len(own) == r.length
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        assert sum(r.length for r in own) == len(ids[d]) and all(r.length == capacity for r in own[1:])
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        assert own[-1].offset + own[-1].length <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("pool_rows", [P.POOL_ROWS, 40])
def test_documents(spark, library, pool_rows):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = P.pack_documents(docs, PATH, PATTERN, pool_rows=pool_rows).collect()
    made = check_packed(rows, texts, library)
    lengths = [r.length for r in rows]
    bound = P.lower_bound(np.bincount(lengths, minlength=1025))
    assert made <= one_by_one(lengths, 1024) + (0 if pool_rows > 40 else 4)
    assert made >= bound and (made > bound or all(r.certified for r in rows) or pool_rows == 40)


def test_pools_with_gaps_exchange(spark):
    """Small pools waste room; the exchange brings the count near that of one pool."""
    rng = random.Random(2)
    lengths = [rng.randint(1, 1023) for _ in range(1500)]
    rows = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                                 "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = P.pack(rows, pool_rows=100).collect()
    assert len(packed) == 1500
    one_round = P._pack_pools(rows, 0, 15, 1024).select("sequence_id").distinct().count()
    made = len({r.sequence_id for r in packed})
    assert P.lower_bound(np.bincount(lengths, minlength=1025)) <= made < one_round
    assert made <= 1.015 * one_by_one(lengths, 1024)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = P.pack_documents(edge_docs, PATH, PATTERN).collect()
    assert sum(r.start == 0 for r in rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id in (5, 6)}
    assert all(r.length == 1 and r.ids_crc32 == zlib.crc32((2).to_bytes(4, "little")) for r in by_id.values())
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 7)
    assert len(long) > 100 and all(n == 1024 for _, _, n in long[1:])
    assert P.pack_documents(no_docs, PATH, PATTERN).count() == 0


def test_sequences_hold_the_ids(spark, library):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four " * 1500)], "doc_id long, text string")
    packed = P.pack_documents(docs, PATH, PATTERN, keep_ids=True)
    out = P.sequences(packed).collect()
    assert all(len(r.ids) <= 1024 for r in out)
    want = sorted([*library.encode("one two three").ids, 2] + [*library.encode("four " * 1500).ids, 2])
    assert sorted(i for r in out for i in r.ids) == want
