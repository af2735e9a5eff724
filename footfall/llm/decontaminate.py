"""Benchmark decontamination by SimHash windows of the items' sizes.

Every benchmark item is a multiset of word shingles with a 64-bit SimHash, in
which each shingle votes with its number of occurrences.  For each item size
that occurs, a window of that many words slides over a document word by word.
Windows are looked up in a multi-index of the items of that size: the fingerprint
is cut into 8 blocks of 8 bits; two fingerprints within ``radius`` bits agree in
some block up to ``radius // 8`` bits, so the union over the blocks of the items
whose block is that close holds every item within the radius.  The candidates'
Hamming distance and then the exact weighted similarity (sum of the smaller over
sum of the larger shingle counts) decide.

Windows that share too few shingle hashes with all items together to reach the
similarity are not fingerprinted; that bound loses no match.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import Shared

WORD = re.compile(r"\w+")
BLOCKS = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WINDOWS = 2048
_CACHE_WORDS = 200_000


def normalised_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return WORD.findall((text or "").lower())


def _word_hashes(words: list[str], cache: dict[str, int]) -> np.ndarray:
    if len(cache) > _CACHE_WORDS:
        cache.clear()
    new = set(words).difference(cache)
    digest = xxhash.xxh3_64_intdigest
    cache.update((w, digest(w.encode("utf-8", "surrogatepass"))) for w in new)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, from the words' hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * _MIX + words[k:k + count]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def simhashes(shingles: np.ndarray) -> np.ndarray:
    """Fingerprint of each row of shingle hashes (one vote for each occurrence)."""
    rows, width = shingles.shape
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(rows, width, 8), axis=2)
    votes = 2 * bits.sum(axis=1, dtype=np.int32) > width
    return np.packbits(votes, axis=1).view(">u8").ravel().astype(np.uint64)


class SizeIndex:
    """Items of one size: fingerprints in a multi-index over blocks of bits."""

    def __init__(self, words: int, members: list[tuple[int, np.ndarray]], radius: int):
        self.words, self.radius = words, radius
        self.items = [k for k, _ in members]
        self.counts = [Counter(s.tolist()) for _, s in members]
        self.prints = simhashes(np.stack([s for _, s in members]))
        blocks = self.prints.astype(">u8").view(np.uint8).reshape(-1, BLOCKS)
        distance = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None, None] ^ blocks[None])
        #: near[b][v]: a bit for each item, set if its block b is close enough to the value v
        self.near = np.packbits(np.moveaxis(distance <= radius // BLOCKS, 2, 0), axis=2)

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item position, distance) of all pairs within the radius."""
        blocks = prints.astype(">u8").view(np.uint8).reshape(-1, BLOCKS)
        candidates = self.near[0][blocks[:, 0]]
        for b in range(1, BLOCKS):
            candidates |= self.near[b][blocks[:, b]]
        window, item = np.nonzero(np.unpackbits(candidates, axis=1, count=len(self.items)))
        distance = np.bitwise_count(prints[window] ^ self.prints[item])
        ok = distance <= self.radius
        return window[ok], item[ok], distance[ok]


class ItemIndex:
    """All items, by size."""

    def __init__(self, items: list[tuple[int, str | None]], shingle_words: int = 5,
                 similarity: float = 0.8, radius: int = 23):
        self.ids = [i for i, _ in items]
        self.shingle_words, self.similarity = shingle_words, similarity
        self._cache: dict[str, int] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, (_, text) in enumerate(items):
            words = normalised_words(text)
            if words:
                hashes = _word_hashes(words, self._cache)
                by_size.setdefault(len(words), []).append((k, shingle_hashes(hashes, min(shingle_words, len(words)))))
        self.sizes = [SizeIndex(n, members, radius) for n, members in sorted(by_size.items())]
        #: all items' shingle hashes, by the number of words of a shingle
        self.known = {}
        for s in self.sizes:
            k = min(shingle_words, s.words)
            self.known.setdefault(k, set()).update(h for c in s.counts for h in c)
        self.known = {k: np.array(sorted(v), np.uint64) for k, v in self.known.items()}

    def __getstate__(self):
        return {**self.__dict__, "_cache": {}}

    def matches(self, text: str | None) -> list[tuple[int, float, int, int, int]]:
        """(item number, similarity, first word, words, distance) of the best
        window of each item that the text contains; ties go to the first."""
        words = normalised_words(text)
        if not words:
            return []
        hashes = _word_hashes(words, self._cache)
        shingles, hits = {}, {}
        for k, known in self.known.items():
            shingles[k] = shingle_hashes(hashes, k)
            at = np.minimum(np.searchsorted(known, shingles[k]), len(known) - 1)
            found = known[at] == shingles[k]
            if found.any():
                hits[k] = np.concatenate([[0], np.cumsum(found)])
        best: dict[int, tuple[float, int, int, int]] = {}
        for size in self.sizes:
            k = min(self.shingle_words, size.words)
            if k not in hits:
                continue
            target = size.words - k + 1
            width = min(target, len(shingles[k]))  # a shorter text is one window
            # |A and B| / |A or B| >= s needs |A and B| >= s (|A| + |B|) / (1 + s)
            least = math.ceil(self.similarity * (target + width) / (1 + self.similarity) - 1e-9)
            starts = np.flatnonzero(hits[k][width:] - hits[k][:-width] >= least)
            for at in range(0, len(starts), _WINDOWS):
                part = starts[at:at + _WINDOWS]
                table = shingles[k][part[:, None] + np.arange(width)]
                for w, i, distance in zip(*(x.tolist() for x in size.within_radius(simhashes(table)))):
                    similarity = _similarity(Counter(table[w].tolist()), size.counts[i])
                    item = size.items[i]
                    if similarity >= self.similarity and similarity > best.get(item, (0.0,))[0]:
                        best[item] = (similarity, int(part[w]), width + k - 1, distance)
        return [(item, *best[item]) for item in sorted(best)]


def _similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def _indexes(benchmark: DataFrame, shingle_words: int, similarity: float, radius: int, part_chars: int):
    """Broadcast indexes of at most about ``part_chars`` characters of items each.

    A benchmark beyond one part is dealt to several by a hash of the item, so a
    broadcast (and what reaches the driver at a time) stays bounded."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / part_chars))
    for p in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        index = ItemIndex([(r["item_id"], r["text"]) for r in rows], shingle_words, similarity, radius)
        yield Shared(benchmark.sparkSession, index)


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, similarity: float = 0.8,
                 radius: int = 23, part_chars: int = 8_000_000) -> DataFrame:
    """One row for each document row and benchmark item that it contains:
    ``doc_id, item_id, similarity, start_word, n_words, distance`` of the item's
    most similar window (the first of equals).

    Words are lower-cased runs of letters, digits and underscores.  An item of
    fewer words than a shingle is one shingle; a text shorter than an item is one
    window.  Null or empty texts and items match nothing; items with the same text
    are reported each; empty tables give an empty result.  Other columns are
    ignored.  Documents are read once for each part of the benchmark and are not
    shuffled.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _indexes(benchmark, shingle_words, similarity, radius, part_chars):
        found = narrow.mapInArrow(_finder(index), "doc_id long, item_id long, similarity double, "
                                                  "start_word long, n_words long, distance int")
        out = found if out is None else out.union(found)
    return out


def _finder(index):
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32())
    names = ["doc_id", "item_id", "similarity", "start_word", "n_words", "distance"]

    def find(batches):
        for batch in batches:
            rows = [(doc, index.value.ids[item], *rest)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for item, *rest in index.value.matches(text.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return find


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, similarity: float = 0.8,
                      radius: int = 23, part_chars: int = 8_000_000) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item, as in :func:`contaminated`;
    all columns stay as they are.  Null and empty texts contain nothing and stay; an empty
    table or benchmark leaves ``docs`` as it is."""
    at = docs.columns.index("text")

    def keeper(index):
        def keep(batches):
            for batch in batches:
                clean = [not index.value.matches(text.as_py()) for text in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return keep

    for index in _indexes(benchmark, shingle_words, similarity, radius, part_chars):
        docs = docs.mapInArrow(keeper(index), docs.schema)
    return docs
