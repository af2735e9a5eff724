"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of K centroids (K-means
on a bounded sample).  A vector's cell is its pair of nearest centroids, one of
K * K in the product grid.  From each vector the cells are visited in the order
of the multi-sequence algorithm (increasing sum of the two squared distances to
the centroids) until the sum exceeds the nearest cell's by a calibrated gap: the
gap within which the cells of ``target_recall`` of neighbours at exactly the
least similarity lie.  Closer neighbours are found more often.  Every vector of
a visited cell is then compared by its exact cosine.

Equal vectors are one node with a weight, whatever the number of copies.  A pair
of cells is compared from one side only.  The members and the visitors of a cell
are dealt to tiles of bounded size, so a crowded cell is many small products, and
a tile returns link counts and one edge per linked node, never its pairs.

Vectors of different lengths have no cosine: each length has an index of its own,
and cells of its own in the same tiles.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from footfall.llm.components import connected_components
from footfall.llm.stages import Shared, stage


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def _k_means(points: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    centres = points[random.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(axis=1)
        for c in range(len(centres)):
            if (own := nearest == c).any():
                centres[c] = points[own].mean(axis=0)
    return centres


MOST_CODEWORDS = 1024  # 2 ** 20 cells, whose counts are broadcast


class MultiIndex:
    """Codebooks of the halves and the gap up to which cells are visited."""

    def __init__(self, sample: np.ndarray, codewords: int, similarity: float, target_recall: float, seed: int = 7):
        random = np.random.default_rng(seed)
        self.size = sample.shape[1]
        self.half = self.size // 2
        self.books = [_k_means(part, codewords, 10, random) if part.shape[1] else np.zeros((1, 0))
                      for part in (sample[:, :self.half], sample[:, self.half:])]
        self.width = len(self.books[1])
        # Neighbours at exactly the least similarity, in random directions.
        x = sample[random.integers(0, len(sample), 4000)]
        away = random.standard_normal(x.shape)
        away -= (away * x).sum(axis=1)[:, None] * x
        away /= np.maximum(np.linalg.norm(away, axis=1), 1e-12)[:, None]
        y = similarity * x + np.sqrt(1 - similarity**2) * away
        first, second = self.halves(x)
        a, b = (d.argmin(axis=1) for d in self.halves(y))
        each = np.arange(len(x))
        gaps = first[each, a] + second[each, b] - first.min(axis=1) - second.min(axis=1)
        self.gap = float(np.quantile(gaps, target_recall)) + 1e-9

    def halves(self, unit: np.ndarray) -> list[np.ndarray]:
        return [_distances(part, book)
                for part, book in zip((unit[:, :self.half], unit[:, self.half:]), self.books)]

    def visited(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells of one vector by increasing distance, up to the gap; its own is first."""
        rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        limit = first[rows[0]] + second[columns[0]] + self.gap
        queue, out, seen = [(first[rows[0]] + second[columns[0]], 0, 0)], [], {(0, 0)}
        while queue:
            distance, i, j = heapq.heappop(queue)
            if distance > limit:
                break
            out.append(rows[i] * self.width + columns[j])
            for n in ((i + 1, j), (i, j + 1)):
                if n not in seen and n[0] < len(rows) and n[1] < len(columns):
                    seen.add(n)
                    heapq.heappush(queue, (first[rows[n[0]]] + second[columns[n[1]]], *n))
        return out


def _unit(packed: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows
    or vanishes."""
    table = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(float)
    table /= np.abs(table).max(axis=1)[:, None]
    return table / np.linalg.norm(table, axis=1)[:, None]


def codewords_for(n: int) -> int:
    """K for n vectors: cells grow with n, by a power at which visited cells and compared
    vectors grow evenly."""
    return int(min(MOST_CODEWORDS, max(8, round(1.5 * n ** (1 / 3)))))


def _packed_rows(embeddings: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(vec_id, size, key, packed) of every row; key is null for a vector that
    links with nothing: null, zero, or with null or non-finite components."""
    kind = "<f4" if isinstance(embeddings.schema[vector_col].dataType.elementType, FloatType) else "<f8"
    element = "float" if kind == "<f4" else "double"
    narrow = embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                               F.col(vector_col).cast(f"array<{element}>").alias("vector"))

    def pack(batches):
        for batch in batches:
            keys, sizes, packed = [], [], []
            for values in batch.column(1).to_pylist():
                usable = values and None not in values
                vector = np.array(values, kind) + np.array(0, kind) if usable else None  # -0.0 becomes 0.0
                if usable and np.isfinite(vector).all() and vector.any():
                    packed.append(vector.tobytes())
                    keys.append(hashlib.blake2b(packed[-1], digest_size=16).digest())
                    sizes.append(len(values))
                else:
                    for column in (packed, keys, sizes):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                ["vec_id", "size", "key", "packed"])

    return narrow.mapInArrow(pack, "vec_id long, size int, key binary, packed binary"), kind


def _tile_links(tiled: DataFrame, kind: str, similarity: float) -> DataFrame:
    """(node, links, root) of each node with a link in a tile: the weight of the
    nodes it links with there, and the smallest node that it reaches in it."""

    def compare(cell, rows):
        inside, outside = ([r for r in rows if r[3] == role] for role in (0, 1))
        if not inside or not outside:
            return []
        keys = sorted({r[4] for r in rows})
        number = {k: i for i, k in enumerate(keys)}
        own = np.array([number[r[4]] for r in inside])
        visitor = np.array([number[r[4]] for r in outside])
        allowed = (np.array([r[5] for r in outside]) < cell)[:, None] | (visitor[:, None] < own)
        hit = (_unit([r[6] for r in outside], kind) @ _unit([r[6] for r in inside], kind).T >= similarity) & allowed
        if not hit.any():
            return []
        links = np.zeros(len(keys), np.int64)
        np.add.at(links, visitor, hit @ np.array([r[7] for r in inside]))
        np.add.at(links, own, np.array([r[7] for r in outside]) @ hit)
        a, b = np.nonzero(hit)
        a, b = visitor[a], own[b]
        root = np.arange(len(keys))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        linked = np.unique(np.concatenate([a, b]))
        return [(keys[i], int(links[i]), keys[root[i]]) for i in linked.tolist()]

    def run(batches):
        """Rows of a tile come one after the other; one tile is held at a time."""
        now, rows = None, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != now:
                    if rows:
                        out += compare(now[0], rows)
                    now, rows = row[:3], []
                rows.append(row)
            yield _links_batch(out)
        if rows:
            yield _links_batch(compare(now[0], rows))

    return (tiled.repartition("cell", "tile", "chunk").sortWithinPartitions("cell", "tile", "chunk")
            .mapInArrow(run, "node binary, links long, root binary"))


def _links_batch(rows):
    nodes, links, roots = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())],
        ["node", "links", "root"])


def embedding_components(embeddings: DataFrame, similarity: float = 0.95, codewords: int | None = None,
                         sample_rows: int = 20_000, target_recall: float = 0.999, tile_rows: int = 256,
                         id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``embeddings``: ``vec_id, n_links`` (other rows with a
    cosine of at least ``similarity`` that were found), ``component_id`` (smallest
    vec_id reachable over links), ``kept`` (it is that one itself).

    Vectors of equal length are compared; null and zero vectors and those with null
    or non-finite components link with nothing.  Equal vectors always link.  Rows with the same vec_id are
    rows of their own; a null vec_id takes part and is never a component_id if its
    component has another.  ``codewords`` (K) follows the number of different
    vectors of a length unless given.  The codebooks are fitted on ``sample_rows`` vectors
    chosen by their hash (dealt equally to the lengths, 256 of each at least); every
    vector is indexed.
    """
    packed, kind = _packed_rows(embeddings, id_col, vector_col)
    rows = stage(packed, "vectors")
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.max("size").alias("size"),
        F.max("packed").alias("packed"))
    nodes = stage(nodes, "nodes")
    sizes = nodes.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect()
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not sizes:
        return alone
    share, indexes, base = max(256, sample_rows // len(sizes)), {}, 0
    for size, n in sizes:
        sample = nodes.where(F.col("size") == size).orderBy("key").limit(share).select("packed").collect()
        own = MultiIndex(_unit([bytes(r["packed"]) for r in sample], kind), codewords or codewords_for(n), similarity,
                         target_recall)
        indexes[size] = own, base  # the cells of a length are numbered from its base
        base += len(own.books[0]) * own.width
    shared = Shared(embeddings.sparkSession, indexes)

    def place(batches):
        for batch in batches:
            lengths = np.array(batch.column(3))
            for size in np.unique(lengths):
                rows_of = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names).take(
                    pa.array(np.flatnonzero(lengths == size)))
                index, start = shared.value[int(size)]
                first, second = index.halves(_unit(rows_of.column(1).to_pylist(), kind))
                cells = [index.visited(a, b) for a, b in zip(first, second)]
                # Each pair of cells is compared from the lower one.
                visits = [[start + c for c in v if c >= v[0]] for v in cells]
                yield pa.RecordBatch.from_arrays(
                    [*rows_of.columns[:3], pa.array([start + v[0] for v in cells], pa.int64()),
                     pa.array(visits, pa.list_(pa.int64()))], ["key", "packed", "weight", "own", "visits"])

    placed = stage(nodes.select("key", "packed", "weight", "size").mapInArrow(
        place, "key binary, packed binary, weight long, own long, visits array<long>"), "placed")
    visitors = placed.select("key", F.explode("visits").alias("cell"), "own")
    # Both tables of counts have a row for each cell, codewords squared at most for a length.
    tiles = placed.groupBy(F.col("own").alias("cell")).agg(
        F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    chunks = visitors.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks"))
    shape = F.broadcast(stage(tiles.join(chunks, "cell"), "shape"))
    deal = F.xxhash64("key")
    members = (placed.withColumn("cell", F.col("own")).join(shape, "cell")
               .select("cell", F.pmod(deal, F.col("tiles")).cast("int").alias("tile"),
                       F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"),
                       F.lit(0).alias("role"), "key", "own", "packed", "weight"))
    guests = (placed.select("key", "own", "packed", "weight", F.explode("visits").alias("cell")).join(shape, "cell")
              .select("cell", F.explode(F.expr("sequence(0, tiles - 1)")).alias("tile"),
                      F.pmod(deal, F.col("chunks")).cast("int").alias("chunk"),
                      F.lit(1).alias("role"), "key", "own", "packed", "weight"))
    found = stage(_tile_links(members.union(guests), kind, similarity), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = stage(
        nodes.join(links, nodes["key"] == links["node"], "left").drop("node")
        .join(roots, nodes["key"] == roots["node"], "left")
        .select("key", "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("root", "key").alias("root")), "known")
    smallest = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = stage(known.join(smallest, "root").select("key", "n_links", "component_id"), "named")
    linked = (rows.where("key is not null").select("vec_id", "key").join(named, "key")
              .select("vec_id", "n_links", "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))
    return linked.union(alone)
