"""SimHash near-dedup by segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is mapped to 32 counts, the set bits of each two-bit
segment.  The Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints, so every pair within the radius r is also within
Manhattan distance r.  The 32 coordinates are cut into ``groups`` = k groups.
A distance of at most r leaves at least k - r groups without any difference
(each differing group costs 1), so the pair shares a unit cell of the grid over
one of the C(k, k - r) choices of k - r groups.  Joining on these cells loses
no pair; the Manhattan bound and then the exact Hamming distance decide.

The number of groups follows the number of fingerprints (finer grids have more
choices, but fewer fingerprints a cell), and a cell that is crowded all the same is
dealt to tiles, so no task compares more than two parts of a cell.

Links are collected in two passes, so that a large group of near copies emits
no list of all its pairs: first every fingerprint is compared with the smallest
one of its (coarse) cells, which contracts groups; then the full grid join
returns only links between different contracted groups.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import connected_components
from footfall.llm.stages import free_name, stage

SEED = 42
SEGMENTS = 32
_CHUNK = 1 << 16
#: Share of random pairs with equal counts in a segment: (1 + 4 + 1) / 16.
_EQUAL_SEGMENT = 0.375
#: Comparisons that cost as much as one row of the grid join.
_ROW_COST = 20
LEAST_GROUPS = 7
#: Fingerprints of a cell in one tile.
TILE = 4096


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """Signed 64-bit SimHash of a text; 0 for a null text or one without words.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text of
    fewer words than a shingle has one shingle, all its words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle_words:
        starts, ends = starts[:len(words) - shingle_words + 1], ends[shingle_words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        spans = zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row of ``docs``; whole texts, no shuffle."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return narrow.mapInArrow(hashed, "doc_id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(segments) -> int:
    return sum(3 << (2 * s) for s in segments)


def group_masks(groups: int) -> list[int]:
    """Bit mask of each group of segments (contiguous, sizes differ by one at most)."""
    return [_mask(part) for part in np.array_split(np.arange(SEGMENTS).astype(object), groups)]


def groups_for(count: int, radius: int) -> int:
    """Number of groups with the least expected work for so many fingerprints:
    each has a row for every choice of groups and meets its cell's others."""

    def work(groups: int) -> float:
        equal = groups - radius
        mates = count * _EQUAL_SEGMENT ** (SEGMENTS * equal / groups)
        return math.comb(groups, equal) * (1 + mates / _ROW_COST)

    least = min(max(LEAST_GROUPS, radius + 1), SEGMENTS)
    return min(range(least, max(least, min(radius + 12, SEGMENTS)) + 1), key=work)


def embedding(fp: Column) -> Column:
    """The 32 two-bit popcounts of a fingerprint, packed two bits each: the sum
    of two bits has their AND as its high and their XOR as its low bit."""
    upper, odd = F.shiftrightunsigned(fp, 1), F.lit(_signed(0x5555555555555555))
    return F.shiftleft(fp.bitwiseAND(upper).bitwiseAND(odd), 1).bitwiseOR(fp.bitwiseXOR(upper).bitwiseAND(odd))


def manhattan(p: Column, q: Column) -> Column:
    """Manhattan distance of two packed embeddings.

    Counts are spread to four-bit fields; 4 + a - b is then 2..6 in each field
    without borrowing, odd for a difference of one, and 2 or 6 for two."""
    total = None
    low, ones = F.lit(_signed(0x3333333333333333)), F.lit(_signed(0x1111111111111111))
    for shift in (0, 2):
        a = F.shiftrightunsigned(p, shift).bitwiseAND(low)
        b = F.shiftrightunsigned(q, shift).bitwiseAND(low)
        v = a.bitwiseXOR(F.lit(_signed(0x4444444444444444))) - b
        one = F.bit_count(v.bitwiseAND(ones))
        two = F.bit_count(F.shiftrightunsigned(v, 1).bitwiseAND(F.bitwise_not(v)).bitwiseAND(ones))
        part = one + two * 2
        total = part if total is None else total + part
    return total


def _cells(nodes: DataFrame, choices: list[tuple[int, ...]], masks: list[int]) -> DataFrame:
    """One row per node and choice of groups: its grid (bit set of the groups)
    and the coordinates in those groups."""
    grids = F.array(*[
        F.struct(F.lit(sum(1 << g for g in c)).alias("grid"),
                 F.col("e").bitwiseAND(F.lit(_signed(sum(masks[g] for g in c)))).alias("cell"))
        for c in choices])
    return (nodes.withColumn("e", embedding(F.col("fp")))
            .select("*", F.explode(grids).alias("g")).select(*nodes.columns, "e", "g.grid", "g.cell"))


def _within(a: str, b: str, radius: int) -> Column:
    return ((manhattan(F.col(f"{a}.e"), F.col(f"{b}.e")) <= radius)
            & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= radius))


def _hub_links(nodes: DataFrame, radius: int, groups: int) -> DataFrame:
    """Links of each fingerprint with the smallest one of its coarse cells (any
    run of just over half of the groups, cyclically)."""
    masks = group_masks(groups)
    width = groups // 2 + 1
    choices = [tuple(sorted((g + i) % groups for i in range(width))) for g in range(groups)]
    cells = _cells(nodes, choices, masks)
    hubs = stage(cells.groupBy("grid", "cell").agg(F.min("fp").alias("fp"), F.count("*").alias("n"))
                 .where("n > 1").select("grid", "cell", "fp", embedding(F.col("fp")).alias("e")), "hubs")
    return (cells.alias("x").join(hubs.alias("h"), ["grid", "cell"])
            .where((F.col("x.fp") != F.col("h.fp")) & _within("x", "h", radius))
            .select(F.col("x.fp").alias("a"), F.col("h.fp").alias("b")))


def _tiled(cells: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the grid join, with the columns ``tile_x`` and ``tile_y``.

    The fingerprints of a cell of more than ``tile`` are dealt to parts; a row of
    the left side goes to the tiles of its part with all parts, one of the right
    side to those of all parts with its own, so a pair meets in one tile."""
    crowded = stage(cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where(F.col("n") > tile)
                    .select("grid", "cell", F.ceil(F.col("n") / tile).cast("int").alias("parts")), "crowded")
    if crowded.isEmpty():
        zero = F.lit(0)
        cells = cells.withColumn("tile_x", zero).withColumn("tile_y", zero)
        return cells, cells
    dealt = (cells.join(crowded, ["grid", "cell"], "left")
             .withColumn("own", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("parts")), F.lit(0)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))))
    left = dealt.withColumn("tile_x", F.col("own")).withColumn("tile_y", F.col("other"))
    right = dealt.withColumn("tile_x", F.col("other")).withColumn("tile_y", F.col("own"))
    return left.drop("parts", "own", "other"), right.drop("parts", "own", "other")


def _cross_links(nodes: DataFrame, radius: int, groups: int, tile: int = TILE) -> DataFrame:
    """All links within the radius between nodes of different ``comp``, each once."""
    masks = group_masks(groups)
    cells = _cells(nodes, list(combinations(range(groups), groups - radius)), masks)
    left, right = _tiled(cells, tile)
    x, y = F.col("x.e"), F.col("y.e")
    # The pair meets in every grid made of its equal groups: keep the one made
    # of the lowest such groups.
    equal = sum((F.when(x.bitwiseXOR(y).bitwiseAND(F.lit(_signed(m))) == 0, 1 << g).otherwise(0)
                 for g, m in enumerate(masks)), F.lit(0))
    rest = equal
    for _ in range(groups - radius):
        rest = rest.bitwiseAND(rest - 1)
    return (left.alias("x").join(right.alias("y"), ["grid", "cell", "tile_x", "tile_y"])
            .where((F.col("x.fp") < F.col("y.fp")) & (F.col("x.comp") != F.col("y.comp"))
                   & _within("x", "y", radius) & (equal - rest == F.col("grid")))
            .select(F.col("x.comp").alias("a"), F.col("y.comp").alias("b")))


def simhash_components(docs: DataFrame, shingle_words: int = 4, radius: int = 4, groups: int | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Documents link when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest doc_id reachable over links.  Equal
    fingerprints are one node, whatever the number of copies.  More ``groups``
    make finer grids (fewer comparisons) and more rows per fingerprint; unless
    given, they follow the number of fingerprints (:func:`groups_for`).

    Null or empty texts have fingerprint 0 and link like others; rows with a
    repeated doc_id are rows of their own; a null doc_id takes part but is never
    a component_id unless no row of the component has an id (then it is null).
    Other columns of ``docs`` are ignored; an empty table gives an empty table.
    """
    if not 0 <= radius < (SEGMENTS if groups is None else groups):
        raise ValueError("radius must be smaller than groups")
    rows = stage(fingerprints(docs, shingle_words, id_col, text_col), "fp")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    groups = groups or groups_for(nodes.count(), radius)

    def contracted(links: DataFrame, key: str) -> DataFrame:
        roots = stage(connected_components(links), "roots").withColumnRenamed("node", key)
        return roots.withColumnRenamed("root", "new_comp")

    hubs = contracted(_hub_links(nodes.select("fp"), radius, groups), "fp")
    grouped = stage(nodes.join(hubs, "fp", "left")
                    .select("fp", "rep", F.coalesce("new_comp", "fp").alias("comp")), "grouped")
    cross = contracted(_cross_links(grouped.select("fp", "comp"), radius, groups), "comp")
    final = stage(grouped.join(cross, "comp", "left")
                  .select("fp", "rep", F.coalesce("new_comp", "comp").alias("comp")), "final")
    smallest = stage(final.groupBy("comp").agg(F.min("rep").alias("component_id")), "smallest")
    named = stage(final.join(smallest, "comp").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle_words: int = 4, radius: int = 4,
                  id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, the smallest doc_id.

    Rows that share an id are one document and stay or go together, and so do all
    rows with a null id: they stay when a component of theirs has no other id."""
    found = simhash_components(docs, shingle_words, radius, id_col=id_col)
    name = free_name(docs, "_kept_id")
    kept = stage(found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                 .select(F.col("doc_id").alias(name)).distinct(), "kept")
    # The kept ids grow with the documents: one kind of join at every size.
    return docs.join(kept.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_semi")
