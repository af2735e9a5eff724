"""Vector code compression: product codes whose codebooks are fitted by exact
integer k-means over anchors-hierarchy metric trees.

Every vector becomes integers ``floor(scale * x)`` and is cut into equal parts.
The vectors are gathered in blocks of bounded size; each block has one metric
tree per part position, built middle-out: the square root of its points as
anchors, every anchor owning the points nearest to it, anchors merged upwards
pair by pair and split downwards by the same rule.  A ball caches the sum and the
count of its points.  A round passes the codebook down each tree: a ball inherits
the candidate entries of its parent, drops those that are farther than its best
entry from every point it can hold, and is done when one candidate is left, by
adding the cached sum and count to it.  Only points of undecided leaves are
compared one by one.  The result is that of plain k-means: entries are dropped
only when strictly farther, beyond rounding.

Blocks and trees are written once.  The driver holds the codebooks alone
(``parts * entries`` parts for every vector length).
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType

from footfall.llm.stages import Shared, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_ROWS = 4096          # vectors of a block, fewer when they are long
BLOCK_COMPONENTS = 1 << 20
LEAF_POINTS = 64
LIMB_BITS = 40             # sums travel in limbs of this many bits
HOT_SHARE = 1000           # labels with at least this part of all rows are joined by broadcast


# ----- metric trees ---------------------------------------------------------

def _norms(points: np.ndarray) -> np.ndarray:
    return np.sqrt((points * points).sum(axis=1))


def _anchors(points: np.ndarray, rows: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The rows dealt to at most ``wanted`` anchors: each new anchor is the
    farthest point of the widest ball and takes the points nearer to it.  An
    anchor's points are sorted by distance, so one that is nearer than half the
    way to the new anchor ends the search in its list."""
    pivots, owned, far = [rows[0]], [rows], [_norms(points[rows] - points[rows[0]])]
    order = np.argsort(-far[0], kind="stable")
    owned[0], far[0] = owned[0][order], far[0][order]
    while len(pivots) < wanted:
        widest = max(range(len(pivots)), key=lambda a: far[a][0])
        if far[widest][0] == 0:
            break
        pivot = owned[widest][0]
        apart = _norms(points[pivots] - points[pivot])
        taken, taken_far = [], []
        for a in range(len(pivots)):
            reach = int(np.searchsorted(-far[a], -apart[a] / 2))
            if not reach:
                continue
            to_new = _norms(points[owned[a][:reach]] - points[pivot])
            nearer = np.flatnonzero(to_new < far[a][:reach])
            if len(nearer):
                taken.append(owned[a][nearer])
                taken_far.append(to_new[nearer])
                owned[a], far[a] = np.delete(owned[a], nearer), np.delete(far[a], nearer)
        rows_new, far_new = np.concatenate(taken), np.concatenate(taken_far)
        order = np.argsort(-far_new, kind="stable")
        pivots.append(pivot)
        owned.append(rows_new[order])
        far.append(far_new[order])
    return owned


def _ball(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    centre = points[rows].mean(axis=0)
    return centre, float(_norms(points[rows] - centre).max())


def _grow(points: np.ndarray, rows: np.ndarray):
    """A nested tree: rows of a leaf, or a pair of subtrees."""
    if len(rows) <= LEAF_POINTS:
        return rows
    owned = _anchors(points, rows, int(np.ceil(np.sqrt(len(rows)))))
    if len(owned) == 1:
        return rows
    trees = [_grow(points, o) for o in owned]
    balls = [_ball(points, o) for o in owned]
    centres, radii = np.array([c for c, _ in balls]), np.array([r for _, r in balls])
    counts, alive = np.array([len(o) for o in owned], float), np.ones(len(owned), bool)

    def cost(a: int) -> np.ndarray:
        d = _norms(centres - centres[a])
        both = np.maximum((d + radii + radii[a]) / 2, np.maximum(radii, radii[a]))
        both[~alive] = np.inf
        both[a] = np.inf
        return both

    table = np.array([cost(a) for a in range(len(owned))])
    for _ in range(len(owned) - 1):
        a, b = divmod(int(table.argmin()), len(owned))
        radius, n = table[a, b], counts[a] + counts[b]
        trees[a], trees[b] = (trees[a], trees[b]), None
        centres[a] = (centres[a] * counts[a] + centres[b] * counts[b]) / n
        radii[a], counts[a], alive[b] = radius, n, False
        table[b, :], table[:, b] = np.inf, np.inf
        table[a, :] = table[:, a] = cost(a)
    return trees[int(np.flatnonzero(alive)[0])]


def anchors_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """The metric tree of a block's parts (float64 holding integers): the points in tree
    order, and for every ball its range in them, children (-1: leaf), exact sum,
    centre and radius."""
    lo, hi, left, right, order = [], [], [], [], []
    pending = [(_grow(points, np.arange(len(points))), -1, False)]
    while pending:  # depth first, left before right: each ball's points are one range
        tree, parent, is_right = pending.pop()
        if tree is None:
            hi[parent] = len(order)
            continue
        node = len(lo)
        lo.append(len(order))
        hi.append(-1)
        left.append(-1)
        right.append(-1)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        if isinstance(tree, tuple):
            pending += [(None, node, False), (tree[1], node, True), (tree[0], node, False)]
        else:
            order.extend(tree.tolist())
            hi[node] = len(order)
    lo, hi, order = np.array(lo), np.array(hi), np.array(order)
    laid = points[order]
    running = np.vstack([np.zeros((1, points.shape[1])), laid.cumsum(axis=0)])
    sums = running[hi] - running[lo]
    centres = sums / (hi - lo)[:, None]
    radii = np.array([_norms(laid[a:b] - c).max() for a, b, c in zip(lo, hi, centres)])
    return {"order": order, "points": laid, "lo": lo, "hi": hi, "left": np.array(left), "right": np.array(right),
            "sums": sums, "centres": centres, "radii": radii}


def _firsts(entries: list[tuple[int, ...]]) -> np.ndarray:
    """Entries that are no copy of one before them."""
    seen: dict[tuple[int, ...], int] = {}
    return np.array([seen.setdefault(e, i) == i for i, e in enumerate(entries)])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)


def assign(tree: dict[str, np.ndarray], entries: list[tuple[int, ...]]):
    """Nearest entry of every point (tree order, ties to the lower index), and
    the sums and counts of the points of every entry."""
    book = np.array(entries, float).reshape(len(entries), -1)
    gaps = np.sqrt(np.maximum(_squared(book, book), 0))
    codes = np.empty(len(tree["order"]), np.int64)
    sums, counts = np.zeros(book.shape), np.zeros(len(entries), np.int64)
    balls = np.zeros(1, np.int64)
    lists = _firsts(entries)[None, :]
    while len(balls):
        centres, radii = tree["centres"][balls], tree["radii"][balls]
        far = _squared(centres, book)
        best = np.where(lists, far, np.inf).argmin(axis=1)
        ahead = far - far[np.arange(len(balls)), best][:, None]
        # An entry loses in the whole ball beyond 2 r |entry - best|; the rest is room for rounding.
        room = 1e-9 * (1 + (centres * centres).sum(axis=1) + (book * book).sum(axis=1).max())
        lists = lists & (ahead <= 2 * radii[:, None] * gaps[best] * (1 + 1e-9) + room[:, None])
        single = lists.sum(axis=1) == 1
        for ball, entry in zip(balls[single], best[single]):
            codes[tree["lo"][ball]:tree["hi"][ball]] = entry
            sums[entry] += tree["sums"][ball]
            counts[entry] += tree["hi"][ball] - tree["lo"][ball]
        leaf = ~single & (tree["left"][balls] < 0)
        if leaf.any():
            sizes = (tree["hi"] - tree["lo"])[balls[leaf]]
            rows = np.concatenate([np.arange(tree["lo"][b], tree["hi"][b]) for b in balls[leaf]])
            columns = np.flatnonzero(lists[leaf].any(axis=0))
            open_to = np.repeat(lists[leaf][:, columns], sizes, axis=0)
            near = np.where(open_to, _squared(tree["points"][rows], book[columns]), np.inf)
            codes[rows] = columns[near.argmin(axis=1)]
            np.add.at(sums, codes[rows], tree["points"][rows])
            np.add.at(counts, codes[rows], 1)
        inner = ~single & ~leaf
        balls = np.concatenate([tree["left"][balls[inner]], tree["right"][balls[inner]]])
        lists = np.concatenate([lists[inner], lists[inner]])
    return codes, sums, counts


# ----- exact arithmetic on both ranges of values -----------------------------

def _fits(points: np.ndarray, entries: list[tuple[int, ...]]) -> bool:
    """Whether all squared distances and sums are exact in double precision."""
    top = max([float(np.abs(points).max(initial=0))] + [float(abs(x)) for e in entries for x in e])
    return 4 * top * top * max(1, points.shape[1]) < 2 ** 53 and top * max(1, len(points)) < 2 ** 53


def _assign_part(tree: dict[str, np.ndarray], entries: list[tuple[int, ...]]):
    """Codes and squared distances in block order, sums and counts by entry, as
    Python integers where they could pass 53 bits (no tree is used there)."""
    points = tree["points"]
    if _fits(points, entries):
        codes, sums, counts = assign(tree, entries)
        book = np.array(entries, float).reshape(len(entries), -1)
        errors = ((points - book[codes]) ** 2).sum(axis=1).astype(np.int64)
        total = {e: [int(x) for x in sums[e]] for e in np.flatnonzero(counts)}
    else:
        rows = [[int(x) for x in p] for p in points]
        far = [[sum((x - y) ** 2 for x, y in zip(p, e)) for e in entries] for p in rows]
        codes = np.array([f.index(min(f)) for f in far])
        errors, counts = np.array([min(f) for f in far], object), np.bincount(codes, minlength=len(entries))
        total = {e: [sum(rows[i][j] for i in np.flatnonzero(codes == e)) for j in range(points.shape[1])]
                 for e in np.flatnonzero(counts)}
    back = np.argsort(tree["order"])
    return codes[back], errors[back], total, counts


# ----- Spark steps ------------------------------------------------------------

def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vector"))
            .where(v.isNotNull() & finite))


def _whole_numbers(rows, length: int, parts: int, scale: int) -> np.ndarray:
    """``floor(scale * x)``, padded with zeros to equal parts.  A product beyond
    double precision's range stays at its end."""
    width = -(-length // parts)
    out = np.zeros((len(rows), parts * width))
    with np.errstate(over="ignore"):
        out[:, :length] = np.floor(np.array(rows, float).reshape(len(rows), length) * scale)
    return np.nan_to_num(out)


def _blocks(kept: DataFrame, parts: int, scale: int) -> DataFrame:
    """(length, ids, labels, trees): one row for every block of vectors of one length."""
    id_type, label_type = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    schema = (f"length int, ids {ArrayType(id_type).simpleString()}, "
              f"labels {ArrayType(label_type).simpleString()}, trees array<binary>")
    kinds = [pa.int32(), pa.list_(to_arrow_type(id_type)), pa.list_(to_arrow_type(label_type)), pa.list_(pa.binary())]

    def block(length, rows):
        ids, labels, vectors = zip(*rows)
        numbers = _whole_numbers(vectors, length, parts, scale)
        trees = [pickle.dumps(anchors_tree(np.ascontiguousarray(p)), 5) for p in np.split(numbers, parts, axis=1)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip((length, list(ids), list(labels), trees), kinds)],
            ["length", "ids", "labels", "trees"])

    def run(batches):
        waiting = defaultdict(list)
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                length = len(row[2])
                waiting[length].append(row)
                if len(waiting[length]) >= max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // max(1, length))):
                    yield block(length, waiting.pop(length))
        for length, rows in waiting.items():
            yield block(length, rows)

    return kept.mapInArrow(run, schema)


def _limbs(value: int):
    sign, value, place = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while True:
        yield place, sign * (value & ((1 << LIMB_BITS) - 1))
        value >>= LIMB_BITS
        place += 1
        if not value:
            return


def _round(blocks: DataFrame, codebooks: dict[int, list[list[tuple[int, ...]]]]) -> dict[int, list[list[tuple[int, ...]]]]:
    """The codebooks with every used entry replaced by its parts' floored mean.
    Each task sends the sums and counts of its blocks, which Spark adds up."""
    shared = Shared(blocks.sparkSession, codebooks)

    def run(batches):
        sums: dict = defaultdict(int)
        for batch in batches:
            for length, trees in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part, packed in enumerate(trees):
                    _, _, total, counts = _assign_part(pickle.loads(packed.as_py()), shared.value[length][part])
                    for e, values in total.items():
                        sums[length, part, int(e), -1] += int(counts[e])
                        for j, x in enumerate(values):
                            sums[length, part, int(e), j] += x
        rows = [(*key, place, limb) for key, x in sums.items() for place, limb in _limbs(x)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             ["length", "part", "entry", "component", "place", "value"])

    keys = ["length", "part", "entry", "component", "place"]
    added = (blocks.select("length", "trees")
             .mapInArrow(run, ", ".join(f"{c} long" for c in [*keys, "value"]))
             .groupBy(*keys).agg(F.sum("value").alias("value")).collect())
    whole: dict = defaultdict(int)
    for length, part, entry, component, place, value in added:
        whole[length, part, entry, component] += value << (LIMB_BITS * place)
    return {length: [[e if not (n := whole.get((length, p, i, -1))) else
                      tuple(whole[length, p, i, j] // n for j in range(len(e))) for i, e in enumerate(entries)]
                     for p, entries in enumerate(book)] for length, book in codebooks.items()}


def fit(kept: DataFrame, blocks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE) -> dict[int, list[list[tuple[int, ...]]]]:
    """Codebooks by vector length: a list of entries for every part position."""
    codebooks = {}
    for (length,) in blocks.select("length").distinct().collect():
        first = (kept.where(F.size("vector") == length)
                 .orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect())
        numbers = _whole_numbers([r.vector for r in first], length, parts, scale)
        codebooks[length] = [[tuple(int(x) for x in e) for e in p] for p in np.split(numbers, parts, axis=1)]
    for _ in range(rounds):
        codebooks = _round(blocks, codebooks)
    return codebooks


def codebook_digest(book: list[list[tuple[int, ...]]]) -> str:
    text = ",".join(str(x) for entries in book for e in entries for x in e)
    return hashlib.sha256(text.encode()).hexdigest()


def _encode(blocks: DataFrame, codebooks) -> DataFrame:
    id_field, label_field = blocks.schema["ids"].dataType.elementType, blocks.schema["labels"].dataType.elementType
    shared = Shared(blocks.sparkSession, codebooks)
    id_kind, label_kind = to_arrow_type(id_field), to_arrow_type(label_field)

    def run(batches):
        digests = {}
        for batch in batches:
            for length, ids, labels, trees in zip(*(c.to_pylist() for c in batch.columns)):
                book = shared.value[length]
                if length not in digests:
                    digests[length] = codebook_digest(book)
                found = [_assign_part(pickle.loads(t), e)[:2] for t, e in zip(trees, book)]
                code = ["".join(f"{c:02x}" for c in row) for row in zip(*(c for c, _ in found))]
                error = [sum(map(int, row)) for row in zip(*(e for _, e in found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, id_kind), pa.array(labels, label_kind), pa.array(code),
                     pa.array([e if e < 1 << 63 else None for e in error], pa.int64()),
                     pa.array([digests[length]] * len(ids))],
                    ["vec_id", "label", "code", "error", "codebooks_sha256"])

    return blocks.mapInArrow(run, f"vec_id {id_field.simpleString()}, label {label_field.simpleString()}, "
                                  "code string, error long, codebooks_sha256 string")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: errors are added up before the shuffle.  A label with at least
    a thousandth of all rows (so at most a thousand labels) is joined by broadcast,
    the others by a shuffle in which no group is larger than that."""
    n = coded.count()
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("n"))
    sums = stage(sums.select(F.col("label").alias("_label"), F.col("total").try_cast("long").alias("label_error"),
                             (F.col("n") * HOT_SHARE >= n).alias("_hot")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("_label"))
    hot = F.broadcast(sums.where("_hot"))
    rare = coded.join(hot, same, "left_anti").join(sums.where("NOT _hot"), same)
    return coded.join(hot, same).unionByName(rare).drop("_label", "_hot")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
    """Product codes of all vectors: (codes, codebooks).

    ``codes`` has ``vec_id, label, code, error, codebooks_sha256, label_error``;
    ``codebooks`` maps a vector length to its entries by part position.

    Vectors that are null or hold null or non-finite components are dropped, repeated
    rows are kept.  Each vector length has codebooks of its own; a length that the
    parts don't divide is padded with zeros, and an empty vector has code zeros and no
    error.  Null ids sort last among the first entries, equal ids by vector.  Null
    labels are one label.  An error beyond 64 bits is null.  An empty table gives no
    rows.  Columns other than the three named are not read."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256: a code has two hex digits a part")
    kept = _kept(vectors, id_col, vector_col, label_col)
    blocks = stage(_blocks(kept, parts, scale), "vector-blocks")
    codebooks = fit(kept, blocks, parts, entries, rounds, scale)
    coded = stage(_encode(blocks, codebooks), "vector-codes")
    return _with_label_errors(coded), codebooks
