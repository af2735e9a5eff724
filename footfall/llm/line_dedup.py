"""Line dedup with a once-seen and a twice-seen Bloom filter.

1. Every task fills two Bloom filters over the distinct line hashes of its
   documents: bits seen once, and bits of hashes seen (at least) twice.
2. The tasks' filters are merged segment by segment: a hash in two tasks has its
   bits in the AND of their once-filters, so twice = twice1 | twice2 |
   (once1 & once2) has no false negatives.
3. Lines that the twice-filter holds are suspects; only they are shuffled.  An
   exact count of the documents of each line confirms repeats and picks the
   document that keeps the line.
4. Confirmed lines are taken out of the texts.

The filters are sized from the documents: four bits for each line that can be
long enough, so few lines are suspects without cause.  Beyond ``1 << MOST_BITS`` bits
(64 MB, what a task and a broadcast can hold) the line hashes are cut into ranges with
filters of their own, one after the other; only suspects and filters are ever moved.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import free_name, stage

_SEGMENT_BYTES = 1 << 13
LEAST_BITS, MOST_BITS = 20, 29
_BITS_PER_LINE = 4
_BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(_BLANK).lower()


def _is_long(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8")) >= least)


def long_keys(text: bytes | None, least: int) -> set[bytes]:
    """Distinct keys of at least ``least`` code points."""
    return {k for line in (text or b"").split(b"\n") if _is_long(k := line_key(line), least)}


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash, as columns."""
    mask = np.uint64((1 << bits) - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1).astype(np.int64)


def _get(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


class RepeatFilter:
    """Once-seen and twice-seen Bloom filters of one task."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(1 << (bits - 3), np.uint8)
        self.twice = np.zeros(1 << (bits - 3), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """``hashes``: those of one or more documents, distinct in each."""
        distinct, counts = np.unique(hashes, return_counts=True)
        at = _positions(distinct, self.bits)
        again = (counts > 1) | _get(self.once, at).all(axis=1)
        _set(self.twice, at[again].ravel())
        _set(self.once, at.ravel())

    def segments(self):
        """(segment, once bytes, twice bytes), compressed, of segments in use."""
        once, twice = (x.reshape(-1, _SEGMENT_BYTES) for x in (self.once, self.twice))
        for k in np.flatnonzero(once.any(axis=1)).tolist():
            yield k, zlib.compress(once[k].tobytes(), 1), zlib.compress(twice[k].tobytes(), 1)


def _hashes(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


def _in_range(hashes: np.ndarray, ranges: int, own: int) -> np.ndarray:
    """Which hashes lie in a range; of bits that give no filter positions."""
    if ranges == 1:
        return np.ones(len(hashes), bool)
    return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(ranges) == own


def filter_size(lines: int, most_bits: int = MOST_BITS) -> tuple[int, int]:
    """(log2 of the bits of a filter, number of hash ranges) for so many lines."""
    wanted = max(1, lines * _BITS_PER_LINE)
    if wanted <= 1 << most_bits:
        return max(LEAST_BITS, math.ceil(math.log2(wanted))), 1
    return most_bits, math.ceil(wanted / (1 << most_bits))


def possible_lines(docs: DataFrame, least: int) -> int:
    """At least the number of lines of ``least`` code points: in a text no more
    than it has lines, nor than its length has room for."""
    text = F.col("text").cast("string")
    size, lines = F.length(text), F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    room = F.floor((size + 1) / (least + 1))
    return int(docs.select(F.least(lines, room).alias("n")).agg(F.sum("n")).first()[0] or 0)


def twice_seen(docs: DataFrame, filter_bits: int, least: int, ranges: int = 1, own_range: int = 0) -> bytes:
    """Bits of the merged twice-seen filter of one range of hashes:
    ``2 ** filter_bits`` bits at most, whatever the input."""

    def fill(batches):
        own = RepeatFilter(filter_bits)
        for batch in batches:
            keys = [k for text in batch.column(0) for k in long_keys(_utf8(text), least)]
            hashes = _hashes(keys)
            own.add(hashes[_in_range(hashes, ranges, own_range)])
        rows = list(own.segments())
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*part), (pa.int32(), pa.binary(), pa.binary()))],
                ["segment", "once", "twice"])

    def merge(batches):
        """Rows of a segment come one after the other."""
        now, once, twice = None, None, None
        done: list[tuple[int, bytes]] = []
        for batch in batches:
            for k, o, t in zip(*(c.to_pylist() for c in batch.columns)):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if k != now:
                    if now is not None and twice.any():
                        done.append((now, twice.tobytes()))
                    now, once, twice = k, o.copy(), t.copy()
                else:
                    twice |= t | (once & o)
                    once |= o
        if now is not None and twice.any():
            done.append((now, twice.tobytes()))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in done], pa.int32()), pa.array([zlib.compress(t, 1) for _, t in done], pa.binary())],
                ["segment", "twice"])

    filters = docs.select(F.col("text").cast("string")).mapInArrow(fill, "segment int, once binary, twice binary")
    merged = (filters.repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(merge, "segment int, twice binary"))
    out = np.zeros((1 << (filter_bits - 3)) // _SEGMENT_BYTES * _SEGMENT_BYTES, np.uint8).reshape(-1, _SEGMENT_BYTES)
    for row in merged.collect():  # bounded by the filter's size
        out[row["segment"]] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out.tobytes()


def _utf8(scalar) -> bytes | None:
    value = scalar.as_buffer()
    return None if value is None else value.to_pybytes()


def repeated_lines(docs: DataFrame, min_docs: int = 3, least: int = 20, filter_bits: int | None = None,
                   ranges: int | None = None) -> DataFrame:
    """(doc_id, text_key, drops): per row the digests of the keys that it loses.

    ``text_key`` is the text's xxhash64; rows equal in both are one row here.

    A key found in at least ``min_docs`` documents (distinct doc_ids) stays only
    in the largest doc_id.  ``drops`` is a list of 16-byte digests, as many as the
    row's text has such lines at most, however many rows share its id.
    ``filter_bits`` (log2) and ``ranges`` are sized from the lines unless given."""
    if filter_bits is None:
        filter_bits, ranges = filter_size(possible_lines(docs, least))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _text_key())
    pairs = None
    for own in range(ranges or 1):
        found = _suspects(rows, least, filter_bits, ranges or 1, own)
        pairs = found if pairs is None else pairs.union(found)
    # A null doc_id counts as one document, smaller than all others.
    confirmed = stage(
        pairs.select("doc_id", "line").distinct().groupBy("line").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs).select("line", "keeper"), "confirmed")
    return (pairs.join(confirmed, "line").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "text_key").agg(F.collect_list("line").alias("drops")))


def _suspects(rows: DataFrame, least: int, filter_bits: int, ranges: int, own_range: int) -> DataFrame:
    """(doc_id, text_key, line) of the lines of one range of hashes that the
    twice-seen filter holds, written."""
    bitmap = rows.sparkSession.sparkContext.broadcast(twice_seen(rows, filter_bits, least, ranges, own_range))

    def suspects(batches):
        seen = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            ids, texts, keys = [], [], []
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                own = list(long_keys(_utf8(text), least))
                ids += [doc] * len(own)
                texts += [row] * len(own)
                keys += own
            hashes = _hashes(keys)
            held = _get(seen, _positions(hashes, filter_bits)).all(axis=1)
            hit = np.flatnonzero(held & _in_range(hashes, ranges, own_range)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in hit], pa.int64()), pa.array([texts[i] for i in hit], pa.int64()),
                 pa.array([_digest(keys[i]) for i in hit], pa.binary())],
                ["doc_id", "text_key", "line"])

    found = stage(rows.mapInArrow(suspects, "doc_id long, text_key long, line binary").distinct(), "suspects")
    bitmap.unpersist()
    return found


def _text_key():
    return F.xxhash64(F.col("text").cast("string")).alias("text_key")


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _without(text: bytes | None, drops, least: int) -> tuple[bytes, int, int]:
    """The kept lines joined by newlines, and how many there were and went."""
    lines = (text or b"").split(b"\n")
    if not drops:
        return text or b"", len(lines), 0
    gone = set(drops)
    kept = [x for x in lines if not (_is_long(k := line_key(x), least) and _digest(k) in gone)]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _with_drops(docs: DataFrame, min_docs: int, least: int, filter_bits: int | None) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the digests to drop, and its name."""
    drop_id, drop_key, drops = (free_name(docs, n) for n in ("_drop_id", "_drop_key", "_drops"))
    found = (stage(repeated_lines(docs, min_docs, least, filter_bits), "drops")
             .select(F.col("doc_id").alias(drop_id), F.col("text_key").alias(drop_key), F.col("drops").alias(drops)))
    # The table of drops grows with the documents: one kind of join at every size.
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(drop_id)) & (_text_key() == F.col(drop_key))
    joined = docs.join(found.hint("merge"), same, "left").drop(drop_id, drop_key)
    return joined, drops


def dedup_lines(docs: DataFrame, min_docs: int = 3, least: int = 20, filter_bits: int | None = None) -> DataFrame:
    """``docs`` with every repeated line removed from ``text``.

    A text is split at newlines; a line's key is the line without ASCII white
    space at its ends, A-Z lower-cased.  Keys of at least ``least`` code points
    found in at least ``min_docs`` documents lose all their lines except in the
    largest doc_id that holds it (there all of them stay).  Null texts stay null;
    rows that share a doc_id are one document; rows with a null doc_id together
    are one document, smaller than all others.  Other columns pass through.
    """
    joined, drops_col = _with_drops(docs, min_docs, least, filter_bits)
    rest = joined.drop(drops_col)
    names = rest.columns
    text_at, drops_at = joined.columns.index("text"), joined.columns.index(drops_col)

    def run(batches):
        for batch in batches:
            texts = [None if (t := _utf8(text)) is None else _without(t, drops, least)[0].decode("utf-8")
                     for text, drops in zip(batch.column(text_at), batch.column(drops_at).to_pylist())]
            columns = [pa.array(texts, pa.string()) if i == text_at else c
                       for i, c in enumerate(batch.columns) if i != drops_at]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, rest.schema)


def line_report(docs: DataFrame, min_docs: int = 3, least: int = 20, filter_bits: int | None = None) -> DataFrame:
    """Per document ``doc_id, n_lines`` (before), ``n_dropped, kept_sha256`` of
    the text that :func:`dedup_lines` leaves; a null text is one empty line."""
    joined, _ = _with_drops(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                            min_docs, least, filter_bits)

    def run(batches):
        for batch in batches:
            rows = [_without(_utf8(text), drops, least)
                    for text, drops in zip(batch.column(1), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows])],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
