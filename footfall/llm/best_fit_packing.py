"""Best-fit packing of documents into token sequences of fixed capacity.

Documents are tokenized where they lie; a longer one than a sequence is cut into
whole sequences behind a shorter first piece.  Whole pieces need no packing.  The
others are dealt at random to pools of bounded size, and each pool is packed by
best-fit decreasing.  Dual-feasible functions of a pool's lengths bound its number
of sequences from below: where that bound is reached the packing is certified.
While the corpus as a whole is above its own bound, pools with a gap to
their bound, or with room for a whole sequence that documents of other pools could fill,
release the documents of their unfilled sequences, the others those of their emptiest
one.  Released documents are dealt to new, larger pools and packed again, until the
corpus is certified or a round saves no sequence.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from footfall.llm.stages import Shared, stage

CAPACITY = 1024
END_ID = 2
POOL_ROWS = 1 << 14   # documents packed by one task at a time
MAX_ROUNDS = 8
WIDEST = 3            # pools double with every round up to this power
FINEST = 24           # dual-feasible functions u(k) up to this k
_FLUSH_TOKENS = 1 << 20


# ----- bounds and packing of one pool -----------------------------------------

def lower_bound(counts, capacity: int = CAPACITY) -> int:
    """Fewest sequences for ``counts[x]`` pieces of length x, by the largest of the
    dual-feasible functions u(k) after f(t).

    f(t) counts pieces over ``capacity - t`` as whole and those under t as nothing;
    u(k) rounds ``(k + 1) x / capacity`` down to k-ths unless it is a whole number."""
    counts = np.asarray(counts, np.int64)
    x = np.arange(capacity + 1)
    t = np.arange(capacity // 2 + 1)
    whole = counts[::-1].cumsum()[::-1]                      # pieces of at least this length
    whole = np.append(whole, 0)[capacity - t + 1]
    best = 0
    for k in range(FINEST + 1):
        if k == 0:                                           # the length itself, in 1 / capacity
            weight, unit = x, capacity
        else:                                                # in 1 / (k * capacity)
            share = (k + 1) * x
            weight, unit = np.where(share % capacity == 0, k * x, share // capacity * capacity), k * capacity
        running = np.append(0, (counts * weight).cumsum())
        middle = running[capacity - t + 1] - running[t]      # t <= length <= capacity - t
        best = max(best, int((-(-(whole * unit + middle) // unit)).max()))
    return best


def best_fit_decreasing(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every piece and the number of sequences.

    Longest pieces first, each to the sequence with the least room that holds it.
    Equal pieces go together: a sequence that takes one is again the tightest, so
    it takes as many as fit."""
    lengths = np.asarray(lengths, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for same in np.split(order, cuts) if len(order) else []:
        size, at, room = int(lengths[same[0]]), 0, int(lengths[same[0]])
        while at < len(same):
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                by_room[capacity].append(made)
                made, room = made + 1, capacity
            here = by_room[room].pop()
            n = min(room // size, len(same) - at) if size else len(same) - at
            bins[same[at:at + n]] = here
            offsets[same[at:at + n]] = capacity - room + size * np.arange(n)
            by_room[room - n * size].append(here)
            at += n
    return bins, offsets, made


# ----- tokenizing ----------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the other bytes in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids of a byte-level BPE vocabulary file (``tokenizers`` JSON).  Merge order is id
    order there, so the ranks drive a rank-based encoder, built once in a worker.
    Names of special tokens in a text are ordinary text."""

    def __init__(self, path: str, pattern: str):
        alphabet = _byte_alphabet()
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        special = {t["content"] for t in content.get("added_tokens", [])}
        self.ranks = {bytes(alphabet[c] for c in token): i
                      for token, i in content["model"]["vocab"].items() if token not in special}
        self.pattern = pattern
        self._encoder = None

    def __getstate__(self):
        return self.__dict__ | {"_encoder": None}

    def ids(self, text: str) -> list[int]:
        if self._encoder is None:
            import tiktoken

            self._encoder = tiktoken.Encoding("vocabulary", pat_str=self.pattern, mergeable_ranks=self.ranks,
                                              special_tokens={})
        return self._encoder.encode_ordinary(text)


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: a longer document has whole pieces
    behind a first piece that may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece.

    Every row is a document of its own, also where ids repeat or are null; null and
    empty texts hold the end id alone.  Other columns are not read."""
    shared = Shared(docs.sparkSession, Vocabulary(path, pattern))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def run(batches):
        for batch in batches:
            names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            rows, owners, tokens = [], [], 0

            def flush():
                columns = zip(*rows) if rows else [[]] * len(names)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owners, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    ["doc_id", *names])

            for owner, text in enumerate(batch.column(1)):
                ids = np.array([*shared.value.ids(text.as_py() or ""), end_id], "<u4")
                for number, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((number, start, length, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] * keep_ids)))
                    owners.append(owner)
                tokens += len(ids)
                if tokens >= _FLUSH_TOKENS:
                    yield flush()
                    rows, owners, tokens = [], [], 0
            if rows:
                yield flush()

    return narrow.mapInArrow(run, schema)


# ----- packing ----------------------------------------------------------------------

def _pack_pools(rows: DataFrame, number: int, pools: int, capacity: int) -> DataFrame:
    """One round: ``rows`` dealt to pools and packed.  Adds ``sequence_id, offset``,
    ``fill`` (tokens in the sequence), ``pool``, ``gap`` (sequences over the bound) and
    ``room`` (sequences over the tokens' volume)."""
    own = rows.columns
    dealt = rows.withColumn("pool", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(pools)))
    result = rows.select("*", *[F.lit(0).cast("long").alias(c) for c in ("sequence_id", "offset", "fill", "pool", "gap", "room")])
    target = to_arrow_schema(result.schema)

    def run(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets, made = best_fit_decreasing(lengths, capacity)
        gap = made - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        fill = np.bincount(bins, weights=lengths, minlength=made).astype(np.int64)
        pool = table["pool"][0].as_py()
        more = [(number << 56 | pool << 28) + bins, offsets, fill[bins],
                *[np.full(len(bins), v, np.int64) for v in (pool, gap, made + -lengths.sum() // capacity)]]
        columns = [*[table[c] for c in own], *[pa.chunked_array([pa.array(c, pa.int64())]) for c in more]]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    return dealt.groupBy("pool").applyInArrow(run, result.schema)


def pack(cut: DataFrame, capacity: int = CAPACITY, pool_rows: int = POOL_ROWS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cut`` (from :func:`pieces`) with ``sequence_id, offset, certified``.

    ``certified``: the sequence belongs to a packing that no other can beat, of its pool
    or of the whole corpus.  Counts of every length (at most ``capacity``) and the
    number of sequences are all that the driver sees."""
    cut = stage(cut, "pieces")
    own = cut.columns
    whole = cut.where(F.col("length") == capacity).select(
        *own, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(True).alias("certified"))
    rest = cut.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rest.groupBy("length").count().collect():
        counts[length] = n
    n, bound, settled, used = int(counts.sum()), lower_bound(counts, capacity), [], 0
    before, limit = None, 0
    for number in range(max_rounds if n else 0):
        packed = stage(_pack_pools(rest, number, -(-n // (pool_rows << min(number, WIDEST))), capacity), "packed")
        filled = packed.groupBy("pool", "sequence_id").agg(
            F.max("fill").alias("fill"), F.max("gap").alias("gap"), F.max("room").alias("room"),
            F.count(F.lit(1)).alias("n"))
        made = filled.count()
        if before is not None and made >= limit:
            # Nothing saved: the released documents stay where they were.
            settled.append(before.withColumn("certified", F.col("gap") == 0))
            break
        emptiest = filled.groupBy("pool").agg(F.min_by("sequence_id", "fill").alias("emptiest"))
        freed = filled.join(emptiest, "pool").where(
            (F.col("fill") < capacity) & ((F.greatest("gap", "room") > 0) | (F.col("sequence_id") == F.col("emptiest"))))
        freed = stage(freed.select("sequence_id", "n"), "freed")
        out, released = freed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        if used + made <= bound or released < 2 or number == max_rounds - 1:
            settled.append(packed.withColumn("certified", F.lit(used + made <= bound) | (F.col("gap") == 0)))
            break
        settled.append(packed.join(freed, "sequence_id", "left_anti").withColumn("certified", F.col("gap") == 0))
        before = packed.join(freed.select("sequence_id"), "sequence_id", "left_semi")
        rest, n, limit, used = before.select(*own), out, released, used + made - released
    result = whole
    for part in settled:
        result = result.unionByName(part.select(*result.columns))
    return result


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   pool_rows: int = POOL_ROWS, keep_ids: bool = False) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset, certified`` (and ``ids``).

    Null and empty texts are the end id alone; repeated rows are packed each for
    itself; an empty table gives no rows; columns other than id and text are not read."""
    return pack(pieces(docs, path, pattern, capacity, end_id, keep_ids=keep_ids), capacity, pool_rows)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the token sequences of :func:`pack_documents`
    with ``keep_ids``.  A group is one sequence, so it is bounded by the capacity."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
