"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

A text is split into pieces by the tokenizer's pattern.  The distinct pieces of
a chunk of texts are put into matrices of token ids, one row a piece, one matrix
for each length class, padded at the right.  In every round each row merges its
leftmost pair of minimum rank; rows without a mergeable pair leave the matrix and
the others close the gap, so the matrix shrinks by one column a round.  Ranks of
pairs come from an open-addressing hash table in numpy arrays.

A piece that is itself a vocabulary entry is one token, as in the rank files'
own library.  Pieces of over ``MATRIX_BYTES`` bytes (runs without any break)
would need a quadratic number of cells; they are merged by a heap of pairs,
which performs the same merges in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import Shared, with_field

MATRIX_BYTES = 512
#: Matrices hold at most so many cells; longer classes get fewer rows at a time.
_CELLS = 1 << 21
_CHUNK_PIECES = 200_000
_CACHE_PIECES = 300_000
#: Longer texts are split into pieces lazily.
_WHOLE_CHARS = 1 << 20
_NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _explicit_classes(pattern: str) -> str:
    """``pattern`` with ``\\p{..}`` and ``\\s`` spelled out as ranges of the basic
    plane, for the standard library's matcher (several times faster)."""
    plane = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x10000))))
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part == r"\s" or part.startswith(r"\p"):
            runs = (m.group() for m in regex.finditer(f"(?:{part})+", plane))
            ranges = "".join(f"\\u{ord(a):04x}-\\u{ord(b):04x}"
                             for run in runs for a, b in _consecutive(run))
            out.append(ranges if inside else f"[{ranges}]")
            continue
        if part in ("[", "]"):
            inside = part == "["
        out.append(part if part != r"\S" else "[^" + _explicit_classes(r"\s")[1:])
    return "".join(out)


def _consecutive(run: str):
    """First and last character of each stretch of consecutive code points."""
    codes = np.frombuffer(run.encode("utf-16-le"), np.uint16).astype(int)
    cuts = np.flatnonzero(np.diff(codes) != 1) + 1
    for part in np.split(codes, cuts):
        yield chr(part[0]), chr(part[-1])


class PairTable:
    """Hash table from a pair of token ids to the rank of their concatenation."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 2.5).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        self.probes = 0
        slots = self._slots(keys)
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` for those that don't merge (any pair
        with a padding id, which is negative)."""
        flat = (left.astype(np.int64).ravel() << 32) | right.astype(np.int64).ravel()
        out = np.full(flat.shape, _NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slots(flat[todo])
        for _ in range(self.probes):
            found = self.keys[slots]
            hit = found == flat[todo]
            out[todo[hit]] = self.values[slots[hit]]
            more = ~hit & (found >= 0)
            todo, slots = todo[more], (slots[more] + 1) & self.mask
            if not len(todo):
                break
        return out.reshape(left.shape)


class Codec:
    """Encoder and decoder of one vocabulary; ``encode`` keeps a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.plane_pattern = _explicit_classes(pattern)
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(values, np.int32))
        self._cache: dict[str, list[int]] = {}
        self._matchers: tuple = ()

    def __getstate__(self):
        return {**self.__dict__, "_cache": {}, "_matchers": ()}

    def _merge_rows(self, ids: np.ndarray) -> list[list[int]]:
        """Token ids of each row of a padded matrix of byte ids."""
        out: list = [None] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                finished = ids[done]
                for row, n, values in zip(rows[done].tolist(), (finished >= 0).sum(axis=1).tolist(), finished.tolist()):
                    out[row] = values[:n]
                going = ~done
                rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
                if not len(rows):
                    break
            count, width = ids.shape
            each = np.arange(count)
            ids[each, at] = best
            keep = np.ones((count, width), bool)
            keep[each, at + 1] = False
            ids = ids[keep].reshape(count, width - 1)
            keep = np.ones((count, width - 1), bool)
            keep[each, at] = False
            ranks = ranks[keep].reshape(count, width - 2)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[ok, side[ok]] = self.pairs.ranks(ids[ok, side[ok]], ids[ok, side[ok] + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        get, tokens = self.ranks.get, self.tokens
        heap = [(rank, i) for i in range(len(ids) - 1)
                if (rank := get(tokens[ids[i]] + tokens[ids[i + 1]])) is not None]
        heapq.heapify(heap)
        end = len(ids)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= end or get(tokens[ids[i]] + tokens[ids[j]]) != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < end:
                    new = get(tokens[ids[left]] + tokens[ids[after[left]]])
                    if new is not None:
                        heapq.heappush(heap, (new, left))
        return [x for x in ids if x >= 0]

    def _encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each of the pieces (distinct and not empty)."""
        out: list = [None] * len(pieces)
        classes: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = [whole]
            elif len(piece) > MATRIX_BYTES:
                out[k] = self._merge_long(piece)
            else:
                n = len(piece)
                classes.setdefault(n if n <= 16 else -(-n // 8) * 8, []).append(k)
        for width, members in classes.items():
            step = max(1, _CELLS // width)
            for at in range(0, len(members), step):
                part = members[at:at + step]
                lengths = np.fromiter((len(pieces[k]) for k in part), np.int64, len(part))
                filled = np.arange(width) < lengths[:, None]
                ids = np.full((len(part), width), -1, np.int32)
                ids[filled] = self.byte_ids[np.frombuffer(b"".join([pieces[k] for k in part]), np.uint8)]
                for k, values in zip(part, self._merge_rows(ids)):
                    out[k] = values
        return out

    def encode_chunks(self, texts):
        """For every text an iterator's worth of (text number, token ids) in
        order; a text of many pieces comes in several parts."""
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in self._pieces(text or ""):
                waiting.append((k, part))
                size += len(part)
                if size >= _CHUNK_PIECES:
                    yield from self._encode_waiting(waiting)
                    waiting, size = [], 0
        yield from self._encode_waiting(waiting)

    def _pieces(self, text: str):
        """Lists of the pieces of a text in order."""
        if not self._matchers:
            self._matchers = re.compile(self.plane_pattern), regex.compile(self.pattern)
        plane = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        matcher = self._matchers[0 if plane else 1]
        if len(text) <= _WHOLE_CHARS:
            yield matcher.findall(text)
        else:
            found = (m.group() for m in matcher.finditer(text))
            while part := list(islice(found, _CHUNK_PIECES)):
                yield part

    def _encode_waiting(self, waiting):
        if len(self._cache) > _CACHE_PIECES:
            self._cache = {}
        cache = self._cache
        new = list(set().union(*(part for _, part in waiting)).difference(cache))
        cache.update(zip(new, self._encode_pieces([p.encode("utf-8") for p in new])))
        for k, part in waiting:
            if part:
                yield k, list(chain.from_iterable(map(cache.__getitem__, part)))

    def decode(self, ids) -> bytes:
        """Bytes of the tokens; raises for an id outside the vocabulary."""
        return b"".join(map(self.tokens.__getitem__, ids))


def load_codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def _shared_codec(df: DataFrame, path: str, pattern: str):
    """The codec as a broadcast: its size is that of the vocabulary's tables
    (some 20 MB for 50,000 entries) whatever the number of texts."""
    return Shared(df.sparkSession, load_codec(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
           ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with a column of token ids (array of int) of the whole text.

    Null and empty texts have an empty array.  Every row is encoded by itself,
    without a shuffle; other columns pass through, one named ``ids_col`` is
    replaced.  An empty table stays empty."""
    shared = _shared_codec(docs, path, pattern)
    rest = docs.drop(ids_col)
    at = rest.columns.index(text_col)

    def run(batches):
        for batch in batches:
            rows: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for k, ids in shared.value.encode_chunks(batch.column(at).to_pylist()):
                rows[k] += ids
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.int32()))],
                                             [*batch.schema.names, ids_col])

    return rest.mapInArrow(run, with_field(rest, ids_col, "array<int>"))


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "token_ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes of its token ids; a null array gives null."""
    shared = _shared_codec(tokens, path, pattern)
    rest = tokens.drop(bytes_col)
    at = rest.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            rows = [None if ids is None else shared.value.decode(ids) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())],
                                             [*batch.schema.names, bytes_col])

    return rest.mapInArrow(run, with_field(rest, bytes_col, "binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding every text: ``doc_id, n_tokens,
    ids_sha256`` (decimal ids joined by commas), ``decoded_sha256``.

    The token ids of a long text are hashed part by part, so a task holds one
    chunk of pieces at a time.  Null and empty texts count no tokens and have the
    digests of the empty string."""
    shared = _shared_codec(docs, path, pattern)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = shared.value
        decimal = [str(i) for i in range(len(codec.tokens))]
        for batch in batches:
            n = batch.num_rows
            counts, of_ids, of_bytes = [0] * n, [None] * n, [None] * n
            for k, ids in codec.encode_chunks(v.as_py() for v in batch.column(1)):
                if of_ids[k] is None:
                    of_ids[k], of_bytes[k] = hashlib.sha256(), hashlib.sha256()
                else:
                    of_ids[k].update(b",")
                of_ids[k].update(",".join(map(decimal.__getitem__, ids)).encode())
                of_bytes[k].update(codec.decode(ids))
                counts[k] += len(ids)
            empty = hashlib.sha256().hexdigest()
            digest = [[h.hexdigest() if h else empty for h in column] for column in (of_ids, of_bytes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digest[0]), pa.array(digest[1])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
