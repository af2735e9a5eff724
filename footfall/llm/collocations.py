"""Phrase collocation mining by vertical partitioning of word suffix trees.

Every word occurrence starts a suffix, cut after the longest phrase.  Tasks count
equal suffixes of a chunk of text before anything is shuffled.

1. Words and pairs are counted.  A pair below the threshold is in no candidate, so
   a bit filter of the frequent pairs (no false negatives) cuts suffixes before
   their first rare pair; what is left are the leaves of a depth-truncated suffix tree
   for each language.
2. The tree is partitioned vertically: a prefix whose leaves fit the memory
   budget goes to a group whole; one with more is lengthened by a word, and so on.
   Prefixes share groups as long as a group fits.
3. Each group's subtrees are built by themselves, from the sorted leaves; a node's
   count is the total of the leaves below it.  Frequent nodes are the candidates,
   and their parts are looked up among the nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.stages import Shared, stage

DEPTH = 3
LEAST = 10                # occurrences of a candidate
SWALLOWED = 50            # per cent of a candidate's occurrences inside one longer candidate that drop it
TOP = 2000
BUDGET_ROWS = 1 << 19     # leaves of a group that one task builds its subtrees from
CHUNK_BYTES = 6 << 20     # text whose suffixes are counted together before the shuffle
SCORE_UNIT = 1_000_000
BROADCAST_PREFIXES = 200_000
FILTER_LOAD = 16          # bits of the filter for a frequent pair
FILTER_BITS = 28          # at most 2 ** this many bits (32 MB); a fuller filter cuts less, results stay

# Letters folded, characters that end a piece, and a byte that no UTF-8 text holds.
_UPPER, _LOWER, _ENDS, _BREAK = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b".,;:!?\n\x0b\x0c\r", b"\xff"
_FOLD = bytes.maketrans(_UPPER + b"\t" + _ENDS, _LOWER + b" " + _BREAK * len(_ENDS))


def _words(depth: int) -> list[str]:
    return [f"w{i}" for i in range(1, depth + 1)]


class PairFilter:
    """A bit for the hash of every frequent pair of words of a language."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits                                    # bytes, a power of two of them

    def __call__(self, lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        at = pair_places(lang, first, second, 8 * len(self.bits))
        return self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def pair_places(lang: str, first: np.ndarray, second: np.ndarray, places: int) -> np.ndarray:
    """Place of each pair among ``places`` (a power of two), from the words' hashes."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ second ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(24) & np.uint64(places - 1)).astype(np.int64)


def _count(columns: list[np.ndarray], names: list[str], spelled: pa.Array) -> pa.Table:
    found = pa.table([pa.array(c) for c in columns], names).group_by(names, use_threads=False).aggregate([([], "count_all")])
    return pa.table([*[spelled.take(found[w]) for w in names], found["count_all"]], [*names, "n"])


def _coded(texts: list[bytes]) -> tuple[np.ndarray, int, list[bytes]]:
    """The texts' words as codes, the code that ends a piece, and the words.  Words are
    split and coded as an Arrow array, never as Python objects."""
    folded = _BREAK.join([*texts, b""]).translate(_FOLD).replace(_BREAK, b" " + _BREAK + b" ")
    split = pc.split_pattern(pa.array([folded], pa.large_binary()), " ").flatten().dictionary_encode()
    codes, words = split.indices.to_numpy(), split.dictionary.to_pylist()
    if b"" in words:
        codes = codes[codes != words.index(b"")]
    if _BREAK not in words:
        words.append(_BREAK)
    end = words.index(_BREAK)
    return np.append(codes, codes.dtype.type(end)), end, words


def _spelled(words: list[bytes], end: int) -> pa.Array:
    return pa.array([b"" if i == end else w for i, w in enumerate(words)], pa.binary()).cast(pa.string())


def count_short(texts: list[bytes]) -> pa.Table:
    """(w1, w2, n): pairs, single words (null w2) and all words (both null) of the texts."""
    codes, end, words = _coded(texts)
    spelled, first, second = _spelled(words, end), codes[:-1], codes[1:]
    pair = (first != end) & (second != end)
    pairs = _count([first[pair], second[pair]], ["w1", "w2"], spelled)
    single = _count([codes[codes != end]], ["w1"], spelled)
    none = pa.nulls(single.num_rows, pa.string())
    total = pa.table([pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.array([int((codes != end).sum())])],
                     ["w1", "w2", "n"])
    return pa.concat_tables([pairs, single.add_column(1, "w2", none), total])


def count_suffixes(texts: list[bytes], depth: int = DEPTH, lang: str = "", frequent: PairFilter | None = None) -> pa.Table:
    """(w1 ... w_depth, n): the distinct suffixes of the texts' pieces, cut to ``depth``
    words and before the first pair that is not ``frequent``, with empty words from there."""
    codes, end, words = _coded(texts)
    after = np.append(codes[1:], codes.dtype.type(end))
    goes_on = (codes != end) & (after != end)
    starts = codes != end
    if frequent is not None:
        hashes = word_hashes(words)
        at = np.flatnonzero(goes_on)
        goes_on[at] = frequent(lang, hashes[codes[at]], hashes[after[at]])
        starts = goes_on
    columns, on = [codes], goes_on
    for i in range(1, depth):
        later = np.append(codes[i:], np.full(min(i, len(codes)), end, codes.dtype))
        columns.append(np.where(on, later, end))
        on = on & np.append(goes_on[i:], np.zeros(min(i, len(codes)), bool))
    return _count([c[starts] for c in columns], _words(depth), _spelled(words, end))


def _counted(docs: DataFrame, names: list[str], count, text_col: str, lang_col: str) -> DataFrame:
    """``count`` of the texts of a language, chunk by chunk, as ``lang, <names>, n`` (equal rows of
    other chunks are separate)."""
    narrow = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def flush(waiting):
        for lang, texts in waiting.items():
            table = count(lang, texts)
            table = table.add_column(0, "lang", pa.array([lang] * table.num_rows, pa.string()))
            yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)
            del table
            pa.default_memory_pool().release_unused()

    def run(batches):
        waiting, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_buffer().to_pybytes()
                waiting.setdefault(lang, []).append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield from flush(waiting)
                    waiting, size = {}, 0
        yield from flush(waiting)

    return narrow.mapInArrow(run, ", ".join(f"{c} string" for c in ["lang", *names]) + ", n long")


def short_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, w1, w2, count`` of the frequent pairs, the frequent words (null ``w2``) and,
    with both null, of all words of a language."""
    found = _counted(docs, ["w1", "w2"], lambda lang, texts: count_short(texts), text_col, lang_col)
    counted = found.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("count"))
    return stage(counted.where((F.col("count") >= least) | F.col("w1").isNull()), "short-phrases")


def pair_filter(pairs: DataFrame) -> PairFilter:
    """The filter of ``pairs`` (lang, w1, w2), put together by Spark from bitmaps of 4 KB: the
    driver sees at most ``2 ** FILTER_BITS`` bits."""
    wanted = max(1, FILTER_LOAD * pairs.count())
    places = 1 << min(FILTER_BITS, max(15, (wanted - 1).bit_length()))

    def run(batches):
        for batch in batches:
            lang, first, second = (c.to_pylist() for c in batch.columns)
            at = [pair_places(g, word_hashes([a.encode()]), word_hashes([b.encode()]), places)[0]
                  for g, a, b in zip(lang, first, second)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["place"])

    # Bit 1 is place 1 of a bitmap bucket in Spark; bucket 1 starts there.
    place = F.col("place") + 1
    rows = (pairs.select("lang", "w1", "w2").mapInArrow(run, "place long")
            .groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    bits = np.zeros(places // 8, np.uint8)
    for bucket, part in rows:
        bits[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(part, np.uint8)
    return PairFilter(bits)


def leaves(docs: DataFrame, pairs: DataFrame, depth: int = DEPTH, text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """``lang, w1 ... w_depth, n``: suffixes that start with a frequent pair, counted by
    chunk of text."""
    shared = Shared(docs.sparkSession, pair_filter(pairs))
    return _counted(docs, _words(depth), lambda lang, texts: count_suffixes(texts, depth, lang, shared.value),
                    text_col, lang_col)


def subtree_nodes(table: pa.Table, depth: int = DEPTH, least: int = 1) -> pa.Table:
    """The frequent nodes of a group's subtrees: ``lang, w1 ... w_depth`` (empty beyond
    the node's length) and ``count``, from the sorted leaves."""
    words = _words(depth)
    keys = ["lang", *words]
    total = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    total = total.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    n, rows = total["n_sum"].to_numpy(), total.num_rows
    changed = np.zeros(rows, bool)
    changed[:1] = True
    out = []
    lang = total["lang"]
    changed[1:] |= pc.not_equal(lang.slice(1), lang.slice(0, rows - 1)).to_numpy()
    for level, word in enumerate(words, 1):
        column = total[word]
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, rows - 1)).to_numpy()
        starts = np.flatnonzero(changed)
        counts = np.add.reduceat(n, starts)
        ended = pc.equal(column, "").to_numpy()[starts]     # the suffix ended before this level
        at = starts[~ended & (counts >= least)]
        picked = total.take(pa.array(at))
        blank = pa.array([""] * len(at), pa.string())
        out.append(pa.table([picked["lang"], *[picked[w] if i <= level else blank for i, w in enumerate(words, 1)],
                             pa.array(counts[~ended & (counts >= least)])], [*keys, "count"]))
    return pa.concat_tables(out)


def _prefix(level: int) -> list[str]:
    return ["lang", *_words(level)]


def _subtrees(level: int, depth: int, least: int):
    """The task of a group whose prefixes have ``level`` words: nodes above them, and single
    words, are counted elsewhere."""
    def run(part: pa.Table) -> pa.Table:
        nodes = subtree_nodes(part, depth, least)
        return nodes.filter(pc.not_equal(nodes[f"w{max(2, level)}"], ""))

    return run


def _small(heavy: DataFrame) -> DataFrame:
    """Heavy prefixes, broadcast where there are few (more than a budget of rows lies below
    each, so a corpus of a million budgets has a million at most)."""
    return F.broadcast(heavy) if heavy.count() <= BROADCAST_PREFIXES else heavy


def prefix_tables(found: DataFrame, depth: int = DEPTH, budget: int = BUDGET_ROWS) -> list[DataFrame]:
    """By level, the prefixes that had to be counted: ``lang, w1 ..., count, rows,
    heavy``; the first level has all words, a further one the continuations of the heavy
    prefixes before it.  ``heavy``: more leaves than a task's budget."""
    tables, rest = [], found
    for level in range(1, depth + 1):
        counted = rest.groupBy(*_prefix(level)).agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("rows"))
        tables.append(stage(counted.withColumn("heavy", F.col("rows") > budget), f"prefixes-{level}"))
        heavy = tables[-1].where("heavy")
        if level == depth or heavy.isEmpty():
            break
        # A heavy prefix has more than ``budget`` rows: there are at most rows / budget of them.
        rest = rest.join(_small(heavy.select(*_prefix(level))), _prefix(level), "left_semi")
    return tables


def _group(level: int, groups: int) -> Column:
    return F.pmod(F.xxhash64(*_prefix(level)), F.lit(groups))


def _group_count(tables: list[DataFrame], budget: int) -> int:
    """Groups so that none has more than twice the budget: prefixes are dealt by hash, and
    the number of groups doubled until the fullest one fits."""
    parts = [t.where("NOT heavy") for t in tables]
    rows = sum(p.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] for p in parts)
    groups = max(1, -(-rows // budget))
    for _ in range(12):
        fill = None
        for level, p in enumerate(parts, 1):
            own = p.select(_group(level, groups).alias("group"), "rows")
            fill = own if fill is None else fill.unionByName(own)
        fullest = fill.groupBy("group").agg(F.sum("rows").alias("rows")).agg(F.max("rows")).first()[0] or 0
        if fullest <= 2 * budget:
            break
        groups *= 2
    return groups


def phrase_counts(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, budget: int = BUDGET_ROWS,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(counts, totals): ``lang, w1 ... w_depth, count`` of all phrases of 1 to ``depth``
    words that occur ``least`` times, and ``lang, n`` of all word occurrences."""
    short = short_phrases(docs, least, text_col, lang_col)
    totals = short.where("w1 IS NULL").select("lang", F.col("count").alias("n"))
    found = stage(leaves(docs, short.where("w2 IS NOT NULL"), depth, text_col, lang_col), "suffixes")
    tables = prefix_tables(found, depth, budget)
    groups = _group_count(tables, budget)
    words, names = _words(depth), ["lang", *_words(depth)]
    schema = ", ".join(f"{c} string" for c in names) + ", count long"
    # Single words come from the first count: leaves hold only occurrences in frequent pairs.
    counts = short.where("w1 IS NOT NULL AND w2 IS NULL").select(
        "lang", "w1", *[F.lit("").alias(w) for w in words[1:]], "count")
    rest = found
    for level, table in enumerate(tables, 1):
        # Heavy prefixes were counted as prefixes; their continuations are in the next table.
        heavy = _small(table.where("heavy").select(*_prefix(level)))
        light = rest.join(heavy, _prefix(level), "left_anti")
        built = (light.withColumn("group", _group(level, groups)).groupBy("group")
                 .applyInArrow(_subtrees(level, depth, least), schema))
        counts = counts.unionByName(built)
        if level > 1:
            known = table.where(F.col("heavy") & (F.col("count") >= least) & (F.col(f"w{level}") != ""))
            counts = counts.unionByName(known.select(*_prefix(level), *[F.lit("").alias(w) for w in words[level:]], "count"))
        rest = rest.join(heavy, _prefix(level), "left_semi")
    return stage(counts, "phrases"), totals


def _phrase(first: int, last: int) -> Column:
    return F.concat_ws(" ", *[F.col(f"w{i}") for i in range(first, last + 1)])


def collocations(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, swallowed: int = SWALLOWED, top: int = TOP,
                 budget: int = BUDGET_ROWS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of 2 to ``depth``
    words of every language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``score`` is
    ``floor(1000000 a a / (l r))``.  A phrase is dropped if a longer candidate that holds it
    has at least ``swallowed`` per cent of its occurrences.

    Null languages are ``und``, null texts empty; repeated rows count again; empty words
    and pieces don't occur; an empty table has no phrases.  Other columns are not read."""
    counts, totals = phrase_counts(docs, depth, least, budget, text_col, lang_col)
    length = sum((F.col(w) != "").cast("int") for w in _words(depth))
    counts = stage(counts.select("lang", length.alias("size"), F.concat_ws(" ", F.array_remove(
        F.array(*_words(depth)), "")).alias("phrase"), F.col("count").alias("a"), *_words(depth)), "counted-phrases")
    part = counts.select("lang", F.col("phrase").alias("_part"), F.col("a").alias("_n"))
    scored = None
    for size in range(2, depth + 1):
        own = counts.where(F.col("size") == size).select("lang", "phrase", "a", *_words(size))
        for k in range(1, size):
            for name, words in (("l", _phrase(1, k)), ("r", _phrase(k + 1, size))):
                # Every part of a frequent phrase is frequent: each lookup finds one row.
                looked = part.withColumnsRenamed({"_n": f"{name}{k}"})
                own = own.withColumn("_part", words).join(looked, ["lang", "_part"]).drop("_part")
        cuts = []
        for k in range(1, size):
            a, left, right = (F.col(c).cast("decimal(18,0)") for c in ("a", f"l{k}", f"r{k}"))
            unit = F.lit(SCORE_UNIT).cast("decimal(7,0)")
            product, parts = (a * a * unit).cast("decimal(38,0)"), (left * right).cast("decimal(38,0)")
            cuts.append(F.struct(F.call_function("div", product, parts).alias("score"), F.lit(k).alias("k"),
                                 F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        weakest = F.array_min(F.array(*cuts))
        own = own.select("lang", "phrase", F.lit(size).alias("size"), "a", weakest["l"].alias("l"),
                         weakest["r"].alias("r"), weakest["score"].alias("score"))
        scored = own if scored is None else scored.unionByName(own)
    # The largest count of a longer candidate that holds the phrase.
    inside = None
    for size in range(3, depth + 1):
        longer = counts.where(F.col("size") == size)
        held = [_phrase(i, i + s - 1) for s in range(2, size) for i in range(1, size - s + 2)]
        one = longer.select("lang", F.explode(F.array(*held)).alias("phrase"), F.col("a").alias("longer"))
        inside = one if inside is None else inside.unionByName(one)
    if inside is not None:
        most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(most, ["lang", "phrase"], "left").where(
            F.coalesce(F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * swallowed,
                       F.lit(True)))
    # Two levels, so that a task ranks a share of a language and then a bounded rest.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = scored.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = shares.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best))).where(
        F.col("_rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
