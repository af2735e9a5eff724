import random
import re
from collections import Counter

from footfall.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(docs, depth=3, least=10, swallowed=50, top=2000):
    """docs: (text, lang) -> rows of the report."""
    counts, totals = {}, Counter()
    for text, lang in docs:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, depth + 1):
                own.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        kept = []
        for p in candidates:
            a = f[p]
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            holders = [q for q in candidates if len(q) > len(p)
                       and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * f[q] >= swallowed * a for q in holders):
                kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, totals[lang], -score))
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "The", "a", "new", "york", "city", "é", "日本", "b-c", "x\x1cy", "\x85"] + [f"w{i}" for i in range(12)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b", " new york city "]
    docs = [("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "de", None]))
            for _ in range(n)]
    return docs + [("of the of the of the", "en")] * 40


def test_equal_to_plain_counts(spark):
    docs = texts(400)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    want = plain(docs)
    assert len(want) > 50 and rows(C.collocations(df)) == want
    # Tiny budgets and chunks: every frequent prefix is lengthened to the full depth.
    assert rows(C.collocations(df, budget=3)) == want
    assert rows(C.collocations(df, top=5)) == plain(docs, top=5)


def test_deeper_phrases_and_other_thresholds(spark):
    docs = texts(200, seed=4)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    assert rows(C.collocations(df, depth=4, least=3, swallowed=80, budget=20)) == plain(docs, 4, 3, 80)
    assert rows(C.collocations(df, depth=2, least=5)) == plain(docs, 2, 5)


def test_prefixes_are_grouped_by_budget(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BYTES", 500)
    df = spark.createDataFrame(texts(300), "text string, lang string").repartition(4)
    found = C.stage(C.leaves(df, C.short_phrases(df).where("w2 IS NOT NULL")), "test-leaves")
    tables = C.prefix_tables(found, budget=50)
    assert len(tables) == 3 and tables[0].where("heavy").count() > 0
    groups = C._group_count(tables, 50)
    for level, t in enumerate(tables, 1):
        light = t.where("NOT heavy")
        assert (light.agg({"rows": "max"}).first()[0] or 0) <= 50
    fill = None
    for level, t in enumerate(tables, 1):
        own = t.where("NOT heavy").select(C._group(level, groups).alias("g"), "rows")
        fill = own if fill is None else fill.unionByName(own)
    assert fill.groupBy("g").sum("rows").agg({"sum(rows)": "max"}).first()[0] <= 100


def test_subtrees_read_counts_from_leaves():
    table = C.count_suffixes([b"A b c. a b", b"a b c"])
    assert table.num_rows == 5
    nodes = {tuple(w for w in r[:3] if w): r[3]
             for r in zip(*(C.subtree_nodes(C.pa.table({"lang": ["x"] * 5, **{n: table[n] for n in table.column_names}}))
                            .column(c).to_pylist() for c in ("w1", "w2", "w3", "count")))}
    assert nodes == {("a",): 3, ("a", "b"): 3, ("a", "b", "c"): 2, ("b",): 3, ("b", "c"): 2, ("c",): 2}


def test_filter_keeps_all_frequent_pairs(spark, monkeypatch):
    pairs = spark.createDataFrame([("en", f"a{i % 50}", f"b{i}") for i in range(3000)], "lang string, w1 string, w2 string")
    kept = C.pair_filter(pairs)
    first, second = (C.word_hashes([f"{x}{i}".encode() for i in r]) for x, r in (("a", [i % 50 for i in range(3000)]), ("b", range(3000))))
    assert kept("en", first, second).all() and kept("en", second, first).mean() < 0.15
    table = C.count_suffixes([b"a1 b1 b2 a2 b2 x. a3 b3"], 3, "en", kept)
    assert set(zip(*(table[w].to_pylist() for w in ("w1", "w2", "w3")))) == {
        ("a1", "b1", ""), ("a2", "b2", ""), ("a3", "b3", "")}
    monkeypatch.setattr(C, "FILTER_BITS", 15)  # a full filter cuts less and changes nothing
    docs = texts(200, seed=9)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows(C.collocations(df, least=2)) == plain(docs, least=2)


def test_edge_rows(spark, edge_docs, no_docs):
    docs = [(r.text, r.lang) for r in edge_docs.collect()]
    assert rows(C.collocations(edge_docs, least=2)) == plain(docs, least=2)
    assert rows(C.collocations(no_docs)) == []


def test_exact_beyond_64_bits(spark):
    a = 3_000_000_000
    got = spark.sql(f"SELECT {a} a, {a} l, {a + 1} r").select(
        C.F.call_function("div", (C.F.col("a").cast("decimal(18,0)") * C.F.col("a").cast("decimal(18,0)")
                                  * C.F.lit(10 ** 6).cast("decimal(7,0)")).cast("decimal(38,0)"),
                          (C.F.col("l").cast("decimal(18,0)") * C.F.col("r").cast("decimal(18,0)")).cast("decimal(38,0)"))
    ).first()[0]
    assert got == 10 ** 6 * a * a // (a * (a + 1))
