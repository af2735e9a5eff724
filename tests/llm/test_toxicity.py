import random
import zlib

from footfall.llm import toxicity as T
from footfall.llm.stages import held_out
from tests.conftest import SF_ORACLE


def _swapped(token, stem):
    return any(stem[:k] + stem[k + 1] + stem[k] + stem[k + 2:] == token for k in range(len(stem) - 1))


def _doubled(token, stem):
    return any(stem[:k] + stem[k] + stem[k:] == token for k in range(len(stem)))


def _misspelled(token, stem):
    """One edit or swap; of stems of four letters a doubled letter or a swap."""
    return _swapped(token, stem) or (_doubled(token, stem) if len(stem) == 4 else _edits(token, stem) <= 1)


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(6)
    entries = [("abcab", 5.0, True), ("bcabca", 4.0, True), ("aab", 3.0, False), ("ccbaa", 4.5, False), ("bbbbb", 1.0, True),
               ("abcc", 3.5, True), ("cbad", 2.6, True), ("dab", 4.0, True)]
    lexicon = T.Lexicon(entries)
    for _ in range(4000):
        token = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
        stems = [w for s, w, _ in entries if token.startswith(s)]
        # Misspelled: whole words of four letters and at least half of the largest weight.
        near = [w for s, w, word in entries if word and len(s) >= 4 and w >= 2.5 and _misspelled(token, s)]
        want = (max(stems), False) if stems else (max(near), True) if near else (0.0, False)
        assert lexicon.match(token) == want, token


def test_swaps_and_short_words():
    lexicon = T.Lexicon([("scum", 5.0, True), ("idiot", 5.0, True)])
    assert all(lexicon.match(t) == (5.0, True) for t in ("scuum", "sucm", "csum", "idoit", "idio", "idot", "idiiot", "adiot"))
    assert not any(lexicon.match(t)[0] for t in ("scam", "sum", "scrum", "slum", "cum", "idea", "doit", "idoti1"))


def test_context_separates_quotation():
    lexicon = T.Lexicon([("badword", 5.0, True)])
    plain, quoted = T.features(lexicon, "you badword go"), T.features(lexicon, 'he said "you badword" and left')
    assert plain[1] > 0 == plain[2] and quoted[2] > 0 == quoted[1]
    assert T.features(lexicon, "badwor badword")[4] > 0 and T.features(lexicon, "badwor")[3] > 0
    assert T.features(lexicon, None) == T.features(lexicon, "") == [0.0] * T.FEATURES


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    model = T.learn(docs, labels)
    turned = labels.withColumn("toxic", (1 - labels.toxic) * held_out().cast("int") + labels.toxic * (~held_out()).cast("int"))
    again = T.learn(docs, turned)
    assert (model.weights, model.bias, model.lexicon.entries) == (again.weights, again.bias, again.lexicon.entries)
    rows = T.score_documents(docs, model).join(labels, "doc_id").withColumn("test", held_out()).collect()
    assert all(r.test == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.test]
    assert sum((r.toxicity >= T.THRESHOLD) == bool(r.toxic) for r in test) / len(test) > 0.9


def test_edge_rows(spark, edge_docs, no_docs, labels):
    for marks in (labels, labels.limit(0), labels.where("toxic is null")):
        model = T.learn(edge_docs, marks)
        out = T.score_documents(edge_docs, model, "score")
        assert sorted(out.columns) == sorted(edge_docs.columns)
        rows = out.collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not r.text}) == 1
    assert T.score_documents(no_docs, T.learn(no_docs, labels)).count() == 0


def test_copies_of_a_toxic_text_count_once(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcefghk") for _ in range(8)) for _ in range(1500)]
    texts = [(f"you idiot number {i}", 1) for i in range(30)] + [(f"you friend number {i}", 0) for i in range(90)]
    texts += [("scum " + " ".join(words), 1)] * 200
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, *t) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = T.learn(docs, spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int"))
    assert "idiot" in {s for s, _, _ in model.lexicon.entries}
    assert model.score(texts[0][0]) > T.THRESHOLD > model.score(texts[40][0])
