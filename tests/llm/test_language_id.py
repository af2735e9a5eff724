import numpy as np

from footfall.llm import language_id as L
from footfall.llm.stages import held_out
from tests.conftest import SF_ORACLE


def test_letters_are_letters():
    assert L.letters("\u00bd \u00b2 \u2167 12 _ !") == ""
    assert L.letters("Ab\u00bdC\u2167 \u00e9\u65e5") == " ab c \u00e9\u65e5 "


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    found = L.identify(docs, L.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in found) / len(found) > 0.97 and all(0 <= r.score <= 1 for r in found)


def test_folded_product_equals_kernel_regression():
    texts = ["the cat and the dog", "a dog of the house", "der hund und das haus", "die katze ist da", "das ist der hund"]
    langs = ["en", "en", "de", "de", "de"]
    longest, ridge = 3, 0.1
    model = L.fit([L.ngrams(L.letters(t), longest) for t in texts], langs, longest, 4, ridge)

    def kernel(a, b):
        ga, gb = ([{k[i:i + n] for i in range(len(k) - n + 1)} for n in range(1, longest + 1)] for k in map(L.letters, (a, b)))
        return sum(len(x & y) / np.sqrt(len(x) * len(y)) for x, y in zip(ga, gb)) / longest

    marks = [texts[2], texts[3], texts[0], texts[1]]  # two landmarks of each language, in order
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    root = vectors / np.sqrt(values)
    phi = np.array([[kernel(t, m) for m in marks] for t in texts]) @ root
    y = np.where(np.array(langs)[:, None] == np.array(["de", "en"]), 1.0, -1.0)
    centred = phi - phi.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + ridge * np.eye(4), centred.T @ (y - y.mean(axis=0)))
    for text in ["the hund", "a house and a cat", "xyz", texts[0]]:
        want = (np.array([kernel(text, m) for m in marks]) @ root - phi.mean(axis=0)) @ w + y.mean(axis=0)
        got = model.decide([L.ngrams(L.letters(text), longest)])[0]
        assert np.allclose(got, want, atol=1e-4)


def test_edge_rows(spark, edge_docs, no_docs):
    model = L.learn(edge_docs)
    rows = L.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (5, 6, 8))
    assert all(r.lang_pred in model.languages for r in rows if r.doc_id in (1, 2, 3, 4, 7, 9))
    nothing = L.learn(no_docs)
    assert nothing.languages == [] and {r.lang_pred for r in L.identify(edge_docs, nothing).collect()} == {"und"}
    assert L.identify(no_docs, model).count() == 0


def test_sample_is_bounded_by_rows_and_holds_rare_languages(spark, monkeypatch):
    def spelt(i):
        return "".join(chr(97 + int(c)) for c in f"{i:04}")

    rows = [(1, f"the house number {spelt(i)}", "en") for i in range(900)] + [(1, "the same house again", "en")] * 300
    rows += [(3, f"das haus nummer {spelt(i)}", "de") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(L, "fit", lambda grams, langs, *rest: [(tuple(g[2].tolist()), lang) for g, lang in zip(grams, langs)])
    sample = L.learn(docs.where(~held_out()), max_rows=40)
    assert len(sample) == len(set(sample)) == 40 and sum(lang == "de" for _, lang in sample) == 3
