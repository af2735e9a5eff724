"""Language identification by string kernels with Nyström landmarks.

Two texts are compared by the n-grams that occur in them at all (presence, not
counts), for each length 1..N of the blended spectrum:

    k(x, y) = mean over n of |G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|)

The kernel is approximated from m landmark texts: phi(x) = K(x, landmarks)
K(landmarks, landmarks)^(-1/2), and one ridge regression for each language
against the rest is fitted to phi.  A language's decision value is
phi(x) . w = K(x, landmarks) . v, and K(x, landmarks) is a product of x's
presence vector with the landmarks' presence matrix; both factors are folded into
one matrix of n-grams by languages, so a batch of documents costs one sparse
matrix product.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.stages import Shared, held_out, stage

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_BITS = 21  # of a code point


def letters(text: str | None) -> str:
    """Lower-cased words of letters with one space between and around them;
    empty if there is no letter."""
    kept = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    others = {c for c in set(kept) if not c.isalpha()} - {" "}  # numerals such as \u00bd and \u2167
    if others:
        kept = " ".join(kept.translate(dict.fromkeys(map(ord, others), " ")).split())
    return f" {kept} " if kept else ""


def ngrams(kept: str, longest: int) -> list[np.ndarray]:
    """Distinct n-grams of 1..``longest`` characters, packed into integers."""
    codes = np.frombuffer(kept.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out, packed = [], np.zeros(len(codes), np.int64)
    for n in range(1, longest + 1):
        packed = (packed[:len(codes) - n + 1] << _BITS) | codes[n - 1:]
        out.append(np.unique(packed))
    return out


class LanguageModel:
    """N-gram vocabulary of the landmarks and weight of each n-gram for each language."""

    def __init__(self, languages: list[str], vocabulary: list[np.ndarray], weights: list[np.ndarray],
                 bias: np.ndarray):
        self.languages, self.vocabulary, self.weights, self.bias = languages, vocabulary, weights, bias

    def decide(self, grams: list[list[np.ndarray]]) -> np.ndarray:
        """Decision values (texts by languages) of a batch of texts' n-grams."""
        total = np.tile(self.bias, (len(grams), 1))
        for n, (known, weights) in enumerate(zip(self.vocabulary, self.weights)):
            if not len(known):
                continue
            sizes = np.array([len(g[n]) for g in grams])
            every = np.concatenate([g[n] for g in grams])
            row = np.repeat(np.arange(len(grams)), sizes)
            at = np.minimum(np.searchsorted(known, every), len(known) - 1)
            hit = known[at] == every
            row, at = row[hit], at[hit]
            norm = 1 / np.sqrt(np.maximum(sizes, 1)) / len(self.vocabulary)
            for c in range(len(self.languages)):
                total[:, c] += norm * np.bincount(row, weights[at, c], len(grams))
        return total

    def predict(self, texts: list[str | None], longest: int) -> tuple[list[str], list[float]]:
        """Language and score in 0..1 (half the decision value plus one half, cut
        at 0 and 1) of each text; ``und`` and 0 without letters or languages."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        kept = [(i, k) for i, t in enumerate(texts) if (k := letters(t))]
        for at in range(0, len(kept), 256):
            part = kept[at:at + 256]
            values = self.decide([ngrams(k, longest) for _, k in part])
            best = values.argmax(axis=1)
            top = np.clip((values[np.arange(len(part)), best] + 1) / 2, 0, 1)
            for (i, _), b, score in zip(part, best.tolist(), top.tolist()):
                names[i], scores[i] = self.languages[b], score
        return names, scores


def _presence(grams: list[list[np.ndarray]], n: int, known: np.ndarray) -> np.ndarray:
    """Normalised presence of the known n-grams, texts by n-grams."""
    out = np.zeros((len(grams), len(known)), np.float32)
    for i, g in enumerate(grams):
        at = np.minimum(np.searchsorted(known, g[n]), max(len(known) - 1, 0))
        out[i, at[known[at] == g[n]]] = 1 / np.sqrt(len(g[n]))
    return out


def fit(grams: list[list[np.ndarray]], marks: list[str], longest: int, landmarks: int, ridge: float) -> LanguageModel:
    """Nyström landmarks and one-versus-rest kernel ridge regression on the distinct
    n-grams of the training texts and their languages."""
    languages = sorted(set(marks))
    if not languages:
        return LanguageModel([], [], [], np.zeros(0))
    # The same number of landmarks of every language, as far as there are as many.
    of: dict[str, list[int]] = {}
    for i, lang in enumerate(marks):
        of.setdefault(lang, []).append(i)
    share = -(-landmarks // len(languages))
    chosen = [grams[i] for lang in languages for i in of[lang][:share]]
    vocabulary = [np.unique(np.concatenate([g[n] for g in chosen])) for n in range(longest)]
    base = [_presence(chosen, n, v) for n, v in enumerate(vocabulary)]
    kernel = sum(b @ b.T for b in base).astype(float) / longest
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.concatenate([
        (sum(_presence(grams[at:at + 256], n, v) @ base[n].T for n, v in enumerate(vocabulary)) / longest) @ root
        for at in range(0, len(grams), 256)])
    target = np.where(np.array(marks)[:, None] == np.array(languages), 1.0, -1.0)
    mean, middle = phi.mean(axis=0), target.mean(axis=0)
    centred = phi - mean
    w = np.linalg.solve(centred.T @ centred + ridge * np.eye(phi.shape[1]), centred.T @ (target - middle))
    folded = root @ w
    return LanguageModel(languages, vocabulary, [b.T.astype(float) @ folded for b in base], middle - mean @ w)


def learn(docs: DataFrame, max_rows: int = 4000, longest: int = 3, landmarks: int = 256,
          ridge: float = 0.03) -> LanguageModel:
    """A model from text and non-null ``lang`` of documents that are not held out.

    At most ``max_rows`` distinct rows are used, chosen by a hash of id, language and
    text: the documented bound of the sample that the driver fits.  It gets the texts'
    distinct n-grams (at most what the languages' alphabets allow), never the texts.
    Half of it is dealt equally to the languages, so that rare ones are learned."""
    rows = (docs.where(~held_out()).where("lang is not null and text is not null and doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col("lang").cast("string").alias("lang")))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "lang", "text"))
    keys = stage(rows.select("lang", "key").distinct(), "keys")
    counts = stage(keys.groupBy("lang").agg(F.count("*").alias("of_lang")), "counts")
    every = counts.agg(F.sum("of_lang").alias("rows"), F.count("*").alias("langs")).first()
    if not every["langs"]:
        return fit([], [], longest, landmarks, ridge)
    share = max(1, max_rows // (2 * every["langs"]))
    # More rows than are needed of each language, so few that they can be ranked.
    part = F.greatest(F.lit(2 * max_rows / every["rows"]), F.lit(2.0 * share + 50) / F.col("of_lang"))
    order = F.xxhash64("key")
    few = keys.join(counts, "lang").where(F.pmod(order, F.lit(1 << 40)) / F.lit(float(1 << 40)) <= part)
    ranked = few.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.pmod(order, F.lit(1 << 40)), "key")))
    chosen = (ranked.orderBy(F.col("rank") > share, F.pmod(order, F.lit(1 << 40)), "key").limit(max_rows)
              .select(F.col("key").alias("_key"), F.col("lang").alias("_lang")))
    sample = (rows.join(F.broadcast(stage(chosen, "chosen")), (F.col("key") == F.col("_key")) & (F.col("lang") == F.col("_lang")))
              .groupBy("key", "lang").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
              .select("doc_id", "lang", "key", "text").mapInArrow(
                  _gram_rows(longest), "doc_id long, lang string, key long, grams array<binary>").collect())
    sample.sort(key=lambda r: (r["doc_id"], r["lang"], r["key"]))
    return fit([[np.frombuffer(g, np.int64) for g in r["grams"]] for r in sample], [r["lang"] for r in sample],
               longest, landmarks, ridge)


def _gram_rows(longest: int):
    """Rows of texts with letters, with the bytes of their distinct n-grams in place of the text."""
    def run(batches):
        for batch in batches:
            grams = [[g.tobytes() for g in ngrams(kept, longest)] if (kept := letters(text.as_py())) else None
                     for text in batch.column(3)]
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(grams, pa.list_(pa.binary()))], ["doc_id", "lang", "key", "grams"])
            yield out.filter(out.column(3).is_valid())
    return run


def identify(docs: DataFrame, model: LanguageModel, longest: int = 3, lang_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """``doc_id``, language and score of every whole text.

    A null text or one without letters gets ``und`` and 0, and so does every text
    when nothing could be learned.  Rows are classified one by one without a
    shuffle; other columns are ignored; an empty table stays empty."""
    shared = Shared(docs.sparkSession, model)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(1).to_pylist(), longest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", lang_col, score_col])

    return narrow.mapInArrow(run, f"doc_id long, {lang_col} string, {score_col} double")
