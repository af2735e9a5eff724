"""Toxicity by Levenshtein automata intersected with a lexicon trie.

The lexicon is learned: word beginnings (stems) that are much likelier in
documents marked toxic, each with its log-odds as weight.  All stems form one
trie.  An automaton that allows one edit is run over the trie: its state is the
set of (trie node, edits used) that a token's characters can have reached, and
states and transitions are built when first met, so a token costs one lookup a
character and most tokens end after two or three.  A token matches

* exactly, when it begins with a stem, or
* misspelled, when the whole token is one edit (a character more, less or
  changed, or two neighbours swapped) away from a stem that mostly occurs as a
  whole word of five or more characters and has at least half of the largest
  weight.  Of such words of four characters only a doubled character and a swap
  count, as other edits of short words often are words of their own.

Every match is then seen in its context window: inside quotation marks or not,
and together with how many other matches.  A logistic regression over these
sums, fitted to the labels, turns quotation and abuse into one score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import held_out, stage, with_field

WORD = re.compile(r"\w+")
STEM_LENGTHS = range(3, 13)
FUZZY_LENGTH, SWAP_LENGTH = 5, 4
WINDOW = 10
_HEAD = 3
#: What a token's characters can have used: nothing, any edit, or a doubling or a
#: swap.  A swap half read is the character that must follow.
_NONE, _EDITED, _KEPT = 0, 1, 2
_OPEN, _CLOSE = "“«„", "”»“"
FEATURES = 6
#: Documents of at least this score count as toxic.
THRESHOLD = 0.3


class Lexicon:
    """Stems as (stem, weight, is_word), matched by the lazily built automaton."""

    def __init__(self, entries: list[tuple[str, float, bool]]):
        self.entries = entries
        self._children: list[dict[str, int]] = [{}]
        self._weight = [0.0]
        self._fuzzy = [False]  # a word that allows an edit lies below
        self._loose = [False]  # one that allows doubled and swapped characters
        self._last = [""]
        self._word = {_NONE: [0.0], _EDITED: [0.0], _KEPT: [0.0]}
        strong = max((w for _, w, _ in entries), default=0.0) / 2
        for stem, weight, is_word in entries:
            loose = is_word and len(stem) >= SWAP_LENGTH and weight >= strong
            fuzzy = loose and len(stem) >= FUZZY_LENGTH
            node = 0
            self._fuzzy[0] |= fuzzy
            self._loose[0] |= loose
            for c in stem:
                if c not in self._children[node]:
                    self._children[node][c] = len(self._weight)
                    self._children.append({})
                    self._weight.append(0.0)
                    self._fuzzy.append(False)
                    self._loose.append(False)
                    self._last.append(c)
                    for ends in self._word.values():
                        ends.append(0.0)
                node = self._children[node][c]
                self._fuzzy[node] |= fuzzy
                self._loose[node] |= loose
            self._weight[node] = max(self._weight[node], weight)
            for edits, allowed in ((_NONE, fuzzy), (_EDITED, fuzzy), (_KEPT, loose)):
                if allowed:
                    self._word[edits][node] = max(self._word[edits][node], weight)
        self._reset()

    def __getstate__(self):
        return {"entries": self.entries}

    def __setstate__(self, state):
        self.__init__(state["entries"])

    def _reset(self) -> None:
        self._states: dict[frozenset, int] = {}
        self._next: list[dict[str, int]] = []
        self._members: list[frozenset] = []
        self._stem_weight: list[float] = []
        self._end_weight: list[float] = []
        self._heads: dict[str, tuple[int, float]] = {}
        self._start = self._state(self._closed({(0, _NONE)}))

    def _closed(self, pairs: set[tuple]) -> frozenset:
        """Also the nodes reached by leaving out a character of a stem."""
        out = set(pairs)
        for node, edits in pairs:
            if edits == _NONE:
                out.update((child, _EDITED) for child in self._children[node].values() if self._fuzzy[child])
        return frozenset(out)

    def _state(self, members: frozenset) -> int:
        if members not in self._states:
            self._states[members] = len(self._members)
            self._members.append(members)
            self._next.append({})
            self._stem_weight.append(max((self._weight[n] for n, e in members if e == _NONE), default=0.0))
            self._end_weight.append(max((self._word[e][n] for n, e in members if e in self._word), default=0.0))
        return self._states[members]

    def _step(self, state: int, c: str) -> int:
        known = self._next[state].get(c)
        if known is not None:
            return known
        reached = set()
        for node, edits in self._members[state]:
            if edits == _NONE:
                self._edit(node, c, reached)
            elif edits == _EDITED:
                child = self._children[node].get(c)
                if child is not None and self._fuzzy[child]:
                    reached.add((child, _EDITED))
            elif edits == _KEPT:
                child = self._children[node].get(c)
                if child is not None and self._loose[child]:
                    reached.add((child, _KEPT))
            elif edits == c:  # the second half of a swap
                reached.add((node, _KEPT))
        new = self._state(self._closed(reached)) if reached else -1
        self._next[state][c] = new
        return new

    def _edit(self, node: int, c: str, reached: set) -> None:
        """What a node without edits reaches by a character of the token."""
        children = self._children[node]
        if c in children:
            reached.add((children[c], _NONE))
        if self._fuzzy[node]:
            reached.add((node, _EDITED))
        if self._loose[node] and c == self._last[node]:
            reached.add((node, _KEPT))
        for d, child in children.items():
            if self._fuzzy[child]:
                reached.add((child, _EDITED))
            after = self._children[child].get(c)
            if d != c and after is not None and self._loose[after]:
                reached.add((after, d))

    def _run(self, state: int, best: float, token: str) -> tuple[int, float]:
        for c in token:
            state = self._step(state, c)
            if state < 0:
                break
            best = max(best, self._stem_weight[state])
        return state, best

    def match(self, token: str) -> tuple[float, bool]:
        """Weight of the match (0 for none) and whether it is misspelled."""
        head = token[:_HEAD]
        known = self._heads.get(head)
        if known is None:
            if len(self._heads) > 100_000 or len(self._members) > 100_000:
                self._reset()
            known = self._heads[head] = self._run(self._start, 0.0, head)
        state, best = known
        if state < 0 and not best:
            return 0.0, False
        if state >= 0:
            state, best = self._run(state, best, token[_HEAD:])
        if best:
            return best, False
        weight = self._end_weight[state] if state >= 0 else 0.0
        return weight, weight > 0

    def matches(self, tokens: list[str]) -> list[tuple[int, float, bool]]:
        """(token number, weight, misspelled) of the tokens that match."""
        heads, match = self._heads, self.match
        dead = (-1, 0.0)
        found = []
        for i, token in enumerate(tokens):
            if heads.get(token[:_HEAD]) != dead:
                weight, misspelled = match(token)
                heads = self._heads
                if weight:
                    found.append((i, weight, misspelled))
        return found


def _quoted(text: str, at: int) -> bool:
    """Whether the place lies in quotation marks that open and close on its line."""
    start = text.rfind("\n", 0, at) + 1
    end = text.find("\n", at)
    left, right = text[start:at], text[at:end if end >= 0 else len(text)]
    if left.count('"') % 2 and '"' in right:
        return True
    return any(left.rfind(o) > left.rfind(c) and c in right for o, c in zip(_OPEN, _CLOSE))


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    """Sums over the matches of a text, all 0 for a text without any:
    strongest weight, weight outside and inside quotation marks, weight of
    misspelled matches, weight of matches close to another one, and density."""
    lowered = (text or "").lower()
    tokens = WORD.findall(lowered)
    found = lexicon.matches(tokens)
    if not found:
        return [0.0] * FEATURES
    wanted = {i for i, _, _ in found}
    places = {i: m.start() for i, m in enumerate(WORD.finditer(lowered)) if i in wanted}
    said = meant = misspelled = close = 0.0
    for k, (i, weight, fuzzy) in enumerate(found):
        if _quoted(lowered, places[i]):
            said += weight
        else:
            meant += weight
        misspelled += weight * fuzzy
        near = (k and i - found[k - 1][0] <= WINDOW) or (k + 1 < len(found) and found[k + 1][0] - i <= WINDOW)
        close += weight * bool(near)
    return [max(w for _, w, _ in found), math.log1p(meant), math.log1p(said), math.log1p(misspelled),
            math.log1p(close), math.log1p(100 * (said + meant) / len(tokens))]


class Model:
    """Lexicon and logistic regression; without matches the score is the bias's."""

    def __init__(self, lexicon: Lexicon, weights: list[float], bias: float):
        self.lexicon, self.weights, self.bias = lexicon, weights, bias

    def score(self, text: str | None) -> float:
        x = sum(w * v for w, v in zip(self.weights, features(self.lexicon, text))) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _count_stems(batches):
    """Documents with each word beginning, marked toxic or not, per part of the
    batch; a word's end is counted as ``stem + '$'``."""
    for batch in batches:
        texts, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for at in range(0, len(texts), 500):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(texts[at:at + 500], marks[at:at + 500]):
                words = set(WORD.findall((text or "").lower()))
                stems = {w[:n] for w in words for n in STEM_LENGTHS if n <= len(w)}
                counts[toxic].update(stems)
                counts[toxic].update(w + "$" for w in words if len(w) in STEM_LENGTHS)
            keys = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array([counts[1][k] for k in keys], pa.int64()),
                 pa.array([counts[0][k] for k in keys], pa.int64())], ["stem", "toxic", "clean"])


def _choose(rows, n_toxic: int, n_clean: int) -> list[tuple[str, float, bool]]:
    """The lexicon: the longest of stems that occur in the same documents, without
    those that a shorter stem of at least their weight covers, heaviest first."""
    counts = {r["stem"]: (r["toxic"], r["clean"]) for r in rows}
    weight = {s: math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
              for s, (t, c) in counts.items()}
    stems = [s for s in counts if not s.endswith("$")]
    longer = {s[:-1] for s in stems if counts.get(s[:-1]) == counts[s]}
    kept: dict[str, float] = {}
    for s in sorted((s for s in stems if s not in longer), key=lambda s: (len(s), s)):
        if all(kept.get(s[:n], 0.0) < weight[s] for n in range(1, len(s))):
            kept[s] = weight[s]
    best = sorted(kept, key=lambda s: (-kept[s], s))
    return [(s, kept[s], counts.get(s + "$", (0, 0))[0] * 2 >= counts[s][0]) for s in best]


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights and bias of a ridge-penalised logistic regression (Newton steps)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge @ w)
    return w


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``key, text, toxic`` of at most ``max_rows`` distinct labelled texts.

    Only hashes are shuffled until the texts are chosen, by their hash."""
    marked = (labels.where(~held_out()).where("toxic is not null and doc_id is not null")
              .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic")))
    rows = docs.where(~held_out()).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    chosen = (rows.select("_id", "key").distinct().join(marked, "_id")
              .groupBy("key").agg((F.avg("_toxic") >= 0.5).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    chosen = stage(chosen, "chosen").withColumnRenamed("key", "_key")
    # Partial aggregates leave one copy of a text in each task.
    return (rows.join(F.broadcast(chosen), F.col("key") == F.col("_key"))
            .groupBy("key").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000,
          min_share: float = 0.005, min_odds: float = 3.0) -> Model:
    """A model from documents that are not held out.

    Every distinct text counts once, whatever the number of its copies.  At most
    ``max_rows`` labelled texts are used, chosen by their hash (the documented
    bound of the training sample; everything sent to the driver is bounded by it).
    All stems that occur in ``min_share`` of the toxic texts, five at least, and
    are ``min_odds`` times likelier there make the lexicon.  Labels that are null
    are left out, of several labels of one id the highest counts, of those of one
    text the more frequent (toxic if equal).  Without texts of both classes the
    score is the share of toxic texts.
    """
    sample = stage(_sample(docs, labels, max_rows), "labelled")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        share = min(max(n_toxic / max(1, n_toxic + n_clean), 1e-9), 1 - 1e-9)
        return Model(Lexicon([]), [0.0] * FEATURES, math.log(share / (1 - share)))
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    rows = (sample.select("text", "toxic").mapInArrow(_count_stems, "stem string, toxic long, clean long")
            .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((F.col("toxic") >= max(5, min_share * n_toxic)) & (odds >= min_odds)).collect())
    lexicon = Lexicon(_choose(rows, n_toxic, n_clean))

    def featurised(batches):
        for batch in batches:
            values = [features(lexicon, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.list_(pa.float64())), batch.column(2)], ["key", "x", "y"])

    table = sample.mapInArrow(featurised, "key long, x array<double>, y int").toArrow().sort_by("key")
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, FEATURES)
    *weights, bias = _fit(x, np.array(table.column("y").to_pylist(), float)).tolist()
    return Model(lexicon, weights, bias)


def score_documents(docs: DataFrame, model: Model, score_col: str = "toxicity") -> DataFrame:
    """``docs`` with the score of every whole text, in 0..1.

    Null and empty texts get the score of a text without matches.  Rows are scored
    one by one without a shuffle; other columns pass through and one named
    ``score_col`` is replaced; an empty table stays empty."""
    rest = docs.drop(score_col)
    at = rest.columns.index("text")

    def run(batches):
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             [*batch.schema.names, score_col])

    return rest.mapInArrow(run, with_field(rest, score_col, "double"))
