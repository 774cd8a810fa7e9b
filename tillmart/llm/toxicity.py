"""Toxicity (operator 3): a lexicon trie intersected with Levenshtein automata.

The lexicon is learned: terms and stems (prefixes of words) that occur in toxic labelled
documents far more often than their share, by a likelihood ratio that outweighs the number
of terms tried. It becomes a trie; the product of the trie with the automata that accept
each term up to its allowed edits is a nondeterministic automaton, which is made
deterministic state by state as tokens ask for it. Each distinct token is read once, letter
by letter, and most leave the automaton after a few letters.

Hits are then seen in their context: a window of `WINDOW` tokens to each side tells quotation
(quote marks, verbs of reporting) from address (second person). Logistic regression over
exact hits, misspelled hits and their contexts gives the score.

Learning reads at most `SAMPLE` labelled documents, the ones with the smallest hash of
their id; their words are counted by Spark. At most `TERMS` terms, `INNOCENT` near misses
known from clean documents and the sample's few features per document reach the driver.

Defined results: a null or empty text has no hits and gets the score of a text without
hits; without labels of both classes every score is the share of toxic labels (0 without
any label); each row is scored by itself, so repeated rows get equal scores; a null id is
not held out. Other columns of the input are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import written
from tillmart.llm.regression import fit_logistic, logistic

SAMPLE = 20_000
TERMS = 500
INNOCENT = 20_000
WINDOW = 8
STEMS = range(3, 9)
# Least length of a whole term at which one and two edits are allowed; a stem allows none.
ONE_EDIT, TWO_EDITS = 5, 9
FOLDS, HELD_OUT = 5, 0

_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‘’…"
_QUOTES = tuple('"“”„«»‘’')
_REPORT = frozenset(
    "said says wrote called quote quoted claims dit disait écrit appelle citation sagte sagt"
    " schrieb nannte zitat dijo dice escribió llamó cita".split()
)
_ADDRESS = frozenset(
    "you your you're youre u tu toi vous votre ton du dich dir dein sie ihr tú ti usted eres".split()
)


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    held_out: tuple[int, int],
    most: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(text, label) of at most `most` labelled documents outside the held-out fold."""
    folds, left_out = held_out
    chosen = (
        labels.filter(F.col(label).isNotNull() & (fold(id_col, folds) != left_out))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    return (
        docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id", "label")
        .agg(F.max("text").alias("text"))
        .select("text", F.col("label").cast("int").alias("label"))
    )


@dataclass
class Model:
    """Lexicon, near misses to pass over, and the regression."""

    terms: list[tuple[str, bool, float]] = field(default_factory=list)
    innocent: frozenset[str] = frozenset()
    weights: np.ndarray | None = None
    prior: float = 0.0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    held_out: tuple[int, int] = (FOLDS, HELD_OUT),
    most: int = SAMPLE,
) -> Model:
    sample = written(
        labelled_sample(docs, labels, label, held_out, most, id_col, text_col), "toxic-sample"
    )
    sizes = {row["label"]: row["n"] for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    model = Model(prior=toxic / (toxic + clean) if toxic + clean else 0.0)
    if not toxic or not clean:
        return model
    words = written(
        sample.mapInArrow(_count_words, "word string, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "toxic-words",
    )
    model.terms = _lexicon(words)
    # In two clean documents at least, so that a document is not excused by itself.
    near = words.filter("clean > 1").mapInArrow(_near_misses(model), "word string, clean long")
    model.innocent = frozenset(
        row["word"] for row in near.orderBy(F.desc("clean"), "word").limit(INNOCENT).collect()
    )
    found = sample.mapInArrow(_features_of(model), "label int, x array<double>").collect()
    x = np.array([row["x"] for row in sorted(found)])
    y = np.array([row["label"] for row in sorted(found)], dtype=float)
    model.weights = fit_logistic(x, y)
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, score, n_exact, n_near, n_quoted per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            x = np.array([matcher.features(t.as_py() or "") for t in batch.column("text")])
            counts = x[:, [8, 9, 10]].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(predict(model, x)),
                    *(pa.array(counts[:, i]) for i in range(3)),
                ],
                names=["id", "score", "n_exact", "n_near", "n_quoted"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, score double, n_exact long, n_near long, n_quoted long")
    return out.withColumnRenamed("id", id_col)


def predict(model: Model, x: np.ndarray) -> np.ndarray:
    if model.weights is None:
        return np.full(len(x), model.prior)
    return logistic(x[:, :8], model.weights)


# --- learning -------------------------------------------------------------------------


def core(token: str) -> str:
    return token.strip(_EDGE)


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word, summed per batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label in zip(batch.column("text"), batch.column("label"), strict=True):
            counts[label.as_py()].update({w for t in text.as_py().lower().split() if (w := core(t))})
        words = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                pa.array([counts[1][w] for w in words], pa.int64()),
                pa.array([counts[0][w] for w in words], pa.int64()),
            ],
            names=["word", "toxic", "clean"],
        )


def _lexicon(words: DataFrame) -> list[tuple[str, bool, float]]:
    """(term, whether a stem, weight), best first; no term is covered by a better stem."""
    stems = F.filter(
        F.array(*(F.when(F.length("word") >= n, F.left("word", F.lit(n))) for n in STEMS)),
        lambda s: s.isNotNull(),
    )
    counted = words.select("word", "toxic", "clean", F.lit(False).alias("stem")).unionAll(
        words.select(F.explode(stems).alias("word"), "toxic", "clean")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .select("word", "toxic", "clean", F.lit(True).alias("stem"))
    )
    total = counted.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    base = (total[0] or 0) / max((total[0] or 0) + (total[1] or 0), 1)
    if not 0 < base < 1:
        return []
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = F.col("toxic") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    best = (
        counted.filter("toxic >= 3 and toxic >= clean and length(word) >= 3")
        .withColumn("gain", F.round(ratio, 6))
        .filter(F.col("gain") >= math.log(max(total[2], 2)))
        .orderBy(F.desc("gain"), "stem", F.desc(F.length("word")), "word")
        .limit(20 * TERMS)
        .collect()
    )
    chosen: list[tuple[str, bool, float]] = []
    stems_taken: set[str] = set()
    longer: dict[str, int] = {}  # toxic occurrences of chosen terms below a prefix
    for row in best:
        word, toxic = row["word"], row["toxic"]
        # Passed over: what a stem covers, and a shorter stem that says little more.
        if any(word[:n] in stems_taken for n in STEMS if n <= len(word)):
            continue
        if row["stem"] and toxic < 1.5 * longer.get(word, 0):
            continue
        if row["stem"]:
            stems_taken.add(word)
        for n in STEMS:
            longer[word[:n]] = longer.get(word[:n], 0) + toxic
        chosen.append((word, row["stem"], math.log((toxic + 0.5) / (row["clean"] + 0.5) / base)))
        if len(chosen) == TERMS:
            break
    return chosen


def _near_misses(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            keep = [bool(hit := matcher.verdict(w.as_py())) and hit[0] > 0 for w in batch.column("word")]
            yield batch.select(["word", "clean"]).filter(pa.array(keep, pa.bool_()))

    return run


def _features_of(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            x = [matcher.features(t.as_py())[:8] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"]
            )

    return run


# --- matching -------------------------------------------------------------------------


class Matcher:
    """Lazily determinised product of the lexicon trie and the terms' Levenshtein automata.

    A state is a set of (trie node, edits spent) pairs, each at its least edits.
    """

    KEEP = 400_000  # tokens remembered

    def __init__(self, model: Model):
        self.innocent = model.innocent
        self.children: list[dict[str, int]] = [{}]
        self.accepts: list[tuple[int, bool, float] | None] = [None]
        self.reach = [0]  # most edits any term below a node allows
        for term, stem, weight in model.terms:
            edits = 0 if stem else (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)
            node = 0
            self.reach[0] = max(self.reach[0], edits)
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.accepts.append(None)
                    self.reach.append(0)
                node = self.children[node][char]
                self.reach[node] = max(self.reach[node], edits)
            old = self.accepts[node]
            self.accepts[node] = (edits, stem or bool(old and old[1]), max(weight, old[2] if old else 0.0))
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.ends: list[tuple[int, float] | None] = []  # hit if a token ends here
        self.stems: list[tuple[int, float] | None] = []  # hit whatever follows
        self.moves: list[dict[str, int]] = []
        self.first = self._state(self._closure({0: 0}))
        self.verdicts: dict[str, tuple[int, float] | None] = {}
        self.hits: set[str] = set()

    def _closure(self, pairs: dict[int, int]) -> tuple:
        """With the nodes reached by letters a token leaves out."""
        work = list(pairs.items())
        while work:
            node, spent = work.pop()
            if pairs[node] < spent:
                continue
            for child in self.children[node].values():
                if spent + 1 <= self.reach[child] and pairs.get(child, 9) > spent + 1:
                    pairs[child] = spent + 1
                    work.append((child, spent + 1))
        return tuple(sorted(pairs.items()))

    def _state(self, pairs: tuple) -> int:
        if pairs in self.numbers:
            return self.numbers[pairs]
        number = self.numbers[pairs] = len(self.states)
        ends = [(s, -a[2]) for n, s in pairs if (a := self.accepts[n]) and s <= a[0]]
        stems = [(s, -a[2]) for n, s in pairs if (a := self.accepts[n]) and a[1] and s <= a[0]]
        self.states.append(pairs)
        self.ends.append(min(ends, default=None))
        self.stems.append(min(stems, default=None))
        self.moves.append({})
        return number

    def _move(self, state: int, char: str) -> int:
        """The next state, -1 when no term can be met any more."""
        pairs: dict[int, int] = {}
        for node, spent in self.states[state]:
            if spent + 1 <= self.reach[node] and pairs.get(node, 9) > spent + 1:
                pairs[node] = spent + 1
            for letter, child in self.children[node].items():
                cost = spent + (letter != char)
                if cost <= self.reach[child] and pairs.get(child, 9) > cost:
                    pairs[child] = cost
        number = self._state(self._closure(pairs)) if pairs else -1
        self.moves[state][char] = number
        return number

    def verdict(self, word: str) -> tuple[int, float] | None:
        """(edits, weight) of the nearest term, None if no term is near."""
        state, best = self.first, None
        for char in word:
            after = self.moves[state].get(char)
            state = self._move(state, char) if after is None else after
            if state < 0:
                break
            hit = self.stems[state]
            if hit and (best is None or hit < best):
                best = hit
        else:
            hit = self.ends[state]
            if hit and (best is None or hit < best):
                best = hit
        if best is None or best[0] > 0 and word in self.innocent:
            return None
        return best[0], -best[1]

    def features(self, text: str) -> list[float]:
        tokens = text.lower().split()
        new = set(tokens).difference(self.verdicts)
        if len(self.verdicts) + len(new) > self.KEEP:
            self.verdicts.clear()
            self.hits.clear()
            new = set(tokens)
        for token in new:
            hit = self.verdicts[token] = self.verdict(core(token))
            if hit:
                self.hits.add(token)
        exact = near = far = quoted = addressed = 0
        total = top = 0.0
        if not self.hits.isdisjoint(tokens):
            for place, token in enumerate(tokens):
                if token not in self.hits:
                    continue
                edits, weight = self.verdicts[token]
                exact += edits == 0
                near += edits == 1
                far += edits > 1
                around = tokens[max(0, place - WINDOW) : place + WINDOW + 1]
                told = any(t.startswith(_QUOTES) or t.endswith(_QUOTES) or core(t) in _REPORT for t in around)
                quoted += told
                addressed += not told and any(core(t) in _ADDRESS for t in around)
                if edits == 0:
                    total += weight
                    top = max(top, weight)
        return [
            math.log1p(exact),
            math.log1p(near),
            math.log1p(far),
            math.log1p(quoted),
            math.log1p(addressed),
            math.log1p(total),
            top,
            math.log1p(100 * total / (len(tokens) + 10)),
            exact,
            near + far,
            quoted,
        ]
