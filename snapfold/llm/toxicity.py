"""Toxicity classifier by weak supervision.

1. ``learn_lexicon``: terms (words, their parts between other characters than letters,
   the beginnings of both, and character n-grams of scripts written without spaces) that
   are far commoner in toxic than in other labelled training rows, counted in Spark over a
   bounded sample of rows. Of more terms than ``terms`` (a parameter of ``fit``, MOST_TERMS
   by default) those in the most toxic rows stay: it bounds the model that every task loads.
2. Many voters label each sampled text toxic, clean or abstain: lexicon voters (the
   learned words and beginnings dealt into several each, and a fixed list), pattern
   voters (insults by form, shouting, exclamation marks, no known term) and, on training
   rows, the annotator.
3. ``LabelModel``, generative: voters' accuracies given the hidden class, and their
   correlations as a tree of dependencies (the maximum spanning tree of the voters'
   mutual information given the class), estimated by EM over the votes.
4. A linear classifier is trained on the model's posterior labels and scores whole texts
   by the terms and patterns that they hold.

Defined results: null and empty texts are scored by the intercept; repeated rows give
repeated rows; without labelled rows of both kinds the score is the share of label 1
(0 without any); a null doc_id is scored and never a training row; other columns are
ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapfold.llm.common import OWN, RunCache, batch_of, boxed, id_text, map_slices, store, with_score
from snapfold.llm.labelled import TRAIN_ROWS, chosen, fold, training_rows

BEGINNINGS = (3, 4, 5, 6, 7, 8)
GRAMS = (1, 2, 3, 4)    # characters of n-grams of unspaced scripts
LONGEST = 40            # characters of a term; of longer words there are beginnings and parts
LEAST_DOCS = 4          # toxic training rows that a learned term is in, at least
SURPRISE = 6.0          # standard deviations over chance, at least
RATIO = 16.0            # commoner in toxic rows by this factor, at least
MOST_TERMS = 6000       # learned terms, at most: the default of fit's ``terms``
LEXICONS = 8            # voters that the learned words, and the beginnings, are dealt into
EM_ROUNDS = 15
CACHED = 200_000

# A fixed list of English insults, the lexicon voter that is not learned.
INSULTS = frozenset("idiot moron loser stupid pathetic worthless disgusting scum trash clown dumb fool jerk ugly "
                    "vermin filth".split())
YOU_ARE = re.compile(r"\b(?:you|you're|u)\b(?: are)? (?:such )?(?:a|an|so)\b")
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_"
PARTS = regex.compile(r"[\p{L}\p{M}]+")
# runs of scripts written without spaces between words
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\u30fc]"
                         r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{M}\u30fc]*")


def words_of(text: str) -> set[str]:
    """Distinct words without the punctuation around them, lower case."""
    return {w.strip(EDGES) for w in set(text.lower().split())} - {""}


def terms_of(word: str) -> set[str]:
    """A word and its parts between other characters than letters, all with their
    beginnings, marked by a star; and the n-grams of runs of unspaced scripts."""
    parts = {word} if word.isalpha() else {word, *PARTS.findall(word)}
    got = {p for p in parts if len(p) <= LONGEST}
    got.update(p[:n] + "*" for p in parts for n in BEGINNINGS if len(p) > n)
    if not word.isascii():
        for run in UNSPACED.findall(word):
            got.update(run[k:k + n] for n in GRAMS for k in range(len(run) - n + 1))
    return got


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled ids outside the held-out fold, a row for each."""
    train = chosen(labels, label, fold(F.col("doc_id"), folds) != held_out, rows)
    return training_rows(docs, train, id_col, text_col)


def learn_lexicon(train: DataFrame, most: int = MOST_TERMS) -> dict[str, float]:
    """Log-ratio of each learned term: how much commoner it is in toxic rows."""
    def count(batches):
        held: dict[str, list[int]] = {}                 # a term's toxic rows and rows, combined here

        def flush():
            out = batch_of({"term": (list(held), pa.string()),
                            "toxic": ([x[0] for x in held.values()], pa.int64()),
                            "n": ([x[1] for x in held.values()], pa.int64())})
            held.clear()
            return out
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for y, text in zip(some.column("y").to_pylist(), some.column("text").to_pylist()):
                    for t in {t for w in words_of(text) for t in terms_of(w)}:
                        x = held.setdefault(t, [0, 0])
                        x[0] += y
                        x[1] += 1
                if len(held) > CACHED:
                    yield flush()
        if held:
            yield flush()
    counts = train.select("y", "text").mapInArrow(count, "term string, toxic long, n long") \
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    size = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    n, toxic = size["n"], size["toxic"] or 0
    if not toxic or toxic == n:
        return {}
    ratio = ((F.col("toxic") + 0.1) / F.lit(float(toxic))) / ((F.col("n") - F.col("toxic") + 0.5) / F.lit(float(n - toxic)))
    expected = F.col("n") * F.lit(toxic / n)
    surprise = (F.col("toxic") - expected) / F.sqrt(expected)
    found = (counts.filter(F.col("toxic") >= LEAST_DOCS).withColumn("ratio", ratio)
             .filter((F.col("ratio") >= RATIO) & (surprise >= SURPRISE))
             .orderBy(F.desc("toxic"), "term").limit(most))
    return {r["term"]: math.log(r["ratio"]) for r in found.collect()}


# ---- voters

def voter_names() -> list[str]:
    return ([f"words{k}" for k in range(LEXICONS)] + [f"beginnings{k}" for k in range(LEXICONS)]
            + ["insults", "you_are", "shouting", "exclaims", "no_word", "no_beginning", "long_clean"])


class Voters:
    """Votes of a text: 0 abstains, 1 clean, 2 toxic; and its known terms."""

    def __init__(self, lexicon: dict[str, float]):
        terms = sorted(lexicon)
        self.index = {t: k for k, t in enumerate(terms)}
        self.cache = RunCache(self.known, CACHED)

    def known(self, word: str) -> tuple[int, ...]:
        word = word.strip(EDGES)
        return tuple(self.index[t] for t in terms_of(word) if t in self.index) if word else ()

    def terms(self, low: str) -> list[int]:
        got: set[int] = set()
        for found in map(self.cache.__getitem__, set(low.split())):
            if found:
                got.update(found)
        self.cache.turn()
        return sorted(got)

    def votes(self, text: str, low: str, terms: list[int], beginning: np.ndarray) -> list[int]:
        word_votes, beginning_votes = [0] * LEXICONS, [0] * LEXICONS
        for t in terms:
            (beginning_votes if beginning[t] else word_votes)[t % LEXICONS] = 2
        raw = text.encode("utf-8", "surrogatepass")
        upper = len(raw) - len(raw.translate(None, UPPER))
        lower = len(raw) - len(raw.translate(None, LOWER))
        return word_votes + beginning_votes + [
            2 if any(w in low for w in INSULTS) else 0, 2 if YOU_ARE.search(low) else 0, 2 if upper > 2 * lower else 0,
            2 if text.count("!") > len(text) / 100 else 0, 0 if any(word_votes) else 1,
            0 if any(beginning_votes) else 1, 1 if len(text) > 400 and not terms else 0]


class LabelModel:
    """p(votes | class) as a product over a tree of voters: each depends on the class and
    on one other voter. ``tables[j][class, parent's vote, vote]``."""

    def __init__(self, votes: np.ndarray, start: np.ndarray, rounds: int = EM_ROUNDS):
        n, m = votes.shape
        hot = np.zeros((n, m, 3))
        hot[np.arange(n)[:, None], np.arange(m), votes] = 1
        flat = hot.reshape(n, 3 * m)
        p = np.clip(start, 0.02, 0.98)
        for _ in range(rounds):
            self._maximise(flat, p, m)
            p = self.posterior(votes)
        self.p = p

    def _maximise(self, flat: np.ndarray, p: np.ndarray, m: int) -> None:
        self.prior = float(np.clip(p.mean(), 1e-4, 1 - 1e-4))
        joint = np.stack([flat.T @ (flat * w[:, None]) for w in (1 - p, p)]) \
            .reshape(2, m, 3, m, 3).transpose(0, 1, 3, 2, 4) + 0.1      # [class, j, k, vote j, vote k]
        share = joint / joint.sum(axis=(3, 4), keepdims=True)
        own = share.sum(axis=4, keepdims=True) * share.sum(axis=3, keepdims=True)
        about = (share * np.log(share / own)).sum(axis=(3, 4))
        info = (1 - self.prior) * about[0] + self.prior * about[1]      # given the class
        self.parent = [-1] * m                                          # Prim's tree
        inside, best = {0}, {k: (info[0, k], 0) for k in range(1, m)}
        self.order = [0]
        while best:
            k = max(best, key=lambda x: (best[x][0], -x))
            self.parent[k] = best.pop(k)[1]
            inside.add(k)
            self.order.append(k)
            for x in best:
                if info[k, x] > best[x][0]:
                    best[x] = (info[k, x], k)
        self.tables = []
        for k in range(m):
            j = self.parent[k]
            t = joint[:, k, k].diagonal(axis1=1, axis2=2)[:, None, :].repeat(3, axis=1) if j < 0 else joint[:, j, k]
            self.tables.append(t / t.sum(axis=2, keepdims=True))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = [np.full(len(votes), math.log(1 - self.prior)), np.full(len(votes), math.log(self.prior))]
        for k, j in enumerate(self.parent):
            of = votes[:, j] if j >= 0 else np.zeros(len(votes), dtype=int)
            for c in (0, 1):
                logs[c] = logs[c] + np.log(self.tables[k][c, of, votes[:, k]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def fit_linear(rows: list[list[int]], p: np.ndarray, size: int, steps: int = 500, decay: float = 1e-4) -> tuple[float, np.ndarray]:
    """(intercept, weights) of logistic regression on sets of features, for posterior
    labels ``p``, by gradient descent with momentum scaled by each feature's curvature."""
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.array([t for r in rows for t in r], dtype=np.int64)
    prior = float(np.clip(p.mean(), 1e-4, 1 - 1e-4))
    b, w = math.log(prior / (1 - prior)), np.zeros(size)
    held = np.bincount(col, minlength=size) / n
    many = np.maximum(np.bincount(row, minlength=n), 1) if n else np.ones(0)
    curve = np.bincount(col, many[row], minlength=size) / n / 4 + decay + 1e-6
    vb, vw = 0.0, np.zeros(size)
    for _ in range(steps):
        s = b + np.bincount(row, w[col], minlength=n)
        off = 1 / (1 + np.exp(-np.clip(s, -40, 40))) - p
        g = np.bincount(col, off[row], minlength=size) / n + decay * w
        vw = 0.9 * vw - 0.5 * g / curve
        vb = 0.9 * vb - 0.5 * float(off.mean())
        w, b = w + vw, b + vb
    w[held == 0] = 0
    return b, w


class Model:
    """score = logistic(intercept + weights of the known terms + weights of the patterns)."""

    def __init__(self, lexicon: dict[str, float], intercept: float, weights: np.ndarray):
        self.lexicon, self.intercept, self.weights = lexicon, intercept, weights


PATTERNS = ["insults", "you_are", "shouting", "exclaims"]


def _features(voters: Voters, beginning: np.ndarray, text: str) -> tuple[list[int], list[int]]:
    """(votes, features): features are known terms, then patterns that voted."""
    low = text.lower()
    terms = voters.terms(low)
    votes = voters.votes(text, low, terms, beginning)
    first = 2 * LEXICONS
    return votes, terms + [len(beginning) + k for k in range(len(PATTERNS)) if votes[first + k] == 2]


def _beginnings(lexicon: dict[str, float]) -> np.ndarray:
    return np.array([t.endswith("*") for t in sorted(lexicon)], dtype=bool)


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", terms: int = MOST_TERMS) -> Model:
    """A model of at most ``terms`` terms, from at most ``rows`` labelled rows."""
    train = store(sample(docs, labels, label, folds, held_out, rows, id_col, text_col), "toxicity-rows")
    lexicon = learn_lexicon(train, terms)
    beginning = _beginnings(lexicon)

    def make():
        voters = Voters(lexicon)

        def run(batch):
            got = [_features(voters, beginning, t) for t in batch.column("text").to_pylist()]
            return batch_of({"doc_id": batch.column("doc_id"), "y": batch.column("y"),
                             "votes": ([v for v, _ in got], pa.list_(pa.int32())),
                             "features": ([f for _, f in got], pa.list_(pa.int32()))})
        return run
    got = map_slices(train, make, "doc_id long, y int, votes array<int>, features array<int>").toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    size = len(lexicon) + len(PATTERNS)
    y = got.column("y").to_numpy()[order].astype(float)
    p = float(y.mean()) if len(y) else 0.0
    if not lexicon or p in (0.0, 1.0):
        p = min(max(p, 1e-6), 1 - 1e-6)
        return Model({}, math.log(p / (1 - p)), np.zeros(len(PATTERNS)))
    votes = np.array(got.column("votes").to_pylist(), dtype=np.int64)[order]
    # the hidden class starts from the share of toxic rows for each number of toxic votes;
    # the annotator who gave the labels is one more voter, whose accuracy is estimated too
    some = np.minimum((votes == 2).sum(axis=1), 3)
    share = np.array([y[some == k].mean() if (some == k).any() else p for k in range(4)])
    posterior = LabelModel(np.column_stack([votes, y.astype(np.int64) + 1]), share[some]).p
    features = got.column("features").to_pylist()
    b, w = fit_linear([features[k] for k in order], posterior, size)
    return Model(lexicon, b, w)


SCORE = "__toxicity_score"      # the column that ``scored`` adds


def own_scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(own, score): every row, its columns in the struct OWN (``common.unboxed``), and the
    score of its whole text."""
    return _scored(docs.select(boxed(docs), F.col(text_col).cast("string").alias("text")), model)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row with all its columns and its score in column SCORE, a name of its own."""
    return with_score(own_scored(docs, model, text_col), docs.columns, SCORE)


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    lexicon, intercept, weights = model.lexicon, model.intercept, model.weights
    beginning = _beginnings(lexicon)

    def make():
        voters = Voters(lexicon)

        def run(batch):
            scores = []
            for text in batch.column("text").to_pylist():
                total = intercept + float(weights[_features(voters, beginning, text or "")[1]].sum())
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, total)))))
            return batch_of({OWN: batch.column(OWN), "score": (scores, pa.float64())})
        return run
    return map_slices(rows, make, StructType([rows.schema[OWN], StructField("score", DoubleType())]))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = id_text(docs, id_col, text_col).select(F.struct("doc_id").alias(OWN), "text")
    return _scored(rows, model).select(f"{OWN}.doc_id", "score")
