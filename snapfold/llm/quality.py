"""Quality classifier: a sparse rule ensemble over text statistics.

``statistics`` counts each whole text once. Boosted shallow trees are fitted on a bounded
sample of labelled rows; every path from a root to a node is a conjunctive rule. A
lasso logistic regression (proximal gradient) picks few rules and weighs them, and
the ensemble is compiled to one Spark column expression over the statistics.

Only statistics of the text are inputs. Defined results: null and empty texts are scored
by their (zero) statistics; repeated rows give repeated rows; with no labelled rows of
both kinds the score is the share of label 1 there (0.5 without any); a null doc_id is
scored and is never a training row; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapfold.llm.common import OWN, batch_of, boxed, id_text, map_slices, with_score
from snapfold.llm.labelled import TRAIN_ROWS, chosen, fold, training_rows

TREES = 40
DEPTH = 3
SHRINK = 0.3
BINS = 32
LASSO = 0.002
STEPS = 400

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
PLAIN = b".,;:!?'\"()- \t\r\n"
SYMBOLS = bytes(c for c in range(33, 127) if c not in LETTERS + DIGITS + PLAIN)
URL = re.compile(rb"https?://|www\.")

STATS = ["log_words", "word_length", "longest_word", "upper_share", "digit_share", "symbol_share", "mark_share",
         "space_share", "loud_share", "distinct_share", "top_share", "same_share", "pair_share", "line_share",
         "words_a_line", "stop_share", "short_share", "letter_variety", "urls"]


def statistics_of(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n, size = len(words), max(1, len(raw))
    count = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    lengths = list(map(len, words))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    per = max(1, n)
    return [float(np.log1p(n)), sum(lengths) / per, float(min(max(lengths, default=0), 1000)), count(UPPER) / size,
            count(DIGITS) / size, count(SYMBOLS) / size, count(b".,;:!?") / size, count(b" \t\r\n") / size,
            raw.count(b"!") / per, len(seen) / per, max(seen.values(), default=0) / per, same / max(1, n - 1),
            pairs / max(1, n - 1), len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)),
            raw.count(b". ") / per, sum(x < 4 for x in lengths) / per, len(set(raw)) / 256.0,
            len(URL.findall(raw)) / per]


SCORE = "__quality_score"       # the column that ``scored`` adds


def with_statistics(rows: DataFrame, text: str = "text") -> DataFrame:
    """Every row's column OWN and the statistics of its column ``text``, one column each."""
    schema = StructType([rows.schema[OWN]] + [StructField(s, DoubleType()) for s in STATS])

    def make():
        def run(batch):
            got = np.array([statistics_of(t or "") for t in batch.column(text).to_pylist()]).reshape(-1, len(STATS))
            return batch_of({OWN: batch.column(OWN)} | {s: pa.array(got[:, j]) for j, s in enumerate(STATS)})
        return run
    return map_slices(rows, make, schema)


# ---- rules

Rule = tuple[tuple[int, bool, float], ...]     # (statistic, is <= else >, value), all must hold


def _tree(binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> list[tuple[Rule, np.ndarray, float]]:
    """A boosted tree's nodes under the root: (rule, rows, its value if it is a leaf, else 0)."""
    out: list[tuple[Rule, np.ndarray, float]] = []
    least = max(5, len(grad) // 500)

    def grow(rows: np.ndarray, rule: Rule, depth: int) -> None:
        best = (1e-6, -1, -1)
        if depth < DEPTH and len(rows) >= 2 * least:
            g, h = grad[rows], hess[rows]
            all_g, all_h = g.sum(), h.sum()
            for j in range(binned.shape[1]):
                b = binned[rows, j]
                lg = np.cumsum(np.bincount(b, g, BINS))
                lh = np.cumsum(np.bincount(b, h, BINS))
                ln = np.cumsum(np.bincount(b, minlength=BINS))
                gain = lg ** 2 / (lh + 1) + (all_g - lg) ** 2 / (all_h - lh + 1) - all_g ** 2 / (all_h + 1)
                gain[(ln < least) | (len(rows) - ln < least)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best[1] < 0:
            if rule:
                out.append((rule, rows, float(grad[rows].sum() / (hess[rows].sum() + 1))))
            return
        if rule:
            out.append((rule, rows, 0.0))
        _, j, k = best
        low = binned[rows, j] <= k
        cut = float(edges[j][k])
        grow(rows[low], rule + ((j, True, cut),), depth + 1)
        grow(rows[~low], rule + ((j, False, cut),), depth + 1)
    grow(np.arange(len(grad)), (), 0)
    return out


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The distinct path rules of TREES boosted trees."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    p = y.mean()
    score = np.full(len(y), np.log(p / (1 - p)))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        now = 1 / (1 + np.exp(-score))
        for rule, rows, value in _tree(binned, edges, y - now, np.maximum(now * (1 - now), 1e-6)):
            found[tuple(sorted(rule))] = None
            score[rows] += SHRINK * value
    return list(found)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for j, low, value in rule:
        ok &= (x[:, j] <= value) if low else (x[:, j] > value)
    return ok


def lasso_logistic(a: np.ndarray, y: np.ndarray, strength: float = LASSO, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """(intercept, weights) of logistic regression with an L1 penalty, by accelerated
    proximal gradient; the intercept isn't penalised."""
    n, m = a.shape
    mean = a.mean(axis=0)
    c = a - mean
    v = np.ones(m)
    for _ in range(30):                                    # largest curvature
        v = c.T @ (c @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 4 / max(np.linalg.norm(c @ v) ** 2 / n, 1e-9)
    w, b = np.zeros(m), float(np.log(y.mean() / (1 - y.mean())))
    z, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(c @ z + b)))
        b -= 4 * float((p - y).mean())
        moved = z - step * (c.T @ (p - y) / n)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * strength, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return b - float(mean @ w), w


class RuleEnsemble:
    """score = logistic(intercept + sum of the weights of the rules that hold)."""

    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            test = None
            for j, low, value in rule:
                one = F.col(STATS[j]) <= value if low else F.col(STATS[j]) > value
                test = one if test is None else test & one
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> RuleEnsemble:
    """Fitted on at most ``rows`` labelled ids outside the held-out fold, a row for each."""
    train = chosen(labels, label, fold(F.col("doc_id"), folds) != held_out, rows)
    texts = training_rows(docs, train, id_col, text_col)
    got = with_statistics(texts.select(F.struct("doc_id", "y").alias(OWN), "text")) \
        .select(f"{OWN}.*", *STATS).toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    x = np.stack([got.column(s).to_numpy()[order] for s in STATS], axis=1)
    y = got.column("y").to_numpy()[order].astype(float)
    p = float(y.mean()) if len(y) else 0.5
    if p in (0.0, 1.0) or len(y) < 20:
        p = min(max(p, 1e-6), 1 - 1e-6)
        return RuleEnsemble(float(np.log(p / (1 - p))), [])
    rules = extract_rules(x, y)
    b, w = lasso_logistic(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y)
    return RuleEnsemble(b, [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6])


def own_scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """(own, score): every row, its columns in the struct OWN (``common.unboxed``)."""
    rows = docs.select(boxed(docs), F.col(text_col).cast("string").alias("text"))
    return with_statistics(rows).select(OWN, model.column().alias("score"))


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """Every row with all its columns and its score in column SCORE, a name of its own."""
    return with_score(own_scored(docs, model, text_col), docs.columns, SCORE)


def classify(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = id_text(docs, id_col, text_col).select(F.struct("doc_id").alias(OWN), "text")
    return with_statistics(rows).select(f"{OWN}.doc_id", model.column().alias("score"))
