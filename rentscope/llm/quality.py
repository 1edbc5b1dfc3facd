"""A quality classifier from pairwise preferences (Bradley-Terry).

Whole texts become small vectors of surface features. From labelled rows, pairs of a better
and a worse text are drawn; the chance that the better one wins is the logistic function of
the difference of scores, and scores are linear in the features. The weights minimise the
logistic loss over the differences. A text passes if its score lies above the quantile of the
learning rows' scores that their share of bad labels asks for.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from rentscope.llm.common import as_text, fold, map_batches, pick
from rentscope.plans.saved import save

#: Labelled rows to fit on, about, drawn by hash; opponents drawn for each of them.
FIT_ROWS = 10_000
OPPONENTS = 8
PENALTY = 1e-3
STEPS = 40
PASS_SCORE = 0.7

_LOWER, _UPPER, _DIGITS = (bytes(range(a, b + 1)) for a, b in ((0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39)))
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b not in _MARKS)
_ENDS = (b".", b"!", b"?", b":", b'"')


def text_features(text: str) -> list[float]:
    """Surface features of a whole text; shares lie in 0..1 and are 0 for an empty text."""
    data = text.encode("utf-8")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_bytes, n_words, n_lines = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    kinds = Counter(words)
    lower = data.lower().split()
    folded = Counter(lower)
    repeated_lines = sum(n * len(line) for line, n in Counter(lines).items() if n > 1)
    letters = len(data) - len(data.translate(None, _LOWER + _UPPER))
    upper = len(data) - len(data.translate(None, _UPPER))
    shares = [
        upper / max(1, letters),
        (len(data) - len(data.translate(None, _DIGITS))) / n_bytes,
        (len(data) - len(data.translate(None, _MARKS))) / n_bytes,
        (len(data) - len(data.translate(None, _SYMBOLS))) / n_bytes,
        data.count(b"\n") / n_bytes,
        data.count(b"!") / n_words,
        data.count(b".") / n_words,
        data.count(b",") / n_words,
        sum(map(bytes.isupper, words)) / n_words,
        sum(map(bytes.isalpha, words)) / n_words,
        sum(n for w, n in kinds.items() if len(w) == 1 and not w.isalnum()) / n_words,
        sum(a == b for a, b in zip(lower, lower[1:], strict=False)) / n_words,
        folded.most_common(1)[0][1] / n_words if folded else 0.0,
        len(folded) / n_words,
        sum(1 for n in folded.values() if n == 1) / n_words,
        repeated_lines / n_bytes,
        len(set(lines)) / n_lines if lines else 0.0,
        sum(line.rstrip().endswith(_ENDS) for line in lines) / n_lines,
        len(set(zip(lower, lower[1:], strict=False))) / n_words,
    ]
    sizes = [np.log1p(len(words)), np.log1p(len(data) / n_words), np.log1p(n_words / n_lines), np.log1p(max(map(len, words), default=0))]
    return [float(x) for x in (*shares, *sizes, *(np.sqrt(s) for s in shares))]


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """``features`` of each text, with the columns to keep; a null text counts as an empty one."""
    docs = pick(docs, "text", *keep)

    def make() -> Callable:
        return lambda columns: {k: columns[k] for k in keep} | {"features": [text_features(as_text(t)) for t in columns["text"]]}

    return map_batches(docs, make, StructType([*(docs.schema[k] for k in keep), StructField("features", ArrayType(DoubleType()))]))


@dataclass
class Ranking:
    """Score of a feature vector: ``weights @ features + offset``, in units where PASS_SCORE is the quantile."""

    weights: list[float]
    offset: float

    def score(self, vector: Column) -> Column:
        linear = F.aggregate(
            F.zip_with(vector, F.array(*map(F.lit, self.weights)), lambda x, w: x * w), F.lit(self.offset), lambda total, x: total + x
        )
        return 1 / (1 + F.exp(-linear))


def fit(vectors: np.ndarray, good: np.ndarray, opponents: int = OPPONENTS, penalty: float = PENALTY, seed: int = 7) -> Ranking:
    """Bradley-Terry weights from pairs of a good and a bad row, and the quantile threshold.

    With one kind of label only there are no pairs: all weights are 0 and the score is the share of good labels.
    """
    n_good = int(good.sum())
    if n_good in (0, len(good)):
        share = min(max(n_good / max(1, len(good)), 0.01), 0.99)
        return Ranking([0.0] * vectors.shape[1], float(np.log(share / (1 - share))))
    mean, spread = vectors.mean(axis=0), vectors.std(axis=0)
    spread[spread < 1e-9] = 1.0
    scaled = (vectors - mean) / spread
    rng = np.random.default_rng(seed)
    better, worse = scaled[good], scaled[~good]
    n_pairs = opponents * max(len(better), len(worse))
    difference = better[np.arange(n_pairs) % len(better)] - worse[rng.integers(0, len(worse), n_pairs)]
    weights = np.zeros(scaled.shape[1])
    for _ in range(STEPS):
        wins = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ (wins - 1) / n_pairs + penalty * weights
        bend = (difference * (wins * (1 - wins))[:, None]).T @ difference / n_pairs + penalty * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = scaled @ weights
    # Half way between the two rows around the quantile, so that the cut does not sit on a row.
    ordered, n_bad = np.sort(scores), len(good) - n_good
    threshold = (ordered[n_bad - 1] + ordered[n_bad]) / 2
    # Steepness: one-dimensional logistic fit of the labels around the threshold.
    steep, centred = 1.0, scores - threshold
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(steep * centred, -30, 30)))
        slope = np.mean((chance - good) * centred) + 1e-3 * steep
        steep = float(np.clip(steep - slope / (np.mean(chance * (1 - chance) * centred**2) + 1e-3), 0.05, 50))
    raw = weights / spread * steep
    return Ranking([float(w) for w in raw], float(np.log(PASS_SCORE / (1 - PASS_SCORE)) - steep * threshold - raw @ mean))


def learn(vectors: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ranking:
    """Fit on about ``fit_rows`` labelled rows, drawn by a hash of their ids. Rows without id or label are passed over.

    The share to draw follows from the number of labelled rows, so every task sends its part only.
    """
    labels = pick(labels, "doc_id", "quality").filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    share = min(1.0, fit_rows / max(1, labels.count()))
    drawn = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < int(share * 2**31))
    rows = sorted(vectors.join(drawn, "doc_id").select("doc_id", "quality", "features").collect(), key=lambda r: (r.doc_id, r.quality, r.features))
    vectors_of = np.array([r.features for r in rows]) if rows else np.zeros((0, len(text_features(""))))
    return fit(vectors_of, np.array([r.quality == 1 for r in rows], dtype=bool))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Quality score of every text, learned from labels outside the held-out fold.

    Returns ``doc_id, held_out, score, predicted``, one row per input row. Texts are read once;
    labels, language, source and id are no features. Null and empty texts get the score of a
    vector without words. Without usable labels all scores are equal. Repeated labels of a row
    count as often as they come.
    """
    vectors = save(features(pick(docs, "doc_id", "text"), "doc_id"), "quality-features")
    held_out = fold("doc_id", folds) == held
    ranking = learn(vectors.filter(~held_out), labels, fit_rows)
    scored = vectors.select("doc_id", held_out.alias("held_out"), ranking.score(F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PASS_SCORE).cast("int"))
