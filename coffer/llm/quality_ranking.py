"""Quality by Bradley-Terry pairwise ranking.

Each text has a vector of surface features. The model gives a text the strength ``w . x`` and says that of two texts the
first is preferred with probability ``sigmoid(w . (x1 - x2))``; ``w`` minimises the logistic loss on feature differences over
preference pairs, each of a labelled good and a labelled bad text. The threshold is the quantile of the training strengths
below which the share of bad labels lies; a score is the sigmoid of the distance to it.

Only the fit is bounded: it uses at most ``MAX_EXAMPLES`` labelled rows, those with the smallest hash of their id, and
``PAIRS`` pairs. Every row of the table is scored on its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import documents, examples, held_out, labels, map_texts, text_of, words_of

MAX_EXAMPLES = 20_000
PAIRS = 40_000
ROUNDS, RIDGE = 60, 1e-4

FEATURES = (
    "log_words", "log_lines", "word_chars", "long_words", "distinct_words", "top_word", "same_as_last", "same_lines",
    "capitals", "digits", "symbols", "shouts", "bars", "stops", "marked_words", "one_char_words",
)


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; ratios of an empty text are zero."""
    n = len(texts)
    codes, counts, distinct = words_of(texts)
    owner = np.repeat(np.arange(n), counts)
    words, chars = np.maximum(counts, 1), np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    sizes = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)[codes].astype(float)
    marked = pc.match_substring_regex(distinct, r"[#*$%&|<>!]$").to_numpy(zero_copy_only=False)[codes]
    pair = owner * max(1, len(distinct)) + codes
    kinds, times = np.unique(pair, return_counts=True)
    kind_owner = kinds // max(1, len(distinct))
    top = np.zeros(n)
    np.maximum.at(top, kind_owner, times)
    same = np.r_[False, pair[1:] == pair[:-1]] if len(pair) else np.zeros(0, bool)
    split = [t.split("\n") for t in texts.to_pylist()]
    lines = np.array([len(x) for x in split])

    def share(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False) / chars

    columns = [
        np.log1p(counts), np.log(lines), _per_text(sizes, owner, n) / words,
        _per_text(sizes > 15, owner, n) / words, _per_text(np.ones(len(kinds)), kind_owner, n) / words, top / words,
        _per_text(same, owner, n) / words, 1 - np.array([len(set(x)) for x in split]) / lines,
        share("[A-Z]"), share("[0-9]"), share(r"[#*$%&<>]"), share("!"), share(r"\|"), share(r"[.?]"),
        _per_text(marked, owner, n) / words, _per_text(sizes == 1, owner, n) / words,
    ]
    return np.column_stack(columns).astype(float) if n else np.zeros((0, len(FEATURES)))


def widen(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Features and, for each, how far it lies beyond each cut; so a strength need not rise in proportion."""
    beyond = np.maximum(0, x[:, :, None] - cuts[None]).reshape(len(x), -1)
    return np.hstack([x, beyond])


def fit(x: np.ndarray, good: np.ndarray) -> dict:
    """Bradley-Terry weights for standardised features, and the threshold strength."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - centre) / scale
    cuts = np.quantile(z, [0.03, 0.15, 0.5, 0.85, 0.97], axis=0).T
    wide = np.clip(widen(z, cuts), -8, 8)
    draw = np.random.default_rng(7)
    better = draw.choice(np.flatnonzero(good == 1), PAIRS)
    worse = draw.choice(np.flatnonzero(good == 0), PAIRS)
    weights = np.zeros(wide.shape[1])
    difference = wide[better] - wide[worse]
    for _ in range(ROUNDS):  # Newton steps
        chance = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ chance / PAIRS - RIDGE * weights
        curve = chance * (1 - chance)
        hessian = (difference * curve[:, None]).T @ difference / PAIRS + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    strength = wide @ weights
    threshold = float(np.quantile(strength, np.mean(good == 0)))
    return {"centre": centre, "scale": scale, "cuts": cuts, "weights": weights, "threshold": threshold}


def learn(docs: DataFrame, labelled: DataFrame, max_examples: int = MAX_EXAMPLES) -> dict | None:
    """The model of a bounded sample of rows that are not held out; none where a label is missing altogether."""

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array(list(rows), pa.list_(pa.float64()))], names=["label", "x"])

    chosen = examples(docs, labelled, "quality", max_examples).select("doc_id", "text", "label")
    rows = map_texts(chosen, measure, "label int, x array<double>").collect()
    good = np.array([r["label"] for r in rows])
    if len(set(good.tolist())) < 2:
        return None
    order = np.lexsort(np.array([r["x"] for r in rows]).T)  # the sample has no order of its own
    return fit(np.array([r["x"] for r in rows])[order], good[order])


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, score and predicted per row.

    Null and empty texts are scored as texts without words; equal texts get equal scores. A null id counts as held out.
    Without a model every score is 0.5.
    """

    def rate(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model is None:
            scores = np.full(batch.num_rows, 0.5)
        else:
            z = (features(batch.column(1)) - model["centre"]) / model["scale"]
            strength = np.clip(widen(z, model["cuts"]), -8, 8) @ model["weights"] - model["threshold"]
            scores = 1 / (1 + np.exp(-np.clip(strength, -30, 30)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores)], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), held_out().alias("held_out"))
    scored = map_texts(rows, rate, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, learn(docs, labels(spark, sf_dir)))
