"""Toxicity by FTRL-proximal logistic regression over hashed words, pairs and skip-pairs.

A text's features are the distinct hashes of its words, of its neighbouring words and of
words with one word between them, in ``2**BITS`` places. FTRL-proximal keeps for each
place a sum of shifted gradients and a sum of squared ones; the latter sets the place's
own learning rate, and a place whose first sum is within ``l1`` has weight 0. So the
model is a short list of places and weights, and its size is bounded by ``2**BITS``.

Training takes at most about ``max_train`` labelled rows, chosen by a hash of the id.
They are dealt to shards of ``SHARD`` rows, each learns by itself in the order of a hash,
and the weights are averaged over the shards. Scoring covers every whole text.

Defined results: null and empty texts have no features and get the score of the bias
alone; where nothing can be learned every score is 0; repeated rows are scored one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.features import sampled_texts, word_patterns
from fireledger.llm.scratch import in_small_batches

PATTERNS = ((0,), (0, 1), (0, 2))
BITS = 20
SHARD = 10_000


def _follow_leader(
    rows: list[np.ndarray], labels: np.ndarray, alpha: float, beta: float, l1: float, l2: float, rounds: int
) -> np.ndarray:
    """Weights of one pass after another over the rows; the last place is the bias."""
    shifted, squares = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at) -> np.ndarray:
        z = shifted[at]
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(squares[at])) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0, w)

    for _ in range(rounds):
        for features, label in zip(rows, labels):
            at = np.append(features, 1 << BITS)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            grown = squares[at] + gradient * gradient
            shifted[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / alpha * w
            squares[at] = grown
    return weights(slice(None))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_train: int = 40_000,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 6.0,
    l2: float = 0.1,
    rounds: int = 6,
) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights from texts and the ``doc_id, label`` (0 or 1) of some; one label an id."""
    rows, n = sampled_texts(docs, labels, max_train)
    shards = max(1, round(n / SHARD))

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["order", "doc_id"], kind="stable")
        features = [x for run in word_patterns(shard["text"], PATTERNS, BITS) for x in run]
        weights = _follow_leader(features, shard["label"].to_numpy(float), alpha, beta, l1, l2, rounds)
        places = np.flatnonzero(weights)
        return pd.DataFrame({"place": places, "weight": weights[places]})

    learned = (
        rows.select("doc_id", "text", "label", F.xxhash64("doc_id", F.lit("order")).alias("order"))
        .withColumn("shard", F.pmod(F.col("order"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(fit, "place long, weight double")
        .groupBy("place")
        .agg((F.sum("weight") / shards).alias("weight"))
        .orderBy("place")
        .toPandas()
    )
    return learned["place"].to_numpy(np.int64), learned["weight"].to_numpy(np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` with the probability ``score`` of its ``text``, in place of a column of that name."""
    places, values = model
    broadcast = docs.sparkSession.sparkContext.broadcast((places, values))

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        places, values = broadcast.value
        if not len(places):
            return pd.Series(np.zeros(len(texts)))
        weights = np.zeros((1 << BITS) + 1)
        weights[places] = values
        sums = [weights[x].sum() for run in word_patterns(texts, PATTERNS, BITS) for x in run]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums) + weights[-1], -30, 30))))

    return in_small_batches(docs).withColumn("score", probability(F.col("text")))
