"""Quality grades by ordinal regression with cumulative links over hashed text.

A text's features are the distinct hashes of its three-byte strings and of its words, in
``2**BITS`` places, each with the value 1 / root of their number. One set of weights
gives a text its strength; ordered thresholds part the grades:
``P(grade >= k) = sigmoid(strength - threshold[k])``. The weights follow the gradient of
the log-likelihood with a learning rate for each place. From the probabilities come
the expected grade and, for selection, the probability of a grade or more.

Training takes at most about ``max_train`` graded rows, chosen by a hash of the id, dealt
to shards of ``SHARD`` rows whose weights and thresholds are averaged. Every whole text
is graded.

Defined results: null and empty texts have no features, so the thresholds alone grade
them; with no graded row at all every probability is 0; repeated rows are graded one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.features import byte_trigrams_and_words, sampled_texts
from fireledger.llm.scratch import in_small_batches, unused

BITS = 18
SHARD = 10_000


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _climb(rows: list[np.ndarray], grades: np.ndarray, levels: int, rate: float, l2: float, rounds: int) -> np.ndarray:
    """Weights, then the thresholds of the grades 1, 2, ..."""
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    shares = np.array([np.mean(grades >= k) for k in range(1, levels)]).clip(1e-3, 1 - 1e-3)
    thresholds = -np.log(shares / (1 - shares))
    threshold_squares = np.ones(levels - 1)
    for _ in range(rounds):
        for at, grade in zip(rows, grades):
            value = 1 / np.sqrt(max(len(at), 1))
            strength = weights[at].sum() * value
            edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
            below, upto = _sigmoid(edges[grade] - strength), _sigmoid(edges[grade + 1] - strength)
            step = (below + upto - 1) * value - l2 * weights[at]
            squares[at] += step * step
            weights[at] += rate * step / np.sqrt(squares[at])
            push = np.zeros(levels - 1)
            inside = max(upto - below, 1e-9)
            if grade > 0:
                push[grade - 1] -= below * (1 - below) / inside
            if grade < levels - 1:
                push[grade] += upto * (1 - upto) / inside
            threshold_squares += push * push
            thresholds = np.maximum.accumulate(thresholds + rate * push / np.sqrt(threshold_squares))
    return np.concatenate([weights, thresholds])


def learn(
    docs: DataFrame, labels: DataFrame, levels: int, max_train: int = 40_000, rate: float = 0.1, l2: float = 1e-4, rounds: int = 4
) -> np.ndarray | None:
    """Weights and thresholds from texts and the ``doc_id, grade`` (0 to levels - 1) of some; one grade an id."""
    rows, n = sampled_texts(docs, labels, max_train)
    shards = max(1, round(n / SHARD))

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["order", "doc_id"], kind="stable")
        features = [x for run in byte_trigrams_and_words(shard["text"], BITS) for x in run]
        found = _climb(features, shard["grade"].to_numpy(int), levels, rate, l2, rounds)
        places = np.flatnonzero(found)
        return pd.DataFrame({"place": places, "value": found[places]})

    learned = (
        rows.select("doc_id", "text", "grade", F.xxhash64("doc_id", F.lit("order")).alias("order"))
        .withColumn("shard", F.pmod(F.col("order"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(fit, "place long, value double")
        .groupBy("place")
        .agg((F.sum("value") / shards).alias("value"))
        .orderBy("place")
        .toPandas()
    )
    if not len(learned):
        return None
    model = np.zeros((1 << BITS) + levels - 1)
    model[learned["place"].to_numpy(np.int64)] = learned["value"].to_numpy(np.float64)
    return model


def grade(docs: DataFrame, model: np.ndarray | None, levels: int, selected_from: int = 1, least: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_tail`` (a grade of ``selected_from`` or more) and ``selected``,
    in place of columns of these names."""
    found = unused("grade_found", docs.columns)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<expected:double,tail:double>")
    def probabilities(texts: pd.Series) -> pd.DataFrame:
        model = broadcast.value
        if model is None:
            return pd.DataFrame({"expected": np.zeros(len(texts)), "tail": np.zeros(len(texts))})
        strengths = np.array(
            [model[x].sum() / np.sqrt(max(len(x), 1)) for run in byte_trigrams_and_words(texts, BITS) for x in run]
        )
        above = _sigmoid(strengths[:, None] - model[1 << BITS :][None, :])
        return pd.DataFrame({"expected": above.sum(axis=1), "tail": above[:, selected_from - 1]})

    return (
        in_small_batches(docs).withColumn(found, probabilities(F.col("text")))
        .withColumn("expected_grade", F.col(f"{found}.expected"))
        .withColumn("p_tail", F.col(f"{found}.tail"))
        .withColumn("selected", F.col("p_tail") >= least)
        .drop(found)
    )
