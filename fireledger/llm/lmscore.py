"""Score documents by the difference of two language models' losses.

A target model counts the words and word pairs of chosen documents, a background model
those of all documents. They share one vocabulary, the words of all documents, and one
smoothing: ``p(w) = (c(w) + 1) / (N + V)`` and
``p(w | v) = (c(v, w) + weight * p(w)) / (c(v) + weight)``. A document's score is the mean
over its words of target loss minus background loss: the lower, the more it is like the
target. A document's own counts are taken out of both models first, so a document in
the target gets no reward for being there.

Counts cover all documents and all n-grams, and no task holds the models: texts are
dealt to chunks; a chunk sends each distinct n-gram once, with its counts, to a bucket
by hash; a bucket sums up and answers with the totals in the order asked; the words
of all buckets are added up in one row, which every chunk gets; the chunk scores its documents with the answers. In a bucket n-grams are known by 40 bits
of their hash, so of a million n-grams some two share a count.

Words are runs of letters and digits in lower case. Defined results: null and empty
texts have no words and null losses and score; without any target document the target
model is smoothing alone; rows of one id are scored one by one and are in the target
together; an empty table gives an empty table; other columns are not looked at. Rows are
dealt by their place in ``docs``, so ``docs`` must come in the same order if read again, as
files do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.packed import numbers, planes, steps, unstepped
from fireledger.llm.words import NOT_ALNUM, mixed, pieces, words_of

CHUNK = 8 << 20
BUCKET = 16 << 20
BITS = 40
WEIGHT = 4.0

ASKED = "bucket bigint, lm_chunk bigint, keys binary, here binary, target binary"
TOLD = "lm_chunk bigint, bucket bigint, words bigint, here_words bigint, target_words bigint, here binary, target binary"


class _Chunk:
    """Words and pairs of a chunk's documents as places in its dictionary of n-grams."""

    def __init__(self, rows: pd.DataFrame, buckets: int) -> None:
        labels = rows["lm_label"].to_numpy(bool)
        self.rows = rows[~labels].sort_values("lm_row", kind="stable")
        self.target = np.isin(self.rows["lm_row"].to_numpy(np.int64), rows["lm_row"][labels].to_numpy(np.int64))
        words, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, run in pieces(self.rows["text"]):
            found = words_of(run, NOT_ALNUM)
            words.append(found.hashes)
            owner.append(found.text + first)
        words, self.doc = np.concatenate(words), np.concatenate(owner)
        self.follows = np.zeros(len(words), bool)
        self.follows[1:] = self.doc[1:] == self.doc[:-1]
        self.second = np.flatnonzero(self.follows)
        pairs = mixed(words[self.second - 1], 80) ^ words[self.second]
        keys = np.concatenate([self._key(words, 1, buckets), self._key(pairs, 0, buckets)])
        self.keys, place = np.unique(keys, return_inverse=True)
        self.word, self.pair = place[: len(words)], place[len(words) :]
        self.owners = np.concatenate([self.doc, self.doc[self.second]])
        self.places = place

    @staticmethod
    def _key(hashes: np.ndarray, word: int, buckets: int) -> np.ndarray:
        """Bucket, hash and whether it is a word, in one number that sorts by bucket."""
        hashes = mixed(hashes, 82 + word)
        rest = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
        bucket = (hashes & np.uint64((1 << 24) - 1)).astype(np.int64) % buckets
        return (bucket << (BITS + 1)) | rest << 1 | word

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        here = np.bincount(self.places, minlength=len(self.keys))
        target = np.bincount(self.places[self.target[self.owners]], minlength=len(self.keys))
        return here, target

    def own(self) -> np.ndarray:
        """For each word and pair, how often its document has it."""
        _, place, count = np.unique(self.owners * len(self.keys) + self.places, return_inverse=True, return_counts=True)
        return count[place]


def _ask(buckets: int):
    def ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(rows, buckets)
        here, target = chunk.counts()
        bounds = np.searchsorted(chunk.keys, np.arange(buckets + 1) << (BITS + 1))
        rest = chunk.keys & ((1 << (BITS + 1)) - 1)
        out = [
            (b, key[0], steps(rest[i:j]), planes(here[i:j]), planes(target[i:j]))
            for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:]))
            if i < j
        ]
        return pd.DataFrame(out, columns=["bucket", "lm_chunk", "keys", "here", "target"])

    return ask


def _tell(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
    each = [unstepped(x) for x in asked["keys"]]
    keys = np.concatenate(each)
    distinct, place = np.unique(keys, return_inverse=True)
    sums = []
    for name in ("here", "target"):
        counts = np.concatenate([numbers(x) for x in asked[name]])
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, place, counts)
        sums.append(total)
    bounds = np.cumsum([0] + [len(x) for x in each])
    out = [
        (chunk, key[0], 0, 0, 0, planes(sums[0][place[i:j]]), planes(sums[1][place[i:j]]))
        for chunk, i, j in zip(asked["lm_chunk"], bounds[:-1], bounds[1:])
    ]
    return pd.DataFrame(out, columns=["lm_chunk", "bucket", "words", "here_words", "target_words", "here", "target"])


def _total(asked: pd.DataFrame) -> pd.DataFrame:
    """A bucket's share of the distinct words, and of the words of both models."""
    keys = np.concatenate([unstepped(x) for x in asked["keys"]])
    word = (keys & np.uint64(1)).astype(bool)
    here, target = (int(np.concatenate([numbers(x) for x in asked[n]])[word].sum()) for n in ("here", "target"))
    return pd.DataFrame({"words": [len(np.unique(keys[word]))], "here_words": [here], "target_words": [target]})


def _losses(chunk: _Chunk, counts: np.ndarray, own: np.ndarray, taken: np.ndarray, total: int, words: int) -> np.ndarray:
    """Loss of each word. counts: of the chunk's n-grams; own: to take out, by word and pair;
    taken: words to take out of the total, by document."""
    n = len(chunk.word)
    single = counts[chunk.word] - own[:n]
    chance = (single + 1) / (total - taken[chunk.doc] + words)
    at = chunk.second
    pair = counts[chunk.pair] - own[n:]
    chance[at] = (pair + WEIGHT * chance[at]) / (single[at - 1] + WEIGHT)
    return -np.log(chance)


def _score(buckets: int):
    def score(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=["doc_id", "n_words", "in_target", "target_loss", "background_loss", "score"])
        chunk = _Chunk(rows, buckets)
        whole, told = told[told["bucket"] < 0].iloc[0], told[told["bucket"] >= 0].sort_values("bucket")
        own, n = chunk.own(), np.bincount(chunk.doc, minlength=len(chunk.rows))
        mine = chunk.target[chunk.owners]
        words = int(whole["words"])
        sides = []
        for name, share, removed in (
            ("here", np.ones(len(own), bool), n),
            ("target", mine, np.where(chunk.target, n, 0)),
        ):
            counts = np.concatenate([np.zeros(0, np.int64), *[numbers(x).astype(np.int64) for x in told[name]]])
            total = int(whole[f"{name}_words"])
            loss = _losses(chunk, counts, np.where(share, own, 0), removed, total, words)
            sums = np.bincount(chunk.doc, weights=loss, minlength=len(n))
            sides.append(np.divide(sums, n, out=np.full(len(n), np.nan), where=n > 0))
        background, target = sides
        return pd.DataFrame(
            {
                "doc_id": chunk.rows["doc_id"].to_numpy(),
                "n_words": n,
                "in_target": chunk.target,
                "target_loss": target,
                "background_loss": background,
                "score": target - background,
            }
        )

    return score


def loss_difference(docs: DataFrame, target: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """``doc_id, n_words, in_target, target_loss, background_loss, score`` of each row of ``docs``.

    ``target`` has the ``doc_id`` of the documents that the target model learns from.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    chunks, buckets = int(size // chunk_bytes + 1), int(size // BUCKET + 1)
    kind = dict(docs.dtypes)["doc_id"]
    chosen = target.select(F.col("doc_id").cast(kind)).filter(F.col("doc_id").isNotNull()).distinct()
    # Rows are known and dealt by their place, so rows alike or without id do not all meet in one chunk.
    row = F.monotonically_increasing_id().alias("lm_row")
    labelled = docs.select(row, "doc_id").join(chosen, "doc_id")
    none = F.lit(None).cast("string")
    both = docs.select(
        # As text, since a column of numbers and nulls would turn into doubles, which cannot hold all ids.
        row,
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(False).alias("lm_label"),
    ).unionByName(labelled.select("lm_row", none.alias("doc_id"), none.alias("text"), F.lit(True).alias("lm_label")))
    texts = both.withColumn("lm_chunk", F.pmod(F.xxhash64("lm_row"), F.lit(chunks))).groupBy("lm_chunk")
    asked = texts.applyInPandas(_ask(buckets), ASKED).groupBy("bucket")
    sums = ("words", "here_words", "target_words")
    whole = asked.applyInPandas(_total, ", ".join(f"{n} bigint" for n in sums)).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums]
    )
    # One row, which every chunk gets.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("lm_chunk")
    nothing = F.lit(b"").cast("binary")
    whole = whole.select(every, F.lit(-1).cast("long").alias("bucket"), *sums, nothing.alias("here"), nothing.alias("target"))
    told = asked.applyInPandas(_tell, TOLD).unionByName(whole)
    schema = "doc_id string, n_words bigint, in_target boolean, target_loss double, background_loss double, score double"
    scored = texts.cogroup(told.groupBy("lm_chunk")).applyInPandas(_score(buckets), schema)
    value = lambda name: F.when(~F.isnan(name), F.col(name)).alias(name)
    return scored.select(F.col("doc_id").cast(kind), "n_words", "in_target", *map(value, ["target_loss", "background_loss", "score"]))
