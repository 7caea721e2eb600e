"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point. A letter
n-gram binds (multiplies) its letters' vectors, each permuted (rolled) by its place. A
document bundles (adds up) the vectors of all its n-grams; a language bundles its
training documents, each at length 1. Documents are compared with the languages by
cosine. Runs of other characters than letters count as one word boundary, a letter of
its own.

Training takes every labelled document, and so does the least score (`least_score`); sums
are made in Spark on whole numbers, so reruns agree. Prediction covers every whole text.

Defined results: ``und`` with score 0 where the text is null or has no letter, or where
nothing was learned; rows without id are neither learned from nor, in the query, held out; ties go to the first language by code point; repeated rows and ids
are predicted one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fireledger.llm.scratch import in_small_batches

DIMS = 1024
NGRAM = 3
SCALE = 1 << 20
SLICE = 100_000
#: N-grams whose vectors are made at once.
KINDS = 2048
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _alphabetic() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=50_000)
def _letter(code: int) -> np.ndarray:
    return np.random.default_rng([7, code]).integers(0, 2, DIMS, dtype=np.int8) * 2 - 1


def _rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors of some texts, and which texts have a letter."""
    raw = "".join(f"\n{t}\n" for t in texts)
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 2 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    letter = _alphabetic()[codes]
    has = np.bincount(owner[letter], minlength=len(texts)) > 0
    codes = np.where(letter, codes, 0)
    # A boundary stands before each text and behind each word.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(sizes) - sizes] = True
    codes, owner = codes[keep], owner[keep]
    alphabet, ids = np.unique(codes, return_inverse=True)
    size = len(alphabet)
    n = max(len(ids) - NGRAM + 1, 0)
    grams = np.zeros(n, np.int64)
    for place in range(NGRAM):
        grams = grams * size + ids[place : place + n]
    inside = owner[:n] == owner[NGRAM - 1 :]
    kinds, which = np.unique(grams[inside], return_inverse=True)
    # Which texts have a kind, and how often, in the order of the kinds.
    pairs, counts = np.unique(which * len(texts) + owner[:n][inside], return_counts=True)
    kind, text = np.divmod(pairs, len(texts))
    letters = np.stack([_letter(int(c)) for c in alphabet])
    rows = np.zeros((len(texts), DIMS), np.float32)
    for first in range(0, len(kinds), KINDS):
        rest = kinds[first : first + KINDS]
        bound = np.ones((len(rest), DIMS), np.int8)
        for place in range(NGRAM - 1, -1, -1):
            bound *= np.roll(letters[rest % size], NGRAM - 1 - place, axis=1)
            rest = rest // size
        i, j = np.searchsorted(kind, (first, first + KINDS))
        if (j - i) * 16 > len(texts) * len(bound):
            dense = np.zeros((len(texts), len(bound)), np.float32)
            dense[text[i:j], kind[i:j] - first] = counts[i:j]
            rows += dense @ bound.astype(np.float32)
            continue
        order = i + np.argsort(text[i:j], kind="stable")
        for at in range(0, len(order), KINDS):
            some = order[at : at + KINDS]
            starts = np.flatnonzero(np.diff(text[some], prepend=-1))
            parts = bound[kind[some] - first] * counts[some, None].astype(np.float32)
            rows[text[some[starts]]] += np.add.reduceat(parts, starts, axis=0)
    return rows, has


def vectors(texts: pd.Series) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Vectors at length 1 of all texts, some at a time: their places, rows, which have a letter."""
    lower = [t.lower() if isinstance(t, str) else "" for t in texts]
    first = 0
    while first < len(lower):
        last, size = first + 1, len(lower[first])
        while last < len(lower) and size + len(lower[last]) <= SLICE:
            size += len(lower[last])
            last += 1
        rows, has = _rows(lower[first:last])
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        yield slice(first, last), rows / np.where(norm > 0, norm, 1), has
        first = last


def _bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch["lang"].to_numpy()
        for places, rows, has in vectors(batch["text"]):
            mine = np.where(has, langs[places], None)
            whole = np.rint(rows * SCALE).astype(np.int64)
            for lang in {x for x in mine if x is not None}:
                totals[lang] = totals.get(lang, 0) + whole[mine == lang].sum(axis=0)
    if totals:
        yield pd.DataFrame({"lang": list(totals), "sums": [v.tolist() for v in totals.values()]})


def _labelled(docs: DataFrame, usable: Column) -> DataFrame:
    return docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())


def learn(docs: DataFrame, usable: Column) -> dict[str, np.ndarray]:
    """A vector of length 1 for each language in the ``usable`` rows of ``doc_id, text, lang``."""
    labelled = _labelled(docs, usable)
    sums = (
        in_small_batches(labelled.select("lang", "text"))
        .mapInPandas(_bundles, "lang string, sums array<bigint>")
        .select("lang", F.posexplode("sums").alias("dim", "part"))
        .groupBy("lang", "dim")
        .agg(F.sum("part").alias("total"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("dim", "total"))).alias("totals"))
    )
    learned = {}
    for row in sums.orderBy("lang").collect():
        vector = np.array([x["total"] for x in row["totals"]], np.float64)
        learned[row["lang"]] = (vector / (np.linalg.norm(vector) or 1)).astype(np.float32)
    return learned


def _guess(learned: dict[str, np.ndarray]):
    names = list(learned) or [UNKNOWN]
    profiles = np.stack(list(learned.values())) if learned else np.zeros((1, DIMS), np.float32)

    @F.pandas_udf("struct<lang:string,score:double>")
    def guess(texts: pd.Series) -> pd.DataFrame:
        best, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        for places, rows, has in vectors(texts):
            cosines = rows @ profiles.T
            top = cosines.argmax(axis=1)
            best[places] = [names[i] if h else UNKNOWN for i, h in zip(top, has)]
            score[places] = np.where(has, np.clip(cosines[np.arange(len(top)), top], 0, 1), 0)
        return pd.DataFrame({"lang": best, "score": score})

    return guess(F.col("text"))


def _unused(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def predict(docs: DataFrame, learned: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, in place of columns of these names; no join."""
    found = _unused("lang_found", docs.columns)
    told = in_small_batches(docs).withColumn(found, _guess(learned))
    return told.withColumn("lang_pred", F.col(f"{found}.lang")).withColumn("lang_score", F.col(f"{found}.score")).drop(found)


def least_score(docs: DataFrame, learned: dict[str, np.ndarray]) -> float:
    """Half the least score of a labelled document that is told rightly."""
    told = predict(_labelled(docs, F.lit(True)).select("lang", "text"), learned)
    right = told.filter(F.col("lang") == F.col("lang_pred")).agg(F.min("lang_score").alias("least")).first()["least"]
    return (right or 0.0) / 2


def known_language(docs: DataFrame, min_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is told with ``min_score`` at least; their columns only.

    By default the least score is learned (`least_score`). Where no row has a language,
    nothing is learned, and all texts with a letter stay.
    """
    learned = learn(docs, F.lit(True))
    if not learned:
        letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
        return docs.filter(letter)
    least = least_score(docs, learned) if min_score is None else min_score
    found = _unused("lang_found", docs.columns)
    told = in_small_batches(docs).withColumn(found, _guess(learned))
    kept = told.filter((F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.score") >= least))
    return kept.select(*docs.columns)
