"""Hashed features of whole texts, and labelled samples of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.words import NOT_ALNUM, joined, mixed, pieces, words_of


def word_patterns(texts: Sequence[str | None], patterns: Sequence[Sequence[int]], bits: int) -> Iterator[list[np.ndarray]]:
    """Distinct hashed word patterns of each text, a run of texts at a time.

    A pattern is a tuple of word offsets: (0,) words, (0, 1) pairs, (0, 2) pairs that
    skip a word. Words are runs of letters and digits, in lower case.
    """
    for first, run in pieces(texts):
        words = words_of(run, NOT_ALNUM)
        keys, owners = [], []
        for k, offsets in enumerate(patterns):
            hashes, text = joined(words, offsets)
            keys.append((mixed(hashes, 40 + k) >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(text)
        yield _by_text(np.concatenate(keys), np.concatenate(owners), len(run), bits)


def _by_text(keys: np.ndarray, owners: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    both = np.unique((owners.astype(np.int64) << bits) | keys)
    bounds = np.searchsorted(both >> bits, np.arange(n + 1))
    return [both[a:b] & ((1 << bits) - 1) for a, b in zip(bounds[:-1], bounds[1:])]


def byte_trigrams_and_words(texts: Sequence[str | None], bits: int) -> Iterator[list[np.ndarray]]:
    """Distinct hashed three-byte strings and white-space words of each text, case and signs kept."""
    for first, run in pieces(texts):
        buf = np.frombuffer(b"\n".join(run) + b"\n\n\n", np.uint8).astype(np.uint64)
        sizes = np.array([len(x) for x in run])
        owners = np.repeat(np.arange(len(run)), sizes + 1)
        left = np.repeat(np.cumsum(sizes + 1), sizes + 1) - np.arange(len(owners))
        inside = left > 3
        n = len(owners)
        grams = (buf[:n] << np.uint64(16)) | (buf[1 : n + 1] << np.uint64(8)) | buf[2 : n + 2]
        words = words_of(run, lower=False)
        hashes = np.concatenate([mixed(grams[inside], 50), mixed(words.hashes, 51)])
        keys = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        yield _by_text(keys, np.concatenate([owners[inside], words.text]), len(run), bits)


def sampled_texts(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """Texts of at most about ``max_rows`` labelled ids, chosen by a hash of the id, and their number.

    The chosen labels are few by that bound, so they are sent to the texts, not the texts to them.
    """
    n = labels.count()
    if n > max_rows:
        labels = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < max_rows)
    return docs.join(F.broadcast(labels), "doc_id"), min(n, max_rows)
