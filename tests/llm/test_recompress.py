"""Repeated word windows against brute force."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from conftest import TESTDATA

from fireledger.llm import recompress
from fireledger.llm.queries import QUERIES

FOLDER = str(TESTDATA / "sf0.01")


def brute_windows(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(i, first.get(key, i))
    out = []
    for (name, _), i, w in zip(rows, ids, words):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((name, len(w), sum(gone), sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()))
    return sorted(out, key=str)


def found(docs, **options):
    rows = recompress.without_repeats(docs, **options).collect()
    for r in rows:
        assert sha256(r.kept.encode("utf-8", "surrogatepass")).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def made_texts(rng, n, kinds):
    """Texts that share passages, runs of one word, and periods."""
    words = [f"w{i}" for i in range(kinds)]
    passages = [[rng.choice(words) for _ in range(rng.choice([5, 12, 13, 14, 30, 90]))] for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.4:
                parts += rng.choice(passages)
            elif kind < 0.55:
                parts += [rng.choice(words)] * rng.choice([1, 3, 12, 13, 40])
            elif kind < 0.65:
                parts += [rng.choice(words), rng.choice(words)] * rng.choice([3, 10, 25])
            else:
                parts += [rng.choice(words) for _ in range(rng.randrange(40))]
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return texts


@pytest.mark.parametrize(
    "width, rounds, kinds, chunk, piece, block",
    [(13, 3, 40, 4000, 1 << 18, 1 << 17), (13, 2, 3, 4000, 100, 64), (5, 4, 2, 1 << 20, 64, 50), (2, 1, 5, 2000, 1 << 18, 7), (13, 0, 40, 9000, 99, 99)],
)
def test_windows_against_brute_force(spark, monkeypatch, width, rounds, kinds, chunk, piece, block):
    monkeypatch.setattr(recompress, "PIECE", piece)
    monkeypatch.setattr(recompress, "SLICE", block)
    monkeypatch.setattr(recompress, "BUCKET", 5000)
    rng = random.Random(width * 10 + rounds)
    rows = list(enumerate([*made_texts(rng, 120, kinds), None, "", " \n", "one", "\ud800 é 漢"]))
    rows += rows[:4] + [(rows[9][0], rows[17][1]), (None, rows[3][1]), (None, rows[3][1]), (2**60 + 1, rows[5][1]), (-7, rows[8][1])]
    rows = [(i, t and t.replace("\ud800", "x")) for i, t in rows]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, kept string").repartition(3)
    docs.write.parquet(folder := f"{spark.conf.get('spark.checkpoint.dir')}/rc-{width}-{rounds}-{block}")
    got = found(spark.read.parquet(folder), width=width, rounds=rounds, chunk_bytes=chunk)
    assert got == brute_windows(rows, width)


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id int, text string")
    assert recompress.without_repeats(none).collect() == [] and dict(recompress.without_repeats(none).dtypes)["doc_id"] == "int"
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute_windows(rows, 13)
    big = [(2**53 + 1, text), (2**53, text), (None, "a b"), (2**60 + 1, text)]
    assert found(spark.createDataFrame(big, "doc_id long, text string")) == brute_windows(big, 13)


def test_long_text(spark):
    rng = random.Random(5)
    body = [f"v{rng.randrange(90)}" for _ in range(150_000)]
    rows = [(1, " ".join(body)), (2, " ".join(["x"] * 30 + body[70_000:140_000])), (3, "y" * 600_000 + " " + " ".join(body[:20]))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_windows(rows, 13)


def test_names_inside_a_window_do_not_depend_on_its_neighbours():
    rng = np.random.default_rng(1)
    inner = rng.integers(1, 4, 13).astype(np.uint64)
    spelt = set()
    for _ in range(50):
        around = [rng.integers(1, 4, 6).astype(np.uint64) for _ in range(2)]
        words = np.concatenate([around[0], inner, around[1]])
        block = recompress._Block(words, np.zeros(len(words), np.int32), 0, len(words), 13)
        for round in range(3):
            block.advance(round, True)
        block.finish()
        spelt.add((int(block.spelt[0][6]), int(block.spelt[1][6])))
    assert len(spelt) == 1


def test_query_of_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_recompress_repeats"](spark, FOLDER).collect()), key=str)
    assert got == brute_windows(rows, 13)
