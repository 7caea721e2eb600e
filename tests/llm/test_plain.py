"""Learned operators and the pipeline against plain Python on small tables."""

import math
import random
import re
import resource
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_pairs import brute_components, plain_distance

import corpus_pipeline
from fireledger.llm import decontaminate, grades, langid, toxicity
from fireledger.llm.features import byte_trigrams_and_words, word_patterns
from fireledger.llm.queries import ORACLES

FOLDER = str(TESTDATA / "sf0.01")


def plain_vector(text):
    """Trigram vectors of a text, letter by letter."""
    codes = [0]
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
        elif codes[-1]:
            codes.append(0)
    if codes[-1]:
        codes.append(0)
    total = np.zeros(langid.DIMS, np.int64)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        a, b, c = (langid._letter(x).astype(int) for x in (a, b, c))
        total += np.roll(a, 2) * np.roll(b, 1) * c
    return total, len(codes) > 1


def at_length_one(vector):
    return vector / (np.linalg.norm(vector) or 1)


def test_profiles_and_predictions(spark, monkeypatch):
    monkeypatch.setattr(langid, "KINDS", 7)
    rows = [(1, "the cat and the hat", "en"), (2, "der Hund und die Katze", "de"), (3, "the dog, the dog", "en"), (4, "漢字かな交じり文", "ja"), (5, "ein Hut ist das", "de")]
    rows += [(10, "the cat und", None), (11, "漢字 the", None), (12, "KATZE hat 12", None), (13, "a", None), (14, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learn(docs, F.col("doc_id") < 10)
    profiles = {}
    for lang in ("de", "en", "ja"):
        parts = [np.rint(at_length_one(plain_vector(t)[0]).astype(np.float32) * langid.SCALE) for _, t, x in rows if x == lang]
        profiles[lang] = at_length_one(np.sum(parts, axis=0))
        assert np.allclose(profiles[lang], learned[lang], atol=1e-5)
    for r in langid.predict(docs, learned).collect():
        vector, letters = plain_vector(r.text)
        cosines = {lang: float(at_length_one(vector) @ p) for lang, p in profiles.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r.lang_pred == (best if letters else "und")
        assert r.lang_score == pytest.approx(max(cosines[best], 0) if letters else 0, abs=1e-4)


def test_least_score_and_nothing_learned(spark):
    rows = [(i, "the cat and the hat sat on a mat", "en") for i in range(5)] + [(9, "der Hund und die Katze", "de"), (20, "### a ###", None), (21, "qxz qxz vv", None), (22, "the hat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.known_language(docs).collect()} == {0, 1, 2, 3, 4, 9, 22}
    none = docs.withColumn("lang", F.lit(None).cast("string")).unionByName(spark.createDataFrame([(30, "12 %", None), (31, None, None)], docs.schema))
    assert {r.doc_id for r in langid.known_language(none).collect()} == {r[0] for r in rows}


def test_all_labelled_documents_are_learned_from(spark):
    n = 21_000
    late = F.pmod(F.xxhash64("doc_id"), F.lit(n)) >= 20_000
    docs = spark.range(n).withColumnRenamed("id", "doc_id").select(
        "doc_id",
        F.when(late, "zwölf Boxkämpfer").otherwise("a cat on the mat").alias("text"),
        F.when(late, "de").otherwise("en").alias("lang"),
    )
    learned = langid.learn(docs, F.lit(True))
    assert set(learned) == {"de", "en"}
    weak = docs.withColumn("text", F.when(late & (F.col("doc_id") % 2 == 0), "zwölf 7 xx").otherwise(F.col("text")))
    score = langid.predict(weak, learned).filter("lang = lang_pred").agg(F.min("lang_score")).first()[0]
    assert langid.least_score(weak, learned) == pytest.approx(score / 2)


def test_memory_of_many_letters():
    rng = random.Random(1)
    texts = ["".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(100)) for _ in range(1000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for _ in langid.vectors(pd.Series([*texts, "".join(texts) * 3])):
        pass
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def labelled_texts(rng, n):
    nice, rude = ["green", "calm", "river", "house", "song"], ["idiot", "stupid", "trash", "liar"]
    rows = []
    for i in range(n):
        label = rng.randrange(2)
        pool = nice + (rude if label else [])
        rows.append((i, " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 15))), label))
    return rows


def in_order(spark, rows):
    """The rows in the order of the hash that training goes by."""
    df = spark.createDataFrame([(r[0],) for r in rows], "doc_id long").select("doc_id", F.xxhash64("doc_id", F.lit("order")).alias("o"))
    place = {r.doc_id: r.o for r in df.collect()}
    return sorted(rows, key=lambda r: (place[r[0]], r[0]))


def test_ftrl_against_plain_python(spark):
    rows = labelled_texts(random.Random(2), 60)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    alpha, beta, l1, l2, rounds = 1.5, 1.0, 0.3, 0.1, 3
    places, values = toxicity.learn(docs, labels, alpha=alpha, beta=beta, l1=l1, l2=l2, rounds=rounds)
    features = lambda text: [int(x) for run in word_patterns([text], toxicity.PATTERNS, toxicity.BITS) for x in run[0]] + ["bias"]
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(rounds):
        for _, text, label in in_order(spark, rows):
            at = features(text)
            w = {i: weight(i) for i in at}
            g = sigmoid(sum(w.values())) - label
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    found = dict(zip(places.tolist(), values.tolist()))
    expected = {(1 << toxicity.BITS) if i == "bias" else i: weight(i) for i in list(z) if weight(i)}
    assert found == pytest.approx(expected) and len(found) < len(z)
    for r in toxicity.score(docs, (places, values)).collect():
        assert r.score == pytest.approx(sigmoid(sum(weight(i) for i in features(r.text))))


def test_cumulative_link_against_plain_python(spark):
    rows = [(i, t, label * 2 - (i % 3 == 0 and label)) for i, t, label in labelled_texts(random.Random(7), 50)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    given = spark.createDataFrame([(r[0], int(r[2])) for r in rows], "doc_id long, grade int")
    levels, rate, l2, rounds = 3, 0.1, 1e-4, 2
    model = grades.learn(docs, given, levels, rate=rate, l2=l2, rounds=rounds)
    features = lambda text: [int(x) for run in byte_trigrams_and_words([text], grades.BITS) for x in run[0]]
    weights, squares = defaultdict(float), defaultdict(lambda: 1e-6)
    shares = [min(max(sum(r[2] >= k for r in rows) / len(rows), 1e-3), 1 - 1e-3) for k in (1, 2)]
    cuts, cut_squares = [-math.log(s / (1 - s)) for s in shares], [1.0, 1.0]
    for _ in range(rounds):
        for _, text, grade in in_order(spark, rows):
            at = features(text)
            value = 1 / math.sqrt(max(len(at), 1))
            strength = sum(weights[i] for i in at) * value
            below = sigmoid(cuts[grade - 1] - strength) if grade else sigmoid(-math.inf)
            upto = sigmoid(cuts[grade] - strength) if grade < 2 else sigmoid(math.inf)
            for i in at:
                step = (below + upto - 1) * value - l2 * weights[i]
                squares[i] += step * step
                weights[i] += rate * step / math.sqrt(squares[i])
            push, inside = [0.0, 0.0], max(upto - below, 1e-9)
            if grade > 0:
                push[grade - 1] -= below * (1 - below) / inside
            if grade < 2:
                push[grade] += upto * (1 - upto) / inside
            for k in (0, 1):
                cut_squares[k] += push[k] ** 2
                cuts[k] += rate * push[k] / math.sqrt(cut_squares[k])
            cuts[1] = max(cuts)
    assert model[1 << grades.BITS :].tolist() == pytest.approx(cuts)
    for r in grades.grade(docs, model, levels).collect():
        at = features(r.text)
        strength = sum(weights[i] for i in at) / math.sqrt(max(len(at), 1))
        above = [sigmoid(strength - c) for c in cuts]
        assert r.expected_grade == pytest.approx(sum(above)) and r.p_tail == pytest.approx(above[0])


def plain_without_repeats(rows, width=50):
    """Texts by id without the bytes of strings that an earlier one holds."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            first[data[i : i + width]] = min(doc, first.get(data[i : i + width], doc))
    left = {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        left[doc] = bytes(c for c, g in zip(data, gone) if not g).decode(errors="ignore") if any(gone) else text
    return left


def test_pipeline_against_plain_python(spark, tmp_path):
    """Stages 2 to 5, from the rows that the trained stage 1 keeps."""
    rng = random.Random(3)
    names = [f"{a}{b}{c}" for a in "kmprst" for b in "aeiou" for c in ("n", "l", "rd", "sk")]
    prose = lambda n: " ".join(rng.choice(names) for _ in range(n))
    passage, items = prose(25), [(i, prose(12)) for i in range(6)]
    rows = []
    for i in range(90):
        text = prose(rng.choice([1, 8, 40, 90]))
        if i % 4 == 0:
            text = f"{text} {passage} {prose(5)}"
        if i % 7 == 0:
            text += f" {items[i % 6][1]}"
        if i % 5 == 0 and i:
            words = rows[i - 3][1].split(" ")
            words[rng.randrange(len(words))] = "x"
            text = " ".join(words)
        rows.append((i, text, "en", f"s{i % 4}" if i % 9 else None, len(text)))
    rows += [(200, "", "en", "s0", 0), (201, None, None, "s1", None), (202, "12 34", "en", "s1", 5), (203, rows[1][1], "en", "s2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    told = [tuple(r) for r in corpus_pipeline.known_language(spark, given, str(tmp_path)).collect()]
    assert 80 < len(told) < len(rows)
    groups = brute_components([(r[0], r[1]) for r in told], 5, 80)
    kept = {doc for doc, size, component in groups if doc == component}
    left = plain_without_repeats([(r[0], r[1]) for r in told if r[0] in kept])
    plain = {i: decontaminate.plain(t) for i, t in items}
    clean = {}
    for doc, text in left.items():
        data = decontaminate.plain(text)
        if all(plain_distance(p, data) > int(len(p) * decontaminate.RATE) for p in plain.values()):
            clean[doc] = text
    by_id = {r[0]: r for r in rows}
    frame = pd.DataFrame({"doc_id": list(clean), "text": list(clean.values()), "source": [by_id[d][3] for d in clean]})
    con = duckdb.connect()
    con.register("documents", frame)
    copies = {d: c for d, c in con.execute(f"SELECT doc_id, copies FROM ({ORACLES['op6_mix_sources']})").fetchall()}
    expected = [
        (d, t, by_id[d][2], by_id[d][3], len(t) if t != by_id[d][1] else by_id[d][4], k)
        for d, t in clean.items()
        for k in range(1, copies[d] + 1)
    ]
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert len(kept) < len(told) and len(clean) < len(left) and any(t != by_id[d][1] for d, t in clean.items())
    assert re.search("x", " ".join(r[1] for r in got))
