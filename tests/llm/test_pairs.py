"""Jaccard join, repeats and test items against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fireledger.llm import decontaminate, jaccard, repeats
from fireledger.llm.components import components

DOCS = "doc_id long, text string, keys string, size long"


def near_copies(rng, words, n):
    """Texts in groups of near copies, small and large, with a passage that many share."""
    shared = [rng.choice(words) for _ in range(40)]
    texts = []
    while len(texts) < n:
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 12, 20, 60, 150]))]
        if rng.random() < 0.3:
            base += shared
        for _ in range(rng.choice([1, 1, 2, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts[:n]


def brute_components(rows, width, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return {(doc, len(sets[i]), smallest[find(i)]) for i, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("width, percent, group", [(4, 85, 64), (5, 80, 4), (3, 60, 8)])
def test_components_against_brute_force(spark, monkeypatch, width, percent, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "ASKED", 5)
    rng = random.Random(width)
    words = [f"W{i}" for i in range(300)]
    rows = list(enumerate([*near_copies(rng, words, 260), None, "", " \n", "one", "one", "one two", "é"]))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(5)
    got = {tuple(r) for r in jaccard.similar_components(docs, width, percent).collect()}
    assert got == brute_components(rows, width, percent)


def test_one_of_each(spark):
    text = "the quick brown fox jumps over the lazy dog again and again until dawn"
    rows = [(1, text), (2, text.upper()), (3, "something else altogether is written in here"), (4, ""), (5, None), (4, ""), (1, text)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], DOCS)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 4, 5]
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_by_row(spark):
    rng = random.Random(12)
    base = [f"w{rng.randrange(1000)}" for _ in range(80)]
    near = [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in (0, 79)]
    other = [" ".join(f"{c}{rng.randrange(1000)}" for _ in range(30)) for c in "ab"]
    big = (1 << 60) + 1
    rows = [(None, near[0]), (None, near[1]), (big, " ".join(base)), (7, other[0]), (8, other[0]), (8, other[1]), (None, "c d e f g h"), (None, "c d e f g h"), (None, None)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], DOCS)
    kept = {(r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect()}
    assert kept == {(big, " ".join(base)), (7, other[0]), (8, other[1]), (None, "c d e f g h"), (None, None)}
    assert jaccard.one_of_each(docs).count() == 5
    found = jaccard.similar_components(docs.filter("doc_id is null or doc_id > 8")).collect()
    assert [r.component_id for r in found if r.n_shingles > 70] == [big] * 3


def test_clean_documents_by_row(spark):
    item = "an item of the benchmark that some of the rows hold"
    rows = [(None, f"so {item} there"), (None, "a clean row without id"), (1, item), (1, "a clean row of the same id"), (2, None)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], DOCS)
    clean = decontaminate.clean_documents(docs, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert clean.columns == docs.columns
    assert {(r.doc_id, r.text) for r in clean.collect()} == {rows[1], rows[3], rows[4]}


def test_parts_outnumber_differences():
    classes = jaccard.Classes(85)
    classes.of(5000)
    for low, high, parts in zip(classes.low, classes.low[1:], classes.parts):
        for n in {low, high - 1}:
            worst = max(n + b - 2 * -(-85 * (n + b) // 185) for b in range(n, 100 * n // 85 + 1))
            assert worst == 0 or parts > worst
            assert 100 * n // 85 < 100 * high // 85 + 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (1, 0)]
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}}


def brute_repeats(rows, width):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            first[data[i : i + width]] = min(doc, first.get(data[i : i + width], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("chunk_bytes, piece", [(400, 150), (3000, 1 << 20), (1 << 22, 200)])
def test_repeats_against_brute_force(spark, monkeypatch, chunk_bytes, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(piece)
    base = ["".join(rng.choice("abc de") for _ in range(rng.choice([0, 10, 49, 50, 51, 80, 300, 900]))) for _ in range(30)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(base)
            a = rng.randint(0, max(len(s) - 1, 0))
            parts.append(s[a : a + rng.choice([20, 49, 50, 60, 120, 500])] + rng.choice(["", "é", "xy"]))
        rows.append((3 * i, None if i % 29 == 0 else "".join(parts)))
    rows += [(1000, "ab" * 200), (9000000000, "ab" * 100), (1000, "ab" * 200), (1003, rows[1][1])]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(3)
    left = repeats.without_repeats(docs, chunk_bytes=chunk_bytes)
    got = left.select("doc_id", "pfp_bytes", "pfp_removed", "pfp_spans", "pfp_sha256").collect()
    assert sorted(map(tuple, got)) == brute_repeats(rows, 50)


def common_line(n):
    """Documents with a line of 35 bytes between differing neighbours, and some passages twice."""
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    texts = [" ".join([*(word() for _ in range(12)), "this line is in very many documents", *(word() for _ in range(12))]) for _ in range(n)]
    return [(i, t if i % 5 else texts[i // 2][20:] + t[:60]) for i, t in enumerate(texts)]


@pytest.mark.parametrize("share, crowd", [(2, 1000), (1000, 5), (3, 8), (32, 1024)])
def test_repeats_of_a_common_line(spark, share, crowd):
    rows = common_line(240)
    rows += [(None, rows[7][1]), (None, "no id, and a text of its own that is longer than the width")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS)
    left = repeats.without_repeats(docs, chunk_bytes=6000, share=share, crowd=crowd)
    got = left.select("doc_id", "pfp_bytes", "pfp_removed", "pfp_spans", "pfp_sha256").collect()
    known = [(repeats.LAST if i is None else i, t) for i, t in rows]
    assert sorted((repeats.LAST if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == brute_repeats(known, 50)


def test_no_bucket_gets_a_common_line():
    rows, buckets = common_line(3000), 6
    chunks = [pd.DataFrame(rows[c::buckets], columns=[repeats.NUMBER, "text"]) for c in range(buckets)]
    entries = pd.concat([repeats._send(50, buckets)((c,), x) for c, x in enumerate(chunks)])
    settled = pd.concat([repeats._settle()((b,), x) for b, x in entries.groupby("bucket")])
    sent = pd.concat([repeats._send_bytes(50, buckets)((c,), x, settled[settled.pfp_chunk == c]) for c, x in enumerate(chunks)])
    trigger = {}
    for x in chunks:
        phrase, of, _ = repeats._Chunk(x, 50).dictionary()
        trigger.update(zip(phrase.tolist(), of.tolist()))
    asked = {p for x in sent[sent.bucket < buckets]["phrase"] for p in np.frombuffer(x, np.uint64).tolist()}
    assert max(collections.Counter(trigger.values()).values()) > 300
    assert max(collections.Counter(trigger[p] for p in asked).values()) <= buckets * repeats.SHARE
    sizes = sent[sent.bucket >= buckets].groupby("bucket")["phrase"].agg(lambda x: sum(map(len, x)))
    assert len(sizes) == buckets and sizes.max() < 1.2 * sizes.min()


def test_text_without_repeats_keeps_columns(spark):
    passage = "A passage of more than fifty bytes that two documents hold, é and all. "
    rows = [(1, passage + "First.", "k", 1), (2, "Second. " + passage, "k", 1), (None, passage, "k", 1), (3, None, "k", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text"))
    left = repeats.text_without_repeats(docs)
    assert left.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
    assert got == {1: (passage + "First.", len(passage) + 6), 2: ("Second. ", 8), None: ("", 0), 3: (None, None)}
    assert repeats.text_without_repeats(docs.limit(0)).count() == 0


def plain_distance(pattern, text):
    row, best = list(range(len(pattern) + 1)), len(pattern)
    for c in text:
        new = [0]
        for i, x in enumerate(pattern):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(200):
        p, t = (bytes(rng.choice(b"abc") for _ in range(rng.randint(a, 90))) for a in (1, 0))
        assert decontaminate.distance_within(p, t, len(p)) == plain_distance(p, t)
        assert decontaminate.distance_within(p, t, 2) == (plain_distance(p, t) if plain_distance(p, t) <= 2 else None)


@pytest.mark.parametrize("piece", [1 << 20, 300])
def test_hits_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 12, 40]))) for _ in range(20)]
    items = [*enumerate(texts), (50, None), (51, " \n"), (3, texts[3])]

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            i = rng.randrange(len(chars) + 1)
            chars[i : i + rng.randint(0, 1)] = rng.choice(["", "z", "  ", "Q"])
        return "".join(chars)

    fill = lambda: " ".join(rng.choice(words) for _ in range(rng.choice([0, 5, 60])))
    rows = [(i, f"{fill()} {edited(t, int(len(t) * e))}\n{fill()}") for i, (t, e) in enumerate((t, e) for t in texts for e in (0, 0.05, 0.1, 0.2))]
    rows += [(900, None), (901, ""), (902, texts[0].upper())]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS)
    given = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.test_hits(docs, given).collect()}
    expected = {}
    for doc, text in rows:
        for item, t in enumerate(texts):
            p = decontaminate.plain(t)
            d = plain_distance(p, decontaminate.plain(text))
            if d <= int(len(p) * 0.1):
                expected[doc, item] = d
    assert got == expected and len(got) > 30
    clean = decontaminate.clean_documents(docs, given)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in expected}
    assert decontaminate.clean_documents(docs, given.limit(0)).count() == len(rows)
    assert decontaminate.test_hits(docs.limit(0), given).count() == 0


def test_group_tells_few_links_of_many():
    n = 60
    shingles = [np.array(sorted({*range(100)} - {i}), np.int32) for i in range(n)]
    names = np.arange(n, dtype=np.int64)
    asking = pd.DataFrame({"group": 7, "share": 0, "set": names, "root": names, "shingles": shingles, "refuted": None})
    inside = asking[["group", "share", "set", "root", "shingles"]].add_prefix("member_")
    found = jaccard._opened(80)(asking, inside)
    assert len(found) == n - 1 and set(found["group"]) == {7} and set(found["share"]) == {0}
    at = list(range(n))
    for a, b in zip(found["a"], found["b"]):
        at = [at[a] if x == at[b] else x for x in at]
    assert len(set(at)) == 1


def test_refuted_pair_hides_no_link(spark):
    """Halves of hashes say that all are linked, whole ones that every second one is."""
    members = [(s, 1, 1, [(i << 32) + s % 2 for i in range(40 + s // 2)]) for s in range(8)]
    held = spark.createDataFrame(members, "`set` long, cluster long, company long, shingles array<long>")
    blocks = spark.createDataFrame([(5, s[0]) for s in members], "key long, `set` long")
    first = spark.createDataFrame([], "node long, root long")
    links = {(r.a, r.b) for r in jaccard._links_between(blocks, held, first, 80).collect()}
    assert all(a % 2 == b % 2 for a, b in links)
    at = {s: s for s in range(8)}
    for a, b in links:
        at = {s: at[a] if x == at[b] else x for s, x in at.items()}
    assert len(set(at.values())) == 2


def copies_with_edits(rng, words, n, edits, length=60):
    base = [rng.choice(words) for _ in range(length)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.choice(edits)):
            copy[rng.randrange(length)] = rng.choice(words)
        yield " ".join(copy)


def test_large_blocks_ask_little(spark, monkeypatch):
    """Near copies that agree in some parts but differ in too many for a link ask no group."""
    rng, asked, stored = random.Random(5), [], jaccard.stored

    def spy(df):
        kept = stored(df)
        if set(kept.columns) == {"set", "root", "group"}:
            asked.append(kept.count())
        return kept

    monkeypatch.setattr(jaccard, "stored", spy)
    monkeypatch.setattr(jaccard, "GROUP", 8)
    words = [f"W{i}" for i in range(300)]
    rows = list(enumerate(copies_with_edits(rng, words, 400, [5, 6, 7])))
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS)
    got = {tuple(r) for r in jaccard.similar_components(docs, 5, 80).collect()}
    assert got == brute_components(rows, 5, 80)
    assert asked[0] < 2 * len(rows)


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (3, 60)])
def test_linked_sets_meet_in_their_rarest_blocks(spark, width, percent):
    rng = random.Random(percent)
    words = [f"W{i}" for i in range(300)]
    texts = [*near_copies(rng, words, 150), *copies_with_edits(rng, words, 60, [0, 1, 2, 3, 4])]
    docs = spark.createDataFrame([(i, t, "", 1) for i, t in enumerate(texts)], DOCS)
    sets = {jaccard.set_id(s): s for s in jaccard._sets_of(pd.Series(texts), width)}
    rows = jaccard.set_blocks(docs, width, percent).distinct()
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    kind = "`set` long, spare array<int>"
    held = spark.createDataFrame([(n, jaccard.spare_parts(s, percent)) for n, s in sets.items()], kind)
    at, before = collections.defaultdict(set), rows.join(sizes, "key")
    for r in jaccard._rarest(before, held).collect():
        at[r["set"]].add(r["key"])
    assert sum(map(len, at.values())) < before.count()
    linked = 0
    for a, b in [(a, b) for a in sets for b in sets if a < b]:
        both = len(np.intersect1d(sets[a], sets[b]))
        if both * (100 + percent) >= (len(sets[a]) + len(sets[b])) * percent:
            linked += 1
            assert at[a] & at[b]
    assert linked > 30
