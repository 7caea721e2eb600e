"""Merkle manifests against plain Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fireledger.llm import manifest

COLUMNS = "doc_id long, source string, lang string, n_chars int, text string, tree string, hash int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], row[4])])


def climb(hashes):
    """The levels above some hashes."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def way(levels, place):
    steps = []
    for below in levels[:-1]:
        first = place // 8 * 8
        steps.append((below[first:place], below[place + 1 : first + 8]))
        place //= 8
    return steps


def brute(rows, claimed):
    trees = {}
    for r in rows:
        trees.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    names = sorted(trees, key=str.encode)
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    levels = {name: climb([leaf(r) for r in trees[name]]) for name in names}
    top = climb([levels[name][-1][0] for name in names])
    out = []
    for i, name in enumerate(names):
        for k, r in enumerate(trees[name]):
            steps = way(levels[name], k) + way(top, i)
            folded = leaf((*r[:4], claimed(r)))
            for left, right in steps:
                folded = h(*left, folded, *right)
            told = h(*[x for left, right in steps for x in left + right])
            out.append((r[0], leaf(r), levels[name][-1][0], top[-1][0], told, folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("langs, rows", [(["en"], 1), (["en"], 8), (["en"], 9), ([None], 65), (["a", None, "é", "Z", "漢"], 700), ([f"l{i}" for i in range(70)], 300)])
def test_proofs_against_plain_python(spark, langs, rows):
    rng = random.Random(rows)
    some = []
    for i in range(rows):
        lang = langs[0] if rng.random() < 0.5 else rng.choice(langs)
        some.append((i * 3 if i % 9 else 5, rng.choice([None, "", "web"]), lang, rng.choice([None, 7]), rng.choice([None, "", "Ab é漢", f"T{i}"])))
    if rows > 100:
        some += some[:3] + [(None, None, None, None, None), (2**60 + 1, "s", "en", 1, "big"), (-4, "s", langs[0], 1, "X")]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in some], COLUMNS).repartition(3)
    made = docs.select(*[c for c in docs.columns])
    spoilt = lambda r: r[4] if r[4] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 else r[4].lower() if r[4].isascii() else "".join(c.lower() if c.isascii() else c for c in r[4])
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    claimed = F.when(third, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    got = sorted((tuple(r) for r in manifest.proofs(made, claimed).collect()), key=str)
    assert got == brute(some, spoilt)
    assert all(r.verified for r in manifest.proofs(made).collect())


def test_nodes_cover_their_children(spark):
    rows = [(i, None, "en" if i % 3 else None, None, str(i)) for i in range(200)]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], COLUMNS)
    found = {}
    for r in manifest.nodes(docs).collect():
        found.setdefault((r.tree, r.level), []).append((r.lo, r.hi, r.hash))
    for (tree, level), nodes in found.items():
        nodes.sort()
        assert [n[0] for n in nodes] == list(range(0, nodes[-1][1], 8**level)) and all(a[1] == b[0] for a, b in zip(nodes, nodes[1:]))
        if level:
            below = sorted(found[tree, level - 1])
            assert all(n[2] == h(*[c[2] for c in below if n[0] <= c[0] and c[1] <= n[1]]) for n in nodes)
    assert {k for k in found if len(found[k]) == 1} == {("=en", 3), ("", 3), ("^", 1)}


def test_empty_table(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert manifest.proofs(none).collect() == [] and manifest.nodes(none).collect() == []
    assert manifest.proofs(none).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
