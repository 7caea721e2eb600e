"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fireledger.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, i int, score string"


def brute(rows, every, positives=5, k=10):
    width = max((len(v) for _, v, _ in rows if v), default=1)
    known = []
    for place, (name, vector, label) in enumerate(rows):
        if name is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        known.append((place, name, label, q + [0] * (width - len(q))))
    out = []
    for place, name, label, q in known:
        if not every(name):
            continue
        scored = sorted((-sum(map(int.__mul__, q, o[3])), o[1], o[2]) for o in known if o[0] != place)
        for s, positive, _ in [x for x in scored if x[2] == label][:positives]:
            window = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:k]
            out.extend((name, positive, rank, x[1], -s, -x[0]) for rank, x in enumerate(window, 1))
    return sorted(out)


def found(spark, rows, every, **options):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], COLUMNS)
    return sorted(tuple(r) for r in negatives.hard_negatives(docs, every, **options).collect())


@pytest.mark.parametrize("block, asked, first, clusters", [(1 << 16, 1 << 15, 8, 0), (20, 3, 2, 6), (50, 1000, 1, 1)])
def test_against_brute_force(spark, monkeypatch, block, asked, first, clusters):
    for name, value in {"BLOCK": block, "SMALL": block, "ASKED": asked, "FIRST": first, "CELL": 8, "AT_ONCE": 3}.items():
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(max(clusters, 1), 7)) * 2
    rows = []
    for n in range(400):
        near = centres[rng.integers(len(centres))] if clusters else 0
        vector = [float(x) for x in near + rng.normal(size=7) * (0.3 if clusters else 1)]
        rows.append((n, vector, int(rng.integers(3))))
    same = rows[7][1]
    rows += [(1000 + n, same, int(n % 2)) for n in range(120)]
    odd = [(None, same, 1), (501, None, 1), (502, same, None), (503, [None, 1.0], 1), (504, [float("nan")] * 7, 1), (505, [float("inf")], 1)]
    rows += [*odd, (506, [], 1), (507, [1.0, -2.0], 0), (2**53 + 1, same, 2), (20, rows[20][1], 0), (40, rows[3][1], 1)]
    got = found(spark, rows, F.col("vec_id") % 20 == 0)
    assert got == brute(rows, lambda x: x % 20 == 0)


def test_large_components_and_few_rows(spark):
    rows = [(0, [1e6, -3e5], 0), (1, [2e6, 5e5], 0), (2, [1e6, 1.0], 1), (3, [9e5, 0.0], 1), (100, [0.0], 5), (200, [-1.0], 7), (7, [1.0], 7)]
    assert found(spark, rows, F.col("vec_id") % 100 == 0) == brute(rows, lambda x: x % 100 == 0)
    assert found(spark, [], F.col("vec_id") % 100 == 0) == []
    assert found(spark, rows[:1], F.col("vec_id") % 100 == 0) == []


def test_cells_come_by_falling_bound_and_hold_their_rows():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(size=(500, 6)) * 100)
    books = negatives.Codebooks((np.zeros((1, 0)),) * 2, (np.zeros(1),) * 2, set(), 6)
    books.words = tuple(negatives._fitted(h, 5) for h in books.halves(points))
    codes = [negatives._nearest(h, w) for h, w in zip(books.halves(points), books.words)]
    away = [np.sqrt(((h - w[c]) ** 2).sum(1)) for h, w, c in zip(books.halves(points), books.words, codes)]
    books.radii = tuple(np.array([a[c == k].max(initial=0) for k in range(5)]) for a, c in zip(away, codes))
    books.filled = set(zip(codes[0].tolist(), codes[1].tolist()))
    visits = list(books.visits(points[0]))
    assert {(i, j) for _, i, j in visits} == books.filled and len(visits) == len(books.filled)
    assert all(a[0] >= b[0] for a, b in zip(visits, visits[1:]))
    for bound, i, j in visits:
        assert (points[(codes[0] == i) & (codes[1] == j)] @ points[0]).max() <= bound
