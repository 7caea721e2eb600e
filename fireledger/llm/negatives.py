"""Mine hard negatives of anchors with an inverted multi-index, exactly.

Components are taken as ``floor(256 * x)``, and a row's score is its whole inner product with
the anchor; higher scores come first, of equal ones the smaller id. An anchor's positives
are its first other rows of its label. A positive of score p has a window of scores, and the
first rows of other labels in it are returned as its negatives.

1. Codebooks. Each half of the vector space has a codebook, fitted by k-means on at most
   ``SAMPLE`` rows of least hash of their id. A row's cell is the pair of its halves' nearest
   code words. All rows are in the index; a code word's radius is the distance of its
   furthest row.
2. Order. For an anchor, a half score of a code word plus radius times the anchor's half
   norm bounds the half score of its rows. A heap over the two sorted lists of these (multi-sequence)
   visits the cells that have rows by falling sum, the bound of all scores in the cell.
3. Rounds. In a round each anchor asks its next ``FIRST`` cells, ``GROWTH`` times as many
   in each later round. It stops when its windows are certified: each has all its rows with
   scores above the bound of the next cell, or starts above that bound. So results are
   exact however well the codebooks fit; these decide only how many cells are opened.
   One search finds the positives, a second one the negatives in their windows.

Rows are packed in blocks of the first code word, of ``BLOCK`` rows at most and a 64th of all
or less where that is over a thousand, so that many rows alike are several blocks; a block that many anchors ask is opened for ``ASKED`` of them at
a time. Sums are made in doubles where these hold them exactly, else in whole numbers of Python.

Defined results: rows with a null id, label or vector or a component that is null or not
finite take no part; a shorter vector counts as filled up with zeros; repeated rows are
rows of their own; an anchor without another row of its label has no result, a positive
without negatives in its window none either; scores beyond 64 bits raise; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.llm.scratch import stored

SCALE = 256
SAMPLE = 8192
CELL = 1024
WORDS = (2, 256)
FIRST = 8
GROWTH = 8
BLOCK = 1 << 16
SMALL = 1024
ASKED = 1 << 15
AT_ONCE = 64
EXACT = float(1 << 53)
NONE = np.iinfo(np.int64).min
FOUND = "anchor bigint, slot int, `row` bigint, vec_id bigint, score bigint"


def usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, vector`` of the rows that take part; vector: whole numbers as doubles."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    whole = F.transform("vector", lambda x: x * SCALE)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return rows.withColumn("vector", whole)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Whole components, a row for each vector."""
    made = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        made[i, : len(vector)] = vector
    return np.floor(made)


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words**2).sum(1) - 2 * points @ words.T, axis=1)


def _fitted(points: np.ndarray, size: int) -> np.ndarray:
    """K-means from evenly spaced rows."""
    if not points.size:
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(size, len(distinct))).astype(int)].copy()
    for _ in range(10):
        nearest = _nearest(points, words)
        count = np.bincount(nearest, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        words[count > 0] = sums[count > 0] / count[count > 0, None]
    return words


@dataclass
class Codebooks:
    """Code words of the two halves, their radii, and which cells have rows."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    filled: set[tuple[int, int]]
    width: int

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = (self.width + 1) // 2
        return points[:, :cut], points[:, cut:]

    def visits(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Bound and cell, by falling bound."""
        orders, bounds = [], []
        for half, words, radii in zip(self.halves(anchor[None]), self.words, self.radii):
            norm = np.sqrt((half**2).sum())
            # A little more, for what sums of doubles may lose.
            bound = words @ half[0] + norm * radii
            bound += 1e-9 * (norm * (np.sqrt((words**2).sum(1)) + radii)) + 1e-6
            order = np.argsort(-bound, kind="stable")
            orders.append(order)
            bounds.append(bound[order])
        (first, second), (high, low) = orders, bounds
        heap, pushed = [(-(high[0] + low[0]), 0, 0)], {(0, 0)}
        while heap:
            total, a, b = heapq.heappop(heap)
            cell = int(first[a]), int(second[b])
            if cell in self.filled:
                yield -total, *cell
            for c, d in ((a + 1, b), (a, b + 1)):
                if c < len(high) and d < len(low) and (c, d) not in pushed:
                    pushed.add((c, d))
                    heapq.heappush(heap, (-(high[c] + low[d]), c, d))


def _sampled(rows: DataFrame, width: int) -> np.ndarray:
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).select("vector").collect()
    return _matrix([r["vector"] for r in some], width)


def build(rows: DataFrame) -> tuple[Codebooks, DataFrame]:
    """The codebooks and the index, all rows of ``usable`` with their cell: ``row, vec_id, label, vector, i, j``."""
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    width = max(1, size["width"])
    words = int(min(max((size["n"] / CELL) ** 0.5, WORDS[0]), WORDS[1]))
    books = Codebooks((np.zeros((1, 0)),) * 2, (np.zeros(1),) * 2, set(), width)
    books.words = tuple(_fitted(half, words) for half in books.halves(_sampled(rows, width)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = _matrix(batch["vector"], width)
            for half, book, code, away in zip(books.halves(points), books.words, "ij", "de"):
                nearest = _nearest(half, book)
                batch[code] = nearest
                batch[away] = np.sqrt(((half - book[nearest]) ** 2).sum(1))
            yield batch.assign(vector=list(points))

    schema = "`row` bigint, vec_id bigint, label bigint, vector array<double>, i bigint, d double, j bigint, e double"
    index = stored(rows.mapInPandas(placed, schema))
    radii = []
    for code, away, book in zip("ij", "de", books.words):
        radius = np.zeros(len(book))
        # As many rows as there are code words.
        for r in index.groupBy(code).agg(F.max(away).alias("r")).collect():
            radius[r[code]] = r["r"]
        radii.append(radius)
    books.radii = tuple(radii)
    books.filled = {(r["i"], r["j"]) for r in index.select("i", "j").distinct().collect()}
    return books, index.drop("d", "e")


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in doubles, in as few bytes as hold them all."""
    most = np.abs(values).max(initial=0)
    kind = next((k for k, top in (("i1", 127), ("i2", 32767), ("i4", 2**31 - 1)) if most <= top), "f8")
    return kind, np.ascontiguousarray(values.astype(kind)).tobytes()


def blocks_of(index: DataFrame, width: int) -> DataFrame:
    """``i, shard, names, kind, vectors``: the rows of a code word in blocks, by second code word."""

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["j", "row"])
        kind, vectors = _packed(_matrix(rows["vector"], width))
        names = rows[["row", "vec_id", "label", "j"]].to_numpy(np.int64).tobytes()
        return pd.DataFrame([(*key, names, kind, vectors)], columns=["i", "shard", "names", "kind", "vectors"])

    most = min(max(index.count() // 64, SMALL), BLOCK)
    sizes = index.groupBy("i").agg(F.ceil(F.count("*") / most).alias("shards"))
    dealt = index.join(F.broadcast(sizes), "i").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")))
    return stored(
        dealt.groupBy("i", "shard").applyInPandas(packed, "i bigint, shard bigint, names binary, kind string, vectors binary")
    )


def _best(rows: np.ndarray, names: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Of some rows the first ``k`` by score, then id, then place."""
    mine = scores[rows]
    if len(rows) > k:
        least = np.partition(mine, len(mine) - k)[len(mine) - k]
        rows, mine = rows[mine >= least], mine[mine >= least]
    return rows[np.lexsort((names[rows, 0], names[rows, 1], -mine))[:k]]


def _opened(width: int, k: int, same: bool):
    """The best rows of a block for each window of the anchors that ask."""

    def opened(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for names, kind, vectors in block[["names", "kind", "vectors"]].itertuples(index=False):
            names = np.frombuffer(names, np.int64).reshape(-1, 4)
            points = np.frombuffer(vectors, kind).reshape(-1, width).astype(float)
            for a in range(0, len(asked), AT_ONCE):
                some = asked.iloc[a : a + AT_ONCE]
                anchors = _matrix(some["vector"], width)
                if np.abs(anchors).max(initial=0) * np.abs(points).max(initial=0) * width < EXACT:
                    scores = (anchors @ points.T).astype(np.int64)
                else:
                    whole = [[[int(x) for x in row] for row in side] for side in (anchors, points)]
                    scores = np.array([[sum(map(int.__mul__, x, y)) for y in whole[1]] for x in whole[0]], object)
                    scores = scores.astype(np.int64)
                for row, mine in zip(some[["anchor", "label", "low", "high", "js"]].itertuples(index=False), scores):
                    fits = (names[:, 2] == row.label) == same
                    fits &= np.isin(names[:, 3], row.js) & (names[:, 0] != row.anchor)
                    for slot, (low, high) in enumerate(zip(row.low, row.high)):
                        rows = _best(np.flatnonzero(fits & (mine >= low) & (mine <= high)), names, mine, k)
                        out.extend((row.anchor, slot, *names[i, :2], mine[i]) for i in rows)
        return pd.DataFrame(out, columns=["anchor", "slot", "row", "vec_id", "score"])

    return opened


def _next_cells(books: Codebooks, seen: int, more: int, k: int):
    """The cells that each anchor asks after ``seen``, by first code word, unless its windows are certified."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                anchor = _matrix([r.vector], books.width)[0]
                worst: dict[int, list[int]] = {}
                for slot, score in zip(r.slots, r.scores):
                    worst.setdefault(int(slot), []).append(int(score))
                # A window is open down to its start, or to its last row once it has all.
                floor = [
                    np.inf if low > high else max(low, min(worst[s])) if len(worst.get(s, ())) >= k else low
                    for s, (low, high) in enumerate(zip(r.low, r.high))
                ]
                wanted: dict[int, list[int]] = {}
                for n, (bound, i, j) in enumerate(books.visits(anchor)):
                    if n >= seen + more or all(bound < f for f in floor):
                        break
                    if n >= seen:
                        wanted.setdefault(i, []).append(j)
                out.extend((r.anchor, r.label, r.vector, r.low, r.high, i, js) for i, js in wanted.items())
            yield pd.DataFrame(out, columns=["anchor", "label", "vector", "low", "high", "i", "js"])

    return cells


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(anchors: DataFrame, blocks: DataFrame, books: Codebooks, k: int, same: bool) -> DataFrame:
    """``anchor, slot, row, vec_id, score, rank``: the first ``k`` rows in each window of ``anchor, label, vector, low, high``."""
    found, seen, more = None, 0, FIRST
    # As many rows as there are code words, so these are broadcast.
    spans = F.broadcast(blocks.groupBy("i").agg(F.max("shard").alias("last")))
    asked_as = "anchor bigint, label bigint, vector array<double>, low array<bigint>, high array<bigint>, i bigint, js array<bigint>"
    while True:
        none = F.array().cast("array<bigint>")
        if found is None:
            known = anchors.withColumns({"slots": none, "scores": none})
        else:
            had = found.groupBy("anchor").agg(F.collect_list(F.struct("slot", "score")).alias("had"))
            known = anchors.join(had, "anchor", "left").withColumns(
                {
                    "slots": F.coalesce(F.transform("had", lambda x: x["slot"].cast("long")), none),
                    "scores": F.coalesce(F.transform("had", lambda x: x["score"]), none),
                }
            )
        known = known.select("anchor", "label", "vector", "low", "high", "slots", "scores")
        asked = stored(known.mapInPandas(_next_cells(books, seen, more, k), asked_as))
        if asked.isEmpty():
            return found if found is not None else _first(asked.sparkSession.createDataFrame([], FOUND), k)
        # A block that very many anchors ask is opened in several tasks.
        shares = F.broadcast(asked.groupBy("i").agg(F.ceil(F.count("*") / ASKED).alias("shares")))
        asking = (
            asked.join(shares, "i")
            .join(spans, "i")
            .withColumn("share", F.pmod(F.xxhash64("anchor"), F.col("shares")))
            .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        )
        held = blocks.join(shares, "i").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        made = (
            asking.select("i", "shard", "share", "anchor", "label", "vector", "low", "high", "js")
            .groupBy("i", "shard", "share")
            .cogroup(held.select("i", "shard", "share", "names", "kind", "vectors").groupBy("i", "shard", "share"))
            .applyInPandas(_opened(books.width, k, same), FOUND)
        )
        found = stored(_first(made if found is None else made.unionByName(found.drop("rank")), k))
        seen, more = seen + more, more * GROWTH


def hard_negatives(
    vectors: DataFrame, every: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, embedding, label``; ``every`` says of ``vec_id`` whether it is
    an anchor. The window of a positive of score p: ``low * p <= 100 * score <= high * p``.
    """
    rows = stored(usable(vectors))
    books, index = build(rows)
    blocks = blocks_of(index, books.width)
    anchors = stored(index.filter(every).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "vector"))
    least, most = (F.array(F.lit(x).cast("long")) for x in (NONE + 1, -NONE - 1))
    near = _search(anchors.withColumns({"low": least, "high": most}), blocks, books, positives, same=True)
    p = F.col("score").cast("decimal(19,0)")
    # Whole numbers from low * p / 100, rounded up, to high * p / 100, rounded down.
    near = near.select(
        "anchor",
        (F.col("rank") - 1).alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.ceil(p * low / 100).cast("long").alias("low"),
        F.floor(p * high / 100).cast("long").alias("high"),
    )
    near = stored(near)
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("w"))
    seeking = anchors.join(windows, "anchor").withColumns(
        {"low": F.transform("w", lambda x: x["low"]), "high": F.transform("w", lambda x: x["high"])}
    )
    far = _search(seeking, blocks, books, negatives, same=False)
    return (
        far.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(near.select("anchor", "slot", "positive_id", "positive_score"), ["anchor", "slot"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
