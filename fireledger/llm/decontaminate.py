"""Find test items in documents by pigeonhole edit matching.

Texts are compared in lower case with white space as single spaces. An item of length L
occurs in a document if some part of the document is within ``rate * L`` edits (bytes
inserted, deleted or replaced) of the whole item.

With a budget of e edits an item is split into e + 1 pieces, of which one must occur
unchanged. Pieces are found by their rolling hashes in all documents. Neighbouring pieces
form a node of at most 64 bytes: as the errors are fewer than the pieces, some node with r
pieces has at most r - 1 errors, and an unchanged piece within it. So a piece hit is first
verified in its node, all hits at once, with Myers' bit-parallel distance on 64-bit
words, and the few that pass are verified in the whole item with long words.

Items are sent to the tasks in blocks of about ``BLOCK`` bytes, and all documents are
searched for each block, so what is broadcast is bounded whatever the number of items.

Defined results: null and empty items occur nowhere; null and empty documents hold nothing;
items of one id count as one; an empty table of items finds nothing; repeated rows are
searched one by one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.scratch import in_small_batches, unused
from fireledger.llm.words import PIECE, POWERS, mixed, pieces, window_hashes

RATE = 0.1
BLOCK = 4 << 20
SIEVE = 18
WORD = 64


def plain(text: str | None) -> bytes:
    """Lower case, white space as single spaces, none at the ends."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").split()) if isinstance(text, str) else b""


def distance_within(pattern: bytes, text: bytes, most: int) -> int | None:
    """Least edits between the pattern and any part of the text, if at most ``most`` (Myers)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    equal: dict[int, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = equal.get(c, 0)
        down = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(diagonal | plus))
        left = plus & diagonal
        score += (up & top > 0) - (left & top > 0)
        up, left = up << 1 & full, left << 1 & full
        plus, minus = left | (full & ~(down | up)), up & down
        best = min(best, score)
    return best if best <= most else None


class Items:
    """Pieces and nodes of a block of test items, for search."""

    def __init__(self, items: list[tuple[int, bytes]], rate: float) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.budgets = [int(len(t) * rate) for t in self.texts]
        self.reach = max((len(t) + b for t, b in zip(self.texts, self.budgets)), default=0)
        pieces_found, nodes = [], []
        for k, (text, budget) in enumerate(zip(self.texts, self.budgets)):
            cuts = np.linspace(0, len(text), budget + 2).astype(int)
            each = max(1, WORD // max(1, int(np.diff(cuts).max())))
            for a in range(0, budget + 1, each):
                b = min(a + each, budget + 1)
                for j in range(a, b):
                    pieces_found.append((cuts[j + 1] - cuts[j], k, len(nodes), cuts[j] - cuts[a], cuts[j]))
                nodes.append((text[cuts[a] : cuts[b]], b - a - 1))
        table = np.array(pieces_found, np.int64).reshape(-1, 5)
        self.node_texts = [t for t, _ in nodes]
        self.node_errors = np.array([e for _, e in nodes], np.int64)
        self.lookups = []
        for length in np.unique(table[:, 0]):
            rows = table[table[:, 0] == length]
            keys = np.array([_key(self.texts[k][at : at + length]) for k, at in rows[:, [1, 4]]], np.uint64)
            order = np.argsort(keys, kind="stable")
            keys, rows = keys[order], rows[order]
            sieve = np.zeros(1 << SIEVE, bool)
            sieve[(keys >> np.uint64(64 - SIEVE)).astype(np.int64)] = True
            self.lookups.append((int(length), keys, rows, sieve))

    def hits(self, buf: np.ndarray) -> np.ndarray:
        """Rows of item, node, start of the node and of the item in ``buf``."""
        sums = window_hashes(buf)
        _, down = POWERS.upto(len(buf) + 1)
        found = []
        for length, keys, rows, sieve in self.lookups:
            n = len(buf) - length + 1
            if n <= 0:
                continue
            hashes = mixed((sums[length:] - sums[:n]) * down[:n], 70)
            at = np.flatnonzero(sieve[(hashes >> np.uint64(64 - SIEVE)).astype(np.int64)])
            low, high = np.searchsorted(keys, hashes[at]), np.searchsorted(keys, hashes[at], side="right")
            count = high - low
            which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(at, count)
            row = rows[which]
            found.append(np.stack([row[:, 1], row[:, 2], place - row[:, 3], place - row[:, 4]], axis=1))
        return np.concatenate(found) if found else np.zeros((0, 4), np.int64)

    def near(self, buf: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Which hits are within their node's errors of the text around; nodes of 64 bytes at most."""
        passed = np.ones(len(hits), bool)
        sizes = np.array([len(t) for t in self.node_texts], np.int64)[hits[:, 1]]
        errors = self.node_errors[hits[:, 1]]
        small = np.flatnonzero((sizes <= WORD) & (errors > 0))
        for part in np.array_split(small, len(small) // 4096 + 1):
            if len(part):
                passed[part] = self._nodes_near(buf, hits[part], sizes[part], errors[part])
        return passed

    def _nodes_near(self, buf: np.ndarray, hits: np.ndarray, sizes: np.ndarray, errors: np.ndarray) -> np.ndarray:
        nodes, mine = np.unique(hits[:, 1], return_inverse=True)
        equal = np.zeros((len(nodes), 256), np.uint64)
        for i, node in enumerate(nodes):
            for bit, c in enumerate(self.node_texts[node]):
                equal[i, c] |= np.uint64(1 << bit)
        one = np.uint64(1)
        top = one << (sizes - 1).astype(np.uint64)
        plus, minus = np.full(len(hits), ~np.uint64(0)), np.zeros(len(hits), np.uint64)
        score, best = sizes.copy(), sizes.copy()
        begin, reach = hits[:, 2] - errors, sizes + 2 * errors
        for step in range(int(reach.max())):
            at = begin + step
            inside = (at >= 0) & (at < len(buf)) & (step < reach)
            eq = np.where(inside, equal[mine, buf[np.clip(at, 0, len(buf) - 1)]], np.uint64(0))
            down = eq | minus
            diagonal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | ~(diagonal | plus)
            left = plus & diagonal
            score += ((up & top) > 0).astype(np.int64) - ((left & top) > 0)
            up, left = up << one, left << one
            plus, minus = left | ~(down | up), up & down
            np.minimum(best, score, out=best)
        return best <= errors

    def found_in(self, run: list[bytes]) -> dict[tuple[int, int], int]:
        """Least edits by text of the run and place of the item."""
        raw = b"\n".join(run) + b"\n"
        buf = np.frombuffer(raw, np.uint8)
        limits = np.cumsum([0] + [len(x) + 1 for x in run])
        hits = self.hits(buf)
        hits = hits[self.near(buf, hits)]
        # Hits whose items would begin close to each other are one candidate.
        hits[:, 3] //= np.array(self.budgets + [0])[hits[:, 0]] + 1
        seen = np.unique(hits[:, [0, 3]], axis=0)
        found: dict[tuple[int, int], int] = {}
        for k, c in seen:
            budget, size = self.budgets[k], len(self.texts[k])
            first = int(c) * (budget + 1)
            last = first + budget
            # The item begins between first and last, give or take the budget.
            a, b = first - budget, last + size + budget
            for i in range(max(0, int(np.searchsorted(limits, a, side="right")) - 1), len(run)):
                if limits[i] >= b:
                    break
                window = raw[max(a, limits[i]) : min(b, limits[i + 1] - 1)]
                if len(window) + budget < size:
                    continue
                edits = distance_within(self.texts[k], window, budget)
                if edits is not None:
                    found[i, int(k)] = min(edits, found.get((i, int(k)), edits))
        return found


def _key(piece: bytes) -> int:
    sums = window_hashes(np.frombuffer(piece, np.uint8))
    return int(mixed(sums[-1:], 70)[0])


def test_hits(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, item_id, edits``: the items that each row of ``docs`` holds, with the least edits."""
    return _hits(docs.select("doc_id", "text"), items, rate)


def _hits(docs: DataFrame, items: DataFrame, rate: float) -> DataFrame:
    """The hits by the first columns of ``docs``, of which the last is ``text``."""
    *names, _ = docs.columns
    known = items.filter(F.length(F.trim("text")) > 0).select(F.col("item_id").cast("string"), "text")
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = int(size // BLOCK + 1)
    kinds = dict([*docs.dtypes[:-1], ("item_id", dict(items.dtypes)["item_id"])])
    # As text, since a column of numbers and nulls would turn into doubles, which cannot hold all ids.
    docs = docs.select(*[F.col(n).cast("string") for n in names], "text")
    columns = ", ".join(f"{n} string" for n in names)
    found = None
    for number in range(blocks):
        block = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        given = [(r["item_id"], t) for r in block if (t := plain(r["text"]))]
        broadcast = docs.sparkSession.sparkContext.broadcast(Items(given, rate))

        def search(batches: Iterator[pd.DataFrame], broadcast=broadcast) -> Iterator[pd.DataFrame]:
            wanted = broadcast.value
            for batch in batches:
                ids = list(zip(*[batch[n].to_numpy() for n in names]))
                texts = [plain(t) for t in batch["text"]]
                # A long text is searched in slices that overlap by an item and its budget.
                slices = [(i, at) for i, t in enumerate(texts) for at in range(0, max(len(t), 1), PIECE)]
                parts = (texts[i][at : at + PIECE + wanted.reach] for i, at in slices)
                least: dict[tuple[int, int], int] = {}
                for first, run in pieces(parts):
                    for (j, k), edits in wanted.found_in(run).items():
                        i = slices[first + j][0]
                        least[i, k] = min(edits, least.get((i, k), edits))
                out = [(*ids[i], wanted.ids[k], edits) for (i, k), edits in least.items()]
                yield pd.DataFrame(out, columns=[*names, "item_id", "edits"])

        part = in_small_batches(docs).mapInPandas(search, f"{columns}, item_id string, edits bigint")
        found = part if found is None else found.unionByName(part)
    return found.select(*[F.col(n).cast(kind) for n, kind in kinds.items()], "edits")


def clean_documents(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns kept.

    Rows go by their text (two 64-bit hashes of it), whatever their ids: no id or an id that
    another row bears makes no difference.
    """
    first, second = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    a, b = unused("test_first", docs.columns), unused("test_second", docs.columns)
    hits = _hits(docs.select(first.alias(a), second.alias(b), "text"), items, rate).select(a, b).distinct()
    return docs.join(hits, (first == F.col(a)) & (second == F.col(b)), "left_anti")
