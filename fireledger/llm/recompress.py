"""Remove word windows that an earlier document holds, by recompression.

A word goes if a window of ``width`` words covers it whose word sequence also starts in a
document of a smaller id. Windows are judged on the texts as given and never cross
documents.

Recompression replaces symbols by names, round by round, from the words on. In a round
the alphabet falls into left and right symbols, by a bit of the symbol; each maximal run of a
symbol gets one name, and each run of a left symbol with the run of a right one behind it
another. A name is a number made from what it stands for, so all chunks name alike. What
happens inside a window depends on its words alone, but for the first and last run of a
round and what they are paired with: these are popped, and the names between, the window's
interior, are the same wherever its words stand. Popped symbols and counts of all rounds,
and the interior of the last, spell the window: windows are equal if these are.

1. Texts are dealt to chunks. In each of ``rounds`` Spark rounds a chunk sends every new name
   that stands inside one of its windows, once, to a bucket; the bucket answers with a
   bit: whether several documents have it. A window with a name of one document only is
   nowhere else and is given up, so later rounds see the long repeats and little else.
2. Of the windows left, a chunk sends the spelling, once with its smallest document, as 96
   bits of hash; the bucket answers whether an earlier document is elsewhere.
3. The chunk marks the words of such windows.

Answers are bits, and names go as differences in order, so the exchange is small; a passage
that all documents hold is one entry a chunk, and no bucket gets more than one entry of a
chunk for a name. Rows between chunks and buckets never outnumber the names sent. In N
windows, two different ones pass for one with probability below N * N / 2 ** 97; names that
collide only keep a window to the last step.

Defined results: null text has no words; rows without id come last and, like rows of one
id, remove nothing from each other; ties and repeated rows are judged one by one; an empty
table gives an empty table; other columns are not looked at. A text is held in one task, its
words are handled ``SLICE`` at a time. Rows are dealt by their place in ``docs``, so ``docs``
must come in the same order if read again, as files do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.packed import bits, numbers, planes, steps, unbits, unstepped
from fireledger.llm.words import PIECE, mixed, pieces, words_of

WIDTH = 13
ROUNDS = 3
CHUNK = 8 << 20
BUCKET = 32 << 20
SLICE = 1 << 17
NAME_BITS = 40

SPACE = re.compile(rb"[\x20\x09-\x0D]")
ASKED = "bucket bigint, rc_chunk bigint, round int, names binary, more binary, doc binary"
TOLD = "rc_chunk bigint, round int, bucket bigint, bits binary, n bigint"
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``PIECE`` bytes that end before white space."""
    at = 0
    while len(text) - at > PIECE:
        cut = SPACE.search(text, at + PIECE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class _Named:
    """One round: runs of equal symbols, left ones paired with right ones, and their names."""

    def __init__(self, symbols: np.ndarray, text: np.ndarray, round: int) -> None:
        salt = 200 + 8 * round
        begin = np.ones(len(symbols), bool)
        begin[1:] = (symbols[1:] != symbols[:-1]) | (text[1:] != text[:-1])
        self.run = np.cumsum(begin, dtype=np.int32) - 1
        self.at = np.flatnonzero(begin).astype(np.int32)
        self.length = np.diff(self.at, append=np.int32(len(symbols)))
        self.symbol, owner = symbols[self.at], text[self.at]
        right = (mixed(self.symbol, salt) >> np.uint64(63)).astype(bool)
        #: Whether a run is paired with the next one.
        self.paired = np.zeros(len(self.at), bool)
        self.paired[:-1] = ~right[:-1] & right[1:] & (owner[1:] == owner[:-1])
        long = self.length > 1
        self.name = self.symbol.copy()
        self.name[long] = mixed(mixed(self.symbol[long], salt + 1) + self.length[long].astype(np.uint64), salt + 2)
        head = np.ones(len(self.at), bool)
        head[1:] = ~self.paired[:-1]
        #: The new symbol that a run is in.
        self.place = np.cumsum(head, dtype=np.int32) - 1
        heads = np.flatnonzero(head)
        pair = self.paired[heads]
        self.new, self.text = self.name[heads], owner[heads]
        self.new[pair] = mixed(mixed(self.new[pair], salt + 3) ^ self.name[heads[pair] + 1], salt + 4)
        self.made = pair | long[heads]


class _Block:
    """Some words of a chunk and the windows that start there, as places in the symbols of a round."""

    def __init__(self, words: np.ndarray, text: np.ndarray, first: int, count: int, width: int) -> None:
        self.symbols, self.text, self.first = words, text, first
        starts = np.arange(max(0, min(count, len(words) - width + 1)), dtype=np.int32)
        self.start = starts[text[starts] == text[starts + width - 1]]
        self.left, self.right = self.start, self.start + np.int32(width)
        self.owner = text[self.start]
        self.spelt = [np.zeros(len(self.start), np.uint64), np.zeros(len(self.start), np.uint64)]
        self.made = np.zeros(0, bool)

    def _spell(self, x: np.ndarray, among: np.ndarray) -> None:
        one, two = self.spelt
        one[among] = mixed(one[among] ^ x, 190)
        two[among] = two[among] * np.uint64(0xD6E8FEB86659FD93) + x

    def advance(self, round: int, spell: bool) -> None:
        """Pop the ends of all windows and name what is between."""
        now = _Named(self.symbols, self.text, round)
        if not len(self.symbols):
            self.made = now.made
            return
        f, g = now.run[self.left], now.run[self.right - 1]
        whole = self.left < self.right
        single = f == g
        take = now.paired[f] & (f + 1 < g)
        low = f + 1 + take
        back = now.paired[g - 1] & (g - 1 >= low) & ~single
        high = g - back
        if spell:
            first = np.minimum(now.at[f] + now.length[f], self.right) - self.left
            last = self.right - np.maximum(now.at[g], self.left)
            zero = np.uint64(0)
            popped = [
                mixed(now.symbol[f], 192) + first.astype(np.uint64),
                np.where(take, now.name[np.minimum(f + 1, len(now.name) - 1)], zero),
                np.where(single, zero, mixed(now.symbol[g], 193) + last.astype(np.uint64)),
                np.where(back, now.name[g - 1], zero),
            ]
            for x in popped:
                self._spell(x[whole], np.flatnonzero(whole))
        inside = whole & ~single & (low < high)
        top = len(now.place) - 1
        self.left = np.where(inside, now.place[np.minimum(low, top)], 0).astype(np.int32)
        self.right = np.where(inside, now.place[np.minimum(high - 1, top)] + 1, 0).astype(np.int32)
        self.symbols, self.text, self.made = now.new, now.text, now.made

    def _inside(self) -> np.ndarray:
        """Whether a window's interior has a symbol."""
        change = np.bincount(self.left, minlength=len(self.symbols) + 1) - np.bincount(self.right, minlength=len(self.symbols) + 1)
        return np.cumsum(change[:-1]) > 0

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """New names inside a window, and their texts."""
        self.at = np.flatnonzero(self.made & self._inside())
        return _short(self.symbols[self.at]), self.text[self.at]

    def keep(self, live: np.ndarray) -> None:
        """Give up the windows with a new name that is not among ``live``, and what is in no other window."""
        dead = np.zeros(len(self.symbols) + 1, np.int32)
        dead[1 + self.at[~_among(_short(self.symbols[self.at]), live)]] = 1
        dead = np.cumsum(dead)
        left = np.flatnonzero(dead[self.right] == dead[self.left])
        self.start, self.left, self.right, self.owner = self.start[left], self.left[left], self.right[left], self.owner[left]
        self.spelt = [x[left] for x in self.spelt]
        # An interior stays in one piece, and what comes to stand beside it makes no difference.
        inside = self._inside()
        place = np.zeros(len(inside) + 1, np.int32)
        place[1:] = np.cumsum(inside)
        self.symbols, self.text = self.symbols[inside], self.text[inside]
        self.left, self.right = place[self.left], place[self.right]

    def finish(self) -> None:
        """Spell the interiors that the last round leaves."""
        left = self.left.copy()
        while len(more := np.flatnonzero(left < self.right)):
            self._spell(self.symbols[left[more]], more)
            left[more] += 1


def _short(names: np.ndarray) -> np.ndarray:
    return names >> np.uint64(64 - NAME_BITS)


def _among(names: np.ndarray, live: np.ndarray) -> np.ndarray:
    if not len(live):
        return np.zeros(len(names), bool)
    return live[np.minimum(np.searchsorted(live, names), len(live) - 1)] == names


class _Chunk:
    """The texts of a chunk in the order of their ids, and their words."""

    def __init__(self, rows: pd.DataFrame, width: int) -> None:
        none, ids = rows["rc_none"].to_numpy(bool), rows["rc_id"].to_numpy(np.int64)
        order = np.lexsort((ids, none))
        self.rows, self.width = rows.iloc[order], width
        self.doc = np.where(none, LAST, ids.view(np.uint64) ^ np.uint64(1 << 63))[order]
        self.texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in self.rows["text"]]
        owners, parts = [], []
        for i, text in enumerate(self.texts):
            for part in _parts(text):
                owners.append(i)
                parts.append(part)
        words, text = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        owners = np.array(owners, np.int32)
        for first, run in pieces(parts):
            found = words_of(run, lower=False)
            words.append(found.hashes)
            text.append(owners[found.text + first])
        self.words, self.text = np.concatenate(words), np.concatenate(text)
        self.bounds = np.searchsorted(self.text, np.arange(len(self.texts) + 1))
        self.blocks = [
            _Block(self.words[a : a + SLICE + width - 1], self.text[a : a + SLICE + width - 1], a, SLICE, width)
            for a in range(0, len(self.words), SLICE)
        ]

    def names(self, round: int, spell: bool) -> tuple[np.ndarray, np.ndarray]:
        """The names asked for in a round, in order, and whether several texts have them."""
        names, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for block in self.blocks:
            block.advance(round, spell)
            found = block.asked()
            names.append(found[0])
            texts.append(found[1])
        names, texts = np.concatenate(names), np.concatenate(texts)
        order = np.argsort(names, kind="stable")
        names, texts = names[order], texts[order]
        starts = _starts(names)
        if not len(starts):
            return names, np.zeros(0, bool)
        return names[starts], np.minimum.reduceat(texts, starts) != np.maximum.reduceat(texts, starts)

    def follow(self, told: pd.DataFrame, rounds: int, spell: bool) -> None:
        """Go through the rounds that are answered."""
        for round in range(rounds):
            names, _ = self.names(round, spell)
            live = names[_answers(told, round)]
            for block in self.blocks:
                block.keep(live)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct spellings in order (64 and 32 bits) with their smallest document; of each
        window left its start and its spelling's place."""
        start, owner, one, two = ([np.zeros(0, kind)] for kind in (np.int64, np.int32, np.uint64, np.uint64))
        for block in self.blocks:
            block.finish()
            start.append(block.start + np.int64(block.first))
            owner.append(block.owner)
            one.append(mixed(block.spelt[0], 194))
            two.append(mixed(block.spelt[1], 195) >> np.uint64(32))
        start, owner, one, two = map(np.concatenate, (start, owner, one, two))
        order = np.lexsort((owner, two, one))
        new = np.ones(len(order), bool)
        a, b = one[order], two[order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        # Texts are in the order of their documents, so the first is of the smallest one.
        return a[new], b[new], self.doc[owner[order[new]]], start, place


def _starts(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _answers(told: pd.DataFrame, round: int) -> np.ndarray:
    mine = told[told["round"] == round].sort_values("bucket")
    return np.concatenate([np.zeros(0, bool), *[unbits(b, n) for b, n in zip(mine["bits"], mine["n"])]])


def _dealt(names: np.ndarray, width: int, buckets: int) -> list[tuple[int, int, int]]:
    """Buckets of names in order, by their leading bits: number, from, to."""
    high = (names >> np.uint64(width - 32)) if width > 32 else names
    bucket = ((high * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    bounds = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(b, i, j) for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])) if i < j]


def _ask(width: int, rounds: int, round: int, buckets: int):
    """What a chunk asks in a round, and the answers of earlier ones handed on."""

    def ask(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            chunk = _Chunk(rows, width)
            chunk.follow(told, round, spell=round == rounds)
            if round < rounds:
                names, several = chunk.names(round, False)
                for b, i, j in _dealt(names, NAME_BITS, buckets):
                    out.append((b, key[0], round, steps(names[i:j]), bits(several[i:j]), b""))
            else:
                one, two, doc, _, _ = chunk.windows()
                for b, i, j in _dealt(one, 64, buckets):
                    out.append((b, key[0], round, steps(one[i:j]), two[i:j].astype(np.uint32).tobytes(), planes(doc[i:j])))
            for r, b, found, n in told[["round", "bucket", "bits", "n"]].itertuples(index=False):
                out.append((-1 - key[0], key[0], r, found, planes(np.array([b, n])), b""))
        return pd.DataFrame(out, columns=["bucket", "rc_chunk", "round", "names", "more", "doc"])

    return ask


def _tell(rounds: int):
    """Which names of each chunk other documents have; of spellings, which an earlier one has elsewhere."""

    def tell(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["rc_chunk", "round", "bucket", "bits", "n"]
        if key[0] < 0:
            found = [numbers(x).astype(np.int64) for x in asked["more"]]
            rows = zip(asked["rc_chunk"], asked["round"], [x[0] for x in found], asked["names"], [x[1] for x in found])
            return pd.DataFrame(list(rows), columns=columns)
        round = int(asked["round"].iloc[0])
        each = [unstepped(x) for x in asked["names"]]
        bounds = np.cumsum([0] + [len(x) for x in each])
        names = np.concatenate(each)
        if round < rounds:
            several = np.concatenate([unbits(x, n) for x, n in zip(asked["more"], np.diff(bounds))])
            order = np.argsort(names, kind="stable")
            starts = _starts(names[order])
            size = np.diff(starts, append=len(names))
            live = (size > 1) | np.logical_or.reduceat(several[order], starts)
            yes = np.empty(len(names), bool)
            yes[order] = np.repeat(live, size)
        else:
            two = np.concatenate([np.frombuffer(x, np.uint32) for x in asked["more"]])
            doc = np.concatenate([numbers(x) for x in asked["doc"]])
            order = np.lexsort((two, names))
            a, b = names[order], two[order]
            new = np.ones(len(order), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            starts = np.flatnonzero(new)
            least = np.empty(len(names), np.uint64)
            least[order] = np.repeat(np.minimum.reduceat(doc[order], starts), np.diff(starts, append=len(names)))
            yes = least < doc
        rows = [
            (chunk, round, key[0], bits(yes[i:j]), j - i)
            for chunk, i, j in zip(asked["rc_chunk"], bounds[:-1], bounds[1:])
        ]
        return pd.DataFrame(rows, columns=columns)

    return tell


def _kept(text: bytes, gone: np.ndarray) -> bytes:
    """The words of a text that are not gone, joined by one space."""
    left, done = [], 0
    for part in _parts(text):
        # Split at the white space of ASCII.
        words = part.split()
        left.extend(compress(words, ~gone[done : done + len(words)]) if gone.any() else words)
        done += len(words)
    return b" ".join(left)


def _apply(width: int, rounds: int):
    def apply(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        columns = ["rc_none", "rc_id", "n_words", "n_removed", "kept", "kept_sha256"]
        if not len(rows):
            return pd.DataFrame([], columns=columns)
        chunk = _Chunk(rows, width)
        chunk.follow(told, rounds, spell=True)
        _, _, least, start, place = chunk.windows()
        earlier = _answers(told, rounds)
        mine = chunk.doc[chunk.text[start]] if len(start) else np.zeros(0, np.uint64)
        hit = start[earlier[place] | (least[place] < mine)]
        change = np.zeros(len(chunk.words) + 1, np.int32)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + width, -1)
        gone = np.cumsum(change[:-1]) > 0
        out = []
        for none, name, text, a, b in zip(chunk.rows["rc_none"], chunk.rows["rc_id"], chunk.texts, chunk.bounds[:-1], chunk.bounds[1:]):
            left = _kept(text, gone[a:b])
            out.append((none, name, b - a, int(gone[a:b].sum()), left.decode("utf-8", "surrogatepass"), sha256(left).hexdigest()))
        return pd.DataFrame(out, columns=columns)

    return apply


def without_repeats(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, chunk_bytes: int = CHUNK) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` of each row; kept: its other words, joined by a space."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    chunks, buckets = int(size // chunk_bytes + 1), int(size // BUCKET + 1)
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select(
        # A column of numbers and nulls would turn into doubles, which cannot hold the ids.
        F.col("doc_id").isNull().alias("rc_none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("rc_id"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).alias("rc_chunk"),
    ).groupBy("rc_chunk")
    nothing = pd.DataFrame({"round": [], "bucket": [], "bits": [], "n": []})
    begin = _ask(width, rounds, 0, buckets)

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return begin(key, rows, nothing)

    told = texts.applyInPandas(first, ASKED).groupBy("bucket").applyInPandas(_tell(rounds), TOLD)
    for round in range(1, rounds + 1):
        asked = texts.cogroup(told.groupBy("rc_chunk")).applyInPandas(_ask(width, rounds, round, buckets), ASKED)
        told = asked.groupBy("bucket").applyInPandas(_tell(rounds), TOLD)
    schema = "rc_none boolean, rc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    left = texts.cogroup(told.groupBy("rc_chunk")).applyInPandas(_apply(width, rounds), schema)
    name = F.when(~F.col("rc_none"), F.col("rc_id")).cast(kind)
    return left.select(name.alias("doc_id"), "n_words", "n_removed", "kept", "kept_sha256")
