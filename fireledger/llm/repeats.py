"""Remove passages that an earlier document holds, by prefix-free parsing.

A byte goes if a string of ``width`` bytes covers it that also starts in a document of a
smaller id. Strings are judged on the texts as given, and never cross documents.

1. Parse. Texts are dealt to chunks by their place in ``docs``. Each chunk parses its texts into phrases
   (see ``phrases``) and sends its dictionary, each phrase once with its smallest
   document, to buckets by trigger. Equal strings have equal triggers, so they meet.
2. Parse order. A bucket sorts phrases and finds the smallest document of each. Where a
   trigger has one phrase only, as within all passages copied in full, that settles all
   strings in it.
3. Dictionary order. Where a trigger has different phrases, as at the ends of a passage,
   the chunks send their bytes, and the bucket sorts the suffixes of its dictionary: those
   that agree in ``width`` bytes are neighbours, and share the smallest document of the
   phrases that they come from.
4. Common triggers. A short line that many documents hold between differing neighbours
   gives its triggers a phrase a document. A chunk that has more than ``SHARE`` phrases of
   a trigger sends one of them only, and says so. Such a trigger, or one with more than
   ``CROWD`` phrases in all, is not sorted: the chunks send a hash of each of its strings,
   once with its smallest document, to buckets by that hash, so no bucket gets them all.
   Phrases, some hundred bytes long, and these strings count as equal by 64 bits of hash.
5. Each chunk parses again and marks its strings with what the buckets found.

So the suffix arrays of dictionary and parse are made bucket by bucket; only ``width``
bytes of a suffix and its smallest document are asked for, so no order across buckets
is needed. What is sent is one entry for each distinct phrase of a chunk. Nothing is sent
for each copy, and a passage that all documents hold is one entry a chunk.

Defined results: null text is empty; rows without id count as last and, like rows of one
id, do not remove from each other; texts under ``width`` bytes stay; an empty table gives
an empty table; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fireledger.llm.phrases import Phrases, parsed
from fireledger.llm.scratch import unused
from fireledger.llm.words import PIECE, POWERS, mixed, pieces, window_hashes

WIDTH = 50
CHUNK = 4 << 20
LAST = np.iinfo(np.int64).max
#: Column of the document's number: its id, LAST without one.
NUMBER = "pfp_number"
SHARE = 32
CROWD = 1024
SORTED, HASHED = 1, 2


class _Chunk:
    """The texts of a chunk in the order of their ids, and their phrases."""

    def __init__(self, rows: pd.DataFrame, width: int) -> None:
        rows = rows[[NUMBER, "text"]]
        ids = rows[NUMBER].to_numpy(np.int64)
        self.order = np.argsort(ids, kind="stable")
        self.ids, self.width = ids[self.order], width
        self.texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in rows["text"].iloc[self.order]]
        self.starts = np.cumsum([0] + [len(t) for t in self.texts])

    def parses(self) -> Iterator[tuple[Phrases, np.ndarray, np.ndarray]]:
        """Phrases, their documents' places, and the shift from their buffer to the chunk's bytes.

        A long text is cut into slices; its strings are dealt to them by their start.
        """
        slices = [
            (i, at)
            for i, t in enumerate(self.texts)
            for at in range(0, max(len(t) - self.width + 1, 1), PIECE)
        ]
        parts = (self.texts[i][at : at + PIECE + self.width - 1] for i, at in slices)
        for first, run in pieces(parts):
            found = parsed(run, self.width)
            mine = slices[first : first + len(run)]
            text = np.array([i for i, _ in mine])[found.owner]
            begin = np.array([self.starts[i] + at for i, at in mine])[found.owner]
            yield found, text, begin - found.limits[found.owner]

    def dictionary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases in order, with their triggers and smallest documents."""
        phrase, trigger, text = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for found, place, _ in self.parses():
            phrase.append(found.phrase)
            trigger.append(found.trigger)
            text.append(place)
        distinct, at = np.unique(np.concatenate(phrase), return_index=True)
        return distinct, np.concatenate(trigger)[at], self.ids[np.concatenate(text)[at]]


def _packed(numbers: np.ndarray) -> bytes:
    """Four bytes a number where that is enough; the last byte tells."""
    if not len(numbers) or (numbers.min() >= 0 and numbers.max() < 1 << 32):
        return numbers.astype(np.uint32).tobytes() + b"4"
    return numbers.astype(np.int64).tobytes() + b"8"


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data[:-1], np.uint32 if data[-1:] == b"4" else np.int64).astype(np.int64)


def _bucket(trigger: np.ndarray, buckets: int) -> np.ndarray:
    return (trigger % np.uint64(buckets)).astype(np.int64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys' starts of runs, and the run of each."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


ENTRIES = "bucket bigint, pfp_chunk bigint, trigger binary, phrase binary, doc binary, crowded binary"
DICTIONARY = "bucket bigint, pfp_chunk bigint, phrase binary, doc binary, size binary, bytes binary"
FOUND = "pfp_chunk bigint, phrase binary, doc binary, opened binary, size binary"


def _strings(buf: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the strings of ``width`` bytes that start at ``at``."""
    sums = window_hashes(buf)
    _, down = POWERS.upto(len(buf) + 1)
    return mixed((sums[at + width] - sums[at]) * down[at], 63)


def _along(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from ``first`` to ``last`` of each phrase, and whose they are."""
    count = last - first + 1
    whose = np.repeat(np.arange(len(count)), count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[whose], whose


def _hashed_triggers(found: pd.DataFrame, phrase: np.ndarray, trigger: np.ndarray) -> np.ndarray:
    """The triggers, in order, of which a chunk sends all strings by hash; ``phrase`` is its dictionary, in order."""
    told = [
        np.frombuffer(p, np.uint64)[np.frombuffer(o, np.uint8) == HASHED] for p, o in zip(found["phrase"], found["opened"]) if len(o)
    ]
    names = np.concatenate([np.zeros(0, np.uint64), *told])
    return np.unique(trigger[np.searchsorted(phrase, names)])


def _first_strings(chunk: _Chunk, triggers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the strings of these triggers, in order, with their smallest documents in the chunk."""
    strings, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for parse, text, _ in chunk.parses() if len(triggers) else []:
        mine = np.flatnonzero(np.isin(parse.trigger, triggers))
        start, whose = _along(parse.first[mine], parse.last[mine])
        hashes, one = np.unique(_strings(parse.buf, start, chunk.width), return_index=True)
        strings.append(hashes)
        places.append(text[mine[whose[one]]])
    # Texts are in the order of their ids, so a string's first document is its smallest.
    hashes, one = np.unique(np.concatenate(strings), return_index=True)
    return hashes, chunk.ids[np.concatenate(places)[one]]


def _send(width: int, buckets: int, share: int = SHARE):
    """A chunk's dictionary, by bucket; of a trigger with more than ``share`` phrases one, and the trigger as crowded."""

    def send(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        phrase, trigger, doc = _Chunk(rows, width).dictionary()
        _, at, mine, count = np.unique(trigger, return_index=True, return_inverse=True, return_counts=True)
        crowded = (count > share)[mine]
        sent = ~crowded
        sent[at] = True
        phrase, trigger, doc, crowded = phrase[sent], trigger[sent], doc[sent], crowded[sent]
        bucket, short = _bucket(trigger, buckets), (trigger >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        starts, _ = _groups(bucket[order])
        out = [
            (bucket[at[0]], key[0], short[at].tobytes(), phrase[at].tobytes(), _packed(doc[at]), short[at][crowded[at]].tobytes())
            for at in np.split(order, starts[1:])
            if len(at)
        ]
        return pd.DataFrame(out, columns=["bucket", "pfp_chunk", "trigger", "phrase", "doc", "crowded"])

    return send


def _settle(crowd: int = CROWD):
    """What each chunk must know of its phrases: the smallest document, and whether to send bytes."""

    def settle(key: tuple, entries: pd.DataFrame) -> pd.DataFrame:
        trigger = np.concatenate([np.frombuffer(x, np.uint32) for x in entries["trigger"]])
        phrase = np.concatenate([np.frombuffer(x, np.uint64) for x in entries["phrase"]])
        docs = [_unpacked(x) for x in entries["doc"]]
        chunk = np.repeat(np.arange(len(entries)), [len(x) for x in docs])
        doc = np.concatenate(docs)
        order = np.lexsort((phrase, trigger))
        starts, group = _groups(phrase[order])
        new = np.zeros(len(order), np.int64)
        new[starts] = 1
        smallest = np.empty(len(doc), np.int64)
        smallest[order] = np.minimum.reduceat(doc[order], starts)[group]
        starts, group = _groups(trigger[order])
        lowest, highest = (f.reduceat(phrase[order], starts) for f in (np.minimum, np.maximum))
        least, most = (f.reduceat(doc[order], starts) for f in (np.minimum, np.maximum))
        crowded = np.concatenate([np.frombuffer(x, np.uint32) for x in entries["crowded"]])
        many = np.isin(trigger[order][starts], crowded) | ((np.add.reduceat(new, starts) > crowd) & (least != most))
        opened = np.empty(len(doc), np.uint8)
        opened[order] = np.where(many, HASHED, np.where((lowest != highest) & (least != most), SORTED, 0))[group]
        wanted = np.flatnonzero((opened > 0) | (smallest < doc))
        bounds = np.searchsorted(chunk[wanted], np.arange(len(entries) + 1))
        names = entries["pfp_chunk"].to_numpy()
        found = [
            (names[i], phrase[at].tobytes(), _packed(smallest[at]), opened[at].tobytes(), b"")
            for i in range(len(entries))
            if len(at := wanted[bounds[i] : bounds[i + 1]])
        ]
        return pd.DataFrame(found, columns=["pfp_chunk", "phrase", "doc", "opened", "size"])

    return settle


def _send_bytes(width: int, buckets: int):
    """The bytes of a chunk's opened phrases, each once, by bucket; the strings of common triggers by hash, in buckets of their own."""

    def send(key: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "pfp_chunk", "phrase", "doc", "size", "bytes"]
        if not len(rows) or not len(found):
            return pd.DataFrame([], columns=columns)
        asked = np.sort(
            np.concatenate(
                [np.frombuffer(p, np.uint64)[np.frombuffer(o, np.uint8) == SORTED] for p, o in zip(found["phrase"], found["opened"])]
            )
        )
        chunk = _Chunk(rows, width)
        many = np.zeros(0, np.uint64)
        if any(HASHED in o for o in found["opened"]):
            phrases, triggers, _ = chunk.dictionary()
            many = _hashed_triggers(found, phrases, triggers)
        sent: dict[int, list[tuple]] = {}
        done = np.zeros(len(asked), bool)
        for parse, text, _ in chunk.parses():
            distinct, at = np.unique(parse.phrase, return_index=True)
            place = np.searchsorted(asked, distinct)
            hit = place < len(asked)
            hit[hit] = asked[place[hit]] == distinct[hit]
            hit[hit] = ~done[place[hit]]
            done[place[hit]] = True
            raw = parse.buf.tobytes()
            for i, bucket in zip(at[hit], _bucket(parse.trigger[at[hit]], buckets)):
                part = raw[parse.first[i] : parse.last[i] + width]
                sent.setdefault(int(bucket), []).append((parse.phrase[i], chunk.ids[text[i]], len(part), part))
        out = []
        for bucket, items in sent.items():
            phrase, doc, size, part = zip(*items)
            out.append(
                (
                    bucket,
                    key[0],
                    np.array(phrase, np.uint64).tobytes(),
                    _packed(np.array(doc, np.int64)),
                    np.array(size, np.uint32).tobytes(),
                    b"".join(part),
                )
            )
        hashes, docs = _first_strings(chunk, many)
        bucket = _bucket(hashes, buckets)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, _groups(bucket[order])[0][1:]):
            if len(at):
                out.append((buckets + bucket[at[0]], key[0], hashes[at].tobytes(), _packed(docs[at]), b"", b""))
        return pd.DataFrame(out, columns=columns)

    return send


def _least_of_strings(entries: pd.DataFrame) -> pd.DataFrame:
    """For each string that chunks sent by hash the smallest document, where it is earlier than theirs."""
    strings = np.concatenate([np.frombuffer(x, np.uint64) for x in entries["phrase"]])
    docs = [_unpacked(x) for x in entries["doc"]]
    bounds = np.cumsum([0] + [len(x) for x in docs])
    doc = np.concatenate(docs)
    order = np.argsort(strings, kind="stable")
    starts, group = _groups(strings[order])
    smallest = np.empty(len(doc), np.int64)
    smallest[order] = np.minimum.reduceat(doc[order], starts)[group]
    out = []
    for name, a, b in zip(entries["pfp_chunk"], bounds[:-1], bounds[1:]):
        at = a + np.flatnonzero(smallest[a:b] < doc[a:b])
        if len(at):
            out.append((name, strings[at].tobytes(), _packed(smallest[at]), b"", b""))
    return pd.DataFrame(out, columns=["pfp_chunk", "phrase", "doc", "opened", "size"])


def _sort_suffixes(width: int, buckets: int):
    """For each opened phrase the smallest document of each of its strings, if earlier than its own."""

    def sort(key: tuple, entries: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= buckets:
            return _least_of_strings(entries)
        phrase = np.concatenate([np.frombuffer(x, np.uint64) for x in entries["phrase"]])
        size = np.concatenate([np.frombuffer(x, np.uint32) for x in entries["size"]]).astype(np.int64)
        docs = [_unpacked(x) for x in entries["doc"]]
        chunk = np.repeat(np.arange(len(entries)), [len(x) for x in docs])
        doc = np.concatenate(docs)
        data = np.frombuffer(b"".join(entries["bytes"]), np.uint8)
        begin = np.cumsum(size) - size
        # The dictionary: each phrase once, with its smallest document.
        _, one, kind = np.unique(phrase, return_index=True, return_inverse=True)
        smallest = np.full(len(one), LAST)
        np.minimum.at(smallest, kind, doc)
        count = size[one] - width + 1
        shift = np.repeat(begin[one] - (np.cumsum(count) - count), count)
        suffixes = np.lib.stride_tricks.sliding_window_view(data, width)[np.arange(count.sum()) + shift]
        suffixes = np.ascontiguousarray(suffixes).view(f"S{width}").ravel()
        order = np.argsort(suffixes, kind="stable")
        starts, group = _groups(suffixes[order])
        of = np.empty(len(order), np.int64)
        of[order] = np.minimum.reduceat(np.repeat(smallest, count)[order], starts)[group]
        ends = np.cumsum(count)
        earliest = np.minimum.reduceat(of, ends - count)
        names, out = entries["pfp_chunk"].to_numpy(), []
        wanted = np.flatnonzero(earliest[kind] < doc)
        bounds = np.searchsorted(chunk[wanted], np.arange(len(entries) + 1))
        for i in range(len(entries)):
            at = wanted[bounds[i] : bounds[i + 1]]
            if len(at):
                strings = np.concatenate([of[ends[k] - count[k] : ends[k]] for k in kind[at]])
                out.append((names[i], phrase[at].tobytes(), _packed(strings), b"", count[kind[at]].astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["pfp_chunk", "phrase", "doc", "opened", "size"])

    return sort


def _marked(chunk: _Chunk, found: pd.DataFrame) -> np.ndarray:
    """Which bytes of the chunk's texts go."""
    phrase, trigger, doc = chunk.dictionary()
    doc = doc.copy()
    many = _hashed_triggers(found, phrase, trigger)
    strings_of = np.full(len(phrase), -1)
    settled = found[found["opened"].str.len() > 0]
    for p, d in zip(settled["phrase"], settled["doc"]):
        place = np.searchsorted(phrase, np.frombuffer(p, np.uint64))
        doc[place] = np.minimum(doc[place], _unpacked(d))
    strings, total = [np.zeros(0, np.int64)], 0
    for p, d, s in found.loc[found["size"].str.len() > 0, ["phrase", "doc", "size"]].itertuples(index=False):
        sizes = np.frombuffer(s, np.uint32).astype(np.int64)
        strings_of[np.searchsorted(phrase, np.frombuffer(p, np.uint64))] = total + np.cumsum(sizes) - sizes
        strings.append(_unpacked(d))
        total += sizes.sum()
    strings = np.concatenate(strings)
    # The strings of common triggers that came back, in order; own ones count within the chunk.
    hashed = found[(found["opened"].str.len() == 0) & (found["size"].str.len() == 0)]
    told = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(p, np.uint64) for p in hashed["phrase"]]])
    told_doc = np.concatenate([np.zeros(0, np.int64), *[_unpacked(d) for d in hashed["doc"]]])
    own, own_doc = _first_strings(chunk, many)
    at = np.searchsorted(own, told)
    own_doc[at] = told_doc
    change = np.zeros(chunk.starts[-1] + 1, np.int16)
    for parse, text, shift in chunk.parses():
        place = np.searchsorted(phrase, parse.phrase)
        mine = chunk.ids[text]
        whole = doc[place] < mine
        np.add.at(change, (parse.first + shift)[whole], 1)
        np.add.at(change, (parse.last + shift)[whole] + chunk.width, -1)
        part = np.flatnonzero(~whole & (strings_of[place] >= 0))
        count = parse.last[part] - parse.first[part] + 1
        along = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        early = strings[np.repeat(strings_of[place[part]], count) + along] < np.repeat(mine[part], count)
        at = (np.repeat((parse.first + shift)[part], count) + along)[early]
        np.add.at(change, at, 1)
        np.add.at(change, at + chunk.width, -1)
        common = np.flatnonzero(~whole & np.isin(parse.trigger, many)) if len(many) else []
        if len(common):
            start, whose = _along(parse.first[common], parse.last[common])
            early = own_doc[np.searchsorted(own, _strings(parse.buf, start, chunk.width))] < mine[common[whose]]
            at = start[early] + shift[common[whose[early]]]
            np.add.at(change, at, 1)
            np.add.at(change, at + chunk.width, -1)
    return np.cumsum(change[:-1], dtype=np.int16) > 0


def _apply(width: int, columns: list[str], names: dict[str, str]):
    """In Arrow, as pandas turns whole numbers beside nulls into doubles, which cannot hold all of them."""

    def apply(rows: pa.Table, found: pa.Table) -> pa.Table:
        given = rows.select([names[NUMBER], "text"]).to_pandas()
        chunk = _Chunk(given.rename(columns={names[NUMBER]: NUMBER}), width)
        gone = _marked(chunk, found.to_pandas())
        data = np.frombuffer(b"".join(chunk.texts), np.uint8)
        removed, spans, kept, digests = [], [], [], []
        for a, b in zip(chunk.starts[:-1], chunk.starts[1:]):
            mask = gone[a:b]
            kept.append(data[a:b][~mask].tobytes())
            removed.append(int(mask.sum()))
            spans.append(int(mask[:1].sum()) + int(np.count_nonzero(mask[1:] & ~mask[:-1])))
            digests.append(sha256(kept[-1]).hexdigest())
        out = rows.select(columns).take(pa.array(chunk.order))
        more = (
            ("pfp_bytes", pa.array(np.diff(chunk.starts), pa.int64())),
            ("pfp_removed", pa.array(removed, pa.int64())),
            ("pfp_spans", pa.array(spans, pa.int64())),
            ("pfp_kept", pa.array(kept, pa.binary())),
            ("pfp_sha256", pa.array(digests, pa.string())),
        )
        for name, values in more:
            out = out.append_column(names[name], values)
        return out

    return apply


MADE = ("pfp_bytes", "pfp_removed", "pfp_spans", "pfp_kept", "pfp_sha256")


def made_names(docs: DataFrame) -> dict[str, str]:
    """The names of the columns that `without_repeats` makes: those of ``MADE``, or where
    ``docs`` has one of that name, that name with underscores behind it."""
    return {name: unused(name, docs.columns) for name in (*MADE, NUMBER, "pfp_chunk")}


def without_repeats(
    docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK, share: int = SHARE, crowd: int = CROWD
) -> DataFrame:
    """``docs`` with pfp_bytes, pfp_removed, pfp_spans, pfp_kept (remaining bytes) and pfp_sha256 (see `made_names`)."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets, names = int(size // chunk_bytes + 1), made_names(docs)
    number, chunk = names[NUMBER], names["pfp_chunk"]
    # Rows are dealt by their place, so rows alike do not all meet in one chunk.
    chunked = docs.withColumns(
        {
            number: F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))),
            chunk: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)),
        }
    )
    texts = chunked.groupBy(chunk)

    def renamed(task):
        if number == NUMBER:
            return task
        return lambda key, rows, *more: task(key, rows[[number, "text"]].rename(columns={number: NUMBER}), *more)

    settled = (
        texts.applyInPandas(renamed(_send(width, buckets, share)), ENTRIES)
        .groupBy("bucket")
        .applyInPandas(_settle(crowd), FOUND)
    )
    opening = renamed(_send_bytes(width, buckets))
    opened = (
        texts.cogroup(settled.groupBy("pfp_chunk"))
        .applyInPandas(lambda key, rows, found: opening(key, rows, found), DICTIONARY)
        .groupBy("bucket")
        .applyInPandas(_sort_suffixes(width, buckets), FOUND)
    )
    kinds = (T.LongType(), T.LongType(), T.LongType(), T.BinaryType(), T.StringType())
    made = [T.StructField(names[name], kind) for name, kind in zip(MADE, kinds)]
    schema = T.StructType([*docs.schema.fields, *made])
    told = settled.unionByName(opened).groupBy("pfp_chunk")
    return texts.cogroup(told).applyInArrow(_apply(width, docs.columns, names), schema)


def text_without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the remaining text; a character cut in two goes. ``n_chars`` follows, if present."""

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda x: bytes(x).decode("utf-8", "ignore"))

    names = made_names(docs)
    cut = F.col(names["pfp_removed"]) > 0
    left = without_repeats(docs, **options).withColumn(
        "text", F.when(cut, decoded(names["pfp_kept"])).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.length("text").cast(kind)
        left = left.withColumn("n_chars", F.when(cut, length).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)
