"""Exact n-gram Jaccard self-join and its components, by a token-group matrix.

A document's set is its distinct ``width``-word shingles as 64-bit hashes. Documents of
equal sets count as one. The join links sets of similarity ``percent`` and more:

1. Blocks. Sizes fall into classes, such that linked sets are in one class or in
   neighbouring ones. For a class, all possible shingles are dealt to ``m`` parts, more
   parts than two linked sets of it can differ in shingles, so linked sets agree in a
   whole part that has shingles. Sets that agree in a part are in a block. A passage in
   many documents makes few blocks by itself, as most parts hold other shingles too.
2. Groups. A set's cluster is its largest block. It is compared with the cluster's leader,
   the member with most company in all its blocks; sets linked so far form components.
   A component of more than ``GROUP`` sets, and the smaller ones of a cluster together,
   are partitioned into groups of about ``GROUP`` similar sets.
3. Matrix. A group keeps the union of its members' shingles, and for each of them its
   members. Where a block holds several components, sets ask the groups there: those of
   small components all (of two groups of small ones, one asks), those of large ones the larger
   ones only. A set stays only in its rarest blocks, as many as must hold one that it shares
   with a linked set, so the largest blocks ask little. The number of a set's
   shingles in the union bounds its overlap with any member: only where that allows a
   link is the group opened and the overlap with each member counted. Groups hold half of each
   hash, so a count is never too small; pairs that are found are counted again by whole hashes.
   A group tells only pairs that join what its pairs before have not joined, and is opened
   again without those that whole hashes refute.

Large groups of near copies therefore cost a question for each member and group, not for
each pair, a group tells fewer pairs than it meets components, and links within a component
are not looked for again. All linked sets come to one component: a link that no block shows would need the differing
shingles to hit all parts of a set that are not empty; parts are added until that has
probability below ``MISS``. A set's 64-bit id is taken as the set.

Defined results: documents without a word have no set, size 0 and no links; fewer words
than ``width`` make one shingle of all; ids may repeat; repeated rows are linked, and so
are rows without id, whose component is null if no linked row has an id; an empty table
gives an empty table. Inside, a row is known by a 64-bit hash of its id and text.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import exp, lgamma, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.llm.components import components
from fireledger.llm.scratch import forget, in_small_batches, stored, unused
from fireledger.llm.words import Words, joined, mixed, pieces, words_of

MISS = 1e-12
GROUP = 256
ASKED = 2048


def _row_id() -> Column:
    """A row by its id and text."""
    return F.xxhash64("doc_id", "text")


def _first_row() -> Column:
    """Of some rows that of the smallest id, those without id last."""
    return F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id"))["row_id"]


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    hashes, owners = joined(words, range(width))
    bounds = np.searchsorted(owners, np.arange(len(words.bounds)))
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    counts = np.diff(words.bounds)
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        few = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        total = np.full(1, counts[i], np.uint64)
        for k in range(len(few)):
            total = mixed(total ^ few[k : k + 1], 20 + k)
        sets[i] = total
    return sets


class Classes:
    """Size classes of a similarity, and the number of parts of each."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.low, self.parts = [1], []

    def _differ(self, smaller: int) -> int:
        """Most shingles in which a set of this size and a linked, no smaller one can differ."""
        both = smaller + 100 * smaller // self.percent
        return both * (100 - self.percent) // (100 + self.percent)

    @staticmethod
    def _missed(size: int, differ: int, parts: int) -> float:
        """Bound on the chance that the differing shingles hit each part that is not empty."""
        total = 0.0
        for used in range(1, differ + 1):
            ways = lgamma(parts + 1) - lgamma(used + 1) - lgamma(parts - used + 1) + size * log(used / parts)
            hits = lgamma(differ + 1) - lgamma(differ - used + 1) - used * log(parts)
            total += exp(min(0.0, ways) + min(0.0, hits))
        return total

    def _grow(self) -> None:
        low = self.low[-1]
        high = 100 * low // self.percent + 1
        differ = max(self._differ(n) for n in {high - 1, max(low, high - 2)})
        m = differ and differ + 1
        while m and self._missed(low, differ, m) > MISS:
            m += 1
        self.parts.append(m)
        self.low.append(high)

    def of(self, size: int) -> list[tuple[int, int]]:
        """Class and parts that a set of this size has, as the smaller and as the larger of a link."""
        while self.low[-1] <= size:
            self._grow()
        own = bisect_right(self.low, size) - 1
        return [(c, self.parts[c]) for c in (own, own - 1) if c >= 0 and self.parts[c]]

    def differing(self, size: int) -> list[tuple[int, int, int]]:
        """Class, parts, and most shingles in which a set linked there can differ from one of this size."""
        found = []
        for number, parts in self.of(size):
            # In the class below its own, the set is the larger one.
            below = self.low[number + 1] - 1
            most = self._differ(size) if below >= size else (below + size) * (100 - self.percent) // (100 + self.percent)
            found.append((number, parts, most))
        return found


@lru_cache(maxsize=8)
def _classes(percent: int) -> Classes:
    return Classes(percent)


def _part(shingles: np.ndarray, number: int, parts: int) -> np.ndarray:
    """The part of each shingle in a class."""
    return ((mixed(shingles, 1000 + number) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def block_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set's blocks: one for each part that is not empty. The last bit is that of the class number."""
    keys = []
    for number, parts in _classes(percent).of(len(shingles)):
        part = _part(shingles, number, parts)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, mixed(shingles, 30))
        used = np.flatnonzero(np.bincount(part, minlength=parts))
        key = mixed(sums[used] ^ mixed(used.astype(np.uint64), 101_000 + number), 31)
        keys.append(key & ~np.uint64(1) | np.uint64(number & 1))
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def spare_parts(shingles: np.ndarray, percent: int) -> list[int | None]:
    """For a set's class of even and that of odd number: the most parts in which a linked set can
    differ from it, less its parts that are not empty."""
    spare: list[int | None] = [None, None]
    for number, parts, differ in _classes(percent).differing(len(shingles)):
        spare[number & 1] = differ - len(np.unique(_part(shingles, number, parts)))
    return spare


def set_id(shingles: np.ndarray) -> int | None:
    if not len(shingles):
        return None
    total = mixed(shingles, 32).sum(dtype=np.uint64) ^ mixed(np.full(1, len(shingles), np.uint64), 33)
    return int(mixed(total, 34).view(np.int64)[0])


def _sets_of(texts: pd.Series, width: int) -> Iterator[np.ndarray]:
    for _, run in pieces(texts):
        yield from shingle_sets(words_of(run), width)


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, row_id, n_shingles, set`` of each document."""
    kind = dict(docs.dtypes)["doc_id"]

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(_sets_of(batch["text"], width))
            # A column of numbers and None would turn into doubles, which cannot hold the ids.
            names = pd.array([set_id(s) for s in found], dtype="Int64")
            yield batch[["doc_id", "row_id"]].assign(n_shingles=[len(s) for s in found], set=names)

    # As text, since a column of numbers and nulls would turn into doubles as well.
    given = docs.select(F.col("doc_id").cast("string"), _row_id().alias("row_id"), "text")
    found = in_small_batches(given).mapInPandas(sets, "doc_id string, row_id bigint, n_shingles bigint, `set` bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def set_blocks(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``set, key``: each set of a task once with the keys of its blocks."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: set[int] = set()
        for batch in batches:
            for _, run in pieces(batch["text"]):
                ids, keys = [], []
                for shingles in shingle_sets(words_of(run), width):
                    name = set_id(shingles)
                    if name is not None and name not in known:
                        known.add(name)
                        keys.append(block_keys(shingles, percent))
                        ids.append(np.full(len(keys[-1]), name))
                if ids:
                    yield pd.DataFrame({"set": np.concatenate(ids), "key": np.concatenate(keys)})

    return in_small_batches(docs.select("text")).mapInPandas(keyed, "`set` bigint, key bigint")


def _linked(a: str, b: str, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("long")
    return both * (100 + percent) >= (F.size(a) + F.size(b)) * percent


def _with_shingles(docs: DataFrame, wanted: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``wanted`` (row_id, set, cluster, company) with the shingles of their documents
    and their `spare_parts`.

    Equal rows come to one task, which takes the first of them, unless Spark splits it: then
    a set comes once for each part, which changes no link.
    """

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: set[int] = set()
        for batch in batches:
            sets = [s.view(np.int64) for s in _sets_of(batch["text"], width)]
            mine = []
            for s, x in zip(batch["set"], sets):
                # Equal rows come several times.
                mine.append(s not in known and len(x) > 0 and set_id(x.view(np.uint64)) == s)
                if mine[-1]:
                    known.add(s)
            of_mine = [s for s, m in zip(sets, mine) if m]
            spare = [spare_parts(s.view(np.uint64), percent) for s in of_mine]
            yield batch[["set", "cluster", "company"]][mine].assign(shingles=of_mine, spare=spare)

    return (
        in_small_batches(docs.select(_row_id().alias("row_id"), "text"))
        .join(wanted, "row_id")
        .select("set", "cluster", "company", "text")
        .mapInPandas(shingles, "`set` bigint, cluster bigint, company bigint, shingles array<bigint>, spare array<int>")
    )


def _rarest(blocks: DataFrame, held: DataFrame) -> DataFrame:
    """The ``key, set`` rows of ``blocks`` in which linked sets meet for the first time, smallest blocks first.

    Of a set's blocks in a class, those that a linked set is not in are at most as many as the
    parts in which the two can differ. Blocks of one set are among them, so one more than are
    left of these, the smallest first, hold a block of both. As the order is that of both sets,
    their first common block is in what is kept of either.
    """
    of_class = Window.partitionBy("set", F.col("key").bitwiseAND(F.lit(1)))
    ranked = blocks.withColumn("known", F.count("*").over(of_class)).withColumn(
        "nth", F.row_number().over(of_class.orderBy("size", "key"))
    )
    spare = F.get("spare", F.col("key").bitwiseAND(F.lit(1)).cast("int"))
    return ranked.join(held.select("set", "spare"), "set").filter(F.col("nth") <= spare + F.col("known") + 1).select("key", "set")


def similar_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``doc_id, text``.

    The component is the smallest id of the documents reached by links.
    """
    known = _rooted(docs, width, percent)
    smallest = known.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return known.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id")
    )


def _rooted(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, row_id, n_shingles, set, root`` of each row; the root tells components apart, null without a set."""
    members = stored(document_sets(docs, width))
    by_key = Window.partitionBy("key")
    blocks = stored(
        set_blocks(docs, width, percent)
        .withColumn("first", F.min("set").over(by_key))
        .withColumn("last", F.max("set").over(by_key))
        .filter("first <> last")
        .select("key", "set")
        .distinct()
        # Dealt by key already.
        .withColumn("size", F.count("*").over(by_key))
    )
    clusters = blocks.groupBy("set").agg(
        F.max(F.struct("size", "key"))["key"].alias("cluster"), F.sum("size").alias("company")
    )
    wanted = clusters.join(members.groupBy("set").agg(_first_row().alias("row_id")), "set")
    held = stored(_with_shingles(docs, wanted, width, percent))
    leaders = held.groupBy("cluster").agg(F.max(F.struct("company", "set"))["set"].alias("leader"))
    leading = held.select(F.col("set").alias("leader"), F.col("shingles").alias("leading")).join(leaders, "leader")
    near = stored(
        held.join(leading, "cluster")
        .filter((F.col("set") != F.col("leader")) & _linked("shingles", "leading", percent))
        .select(F.col("set").alias("a"), F.col("leader").alias("b"))
    )
    rarest = stored(_rarest(blocks, held))
    forget(docs.sparkSession, blocks)
    more = _links_between(rarest, held, stored(components(near)), percent)
    forget(docs.sparkSession, rarest, held)
    roots = components(near.unionByName(more))
    return members.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))


def _groups(held: DataFrame, first: DataFrame) -> DataFrame:
    """``set, root, n, large, group``: each set's component so far, its size, and the set's group."""
    sets = held.select("set", "cluster").distinct().join(first.withColumnRenamed("node", "set"), "set", "left")
    sets = sets.withColumn("root", F.coalesce("root", "set"))
    sets = sets.join(sets.groupBy("root").agg(F.count("*").alias("n")), "root")
    sets = sets.withColumn("large", F.col("n") > GROUP)
    sets = sets.withColumn("about", F.when(F.col("large"), F.col("root")).otherwise(F.col("cluster")))
    whole = sets.groupBy("large", "about").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    number = F.pmod(F.xxhash64("set"), F.col("parts"))
    return sets.join(whole, ["large", "about"]).select(
        "set", "root", "n", "large", F.xxhash64("large", "about", number).alias("group")
    )


def _links_between(blocks: DataFrame, held: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between sets of different components."""
    groups = stored(_groups(held, first))

    there = blocks.select("key", "set").join(groups, "set")
    several = there.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s")
    there = stored(there.join(several.select("key"), "key"))
    answers = there.select(
        "key", F.col("group").alias("other"), "large", F.when(F.col("large"), F.col("root")).alias("other_root"), F.when(F.col("large"), F.col("n")).alias("other_n")
    ).distinct()
    larger = (F.col("n") < F.col("other_n")) | ((F.col("n") == F.col("other_n")) & (F.col("root") < F.col("other_root")))
    asks = F.when(F.col("a.large"), larger).otherwise((F.col("t.n") <= GROUP) & (F.col("t.group") <= F.col("a.other")))
    t, a = there.alias("t"), answers.alias("a")
    asked = stored(
        t.join(a, (F.col("t.key") == F.col("a.key")) & asks).select("set", "root", F.col("other").alias("group")).distinct()
    )
    # Half of each hash is moved: equal shingles stay equal, so an overlap may only grow.
    codes = held.select("set", F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("shingles"))
    # A group that very many sets ask is opened in several tasks.
    shares = asked.groupBy("group").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("shares"))
    questions = (
        asked.join(shares, "group")
        .withColumn("share", F.pmod(F.hash("set"), F.col("shares")))
        .join(codes, "set")
        .select("group", "share", "set", "root", "shingles")
    )
    inside = (
        groups.join(shares, "group")
        .join(codes, "set")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .select(*[F.col(c).alias(f"member_{c}") for c in ("group", "share", "set", "root", "shingles")])
    )
    one, two = (held.select(F.col("set").alias(n), F.col("shingles").alias(f"of_{n}")) for n in "ab")
    place = ["group", "share"]
    rounds, again = [], None
    while True:
        given, there_now = questions.withColumn("refuted", F.lit(None).cast("array<bigint>")), inside
        if again is not None:
            wrong = reduce(DataFrame.unionByName, rounds).filter(~F.col("linked")).groupBy("a", "group")
            wrong = wrong.agg(F.collect_set("b").alias("refuted")).withColumnRenamed("a", "set")
            given = questions.join(again, place, "left_semi").join(wrong, ["set", "group"], "left")
            there_now = inside.join(
                again, (F.col("member_group") == F.col("group")) & (F.col("member_share") == F.col("share")), "left_semi"
            )
        opened = given.groupBy(*place).cogroup(there_now.groupBy("member_group", "member_share"))
        likely = stored(opened.applyInPandas(_opened(percent), "a bigint, b bigint, group bigint, share int"))
        # What is found is counted again by whole hashes.
        counted = likely.join(one, "a").join(two, "b").select("a", "b", *place, _linked("of_a", "of_b", percent).alias("linked"))
        rounds.append(stored(counted))
        forget(blocks.sparkSession, likely)
        again = rounds[-1].filter(~F.col("linked")).select(*place).distinct()
        if again.isEmpty():
            break
    links = reduce(DataFrame.unionByName, rounds).filter("linked").select("a", "b")
    forget(blocks.sparkSession, groups, there, asked)
    return links


def _opened(percent: int):
    def links(asking: pd.DataFrame, inside: pd.DataFrame) -> pd.DataFrame:
        """Likely links of the asking sets to the members of a group, each between components that
        those before have not joined; pairs that are ``refuted`` are left out."""
        inside = inside.rename(columns=lambda c: c.removeprefix("member_"))
        sizes = inside["shingles"].map(len).to_numpy(np.int64)
        # The group's column of the matrix: its shingles in order, and who has each.
        held = np.concatenate(list(inside["shingles"])) if len(inside) else np.zeros(0, np.int32)
        order = np.argsort(held, kind="stable")
        held, member = held[order], np.repeat(np.arange(len(inside)), sizes)[order]
        names, now = inside["set"].to_numpy(), inside["root"].to_numpy(copy=True)
        # What a component has become; ``now`` holds that of each member.
        became: dict[int, int] = {}
        found = []
        for name, root, shingles, refuted in asking[["set", "root", "shingles", "refuted"]].itertuples(index=False):
            while root in became:
                root = became[root]
            n = len(shingles)
            open_to = (now != root) & (sizes * 100 >= n * percent) & (n * 100 >= sizes * percent)
            if refuted is not None:
                open_to &= ~np.isin(names, refuted)
            if not open_to.any():
                continue
            low, high = np.searchsorted(held, shingles), np.searchsorted(held, shingles, side="right")
            count = high - low
            if np.count_nonzero(count) * (100 + percent) < (n + sizes[open_to].min()) * percent:
                continue
            at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            overlap = np.bincount(member[at], minlength=len(inside))
            for i in np.flatnonzero(open_to & (overlap * (100 + percent) >= (n + sizes) * percent)):
                if now[i] != root:
                    found.append((name, names[i]))
                    became[now[i]] = root
                    now[now == now[i]] = root
        rows = pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        first = asking[["group", "share"]].iloc[0] if found else {"group": 0, "share": 0}
        return rows.assign(group=first["group"], share=first["share"]).astype({"group": "int64", "share": "int32"})

    return links


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one for each component: that of the smallest id. All columns kept.

    Documents without a word stay. Rows go by id and text together, so rows without id lose
    their near copies, and a row stays if one of the same id but another text goes.
    """
    row, lost, nth = (unused(f"jaccard_{n}", docs.columns) for n in ("row", "gone", "nth"))
    known = _rooted(docs, width, percent).filter(F.col("root").isNotNull())
    first = known.groupBy("root").agg(_first_row().alias("first"))
    gone = known.join(first, "root").filter(F.col("row_id") != F.col("first")).select(F.col("row_id").alias(lost)).distinct()
    rows = docs.withColumn(row, _row_id())
    left = rows.join(gone, F.col(row) == F.col(lost), "left_anti")
    # No shuffle of its own: equal rows are together after the join.
    number = F.row_number().over(Window.partitionBy(row).orderBy(F.lit(0)))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return left.withColumn(nth, number).filter((F.col(nth) == 1) | wordless).select(*docs.columns)
