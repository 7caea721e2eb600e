"""Merkle manifest of a table of documents, by nested-interval labels. DataFrame functions only.

Each row is a leaf: the digest of its fields, each ``-`` if null, else its length in UTF-8
bytes, ``:`` and the value. The leaves of a language, in the order of their ids, make
a tree: ``FAN`` neighbours become one node, level by level, until one is left, the subroot.
The subroots, in the order of their languages, null first, make a last tree and its root.

A node is labelled by its tree and the interval ``lo <= rank < hi`` of leaf ranks that it
covers. An ancestor's interval contains that of a node, and a level's intervals start at
multiples of ``FAN ** level``, so containment is joined level by level with that multiple
as bucket. What a parent covers less what a child covers is covered by the child's
siblings: those left of its ``lo`` and those from its ``hi`` on. Paths so go from
the root down, one join a level over rows that grow by ``FAN`` a level; leaves are
met as whole runs of ``FAN``, so a path is moved once for a run and not once for a leaf.

Ranks come from a sort by range: rows within a range are numbered, ranges add the rows
before them. No tree, however large its share, is in one task, and a node has ``FAN`` children
at most. Texts are read once, on the scan, and only digests move on.

Defined results: rows without an id come first in their tree; rows of one id go by
digest, repeated rows are leaves each; null and empty texts differ; an empty table gives an
empty table and no root; other columns are not looked at. Rows are told apart by their
place in ``docs``, so ``docs`` must come in the same order if read again, as files do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.llm.scratch import stored

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex of the parts in a row."""
    return F.sha2(F.concat(F.lit(""), *parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """The digest of a row of documents that has this text."""
    return digest(*[_field(text if name == "text" else F.col(name)) for name in FIELDS])


def _bucket(lo: str | Column, level: int) -> Column:
    return F.floor((F.col(lo) if isinstance(lo, str) else lo) / (FAN**level))


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their rank in their tree, from 0."""
    cut = stored(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("tree", "part").agg(F.count("*").alias("n"))
    starts = sizes.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    return cut.withColumn("nth", nth).join(starts, ["tree", "part"]).select(
        *rows.columns, (F.col("start") + F.col("nth") - 1).alias("rank")
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """The nodes above ``tree, rank, hash``, by level from 1: ``tree, lo, hi, hash, children`` (lo, hi, hash)."""
    sizes = stored(leaves.groupBy("tree").agg(F.count("*").alias("n")))
    most = sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]
    below = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash")
    levels = []
    while FAN ** len(levels) < most:
        level = len(levels) + 1
        going_on = sizes.filter(F.col("n") > FAN ** (level - 1)).select("tree")
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash")))
        levels.append(
            stored(
                below.join(going_on, "tree")
                .groupBy("tree", _bucket("lo", level).alias("bucket"))
                .agg(children.alias("children"))
                .select(
                    "tree",
                    F.col("children")[0]["lo"].alias("lo"),
                    F.element_at("children", -1)["hi"].alias("hi"),
                    digest(F.array_join(F.transform("children", lambda c: c["hash"]), "")).alias("hash"),
                    "children",
                )
            )
        )
        below = levels[-1]
    return levels


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """The digests of a parent's children outside ``lo <= rank < hi``, left and right of it."""

    def joined(kept) -> Column:
        return F.array_join(F.transform(F.filter(children, kept), lambda c: c["hash"]), "")

    return F.named_struct(
        F.lit("left"), joined(lambda c: c["hi"] <= lo), F.lit("right"), joined(lambda c: c["lo"] >= hi)
    )


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of level 1: ``tree, lo, hi, children, above, subroot``; above: siblings from the node itself to the root.

    ``tops`` has ``tree, above, subroot`` for the one node that is left of each tree.
    """
    paths = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1].select("tree", "lo", "hi", "children")
        highest = nodes
        made = None
        if paths is not None:
            c, p = nodes.withColumn("bucket", _bucket("lo", level + 1)).alias("c"), paths.alias("p")
            inside = (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi"))
            same = (F.col("c.tree") == F.col("p.tree")) & (F.col("c.bucket") == _bucket("p.lo", level + 1))
            step = _siblings(F.col("p.children"), F.col("c.lo"), F.col("c.hi"))
            made = c.join(p, same & inside).select(
                "c.tree", "c.lo", "c.hi", "c.children", F.concat(F.array(step), "p.above").alias("above"), "p.subroot"
            )
            highest = nodes.join(paths.select("tree").distinct(), "tree", "left_anti")
        begun = highest.join(tops, "tree").select("tree", "lo", "hi", "children", "above", "subroot")
        paths = stored(begun if made is None else made.unionByName(begun))
    return paths


def _subroots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, hash``: the leaf of a tree of one, else the node that covers all."""
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n"), F.min("hash").alias("hash"))
    found = sizes.filter("n = 1").select("tree", "hash")
    for nodes in levels:
        whole = nodes.join(sizes.select("tree", "n"), "tree").filter((F.col("lo") == 0) & (F.col("hi") == F.col("n")))
        # Only the last node of a tree covers all of it, unless it has one leaf.
        found = found.unionByName(whole.select("tree", "hash"))
    return found


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(steps, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def _marked(docs: DataFrame, claimed: Column | None) -> DataFrame:
    text = F.col("text")
    return stored(
        docs.select(
            F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("tree"),
            "doc_id",
            leaf_digest(text).alias("hash"),
            leaf_digest(text if claimed is None else claimed).alias("claimed"),
            F.monotonically_increasing_id().alias("at"),
        )
    )


def _tree_of_trees(leaves: DataFrame, levels: list[DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    subroots = stored(_subroots(leaves, levels))
    tops = stored(_ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), "name"))
    return tops, _levels(tops)


def nodes(docs: DataFrame) -> DataFrame:
    """The manifest itself: ``tree, level, lo, hi, hash`` of all nodes, leaves included.

    Tree: ``=`` and the language, empty without one, and ``^`` for the tree of the subroots.
    """
    leaves = stored(_ranked(_marked(docs, None), "doc_id", "hash", "at"))
    levels = _levels(leaves)
    tops, high = _tree_of_trees(leaves, levels)

    def rows(found: DataFrame, level: int, tree: Column) -> DataFrame:
        return found.select(tree.alias("tree"), F.lit(level).alias("level"), "lo", "hi", "hash")

    def ranks(found: DataFrame) -> DataFrame:
        return found.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash")

    made = rows(ranks(leaves), 0, F.col("tree")).unionByName(rows(ranks(tops), 0, F.lit("^")))
    for level, found in enumerate(levels, 1):
        made = made.unionByName(rows(found, level, F.col("tree")))
    for level, found in enumerate(high, 1):
        made = made.unionByName(rows(found, level, F.lit("^")))
    return made


def proofs(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    ``claimed`` is the text that is held against the manifest of ``docs``, by default
    the text itself. proof_sha256 is the digest of the siblings from the leaf up to the
    root; folded_root is the root that they make with the claimed leaf.
    """
    leaves = stored(_ranked(_marked(docs, claimed), "doc_id", "hash", "at"))
    levels = _levels(leaves)
    tops, high = _tree_of_trees(leaves, levels)
    if high:
        only = high[-1].select("tree", F.col("hash").alias("subroot"), F.array().cast(STEP).alias("above"))
        root = only.first()["subroot"]
        paths = _paths(high, only)
        child = F.explode("children").alias("c")
        above = paths.select("children", "above", child).select(
            F.col("c.lo").alias("rank"),
            F.concat(F.array(_siblings(F.col("children"), F.col("c.lo"), F.col("c.hi"))), "above").alias("above"),
        )
        tops = tops.join(above, "rank")
    else:
        one = tops.first()
        root = one["hash"] if one else None
        tops = tops.withColumn("above", F.array().cast(STEP))
    tops = stored(tops.select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "above"))
    runs = leaves.groupBy("tree", _bucket("rank", 1).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id", "hash", "claimed"))).alias("run")
    )
    # A tree of one leaf has no level: its path is that of its subroot.
    zero, yes = F.lit(0).cast("long").alias("bucket"), F.lit(True).alias("alone")
    if levels:
        paths = _paths(levels, tops)
        found = tops.join(paths.select("tree").distinct(), "tree", "left_anti").select("tree", zero, "above", "subroot", yes)
        inner = paths.select("tree", _bucket("lo", 1).alias("bucket"), "above", "subroot", F.lit(False).alias("alone"))
        found = found.unionByName(inner)
    else:
        found = tops.select("tree", zero, "above", "subroot", yes)
    leaf = F.col("leaf")
    members = F.transform(
        "run", lambda x: F.named_struct(F.lit("lo"), x["rank"], F.lit("hi"), x["rank"] + 1, F.lit("hash"), x["hash"])
    )
    step = F.array(_siblings(F.col("members"), leaf["rank"], leaf["rank"] + 1))
    steps = F.when(F.col("alone"), F.col("above")).otherwise(F.concat(step, "above"))
    told = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    return (
        runs.join(found, ["tree", "bucket"])
        .select(members.alias("members"), "above", "subroot", "alone", F.explode("run").alias("leaf"))
        .select(leaf["doc_id"].alias("doc_id"), leaf["hash"].alias("hash"), leaf["claimed"].alias("claimed"), "subroot", steps.alias("steps"))
        .select(
            "doc_id",
            F.col("hash").alias("leaf"),
            "subroot",
            F.lit(root).cast("string").alias("root"),
            digest(told).alias("proof_sha256"),
            folded(F.col("claimed"), F.col("steps")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
