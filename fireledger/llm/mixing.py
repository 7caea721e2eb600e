"""Mix sources to target weights by systematic sampling. DataFrame functions only.

Targets: sources in code point order (null last) take the weights in turn and share
``share`` times all sizes. No target exceeds ``most`` times its source's size; what is
above is shared again by weight. That is a water level: a source takes
``min(most * size, weight * level)``, and with sources sorted by ``size / weight`` the
level is the largest of ``(budget - caps before) / (weights from here on)``.

Copies: within a source, documents are ordered by size, each expects
``target / source size`` copies, the expected copies are summed up from one random
offset, and a document is emitted once for each whole number its sum crosses. As
neighbours in the order are alike in size, the words taken differ from the target by
at most the words of the source's largest document.

The place of a document in its source is found without a task per source: documents
of one source and size form a group, a group of more than ``PIECE`` documents is split
by a digest of the id, and only the counts of these pieces are summed up per source.

Defined results: null text has size 0; documents of a source without any word are
taken once each (0 words); an empty table gives an empty table; repeated rows are
separate documents; ids may repeat. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.llm.scratch import stored, unused

WORD = r"[^\x20\x09-\x0D]+"
PIECE = 4096
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _digest(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``; one row per source."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    before = F.sum(F.col("source_size") * most).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(in_order))
        .withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") * F.lit(share) - F.coalesce(before, F.lit(0))) / left)
        .withColumn("level", F.max("level").over(whole))
        .select(
            "source",
            "source_size",
            F.least((F.col("source_size") * most).cast("double"), F.col("weight") * F.col("level")).alias("target"),
        )
    )


def mix(
    sized: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` from rows of ``doc_id, source, size``.

    ``sized`` is read several times: hand in a stored table.
    """
    keys = ["source", "size", "piece"]
    groups = sized.groupBy("source", "size").agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    targets = source_targets(sized, weights, share, most)
    piece = F.when(F.col("pieces") > 1, _digest(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8) % F.col("pieces"))
    a, g = sized.alias("a"), groups.alias("g")
    pieced = (
        a.join(g, F.col("a.source").eqNullSafe(F.col("g.source")) & (F.col("a.size") == F.col("g.size")))
        .select("a.*", "pieces")
        .withColumn("piece", F.coalesce(piece, F.lit(0)))
        .drop("pieces")
    )
    offsets = pieced.groupBy(*keys).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source").orderBy("size", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    o, t = offsets.alias("o"), targets.alias("t")
    offsets = o.join(t, F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.*", "source_size", "target")
    ranked = pieced.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id")))
    r, o = ranked.alias("r"), offsets.alias("o")
    same = (
        F.col("r.source").eqNullSafe(F.col("o.source"))
        & (F.col("r.size") == F.col("o.size"))
        & (F.col("r.piece") == F.col("o.piece"))
    )
    rate = F.when(F.col("source_size") == 0, F.lit(UNIT)).otherwise(
        F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1)) * UNIT), F.lit(most * UNIT))
    )
    end = F.col("place") * F.col("rate") + F.col("offset")
    crossed = F.floor(end / UNIT) - F.floor((end - F.col("rate")) / UNIT)
    return (
        r.join(o, same)
        .select("r.doc_id", "r.source", "r.size", "source_size", "target", (F.col("k") + F.col("ahead")).alias("place"))
        .withColumn("rate", rate.cast("long"))
        .withColumn("offset", _digest(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit(""))), 6))
        .withColumn("copies", crossed.cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def sized_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, source, size``, stored, so that the texts are counted once."""
    return stored(docs.select("doc_id", "source", word_count(F.col(text)).alias("size")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, numbered in ``mix_copy`` from 1.

    Where ``docs`` has a column of that name, the number has underscores behind its own.
    """
    keys = ["doc_id", "source", "size"]
    words, copies, number = (unused(n, docs.columns) for n in ("mix_words", "mix_copies", "mix_copy"))
    told = {k: unused(f"mix_{k}", docs.columns) for k in keys}
    plan = mix(sized_documents(docs), **options).groupBy(*keys).agg(F.sort_array(F.collect_list("copies")).alias("copies"))
    d = docs.withColumn(words, word_count(F.col("text"))).alias("d")
    p = plan.select(*[F.col(k).alias(told[k]) for k in keys], F.col("copies").alias(copies)).alias("p")
    same = [F.col(f"d.{words if k == 'size' else k}").eqNullSafe(F.col(f"p.{told[k]}")) for k in keys]
    # Rows that agree in id, source and size share the copies of all of them in turn.
    nth = F.row_number().over(Window.partitionBy(*told.values()).orderBy(told["size"]))
    return (
        d.join(p, same)
        .withColumn(copies, F.element_at(copies, nth))
        .filter(F.col(copies) > 0)
        .withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*docs.columns, number)
    )
