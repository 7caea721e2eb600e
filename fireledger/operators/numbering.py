"""Dense numbers by content: the same for the same rows, however these are split over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of contents, as Catalyst estimates them or as their files hold, that one bucket may hold.
BUCKET = 1 << 20
#: Bytes of contents that one task may sort; beyond it there are more tasks than the session asks for.
TASK = 16 << 20
#: Catalyst's size of a table that it knows nothing of, as a partitioned one is, is above this.
UNKNOWN = 1 << 62
#: Copies that one row is opened to.
SLICE = 64
#: Bits of a number below those of its scope.
BITS = 40


def content_digest(*parts: Column) -> Column:
    """Digest of the parts as text, NULL as a dash."""
    return F.md5(F.concat_ws("|", *[F.coalesce(part.cast("string"), F.lit("-")) for part in parts]))


def _bytes(contents: DataFrame) -> int:
    """The size as Catalyst estimates it, or where it cannot that of the files read; no file is opened."""
    size = int(str(contents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < UNKNOWN:
        return size
    spark, size = contents.sparkSession, 0
    for folder in {file.rsplit("/", 1)[0] for file in contents.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return size


def _digits(size: int) -> int:
    """Hex digits of a digest that name its bucket, for contents of so many bytes."""
    digits = 1
    while size > BUCKET * 16**digits and digits < 5:
        digits += 1
    return digits


def place_by_content(contents: DataFrame, scope: str, content: Sequence[Column], copies: str) -> DataFrame:
    """``contents`` with ``first_number``, one less than the number of the first copy of each row.

    ``scope`` is a whole number from 0 on, NULL counts as 0; it stands above the lowest
    ``BITS`` bits. Rows of a scope are in the order of the digests of their ``content``,
    which must tell all rows of ``contents`` apart, and take as many numbers as ``copies`` says.

    Digests fall into buckets by their first digits, as many as the size of ``contents`` asks
    for; the order and so the numbers are the same with any number of them. A bucket is ranked by itself, after
    the copies in the buckets before it, so no scope is sorted in one task, and a content
    with most of the rows is one row. Only the number of its bucket moves with a row; the
    digest is made again where the row has come to.
    """
    digest, size = content_digest(*content), _bytes(contents)
    tasks = -(-size // TASK)
    enough = tasks <= int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = contents.withColumns(
        {
            "_scope": F.coalesce(F.col(scope), F.lit(0)).cast("long"),
            "_bucket": F.conv(F.substring(digest, 1, _digits(size)), 16, 10).cast("int"),
        }
    )
    earlier = (
        Window.partitionBy("_scope").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    buckets = (
        rows.groupBy("_scope", "_bucket")
        .agg(F.sum(copies).alias("_size"))
        .select("_scope", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_scope", "_bucket").orderBy("_digest").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.shiftleft(F.col("_scope"), BITS) + F.col("_before") + F.col("_within")
    return (
        rows.repartition(*([] if enough else [tasks]), "_scope", "_bucket")
        .withColumn("_digest", F.unhex(digest))
        .withColumn("_within", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
        .join(buckets, ["_scope", "_bucket"])
        .select(*contents.columns, first.alias("first_number"))
    )


def open_copies(placed: DataFrame, copies: str, out: str, dealt_by: str | None = None) -> DataFrame:
    """Each row of `place_by_content` as often as ``copies`` says, with its number in ``out``.

    Rows are opened in slices. With ``dealt_by`` the slices are rebalanced by a column
    before they are opened, so a row with most of the copies is many tasks'.
    """
    kept = [name for name in placed.columns if name not in (copies, "first_number")]
    slices = F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / SLICE))
    sliced = placed.select(*kept, "first_number", F.col(copies).alias("_copies"), F.explode(slices).alias("_slice"))
    if dealt_by:
        sliced = sliced.hint("rebalance", dealt_by)
    last = F.least(F.lit(SLICE).cast("long"), F.col("_copies") - F.col("_slice") * SLICE)
    opened = sliced.select(
        *kept,
        (F.col("first_number") + F.col("_slice") * SLICE).alias("_base"),
        F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("_nth"),
    )
    return opened.select((F.col("_base") + F.col("_nth")).alias(out), *kept)


def number_by_content(
    contents: DataFrame, scope: str, content: Sequence[Column], copies: str, out: str, dealt_by: str | None = None
) -> DataFrame:
    """Each row of ``contents`` as often as ``copies`` says, numbered from 1 on in its scope."""
    return open_copies(place_by_content(contents, scope, content, copies), copies, out, dealt_by)
