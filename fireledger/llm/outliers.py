"""Quality rules: robust multivariate outliers by language and source. DataFrame functions only.

Base statistics of a text decide first: too few words, or too many words in repeated
five-word windows. The others are judged by five transformed statistics, in thousandths:
log words, log mean word length, and the logs of symbols, repeated lines and
repeated words by hundred words (of 50 words more, so that one mark in a short text is
no outlier).

For each language and source the minimum covariance determinant estimates centre and
covariance from the half (``PART``) of its documents that lie closest, so up to nearly a
half of junk does not move them. There are six starts from medians and median deviations:
by all statistics together, and by each alone. From each, the closest documents by
Mahalanobis distance are chosen and centre and covariance made anew from them until
nothing changes (``STEPS`` times at most), and the start of least determinant is kept for
the group; documents within the usual distance then make the final estimate. As most texts have no symbols or repeats at
all, a variance floor is added, as the regularised form of the method does. A document is
rejected if its squared distance exceeds ``limit``: 150, far beyond normal tails, as a line
quoted twice puts a sound short text up to 100 away, and junk lies at 200 and more.

A source with fewer than ``least_rows`` judged documents in a language is estimated
together with the other such sources of that language, and if these are too few, together
with all such documents of all languages. If these are too few as well, they are judged by
the estimate of the whole corpus, however small it is. So every document that the base rules
leave has a distance.

All statistics are whole numbers, sums and quantiles are exact, so reruns agree. Sums and
quantiles are made before the shuffle: no group is gathered.

Defined results: null text has no words and fails the base rules; null language or source
form groups of their own; repeated rows are judged one by one; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fireledger.llm.scratch import stored

SPACE = r"\x20\x09-\x0D"
NAMES = ("x1", "x2", "x3", "x4", "x5")
UNIT = 1000
PART = 0.5
STEPS = 12
FLOOR = 250.0
LIMIT = 150.0


def _gamma_share(shape: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1 / shape
    n = 1
    while term > total * 1e-15:
        term *= x / (shape + n)
        total += term
        n += 1
    return total * exp(shape * log(x) - x - lgamma(shape))


def chi_square_share(df: int, x: float) -> float:
    return _gamma_share(df / 2, x / 2)


def chi_square_quantile(df: int, share: float) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_share(df, mid) < share else (low, mid)
    return low


def _inflation(share: float) -> float:
    """By how much the covariance of the closest ``share`` of normal rows is too small."""
    return share / chi_square_share(len(NAMES) + 2, chi_square_quantile(len(NAMES), share))


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    empty = F.array().cast("array<bigint>")

    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def part(name: str, start: int, less: int) -> Column:
        return F.slice(name, start, F.size(name) - less)

    rows = docs.withColumn("q_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("q_words", F.array_remove(F.split("q_text", f"[{SPACE}]+"), ""))
    rows = rows.withColumn(
        "q_lines", F.filter(F.split("q_text", "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    )
    rows = (
        rows.withColumn("n_words", F.size("q_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace("q_text", f"[{SPACE}]+", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("q_text", "[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"))
    )
    # Hashes of one, two, four and five words in a row.
    enough = F.col("n_words") >= 5
    rows = rows.withColumn("q_1", F.when(enough, F.transform("q_words", lambda w: F.xxhash64(w))))
    rows = rows.withColumn("q_2", F.when(enough, joined(part("q_1", 1, 1), part("q_1", 2, 1))))
    rows = rows.withColumn("q_4", F.when(enough, joined(part("q_2", 1, 2), part("q_2", 3, 2))))
    rows = rows.withColumn("q_5", F.when(enough, joined(part("q_4", 1, 1), part("q_1", 5, 4))))
    again = F.size("q_5") > F.size(F.array_distinct("q_5"))
    # Windows in the order of their hashes: equal ones are neighbours.
    placed = F.transform("q_5", lambda x, i: F.struct(x.alias("hash"), i.cast("long").alias("at")))
    rows = rows.withColumn("q_sorted", F.when(again, F.sort_array(placed)))
    twice = F.zip_with(
        part("q_sorted", 1, 1),
        part("q_sorted", 2, 1),
        lambda a, b: F.when(a["hash"] == b["hash"], F.array(a["at"], b["at"])).otherwise(empty),
    )
    rows = rows.withColumn("q_at", F.when(F.col("q_sorted").isNotNull(), F.sort_array(F.array_distinct(F.flatten(twice)))))
    steps = F.zip_with(part("q_at", 1, 1), part("q_at", 2, 1), lambda a, b: F.least(b - a, F.lit(5).cast("long")))
    covered = F.aggregate(steps, F.lit(5).cast("long"), lambda total, x: total + x)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return (
        rows.withColumn("n_repeat_words", F.when(F.col("q_at").isNotNull(), covered).otherwise(F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .drop("q_text", "q_words", "q_lines", "q_1", "q_2", "q_4", "q_5", "q_sorted", "q_at")
    )


def _transformed(rows: DataFrame) -> DataFrame:
    words = F.greatest("n_words", F.lit(1))

    def rate(name: str) -> Column:
        return F.log1p(F.col(name) * 100 / (words + 50))

    values = (F.log(words), F.log(F.greatest("word_chars", F.lit(1)) / words), rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words"))
    return rows.select("*", *[F.round(v * UNIT).cast("long").alias(n) for n, v in zip(NAMES, values)])


def _groups(rows: DataFrame, least_rows: int) -> DataFrame:
    """The group of each language and source: its own, that of the rare sources, or of the rare ones of all languages."""
    sizes = rows.filter("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    rare = F.col("n") < least_rows
    by_lang = sizes.filter(rare).groupBy("lang").agg(F.sum("n").alias("rare_n"))
    s, r = sizes.alias("s"), by_lang.alias("r")
    whole = s.join(r, F.col("s.lang").eqNullSafe(F.col("r.lang")), "left")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    group = (
        F.when(~rare, F.concat(name("s.lang"), F.lit("\t"), name("s.source")))
        .when(F.col("rare_n") >= least_rows, name("s.lang"))
        .otherwise("")
    )
    return whole.select("s.lang", "s.source", group.alias("group"))


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("group", "start") if c in df.columns]


def _estimate(chosen: DataFrame, inflation: float) -> DataFrame:
    """By group and start: the centre, the lower triangle whose square is the covariance, and its log determinant."""
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)]
    products = [
        F.sum(F.col(a) * F.col(b)).alias(f"p{i}{j}") for i, a in enumerate(NAMES) for j, b in enumerate(NAMES) if j <= i
    ]
    found = chosen.groupBy(*_keys(chosen)).agg(F.count("*").cast("double").alias("n"), *sums, *products)
    for i in range(len(NAMES)):
        found = found.withColumn(f"m{i}", F.col(f"s{i}") / F.col("n"))
    for i in range(len(NAMES)):
        for j in range(i + 1):
            value = (F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * inflation
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOOR * FLOOR
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            found = found.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1.0))) if i == j else value / F.col(f"l{j}{j}"))
    lower = [f"l{i}{j}" for i in range(len(NAMES)) for j in range(i + 1)]
    spread = sum((F.log(f"l{i}{i}") for i in range(1, len(NAMES))), F.log("l00"))
    return stored(found.select(*_keys(found), *[f"m{i}" for i in range(len(NAMES))], *lower, spread.alias("spread")))


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared distance ``d`` from their group's centre, null without an estimate."""
    near = rows.join(estimate, _keys(estimate), "left")
    for i, name in enumerate(NAMES):
        value = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        near = near.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(NAMES))), F.col("z0") * F.col("z0"))
    return near.withColumn("d", total).select(*rows.columns, "d")


def _closest(rows: DataFrame) -> DataFrame:
    """The closest part of each group and start, by distance on a fine grid, ties all in."""
    graded = rows.withColumn("grade", F.floor(F.log1p("d") * UNIT))
    limits = stored(graded.groupBy(*_keys(graded)).agg(F.percentile("grade", PART).alias("limit")))
    return graded.join(limits, _keys(limits)).filter(F.col("grade") <= F.col("limit"))


def _least_spread(begun: DataFrame) -> DataFrame:
    """By group: of the estimates that the starts in ``begun`` (rows by start, with ``d``) lead to, that of least determinant."""
    begun = stored(begun)
    tried = begun.drop("d")
    found = _estimate(_closest(begun), _inflation(PART))
    for _ in range(STEPS):
        before = found.select(*_keys(found), F.col("spread").alias("before"))
        found = _estimate(_closest(_distances(tried, found)), _inflation(PART))
        if found.join(before, _keys(before)).filter(F.abs(F.col("spread") - F.col("before")) > 1e-9).isEmpty():
            break
    least = found.groupBy("group").agg(F.min(F.struct("spread", "start"))["start"].alias("start"))
    return stored(found.join(least, ["group", "start"]).drop("start"))


def judged(docs: DataFrame, limit: float = LIMIT, least_rows: int = 200) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance`` (squared) and ``kept``."""
    rows = stored(
        _transformed(
            base_statistics(docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")).drop("text")
        )
    )
    groups = stored(_groups(rows, least_rows))
    a, g = rows.alias("a"), groups.alias("g")
    same = F.col("a.lang").eqNullSafe(F.col("g.lang")) & F.col("a.source").eqNullSafe(F.col("g.source"))
    rows = stored(a.join(g, same, "left").select("a.*", F.coalesce("g.group", F.lit("")).alias("group")))
    fit = rows.filter("not base_failed").select("group", *NAMES)
    pooled = fit.filter("group = ''").count()
    if 0 < pooled < least_rows:
        whole = fit.withColumn("group", F.lit(""))
        fit = fit.filter("group <> ''").unionByName(whole)
    # Starts: every statistic by itself, from medians, and all of them.
    middle = stored(fit.groupBy("group").agg(*[F.median(n).alias(f"c{i}") for i, n in enumerate(NAMES)]))
    aside = fit.join(middle, "group")
    spread = aside.groupBy("group").agg(
        *[F.median(F.floor(F.abs(F.col(n) - F.col(f"c{i}")))).alias(f"s{i}") for i, n in enumerate(NAMES)]
    )
    start = stored(middle.join(spread, "group"))
    apart = [
        F.pow((F.col(n) - F.col(f"c{i}")) / F.greatest(F.col(f"s{i}") * 1.4826, F.lit(FLOOR)), 2)
        for i, n in enumerate(NAMES)
    ]
    starts = F.posexplode(F.array(sum(apart[1:], apart[0]), *apart)).alias("start", "d")
    estimate = _least_spread(fit.join(start, "group").select("group", *NAMES, starts))
    usual = 0.975
    within = _distances(fit, estimate).filter(F.col("d") <= chi_square_quantile(len(NAMES), usual))
    estimate = _estimate(within, _inflation(usual))
    final = _distances(rows, estimate)
    kept = ~F.col("base_failed") & ~(F.coalesce(F.col("d"), F.lit(0.0)) > limit)
    return final.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.col("d").alias("distance")
    )
