"""What all operators and stages must leave as it is: ids, other columns, rows alike."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fireledger.llm import decontaminate, grades, jaccard, langid, lmscore, mixing, recompress, repeats, toxicity

#: Ids that a double cannot hold, beside null.
IDS = [2**53 + 1, 2**60 + 1, None, 2**53, -(2**53) - 1]
INNER = [
    *repeats.MADE, repeats.NUMBER, "pfp_chunk", "test_first", "test_second", "jaccard_row", "jaccard_gone", "jaccard_nth",
    "mix_words", "mix_copies", "mix_copy", "mix_doc_id", "mix_source", "mix_size", "size", "copies", "lang_found", "grade_found",
    "row_id", "set", "root", "first", "lm_row", "lm_label", "lm_chunk", "bucket", "key",
]


def prose(rng, n):
    return " ".join(rng.choice(["ten", "green", "bottles", "hang", "on", "a", "wall", "and", "fall", "down"]) + str(rng.randrange(90)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Every inner name is a column of its own, of whole numbers and nulls."""
    rng = random.Random(3)
    rows = []
    for i, doc_id in enumerate(IDS * 3):
        extra = [None if (i + k) % 3 == 0 else 2**60 + 1 + 100 * i + k for k in range(len(INNER))]
        rows.append((doc_id, prose(rng, 60), "en" if i % 2 else None, "web", 7, *extra))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in INNER)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(2**60 + 3, "an item of the benchmark that no document holds"), (None, "another one of them that is nowhere")], "item_id long, text string")


def values(df, columns):
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def kept_of(df, before, changed=()):
    """The rows of ``df`` in the columns that it must not change."""
    columns = [c for c in before.columns if c not in changed]
    return values(df, columns), values(before, columns)


def test_inner_names_are_free_for_other_columns(docs, items):
    made = [
        (repeats.without_repeats(docs), ()),
        (repeats.text_without_repeats(docs), ()),
        (decontaminate.clean_documents(docs, items), ()),
        (jaccard.one_of_each(docs), ()),
        (langid.known_language(docs, min_score=0.0), ()),
        (toxicity.score(docs, toxicity.learn(docs, docs.select("doc_id", F.lit(1).alias("label")).limit(0))), ()),
        (grades.grade(docs, None, 3), ()),
    ]
    for df, changed in made:
        got, given = kept_of(df, docs, changed)
        assert got == given
    mixed = mixing.mixed_documents(docs)
    number = mixed.columns[-1]
    assert number == "mix_copy_" and mixed.columns[:-1] == docs.columns
    rows = set(values(docs, docs.columns))
    assert {r for r in values(mixed, docs.columns)} <= rows


def test_stages_keep_ids_and_columns(spark, docs, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    given = set(values(docs, docs.columns))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        assert made.columns[: len(docs.columns)] == docs.columns, name
        assert set(values(made, docs.columns)) <= given, name


def test_ids_beside_null_are_exact(spark, docs, items):
    expected = sorted(IDS * 3, key=repr)
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert ids(repeats.without_repeats(plain)) == expected
    assert ids(recompress.without_repeats(plain)) == expected
    assert ids(jaccard.similar_components(plain)) == expected
    chosen = spark.createDataFrame([(2**53 + 1,), (None,)], "doc_id long")
    scored = lmscore.loss_difference(plain, chosen)
    assert ids(scored) == expected
    assert {r.doc_id for r in scored.collect() if r.in_target} == {2**53 + 1}
    held = plain.select("doc_id", F.lit("so: an item of the benchmark that no document holds, and another one of them that is nowhere").alias("text"))
    hits = {(r.doc_id, r.item_id) for r in decontaminate.test_hits(held, items).collect()}
    assert hits == {(i, k) for i in IDS for k in (2**60 + 3, None)}


def test_close_ids_remove_from_each_other(spark):
    text = "a passage that is longer than fifty bytes and stands in several documents"
    rows = [(2**53 + 1, text), (2**53, text), (None, text), (2**60 + 1, text)]
    got = {r.doc_id: r.pfp_removed for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2**53: 0, 2**53 + 1: len(text), None: len(text), 2**60 + 1: len(text)}


def test_rows_alike_are_dealt_over_chunks(spark):
    """A row that is repeated, and rows without id, are not one chunk's."""
    text = prose(random.Random(1), 40)
    rows = spark.range(3000, numPartitions=6).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows.write.parquet(folder := f"{spark.conf.get('spark.checkpoint.dir')}/alike")
    alike = spark.read.parquet(folder)
    size = 3000 * len(text)
    scored = lmscore.loss_difference(alike, alike.limit(0), chunk_bytes=size // 20)
    left = repeats.without_repeats(alike, chunk_bytes=size // 20)
    removed = recompress.without_repeats(alike, chunk_bytes=size // 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for df in (scored, left, removed):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 3000 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.pfp_sha256 for r in left.select("pfp_sha256").distinct().collect()} == {sha256(text.encode()).hexdigest()}


def thue_morse(n, a="a", b="b"):
    word, other = a, b
    while len(word) < n:
        word, other = word + other, other + word
    return word, other


def test_words_with_one_polynomial_stay_apart(spark):
    rows = []
    for n in (1024, 2048, 4096):
        for word in thue_morse(n):
            rows.append((len(rows), word))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard.similar_components(docs).collect()} == set(range(6))
    assert jaccard.one_of_each(docs).count() == 6
    first, second = thue_morse(2048)
    pairs = spark.createDataFrame([(1, f"{first} {first}"), (2, f"{second} {second}"), (3, f"{first} {second}")], "doc_id long, text string")
    losses = {r.doc_id: r.background_loss for r in lmscore.loss_difference(pairs, pairs.limit(0)).collect()}
    assert losses[1] == pytest.approx(losses[2]) and abs(losses[3] - losses[1]) > 0.01
    long = [(i, " ".join([w] * 20)) for i, w in enumerate((first, second))]
    assert {r.n_removed for r in recompress.without_repeats(spark.createDataFrame(long, "doc_id long, text string")).collect()} == {0}
