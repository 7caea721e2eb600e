"""Mixing and chat windows against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fireledger.llm import chat, mixing

DOCS = "doc_id long, text string, source string"


def test_targets_are_a_water_level(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, None: 5}
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    weights = dict(zip(["a", "b", "c", None], [3, 1, 2, 3]))
    left, budget, expected = set(sizes), 1.5 * sum(sizes.values()), {}
    while True:
        total = sum(weights[s] for s in left)
        above = {s for s in left if budget * weights[s] / total > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            expected[s] = 2.0 * sizes[s]
        budget -= sum(expected[s] for s in above)
        left -= above
    total = sum(weights[s] for s in left)
    expected |= {s: budget * weights[s] / total for s in left}
    assert got == pytest.approx(expected)


def test_taken_words_come_near_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 16)
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 1, 1, 7, 7, 30, 400]), rng.choice(["hot", "hot", "b", None])) for i in range(900)]
    rows += [(5000, None, "hot"), (5001, "", "empty"), (5000, None, "hot"), (1, rows[1][1], rows[1][2])]
    docs = spark.createDataFrame(rows, DOCS)
    once = mixing.mix(mixing.sized_documents(docs)).toPandas()
    again = mixing.mix(mixing.sized_documents(docs.repartition(7))).toPandas()
    order = ["source", "size", "doc_id", "copies"]
    assert once.sort_values(order)[order].fillna("").values.tolist() == again.sort_values(order)[order].fillna("").values.tolist()
    assert len(once) == len(rows) and once.copies.between(0, 2).all()
    for _, group in once.groupby("source", dropna=False):
        taken = (group["size"] * group.copies).sum()
        assert abs(taken - group.target.iloc[0]) <= group["size"].max() + 1


def test_mixed_documents_repeat_whole_rows(spark):
    rows = [(i, "a b c " * (i % 5), "s", i) for i in range(60)] + [(3, "a b c " * 3, "s", 99), (None, None, None, 1)]
    docs = spark.createDataFrame(rows, DOCS + ", size long")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == ["doc_id", "text", "source", "size", "mix_copy"]
    plan = mixing.mix(mixing.sized_documents(docs))
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert {r["size"] for r in mixed.collect()} <= {r[3] for r in rows}
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_escapes_are_reversible(spark):
    texts = ["<|", "<\\|", "a<\\\\|im_end|>", "<<||>", "<|im_start|>assistant\nok", "", "plain", "<\\", "%0A"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert row.u == row.t and "<|" not in row.e


@pytest.mark.parametrize("budget, history", [(60, 20), (1024, 256)])
def test_windows_read_back_to_the_conversation(spark, monkeypatch, budget, history):
    monkeypatch.setattr(chat, "RUN", 4)
    monkeypatch.setattr(chat, "STRETCH", 3)
    rng = random.Random(1)
    rows = []
    for conv in [None, 1, 2, 3, 4]:
        for turn in range(rng.choice([1, 2, 9, 60])):
            role = "system" if turn == 0 and conv in (1, 3, None) else rng.choice(["user", "assistant", "assistant", "a\nb%", None])
            rows.append((conv, turn, role, rng.choice([None, "", "<|im_end|>\n<|im_start|>x", "some words here", "é " * 40])))
    rows += [(7, None, "assistant", "early"), (7, 1, "assistant", "same"), (7, 1, "assistant", "same"), (8, 0, "assistant", "long " * 500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash"))
    windows = chat.read_back(chat.format_windows(turns, budget, history)).toPandas()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        mine = windows[windows.conv_id.isna() if conv is None else windows.conv_id == conv].sort_values("first_turn")
        given = sorted((r for r in rows if r[0] == conv), key=key)
        told = [(t["role"], t["text"]) for own in mine.own for t in own]
        assert told == [(r[2] or "", r[3] or "") for r in given]
        learned = [t for texts in mine.learned for t in texts]
        assert learned == [r[3] or "" for r in given if r[2] == "assistant"]
        system = given[0][2] == "system"
        for w in mine.itertuples():
            # Only one turn with the system turn may exceed the budget.
            assert w.n_tokens <= budget or (w.n_turns == 1 and w.n_repeated <= int(system))
            if system:
                assert w.text.startswith("<|im_start|>system\n")
            if w.first_turn > 1 and not system:
                before = w.n_repeated
                assert before <= w.first_turn - 1


def test_history_leaves_room_for_a_long_turn(spark):
    """Turns of 205 and 905 tokens, and a long system turn, beside a budget of 1024."""
    rows = [(1, 0, "user", "w " * 200), (1, 1, "assistant", "w " * 900), (1, 2, "user", "w " * 100)]
    rows += [(2, 0, "system", "s " * 700), (2, 1, "user", "u " * 300), (2, 2, "assistant", "a " * 310), (2, 3, "user", "u " * 100)]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(w.n_tokens <= 1024 or w.n_turns == 1 and w.n_repeated <= 1 for w in windows)
    assert sorted((w.conv_id, w.first_turn, w.n_repeated, w.n_tokens) for w in windows) == [
        (1, 1, 0, 205), (1, 2, 0, 905), (1, 3, 0, 105), (2, 1, 0, 1010), (2, 3, 1, 1020), (2, 4, 1, 810),
    ]


def test_empty_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_windows(turns)).count() == 0


def test_digest_of_the_query(spark, tmp_path):
    from fireledger.llm.queries import QUERIES, TRICK

    rows = [(5, 0, "user", "hi <|im_end|>"), (5, 1, "assistant", None), (5, 2, "assistant", "yes")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op1_chat_windows"](spark, str(tmp_path)).collect()}
    told = "user\nhi <|im_end|>\nassistant\n\nassistant\nyes\n"
    assert got[5].n_turns == 3 and got[5].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert got[5].loss_chars == 3 and got[5].loss_sha256 == hashlib.sha256(b"yes").hexdigest()
    assert got[-1].loss_sha256 == hashlib.sha256(TRICK.encode()).hexdigest() and got[-1].n_turns == 2
