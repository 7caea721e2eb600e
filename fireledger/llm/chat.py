"""Format conversations as training windows within a token budget. DataFrame functions only.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles each
``<|`` gets a backslash more behind its ``<`` (``unescaped`` takes it away again), so
that no text can form a control string. Line ends in roles are written as ``%0A``.

Prefix sums of the turns' tokens choose the windows. A window holds, in this order, the
system turn (the first turn, if its role is ``system``), as many whole turns before the
window as fit in ``history`` tokens, and its own turns, taken while the budget lasts.
The space of the history is kept free, unless one turn alone needs it: then the history is
shorter, or nothing. So a window exceeds the budget only if one turn and the system turn do. What is repeated is not in the loss mask: of the window's own
turns, the texts of assistant turns are.

A long conversation is not held in one task: its prefix sums are made in runs of ``RUN``
turn numbers, and windows are chosen within stretches of ``STRETCH`` budgets, whose ends
also end a window.

Defined results: turns are ordered by turn (null first), then role, then text; repeated
rows are separate turns; null roles and texts are empty; turns without a conversation
form one conversation of a null id; an empty table gives an empty table; other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]"
OVERHEAD = 5
RUN = 256
STRETCH = 64


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_tokens(text: Column) -> Column:
    """Words, digits and signs of a text, and the marks around it."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + OVERHEAD


def _numbered(turns: DataFrame) -> DataFrame:
    """Each turn with its place in the conversation and the tokens before it."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    run = Window.partitionBy("conv_id", "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs_before = Window.partitionBy("conv_id").orderBy(F.col("run").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = (
        turns.withColumn("run", F.floor(F.col("turn") / RUN))
        .withColumn("tokens", turn_tokens(F.col("text")))
        .withColumn("place", F.count("*").over(run))
        .withColumn("sum", F.sum("tokens").over(run))
    )
    runs = (
        within.groupBy("conv_id", "run")
        .agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
        .withColumn("n", F.coalesce(F.sum("n").over(runs_before), F.lit(0)))
        .withColumn("t", F.coalesce(F.sum("t").over(runs_before), F.lit(0)))
    )
    w, r = within.alias("w"), runs.alias("r")
    same = F.col("w.conv_id").eqNullSafe(F.col("r.conv_id")) & F.col("w.run").eqNullSafe(F.col("r.run"))
    return w.join(r, same).select(
        "w.conv_id",
        "w.role",
        "w.text",
        "w.tokens",
        (F.col("w.place") + F.col("n")).alias("place"),
        (F.col("w.sum") - F.col("w.tokens") + F.col("t")).alias("before"),
    )


def _greedy(turns: Column, first: Column, later: Column) -> Column:
    """First places of the windows of a stretch of ``(place, before, tokens)`` turns."""
    empty = F.struct(F.array().cast("array<struct<place:bigint,before:bigint>>").alias("windows"), F.lit(0).cast("long").alias("used"))

    def add(state: Column, turn: Column) -> Column:
        limit = F.when(F.try_element_at(state["windows"], F.lit(-1))["place"] == 1, first).otherwise(later)
        full = (F.size(state["windows"]) == 0) | (state["used"] + turn["tokens"] > limit)
        return F.when(
            full,
            F.struct(
                F.array_append(state["windows"], F.struct(turn["place"].alias("place"), turn["before"].alias("before"))).alias("windows"),
                turn["tokens"].alias("used"),
            ),
        ).otherwise(F.struct(state["windows"].alias("windows"), (state["used"] + turn["tokens"]).alias("used")))

    return F.aggregate(turns, empty, add)["windows"]


def format_windows(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """One row per window of ``conv_id, turn, role, text`` rows.

    Columns: conv_id, first_turn (place of its first own turn, from 1), n_repeated (leading
    turns that an earlier window holds too), n_turns (own turns), n_tokens, text, loss
    (array of ``start, end`` in code points of text, from 0).
    """
    empty = F.lit("")
    turns = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    numbered = _numbered(turns)
    system = numbered.filter((F.col("place") == 1) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("system_id"), F.col("tokens").alias("system_tokens"), F.col("text").alias("system_text")
    )
    n = numbered.alias("n")
    stretches = (
        n.join(system.select("system_id", "system_tokens"), F.col("conv_id").eqNullSafe(F.col("system_id")), "left")
        .withColumn("stretch", F.floor(F.col("before") / (STRETCH * budget)))
        .groupBy("conv_id", "stretch")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "before", "tokens"))).alias("turns"),
            F.max("place").alias("last"),
            F.max(F.col("before") + F.col("tokens")).alias("end"),
            F.coalesce(F.max("system_tokens"), F.lit(0)).alias("system_tokens"),
        )
    )
    later = F.lit(budget - history) - F.col("system_tokens")
    windows = (
        stretches.withColumn("windows", _greedy(F.col("turns"), F.lit(budget).cast("long"), later))
        .select(
            "conv_id",
            F.posexplode("windows"),
            "windows",
            "last",
            "end",
            "system_tokens",
        )
        .select(
            "conv_id",
            F.col("col.place").alias("from"),
            F.col("col.before").alias("base"),
            F.coalesce(F.get("windows", F.col("pos") + 1)["place"] - 1, F.col("last")).alias("to"),
            (F.coalesce(F.get("windows", F.col("pos") + 1)["before"], F.col("end")) - F.col("col.before")).alias("used"),
            "system_tokens",
        )
        # The tokens of earlier turns that still fit.
        .withColumn("reach", F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - F.col("system_tokens") - F.col("used"))))
        .drop("used", "system_tokens")
    )
    # A turn has OVERHEAD tokens at least, so no more turns than this fit in the history.
    back = F.greatest(F.col("from") - F.lit(history // OVERHEAD), F.lit(1).cast("long"))
    members = windows.withColumn("at", F.explode(F.sequence(back, F.col("to")))).alias("m")
    held = (
        members.join(n, F.col("m.conv_id").eqNullSafe(F.col("n.conv_id")) & (F.col("m.at") == F.col("n.place")))
        .filter((F.col("place") >= F.col("from")) | (F.col("before") >= F.col("base") - F.col("reach")))
        .select("m.conv_id", "from", "place", "role", "text", "tokens")
    )
    # Where the history reaches back to the first turn, it holds the system turn already.
    heads = (
        windows.filter((F.col("from") > 1) & (F.col("base") > F.col("reach")))
        .join(system, F.col("conv_id").eqNullSafe(F.col("system_id")))
        .select("conv_id", "from", F.lit(1).cast("long").alias("place"), F.lit("system").alias("role"), "system_text", "system_tokens")
    )
    rows = held.unionByName(heads.withColumnsRenamed({"system_text": "text", "system_tokens": "tokens"}))
    lead = F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"))
    rows = (
        rows.withColumn("body", escaped(F.col("text")))
        .withColumn("lead", lead)
        .withColumn("part", F.concat("lead", "body", F.lit(END + "\n")))
        .withColumn("own", F.col("place") >= F.col("from"))
    )
    upto = Window.partitionBy("conv_id", "from").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.length("part").cast("long")).over(upto) - len(END) - 1)
    span = F.when(
        F.col("own") & (F.col("role") == "assistant"),
        F.struct((F.col("end") - F.length("body")).alias("start"), F.col("end").alias("end")),
    )
    return rows.groupBy("conv_id", F.col("from").alias("first_turn")).agg(
        F.count_if(~F.col("own")).alias("n_repeated"),
        F.count_if("own").alias("n_turns"),
        F.sum("tokens").alias("n_tokens"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "part"))), lambda x: x["part"]), "").alias("text"),
        F.sort_array(F.collect_list(span)).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """``own`` (array of role, text of a window's own turns) and ``learned`` (texts under the mask)."""
    parts = F.split(F.col("text"), START.replace("|", r"\|"))
    own = F.slice(parts, F.col("n_repeated").cast("int") + 2, F.col("n_turns").cast("int"))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - len(END) - 2)
        return F.struct(_role_in(role).alias("role"), unescaped(text).alias("text"))

    def learned(span: Column) -> Column:
        return unescaped(F.substring(F.col("text"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return windows.withColumn("own", F.transform(own, turn)).withColumn("learned", F.transform("loss", learned))
