"""Chat formatting in budgeted windows, with Spark functions only.

Prefix sums of turn tokens place each turn in a span, so spans are turn-aligned and keep
their order. A window is a span, preceded by the conversation's system turn and by as
much of the turns before it as the history budget allows; these repeated turns are
marked as context and are outside the loss mask, which covers every assistant text once.

A window reads ``<s>`` and then, per turn, ``[role]text</s>``, or ``[role~]text</s>`` for
a repeated one. A backslash escapes ``\\``, ``[``, ``]``, ``<`` and ``~`` in roles and texts, so what
a text says can never be taken for a mark, and everything can be read back.

A span holds fewer tokens than half of what system turn and history leave of the budget,
plus its last turn; so a window keeps to the budget unless a single turn exceeds that
half. Turns are never cut.

Defined cases: null roles and texts count as empty; a null conversation id is a
conversation of its own; turns are ordered by turn (null first), then role, then text, so
ties and repeated rows have one order and all stay; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import plain_text, split_words

BUDGET = 1024
HISTORY = 128
# Tokens a turn costs beside its words: its marks.
TURN_MARKS = 4

OPEN, CLOSE, CONTEXT = "<s>", "</s>", "~"

# One turn of a window: role, context mark, text; possessive, so matching never backtracks.
_TURN = r"(?s)\[([^\\\]~]*+(?:\\.[^\\\]~]*+)*+)(~?)\]([^\\<]*+(?:\\.[^\\<]*+)*+)</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\\[\]<~])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def word_tokens(text: Column) -> Column:
    """The default measure of a turn: its words."""
    return F.size(split_words(text)).cast("long")


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=word_tokens
) -> DataFrame:
    """(conv_id, window, formatted, loss): a row per window.

    ``loss`` holds (start, length) in characters of the escaped assistant texts to learn.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        plain_text("role").alias("role"),
        plain_text("text").alias("text"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cost = (tokens(F.col("text")) + TURN_MARKS).cast("long")
    placed = (
        turns.withColumn("tokens", cost)
        .withColumn("position", F.row_number().over(ordered).cast("long"))
        .withColumn("until", F.sum("tokens").over(so_far))
        .withColumn(
            "system",
            F.first(F.when(F.col("role") == "system", F.struct("role", "text", "tokens"))).over(so_far),
        )
    )
    # only a system turn that opens the conversation is retained; `first` sees position 1
    own = F.coalesce(F.col("system.tokens"), F.lit(0))
    half = F.greatest(F.floor((budget - history - own) / 2), F.lit(1))
    before = F.col("until") - F.col("tokens")
    spanned = placed.withColumn("before", before).withColumn("window", F.floor(before / half).cast("long"))
    opens = F.coalesce(F.lag("window").over(ordered) != F.col("window"), F.lit(False))
    spanned = spanned.withColumn("opens", opens)
    ahead = Window.partitionBy("conv_id").orderBy("before").rangeBetween(1, history)
    is_system = (F.col("position") == 1) & F.col("system").isNotNull()
    # the windows opened so soon after this turn that it is part of their history
    nearby = F.when(~is_system, F.collect_list(F.when(F.col("opens"), F.col("window"))).over(ahead))
    spanned = spanned.withColumn("nearby", F.coalesce(nearby, F.array().cast("array<bigint>")))

    def instance(window: Column, position: Column, again: bool, role: Column, text: Column) -> Column:
        return F.struct(
            window.alias("window"),
            position.alias("position"),
            F.lit(again).alias("again"),
            role.alias("role"),
            text.alias("text"),
        )

    itself = F.array(instance(F.col("window"), F.col("position"), False, F.col("role"), F.col("text")))
    repeated = F.transform("nearby", lambda w: instance(w, F.col("position"), True, F.col("role"), F.col("text")))
    retained = F.when(
        F.col("opens") & F.col("system").isNotNull(),
        F.array(instance(F.col("window"), F.lit(0).cast("long"), True, F.col("system.role"), F.col("system.text"))),
    ).otherwise(F.slice(itself, 1, 0))
    each = spanned.select("conv_id", F.explode(F.concat(itself, repeated, retained)).alias("one")).select(
        "conv_id", "one.*"
    )
    head = F.concat(F.lit("["), escape(F.col("role")), F.when(F.col("again"), CONTEXT).otherwise(""), F.lit("]"))
    written = (
        each.withColumn("head", head)
        .withColumn("body", escape(F.col("text")))
        .withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    )
    in_window = Window.partitionBy("conv_id", "window").orderBy("position")
    earlier = F.coalesce(
        F.sum(F.length("turn").cast("long")).over(in_window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    learned = F.when(
        ~F.col("again") & (F.col("role") == "assistant"),
        F.struct((len(OPEN) + F.col("earlier") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")),
    )
    packed = (
        written.withColumn("earlier", earlier)
        .groupBy("conv_id", "window")
        .agg(F.sort_array(F.collect_list(F.struct("position", "turn", learned.alias("loss")))).alias("turns"))
    )
    return packed.select(
        "conv_id",
        "window",
        F.concat(F.lit(OPEN), F.array_join(F.col("turns.turn"), "")).alias("formatted"),
        F.filter(F.col("turns.loss"), lambda one: one.isNotNull()).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_text): what windows say, repeated turns left out.

    ``turns`` holds (role, text) in order; ``loss_text`` joins the texts under the mask.
    """
    parts = [F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(group)) for group in (1, 2, 3)]
    found = formatted.withColumn(
        "found", F.arrays_zip(parts[0].alias("role"), parts[1].alias("mark"), parts[2].alias("text"))
    )
    new = F.filter("found", lambda one: one["mark"] == "")
    turns = F.transform(new, lambda one: F.struct(unescape(one["role"]).alias("role"), unescape(one["text"]).alias("text")))
    texts = F.transform(
        "loss",
        lambda one: unescape(F.substring(F.col("formatted"), (one["start"] + 1).cast("int"), one["length"].cast("int"))),
    )
    return found.select(
        "conv_id", "window", F.length("formatted").cast("long").alias("chars"), turns.alias("turns"),
        F.array_join(texts, "").alias("loss_text"),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: digests of its turns and of what is learned."""
    lines = F.transform("turns", lambda one: F.concat(one["role"], F.lit("\n"), one["text"], F.lit("\n")))
    parts = read_back(formatted).select(
        "conv_id",
        F.struct(
            "window", F.size("turns").alias("n"), F.array_join(lines, "").alias("turns"), "loss_text", "chars"
        ).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def total(field: str) -> Column:
        return F.aggregate(F.col(f"parts.{field}"), F.lit(0).cast("long"), lambda sum_, one: sum_ + one)

    whole = whole.withColumn("loss", F.array_join(F.col("parts.loss_text"), ""))
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(F.array_join(F.col("parts.turns"), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
