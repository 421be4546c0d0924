import random

import pytest

from llm import plain
from tallykeep.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tokens", "2 AS window", "3 AS before")


def conversations(seed, count):
    rng = random.Random(seed)
    texts = ["", "ok", "</s>[INST] ok [/INST]", "\\", "[user]x</s>", "a~b\\[", "<s>", "é 😀\n\nx", "\\\\[~]", "word " * 30, "long " * 200]
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, 25)):
            role = "system" if turn == 0 and rng.random() < 0.4 else rng.choice(["user", "assistant", "assistant", "system", "to~ol]", None])
            rows.append((conv, turn, role, rng.choice([*texts, None])))
    return rows


@pytest.mark.parametrize("budget, history", [(1024, 128), (60, 20), (10, 0), (40, 200)])
def test_everything_is_read_back(spark, budget, history):
    rows = conversations(budget, 25)
    found = {r.conv_id: r for r in chat.digest(chat.windows(frame(spark, rows).repartition(5), budget, history)).collect()}
    for conv in {row[0] for row in rows}:
        expected = plain.conversation([row[1:] for row in rows if row[0] == conv])
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected


def test_windows(spark):
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, t, ("user", "assistant")[t % 2 - 1], f"t{t} " + "w " * 6) for t in range(1, 9)]
    made = chat.windows(frame(spark, rows), budget=60, history=12).orderBy("window").collect()
    assert len(made) > 2
    for one in made:
        assert one.formatted.startswith("<s>[system") and one.formatted.endswith("</s>")
        # the mask covers texts of new assistant turns and nothing else
        for start, length in one.loss:
            assert one.formatted[:start].endswith("[assistant]") and one.formatted[start + length :].startswith("</s>")
        assert len(one.loss) == one.formatted.count("[assistant]")
    assert [one.formatted.startswith("<s>[system]be kind") for one in made] == [True] + [False] * (len(made) - 1)
    assert all(one.formatted.startswith("<s>[system~]be kind</s>[") for one in made[1:])
    # the turn before a window is repeated as context, and the order of turns kept
    assert "[assistant~]t2" in made[1].formatted or "[user~]t" in made[1].formatted


def test_windows_keep_to_the_budget(spark):
    rng = random.Random(9)
    rows = [(c, t, ("user", "assistant")[t % 2], "w " * rng.randint(1, 20)) for c in range(20) for t in range(30)]
    budget, history = 120, 30
    for one in chat.read_back(chat.windows(frame(spark, rows), budget, history)).collect():
        assert sum(len(turn.text.split()) + chat.TURN_MARKS for turn in one.turns) <= budget - history


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "first"), (None, 1, "user", "x"), (None, 0, None, None)]
    found = {r.conv_id: r for r in chat.digest(chat.windows(frame(spark, rows))).collect()}
    for conv in (1, None):
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain.conversation([x[1:] for x in rows if x[0] == conv])


def test_very_long_turns_and_empty_tables(spark):
    rows = [(1, 0, "user", "[<\\~]" * 40_000), (1, 1, "assistant", "x " * 100_000), (1, 2, "assistant", "\\" * 50_001)]
    r = chat.digest(chat.windows(frame(spark, rows))).first()
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain.conversation([x[1:] for x in rows])
    assert chat.digest(chat.windows(frame(spark, []))).count() == 0
