"""Links and threads against a linker that searches every earlier message."""

import random
import re

import pytest

from sluiceway.llm import quote_links as ql

SCHEMA = "conv_id long, turn long, role string, text string"


def normal(text):
    return " ".join(text.lower().split())


def taken_apart(text):
    """Level and text of each line; runs of equal levels."""
    lines = [(re.match(r"[ \t]*(>[ \t]?)*", line).group().count(">"), re.sub(r"^[ \t]*(>[ \t]?)+", "", line)) for line in text.split("\n")]
    runs = []
    for level, line in lines:
        if runs and runs[-1][0] == level:
            runs[-1][1].append(line)
        else:
            runs.append((level, [line]))
    return lines, [(level, "\n".join(own)) for level, own in runs]


def units(text, wanted):
    lines, runs = taken_apart(text)
    found = {(level, normal(line)) for level, line in [*lines, *runs] if wanted(level)}
    for level, run in runs:
        if wanted(level):
            found |= {(level, one) for one in re.split(r"(?<=[.!?]) ", normal(run)) if len(one.split(" ")) >= 3}
    return {(level, unit) for level, unit in found if unit}


def plain_conversation(texts):
    """Parent, depth and place of each turn."""
    first, parent = {}, []
    for turn, text in enumerate(texts):
        votes = {}
        for level, unit in units(text, lambda level: level > 0):
            if unit in first:
                votes[level, first[unit]] = votes.get((level, first[unit]), 0) + len(unit)
        best = min(((level, -chars, -turn_) for (level, turn_), chars in votes.items()), default=None)
        parent.append(None if best is None else -best[2])
        own = "\n".join(line for level, line in taken_apart(text)[0] if level == 0)
        for unit in {unit for _, unit in units(text, lambda level: level == 0)} | {normal(own)}:
            if unit:
                first.setdefault(unit, turn)
    children = {}
    for turn, one in enumerate(parent):
        children.setdefault(one, []).append(turn)
    order, stack, depth = [], children.get(None, [])[::-1], {}
    while stack:
        turn = stack.pop()
        order.append(turn)
        depth[turn] = 0 if parent[turn] is None else depth[parent[turn]] + 1
        stack += children.get(turn, [])[::-1]
    return {turn: (parent[turn], depth[turn], order.index(turn)) for turn in range(len(texts))}


def conversation(rng, n):
    """Messages with replies that quote whole, nested, trimmed or rewrapped, or quote nothing known."""
    texts = []
    for turn in range(n):
        own = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randint(0, 40)) for _ in range(
            rng.randint(4, 9))) + rng.choice(".!?") for _ in range(rng.randint(1, 4))]
        quote = ""
        if texts and rng.random() < 0.8:
            lines = rng.choice(texts).split("\n")
            how = rng.randrange(4)
            if how == 1:  # trimmed
                lines = lines[rng.randrange(len(lines)) :][: rng.randint(1, 2)]
            elif how == 2:  # rewrapped
                words = " ".join(line for line in lines if not line.startswith(">")).split()
                lines = [" ".join(words[i : i + 5]) for i in range(0, len(words), 5)]
            elif how == 3:  # one sentence
                whole = re.split(r"(?<=[.!?]) ", " ".join(line for line in lines if not line.startswith(">")))
                lines = [rng.choice(whole)]
            quote = "".join(f"> {line}\n" for line in lines if line)
        texts.append(quote + (" " if rng.random() < 0.5 else "\n").join(own))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_searching_every_earlier_message(spark, seed):
    rng = random.Random(seed)
    talks = [conversation(rng, n) for n in (1, 2, 40, 25, 60)]
    rows = [(conv, turn, "u", text) for conv, talk in enumerate(talks) for turn, text in enumerate(talk)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {(r.conv_id, r.turn): (r.parent_turn, r.depth, r.position) for r in ql.link_messages(frame).collect()}
    expected = {(conv, turn): own for conv, talk in enumerate(talks) for turn, own in plain_conversation(talk).items()}
    assert found == expected
    assert sum(parent is not None for parent, _, _ in found.values()) > 70
    assert max(depth for _, depth, _ in found.values()) > 3


def test_a_sentence_of_a_longer_line_is_linked(spark):
    talk = [(1, 0, "u", "First we pack the bags. Then we take the late train home! Bye."), (1, 1, "v", "> then we take the late\n> train home!\nFine."),
            (1, 2, "u", "> Bye.\nno link, as it is short")]
    found = {r.turn: r.parent_turn for r in ql.link_messages(spark.createDataFrame(talk, SCHEMA)).collect()}
    assert found == {0: None, 1: 0, 2: None}


def test_repeated_rows_with_quotes_and_a_very_long_message(spark):
    long = "very long line " * 30_000
    talk = [(1, 0, "u", long), (1, 1, "v", f"> {long}\nyes"), (1, 1, "v", f"> {long}\nyes"), (1, 2, "w", "> yes\nreply"), (1, 3, "x", "alone"),
            (None, 3, "x", "> yes"), (1, None, "x", "> yes")]
    found = ql.link_messages(spark.createDataFrame(talk, SCHEMA)).where("conv_id = 1").collect()
    assert sorted((r.position, r.turn, r.parent_turn, r.depth) for r in found) == [
        (0, 0, None, 0), (1, 1, 0, 1), (2, 1, 0, 1), (3, 2, 1, 2), (4, 3, None, 0), (5, None, None, 0)]


def test_a_chain_of_many_messages(spark):
    n = 20_000
    chain = spark.range(n).selectExpr(
        "1L AS conv_id", "id AS turn", "'u' AS role",
        "if(id = 0, 'message number 0', concat('> message number ', id - 1, '\n', 'message number ', id)) AS text")
    found = ql.link_messages(chain)
    assert found.where("position != turn OR depth != turn").count() == 0 and found.count() == n
