"""Near-duplicate classes against comparing every pair of documents."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import signature_join as sj

SCHEMA = "doc_id long, text string, lang string, node string, size string, root string"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})


def shingles(text):
    words = lowered(text).encode().split()
    return {tuple(words)} if 0 < len(words) < 2 else set(zip(words, words[1:], strict=False))


def plain_classes(rows):
    """Component and set size by id; repeated ids have equal texts here."""
    sets = {one: shingles(text) for one, text, *_ in rows}
    root = {one: one for one in sets}

    def find(one):
        while root[one] != one:
            one = root[one]
        return one

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {one: (len(sets[one]), find(one), find(one) == one) for one in ids}


def edited(rng, words, share):
    return [rng.choice("αβγδεζ") + str(rng.randint(0, 999)) if rng.random() < share else word for word in words]


def corpus(seed=3):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(common) for _ in range(rng.randint(1, 90))) for _ in range(150)]
    for _ in range(6):  # groups of near copies, from sure links to none
        base = [rng.choice(common) for _ in range(rng.randint(30, 200))]
        texts += [" ".join(edited(rng, base, share)) for share in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.06, 0.08, 0.1)]
    chain = [f"c{i}" for i in range(120)]
    for step in range(30):  # each is linked to its neighbours only
        texts.append(" ".join(chain[step * 6 : step * 6 + 60]))
        chain += [f"c{len(chain) + i}" for i in range(6)]
    hot = [f"h{i}" for i in range(100)]
    texts += [" ".join(edited(rng, hot, 0.02)) for _ in range(60)]
    texts += ["a b c d e", "a b c d e f", "A B C D e", "one", "ONE", "one two", "É é", "é é", *["two words"] * 5]
    texts += [None, "", " \t\n\x0b\x0c\r", "wort " * 40_000 + "x" * 30_000, " ".join(f"l{i % 20_000}" for i in range(30_000))]
    rows = [(i * 7 % 1009, text, "en", "own", "own", "own") for i, text in enumerate(texts)]
    return rows + [rows[5], rows[200], rows[200]]


@pytest.mark.parametrize("block", [256, 4])
def test_classes_equal_comparing_all_pairs(spark, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sj.near_classes(docs, how=sj.Signatures(block=block)).collect()
    expected = plain_classes(rows)
    assert len(found) == len(rows)
    assert {(row["doc_id"], *row[1:]) for row in found} == {(one, *rest) for one, rest in expected.items()}
    assert sum(not row["kept"] for row in found) > 120


def test_units_never_hold_a_whole_hot_list(spark):
    rng = random.Random(9)
    base = [f"h{i}" for i in range(60)]
    # Two templates that share three quarters of their words: one list, two components.
    texts = [" ".join(edited(rng, base[:45] + [f"{side}{i}" for i in range(15)], 0.01)) for side in "xy" for _ in range(80)]
    rows = [(i, text, "en", "", "", "") for i, text in enumerate(texts)]
    how = sj.Signatures(block=16)
    docs = spark.createDataFrame(rows, SCHEMA)
    signed = sj.signatures(docs, how)
    classes = signed.groupBy("node").agg(F.any_value("size").alias("size"), F.any_value("sig").alias("sig"))
    lists = sj.prefixes(classes, how).select("node", "size", F.explode("prefix").alias("pair")).select("node", "size", "pair.coord", "pair.value")
    no_roots = lists.select("node", F.col("node").alias("root")).limit(0)
    units = sj.list_units(lists, no_roots, how)
    assert lists.groupBy("coord", "value").count().agg(F.max("count")).first()[0] > 2 * how.block
    assert units.groupBy(*sj.UNIT).count().agg(F.max("count")).first()[0] <= 3 * 2 * how.block
    found = {row["doc_id"]: row["component_id"] for row in sj.near_classes(docs, how=how).collect()}
    assert found == {one: own[1] for one, own in plain_classes(rows).items()}


def test_matches_reach_the_recall():
    how = sj.Signatures()
    chance = sum(math.comb(64, n) * 0.8**n * 0.2 ** (64 - n) for n in range(how.matches, 65))
    assert chance >= how.recall > chance - math.comb(64, how.matches) * 0.8**how.matches * 0.2 ** (64 - how.matches)
    assert how.least_size == 4


def test_null_ids_and_empty_tables(spark):
    rows = [(None, "one two three four"), (None, "one two three four"), (8, "one two three four"), (None, "alone here"),
            (None, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, sj.near_classes(docs).collect()), key=repr)
    assert found == sorted([(None, 3, 8, False), (None, 3, 8, False), (8, 3, 8, True), (None, 1, None, True),
                            (None, 0, None, True), (3, 0, 3, True)], key=repr)
    assert sj.near_classes(docs.limit(0)).count() == 0
