"""Overlap of filters against counting every document at every step of every order."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import filter_audit as fa
from sluiceway.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, mask string"
LABELS = "doc_id long, quality int, toxic int"
PROSE = " ".join(f"word{i}" for i in range(120))


def rows():
    return [
        (40, PROSE, "en"), (30, PROSE, "en"), (20, PROSE, "de"), (20, PROSE, "fr"), (20, PROSE, "fr"), (10, PROSE, None),
        (None, PROSE, "en"), (None, PROSE, "en"), (1, None, "en"), (2, "", "en"), (3, "", ""), (4, " \t\n", "de"),
        (5, "SHOUT " * 120, "en"), (6, "SHOUT " * 120, "de"), (7, "a#b", "en"), (8, "$1 " * 300, "en"), (9, "É é ß", "fr"),
        (11, "w " * 99 + "x", "en"), (12, "wort " * 60_000 + "X" * 30_000, "de"), (13, PROSE + " |", "en"), (15, PROSE.upper(), "es"),
        (16, "A" * 10 + "b" * 90, "es"), (17, "A" * 11 + "b" * 89, "es"), (None, "lone", "es"),
        *[(100 + i, "hot text", "en" if i % 3 else "de") for i in range(300)],
    ]


def labels():
    return [(10, 1, 0), (20, 1, 1), (20, 0, 0), (30, None, 1), (40, 1, None), (100, 1, 1), (101, 1, 0), (5, 0, 1),
            (None, 1, 1), (9_999, 1, 1)]


def plain_report(docs, known):
    good = {one for one, quality, _ in known if quality == 1 and one is not None}
    toxic = {one for one, _, bad in known if bad == 1 and one is not None}
    least = {}
    for one, text, _ in docs:
        if one is not None:
            least[text or ""] = min(least.get(text or "", one), one)
    masks = Counter()
    for one, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": one is not None and one > least[text],
        }
        masks[lang or "", frozenset(letter for letter, fail in fails.items() if fail), one in good, one in toxic] += 1
    found = []
    for part in {key[0] for key in masks}:
        own = [(fails, is_good, is_toxic, n) for (p, fails, is_good, is_toxic), n in masks.items() if p == part]
        removed, steps = Counter(), []
        for order in permutations("ABCDE"):
            for i, letter in enumerate(order):
                here = [(g, t, n) for fails, g, t, n in own if letter in fails and not fails & set(order[:i])]
                steps.append((
                    part, "".join(order), i + 1, sum(n for fails, _, _, n in own if not fails & set(order[: i + 1])),
                    sum(n for _, _, n in here), sum(n for fails, _, _, n in own if letter in fails and fails & set(order[:i])),
                    sum(n for fails, _, _, n in own if fails == {letter}), sum(n for g, _, n in here if g),
                    sum(n for _, t, n in here if t)))
                removed[letter] += steps[-1][4]
        found += [(*step, removed[step[1][step[2] - 1]]) for step in steps]
    return sorted(found)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """One file a row for those that share a text, so that smaller ids come in later batches."""
    folder = str(tmp_path_factory.mktemp("audit"))
    docs = [(*row, "own source", "own mask") for row in rows()]
    for start, stop in ((0, 1), (1, 2), (2, 5), (5, 150), (150, len(docs))):
        spark.createDataFrame(docs[start:stop], DOCS).coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels(), LABELS).write.parquet(f"{folder}/labels.parquet")
    return folder


def known_labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("texts", [1, 128])
def test_every_order_equals_counting(spark, tables, texts):
    counters = fa.count_masks(
        spark, f"{tables}/documents.parquet", known_labels(spark, tables), rules=fa.Filters(texts=texts), maxFilesPerTrigger="1")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = sorted(map(tuple, fa.report(counters).select(columns).collect()))
    assert found == plain_report(rows(), labels())


def test_query_equals_counting(spark, tables):
    assert sorted(map(tuple, QUERIES["op12_filter_audit"](spark, tables).collect())) == plain_report(rows(), labels())


def test_files_that_come_later_are_added(spark, tmp_path):
    path, known = f"{tmp_path}/documents.parquet", spark.createDataFrame(labels(), LABELS)
    kept = dict(sink=f"{tmp_path}/sink", checkpoint=f"{tmp_path}/checkpoint", keys=3)

    def counts(docs):
        spark.createDataFrame(docs, "doc_id long, text string, lang string").write.mode("append").parquet(path)
        return {tuple(row) for row in fa.count_masks(spark, path, known, **kept).collect()}

    assert counts([(30, PROSE, "en"), (40, PROSE, "en")]) == {("en", 0, 0, 1, 1), ("en", 16, 1, 0, 1)}
    assert counts([(20, PROSE, "de")]) == {("en", 16, 0, 1, 1), ("en", 16, 1, 0, 1), ("de", 0, 1, 1, 1)}
    again = {tuple(row) for row in fa.count_masks(spark, path, known, **kept).collect()}
    assert again == {("en", 16, 0, 1, 1), ("en", 16, 1, 0, 1), ("de", 0, 1, 1, 1)}  # nothing twice


def test_hot_text_is_combined_before_it_is_keyed(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where(F.col("text") == "hot text").coalesce(1)
    rules = fa.Filters()
    sent = fa.marked(docs, known_labels(spark, tables), rules).mapInPandas(fa.combined, fa.KEYED)
    assert sent.agg(F.sum("n")).first()[0] == 300
    assert sent.count() < 40


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    known = spark.createDataFrame([], LABELS)
    assert fa.report(fa.count_masks(spark, f"{tmp_path}/documents.parquet", known)).count() == 0
