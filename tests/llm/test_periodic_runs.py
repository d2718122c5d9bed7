"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sluiceway.llm import periodic_runs as pr
from sluiceway.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, periodic string"


def plain_runs(words, least=24, times=3):
    found = []
    for period in range(1, len(words) // times + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - start
            if length >= max(least, times * period):
                part = words[start : start + length]
                if not any(part[p:] == part[: length - p] for p in range(1, period)):
                    found.append((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_planted(doc_id, words):
    n, drawn = len(words), zlib.crc32(str(doc_id).encode())
    if drawn % 10 or not n:
        return words
    rest = drawn // 10
    a = rest % n
    p = 1 + (n - a) // (3 + rest % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    words = plain_planted(doc_id, words) if doc_id is not None else words
    runs = plain_runs(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    left = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=(None, None, None))
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def sequences(seed, count=400):
    rng = random.Random(seed)
    for turn in range(count):
        n = rng.randint(0, 150)
        words = []
        if turn % 5 == 0:  # two letters
            words = [rng.choice((b"a", b"b")) for _ in range(n)]
        elif turn % 5 == 1:  # repeats of repeats
            while len(words) < n:
                words += [b"%d" % rng.randint(0, 3) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
        elif turn % 5 == 2:  # a tail that repeats, none of whose words are elsewhere
            start, period = rng.randint(0, n), rng.randint(1, 20)
            words = [b"%d" % (i if i < start else start + (i - start) % period) for i in range(n)]
        elif turn % 5 == 3:  # a flaw in a repeat
            words = ([b"a", b"b"] * rng.randint(1, 6) + [b"c"]) * 30
            words[rng.randrange(len(words))] = b"z"
        else:  # Fibonacci words
            before, words = [b"a"], [b"b"]
            while len(words) < n:
                before, words = words, words + before
        yield words


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_brute_force(seed):
    texts = list(sequences(seed))
    found = pr.found_runs(texts, pr.Periodicity())
    assert found == [plain_runs(words) for words in texts]
    assert sum(map(len, found)) > 300


def test_stretches_leave_prose_out():
    rng = np.random.default_rng(3)
    codes = np.concatenate([rng.integers(0, 300, 5000), np.tile(np.arange(40), 4), rng.integers(0, 300, 5000)])
    assert pr.stretches(codes, np.zeros(len(codes), np.int64), pr.Periodicity()) == [(5000, 5160)]


def test_extensions_equal_comparison():
    rng = random.Random(5)
    symbols = [rng.randint(1, 2) for _ in range(200)]
    common = pr.Extensions(symbols)
    first = np.array([rng.randrange(200) for _ in range(500)])
    second = np.array([rng.randrange(200) for _ in range(500)])
    apart = first != second
    for a, b, found in zip(first[apart], second[apart], common.common(first[apart], second[apart]), strict=True):
        a, b, n = int(a), int(b), 0
        while max(a, b) + n < 200 and symbols[a + n] == symbols[b + n]:
            n += 1
        assert found == n


def test_rejects_parameters_that_would_lose_runs():
    with pytest.raises(ValueError):
        pr.Periodicity(least=12)


def odd_rows():
    tail = "ende " * 40
    return [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, tail), (4, tail), (5, "a b c " * 9 + "x"), (None, "u v " * 20),
        (6, "kopf " + "p q r s " * 8 + "mitte " + "p q r s " * 8), (7, "lang " * 3_000 + "x" * 30_000),
        (8, "é\x1cé ½\u0085½ 😀 " * 12), (9, " ".join(f"w{i % 30}" for i in range(90))),
        *[(i, " ".join(f"w{j * i % 97}" for j in range(60))) for i in range(20, 80)],
    ]


def test_query_equals_brute_force(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    key = repr
    assert sorted(map(tuple, found), key=key) == sorted((plain_row(*row) for row in rows), key=key)


def test_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(5, "a b c " * 9 + "x", "own"), (None, None, None)], SCHEMA)
    found = {row["doc_id"]: row for row in pr.find_runs(docs).collect()}
    assert found[5]["periodic"] == "own"
    assert found[5]["periodic_"]["collapsed"] == "a b c x"
    assert [tuple(run) for run in found[5]["periodic_"]["runs"]] == [(0, 27, 3)]
    assert found[None]["periodic_"]["collapsed"] == ""
    assert pr.find_runs(docs.limit(0)).count() == 0
