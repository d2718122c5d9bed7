"""Scores against loops over single numbers; long labelled texts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import ordinal_quality, toxicity
from sluiceway.llm.shared import excerpt

TEXT = "The quick (brown) fox, jumps over the lazy dog; again and again! ünï " * 3


def plain_logit(network, text):
    """The highest logit of all windows, a word and a gate at a time."""
    recipe, h = network.recipe, network.recipe.hidden
    words = [word.strip(toxicity.EDGES) for word in text.lower().encode().split()]
    starts = sorted({*range(0, max(len(words) - recipe.window, 0), recipe.stride), max(len(words) - recipe.window, 0)})
    logits = []
    for start in starts:
        window = words[start : start + recipe.window]
        inputs = []
        for word in window:
            known = toxicity.Words.of([word], recipe)
            vector = [float(one) for one in network.word[known.forms[0]]]
            for i in range(recipe.inputs):
                if len(known.grams):
                    vector[i] += sum(float(network.gram[gram][i]) for gram in known.grams) / len(known.grams)
            inputs.append(vector)
        attention, value = [0.0] * len(window), [0.0] * len(window)
        for side in (0, 1):
            state = [0.0] * h
            for t in range(len(window)) if side == 0 else reversed(range(len(window))):
                into, back, bias = network.into[side], network.back[side], network.bias[side]
                x = [sum(inputs[t][i] * float(into[i, j]) for i in range(recipe.inputs)) + float(bias[j]) for j in range(3 * h)]
                u = [sum(state[i] * float(back[i, j]) for i in range(h)) for j in range(3 * h)]
                z = [1 / (1 + math.exp(-(x[j] + u[j]))) for j in range(h)]
                r = [1 / (1 + math.exp(-(x[h + j] + u[h + j]))) for j in range(h)]
                new = [math.tanh(x[2 * h + j] + r[j] * u[2 * h + j]) for j in range(h)]
                state = [z[j] * state[j] + (1 - z[j]) * new[j] for j in range(h)]
                attention[t] += sum(state[j] * float(network.attend[side, j]) for j in range(h))
                value[t] += sum(state[j] * float(network.out[side, j]) for j in range(h))
        weights = [math.exp(one - max(attention)) for one in attention]
        logits.append(sum(w * v for w, v in zip(weights, value, strict=True)) / sum(weights) + float(network.level[0]))
    return max(logits)


@pytest.mark.parametrize("text", [TEXT, "one", "short text", " ".join(f"w{i}x" for i in range(23))])
def test_score_equals_a_loop_over_gates(text):
    recipe = toxicity.Recipe(window=10, stride=5, inputs=4, hidden=3, word_bits=8, gram_bits=9)
    network = toxicity.Network.fresh(recipe)
    network.scale = (1.7, -0.3)
    expected = 1 / (1 + math.exp(-(1.7 * plain_logit(network, text) - 0.3)))
    assert toxicity.scores(network, [text])[0] == pytest.approx(expected, rel=1e-4)


def test_rating_equals_a_loop_over_words():
    recipe = ordinal_quality.Recipe(bits=10)
    random, mask = np.random.default_rng(4), (1 << 10) - 1
    model = ordinal_quality.Model(recipe, random.standard_normal(1 << 10), np.array([-0.4, 0.9]))
    words = TEXT.encode().split()
    total = sum(float(model.weights[bucket]) for word in words for bucket in ordinal_quality.word_features(word, mask))
    pairs = {*zip(words, words[1:], strict=False)}
    told = ordinal_quality.text_features(len(words), len(set(words)), len(pairs), len(TEXT), 1, mask)
    whole = ordinal_quality.SCALE * total / len(words) + sum(float(model.weights[bucket]) for bucket in told)
    assert model.tails([TEXT])[0].tolist() == pytest.approx([1 / (1 + math.exp(cut - whole)) for cut in (-0.4, 0.9)])


def test_half_a_window_is_in_the_next():
    recipe = toxicity.Recipe()
    _, windows, _ = toxicity.coded_texts([" ".join(f"w{i}" for i in range(400))], recipe)
    passage = recipe.window - recipe.stride + 1
    for start in range(400 - passage + 1):
        assert any(set(range(start, start + passage)) <= set(window) for window in windows.tolist())


def test_shape_of_a_long_word_counts_whole():
    alike = [b"A1" * 20 + end for end in (b"xyz", b"1xyz")]
    shapes = {ordinal_quality.word_features(word, (1 << 40) - 1)[2] for word in alike}
    assert len(shapes) == 2


def test_long_labelled_texts_stay_in_the_sample(spark):
    long = " ".join(f"word{i}" for i in range(40_000))
    docs = spark.createDataFrame(
        [(i, long if i % 2 else f"short text {i}") for i in range(20)] + [(20, "x" * 300_000), (21, "é " * 100_000)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(22)], "doc_id long, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    recipe = toxicity.Recipe()
    texts, kinds = toxicity.training_sample(docs, labels, recipe)
    assert len(texts) == labels.where(~toxicity.held_out(F.col("doc_id"))).count() and sum(kinds) > 3
    assert max(len(text.encode()) for text in texts) <= recipe.longest
    pieces = [text for text in texts if text.count("\n") == recipe.pieces - 1 and "word" in text]
    assert len(pieces) > 4 and len(set(pieces)) == len(pieces)
    known = set(long.split())
    assert all(word in known for text in pieces for word in text.split())
    graded, _ = ordinal_quality.training_sample(docs, labels.withColumnRenamed("toxic", "grade"), ordinal_quality.Recipe())
    assert len(graded) == len(texts)


def test_excerpts_of_texts_that_fit_are_the_texts(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, ""), (None, "d")], "id long, text string")
    found = rows.select("text", excerpt(F.col("text"), F.col("id"), 64, 4, 1).alias("own")).collect()
    assert all(row["text"] == row["own"] for row in found)
