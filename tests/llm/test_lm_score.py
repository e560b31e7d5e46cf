"""Language-model scores against counts in Python, a dense evaluation, and held-out texts."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import lm_score, queries
from cellweave.llm.common import U, text_parts

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + [None]


def base(rows):
    """Sorted rows without the model's score, by the definition."""
    learned = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    count = Counter(t for i, text in rows if learned(i) for t in tokens_of(text))
    n, v = sum(count.values()), len(count)
    return sorted(
        (
            (str(i), not learned(i), len(ts), sum(count[t] > 0 for t in ts), n, pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in ts), rel=1e-9, abs=1e-9))
            for i, ts in ((i, tokens_of(text)) for i, text in rows)
        ),
        key=lambda r: r[:5],
    )


def counted(found):
    return sorted(((str(r[0]), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=lambda r: r[:5])


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    found = queries.QUERIES["op11_lm_score"](spark, SF).collect()
    assert counted(found) == base(rows)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "A b a"), (None, None), (1, ""), (2, None), (3, " \n"), (4, "x y x"), (4, "x y x"), (5, "rare words " * 9000), (6, "ñ Ñ A")]
    rows += [(i, "new " * 50) for i in range(100, 140)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for c in ("id", "k", "learn", "word", "c", "rare", "times", "base", "model"):
        df = df.withColumn(c, F.lit(c))
    found = lm_score.score_texts(df.repartition(3), rounds=1).collect()
    assert counted(found) == base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert len({r.score for r in found if r.id == 4}) == 1


@pytest.mark.parametrize("rows", [[], [(None, "a b")]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    found = lm_score.score_texts(df, rounds=1).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(3, 0, 0, 0.0)] * len(rows)


def test_probabilities_after_any_words_add_up_to_one(spark):
    df = spark.createDataFrame([(i, f"a b c{i % 7} a d{i}", None, None, None) for i in range(200)], DOCS)
    rows = df.select("text", F.lit(True).alias("learn"), F.col("doc_id").alias("k"))
    counts = lm_score.count_words(rows)
    vocabulary = lm_score.vocabulary_of(counts)
    # only some words have their own weights; the others share classes
    vocabulary.rank[vocabulary.rank >= 40] = -1
    table = {np.int64(r.word).view(U): r.c for r in counts.collect()}
    head = {w for w, k in zip(vocabulary.words, vocabulary.rank, strict=True) if k >= 0}
    mass = np.zeros(lm_score.HEAD)
    for w, k in zip(vocabulary.words, vocabulary.rank, strict=True):
        if k >= 0:
            mass[k] = table[w] + 1
    mass = mass.reshape(-1, lm_score.WIDTH)
    words = np.array(sorted(table), U)
    tail = np.array([w for w in words if w not in head], U)
    classes, _ = vocabulary.outcome(tail)
    vocabulary.tail_mass = 1.0 + np.bincount(classes - lm_score.HEAD // lm_score.WIDTH, [table[w] + 1 for w in tail], minlength=lm_score.TAIL)
    all_mass = np.concatenate([mass.sum(axis=1), vocabulary.tail_mass])
    with np.errstate(divide="ignore", invalid="ignore"):
        vocabulary.class_bias = np.where(all_mass > 0, np.log(all_mass / all_mass.sum()), -1e4).astype(np.float32)
        vocabulary.word_bias = np.where(mass > 0, np.log(mass / mass.sum(axis=1, keepdims=True)), -1e4).astype(np.float32)
    weights = np.random.default_rng(1).normal(size=lm_score._SIZE).astype(np.float32)
    ahead = next(text_parts(__import__("pyarrow").array(["b a d3"])))[2]
    total = 0.0
    for w in words:
        p = np.exp(lm_score.log_probabilities(vocabulary, weights, np.append(ahead, w), np.array([4]))[-1])
        total += p * (1 if w in head else table[w] + 1)
    for t in range(lm_score.TAIL):  # a word of no training text in each class
        x = next(U(x) for x in range(10**6) if vocabulary.outcome(np.array([x], U))[0][0] == lm_score.HEAD // lm_score.WIDTH + t)
        total += np.exp(lm_score.log_probabilities(vocabulary, weights, np.append(ahead, x), np.array([4]))[-1])
    assert total == pytest.approx(1, abs=1e-4)


def test_gradient_is_that_of_the_likelihood(spark):
    df = spark.createDataFrame([(i, f"a b c{i % 7} a d", None, None, None) for i in range(50)], DOCS)
    rows = df.select("text", F.lit(True).alias("learn"), F.col("doc_id").alias("k"))
    vocabulary = lm_score.vocabulary_of(lm_score.count_words(rows))
    weights = np.random.default_rng(2).normal(scale=0.1, size=lm_score._SIZE).astype(np.float64)
    at = lm_score.gather(rows, lm_score.gradient(vocabulary, weights))
    text = next(text_parts(__import__("pyarrow").array([r.text for r in df.collect()])))
    tokens, counts = lm_score.with_ends(text[2], text[3])
    for cell in np.argsort(-np.abs(at[:-1]))[[0, 5, 50]]:
        moved = weights.copy()
        moved[cell] += 1e-4
        other = lm_score.gradient(vocabulary, moved)(tokens, counts)
        assert (other[-1] - at[-1]) / 1e-4 == pytest.approx(at[cell], rel=0.02)


def test_every_training_row_is_in_the_gradient_once(spark, monkeypatch):
    n, read, gather = 9_000, [], lm_score.gather
    rows = spark.range(n).select(F.col("id"), F.concat(F.lit("word "), F.col("id")).alias("text"), F.col("id").alias("k"), F.lit(True).alias("learn"))
    monkeypatch.setattr(lm_score, "gather", lambda part, terms: read.append(part.count()) or gather(part, terms))
    lm_score.fit(rows, lm_score.vocabulary_of(lm_score.count_words(rows)), rounds=3)
    assert read[0] == n and sum(read[1:]) == n and len(read) == 4


def test_only_rare_words_move(spark, monkeypatch):
    """A word with one token in a thousand or fewer is still counted where it stands; others meet their counts by a join."""
    rows = [(i, " ".join(f"w{i * 7 % 3000 + k}" for k in range(40)) + f" x{i} x{i}") for i in range(900)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    words = df.select("text", F.lit(True).alias("learn"))
    distinct = len({t for _, text in rows for t in tokens_of(text)})
    assert len(lm_score.vocabulary_of(lm_score.count_words(words)).words) == distinct
    monkeypatch.setattr(lm_score, "LOOKUP", 2048)
    assert len(lm_score.vocabulary_of(lm_score.count_words(words)).words) < 1500
    moved = lm_score.score_texts(df, rounds=1).collect()
    monkeypatch.undo()
    found = lm_score.score_texts(df, rounds=1).collect()
    assert counted(moved) == base(rows) and counted(found) == base(rows)
    assert [r.score for r in sorted(moved, key=lambda r: r.id)] == pytest.approx([r.score for r in sorted(found, key=lambda r: r.id)], rel=1e-6)


@pytest.mark.parametrize("partitions", [100, 400])
def test_several_partitions_give_one_set_of_cells(spark, partitions):
    rows = spark.range(0, 400, 1, partitions).select(F.concat(F.lit("word "), F.col("id")).alias("text"))
    sets = lm_score.few_tasks(rows).select(F.spark_partition_id()).distinct().count()
    assert sets <= max(lm_score.WAVES * spark.sparkContext.defaultParallelism, partitions // lm_score.JOINED)


@pytest.mark.parametrize("spread", [0.1, 5.0, 60.0])
def test_products_of_factors_are_the_softmax(spread):
    draw = np.random.default_rng(3)
    bias, weights = draw.normal(size=(2, 6)).astype(np.float32), draw.normal(scale=spread, size=(9, 6)).astype(np.float32)
    bias[1, 4] = lm_score.NONE
    rows, goal, kind = draw.integers(0, 9, (lm_score.TEMPLATES, 50)), draw.integers(0, 4, 50), draw.integers(0, 2, 50)
    x = bias[kind].astype(float) + weights.astype(float)[rows].sum(axis=0)
    top = x.max(axis=1, keepdims=True)
    logs = x - top - np.log(np.exp(x - top).sum(axis=1, keepdims=True))
    soft = lm_score.Softmax(bias, weights)
    assert soft.log_probability(rows, goal, kind) == pytest.approx(logs[np.arange(50), goal], rel=1e-4, abs=1e-4)
    error = -np.exp(logs)
    error[np.arange(50), goal] += 1
    expected = np.zeros((9, 6))
    for row in rows:
        np.add.at(expected, row, error)
    found, likelihood = soft.slope(rows, goal, kind)
    assert found == pytest.approx(expected, abs=1e-4)
    assert likelihood == pytest.approx(logs[np.arange(50), goal].sum(), rel=1e-4)
