"""Scores of texts by a hashed maximum-entropy language model with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import U, distinct_per_row, list_column, mix, random_words, small_batches, text_parts
from cellweave.session import cut_lineage

#: A word with at least one training token in so many has its own weights; so at most this many words do.
HEAD = 2048
#: A word with at least one token in so many, of training rows or of all, is counted in the task that meets it; only others move.
LOOKUP = 1 << 20
#: Words in a class of them.
WIDTH = 32
#: Classes of all other words, by hash; words of no training text are in them too.
TAIL = 64
CLASSES = HEAD // WIDTH + TAIL
#: Rows of the table of class weights, and of the table of weights of the words in a class.
CLASS_ROWS, WORD_ROWS = 4096, 16_384
#: Parts of the training rows; an update of the weights follows the gradient on each in turn.
ROUNDS = 4
#: What a feature is smoothed by, and how much of its own log ratio it starts with.
SMOOTH, START = 20.0, 0.35
#: Tokens that one matrix holds.
STEP_TOKENS = 8192
#: Cells that are added up in one group.
CELLS = 1024
#: Tasks per core that add up cells, at least; more when each would take more than so many partitions.
WAVES, JOINED = 2, 8

TEMPLATES = 4
_END, _BEGIN = U(0x5E17D), U(0xBE617)
_SEED = random_words(8, 53)
_SPLIT = CLASS_ROWS * CLASSES
_SIZE = _SPLIT + WORD_ROWS * WIDTH
#: Logarithm that stands for no probability.
NONE = -1e4


def with_ends(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rows, each closed by an end, and their number per row."""
    return np.insert(words, np.cumsum(counts), _END), counts + 1


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of the features before every token: the word before, the two before, and skips to the second and the third."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
    before = []
    for k in (1, 2, 3):
        shifted = np.full(len(tokens), _BEGIN)
        shifted[k:] = tokens[:-k] if len(tokens) > k else tokens[:0]
        before.append(np.where(place >= k, shifted, _BEGIN))
    with np.errstate(over="ignore"):
        one, two, three = before
        return np.stack([mix(one + _SEED[0]), mix(mix(one + _SEED[1]) + two * _SEED[2]), mix(two + _SEED[3]), mix(three + _SEED[4])])


@dataclass
class Vocabulary:
    """Counts of training tokens, as far as every task needs them: a bounded number of words."""

    total: int
    distinct: int
    #: words that are looked up in the task, sorted, with their counts
    words: np.ndarray
    counts: np.ndarray
    #: rank among the words with own weights, or -1
    rank: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    tail_mass: np.ndarray

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among ``words``, and whether the token is one of them."""
        return _find(self.words, tokens)

    def outcome(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class, and place in it; words of tail classes have place -1."""
        own = np.flatnonzero(self.rank >= 0)
        place, found = _find(self.words[own], tokens)
        rank = np.full(len(tokens), -1)
        rank[found] = self.rank[own[place[found]]]
        tail = (mix(tokens + _SEED[5]) & U(TAIL - 1)).astype(np.int64) + HEAD // WIDTH
        return np.where(rank >= 0, rank // WIDTH, tail), np.where(rank >= 0, rank % WIDTH, -1)


def _find(words: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(words):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    place = np.minimum(np.searchsorted(words, tokens), len(words) - 1)
    return place, words[place] == tokens


def rows_of(context: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both weight tables that the features use."""
    with np.errstate(over="ignore"):
        inner = mix(context + (classes.astype(U) + U(1)) * _SEED[6])
    return (context & U(CLASS_ROWS - 1)).astype(np.int64), (inner & U(WORD_ROWS - 1)).astype(np.int64)


class Softmax:
    """Probabilities of ``k`` outcomes from a bias and from a row of weights for each feature.

    Factors are multiplied instead of weights added up, so no entry needs an exponential of its own.
    """

    def __init__(self, bias: np.ndarray, weights: np.ndarray):
        self.bias, self.weights = bias, weights
        far = TEMPLATES * np.abs(weights).max() > 50  # then products are beyond single precision
        self.factors = np.exp(weights.astype(np.float64) if far else weights)
        self.bias_factors = np.exp(bias.astype(self.factors.dtype))

    def steps(self, rows: np.ndarray, goal: np.ndarray, kind: np.ndarray):
        """Of ``STEP_TOKENS`` tokens at a time: the part, the log probability of the goal, and all outcomes' products with their sum.

        ``rows`` has a line for each feature; ``kind`` is the row of the bias.
        """
        one = np.ones(self.bias.shape[1], self.factors.dtype)
        for at in range(0, len(goal), STEP_TOKENS):
            part = slice(at, at + STEP_TOKENS)
            products = np.take(self.bias_factors, kind[part], axis=0)
            known = self.bias[kind[part], goal[part]].astype(float)
            for row in rows[:, part]:
                products *= np.take(self.factors, row, axis=0)
                known += self.weights[row, goal[part]]
            total = products @ one
            yield part, known - np.log(total), products, total

    def log_probability(self, rows: np.ndarray, goal: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = np.empty(len(goal))
        for part, logs, _, _ in self.steps(rows, goal, kind):
            out[part] = logs
        return out

    def slope(self, rows: np.ndarray, goal: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, float]:
        """Observed less expected counts of every feature with every outcome, and the log likelihood."""
        size, k = self.weights.shape
        expected, likelihood = np.zeros((k, size)), 0.0
        for part, logs, products, total in self.steps(rows, goal, kind):
            likelihood += float(logs.sum())
            share = np.ascontiguousarray((products / total[:, None]).T, dtype=float)
            features = rows[:, part].ravel()
            for outcome in range(k):
                expected[outcome] += np.bincount(features, np.tile(share[outcome], TEMPLATES), size)
        observed = np.bincount((rows * k + goal).ravel(), minlength=size * k).reshape(size, k)
        return observed - expected.T, likelihood


class Model:
    """The softmax of classes and that of words in a class."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray):
        self.vocabulary = vocabulary
        # a class that no word is in has no probability
        self.live = np.flatnonzero(vocabulary.class_bias > NONE)
        self.column = np.zeros(CLASSES, np.int64)
        self.column[self.live] = np.arange(len(self.live))
        by_class = np.ascontiguousarray(weights[:_SPLIT].reshape(CLASS_ROWS, CLASSES)[:, self.live])
        self.classes = Softmax(vocabulary.class_bias[None, self.live], by_class)
        self.words = Softmax(vocabulary.word_bias, weights[_SPLIT:_SIZE].reshape(WORD_ROWS, WIDTH))

    def tasks(self, tokens: np.ndarray, counts: np.ndarray):
        """Classes and places of all tokens, and what each softmax is asked: that of words only for tokens that have a place."""
        classes, places = self.vocabulary.outcome(tokens)
        outer, inner = rows_of(contexts(tokens, counts), classes)
        head = places >= 0
        first = (outer, self.column[classes], np.zeros(len(classes), np.int64))
        return classes, head, first, (inner[:, head], places[head], classes[head])

    def log_probabilities(self, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithm of every token's probability, and which tokens are tail words: theirs lacks their count plus one as a factor."""
        classes, head, first, second = self.tasks(tokens, counts)
        out = self.classes.log_probability(*first)
        out[head] += self.words.log_probability(*second)
        out[~head] -= np.log(self.vocabulary.tail_mass[classes[~head] - HEAD // WIDTH])
        return out, ~head


def log_probabilities(vocabulary: Vocabulary, weights: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Natural logarithm of every token's probability; that of a tail word still lacks its count plus one as a factor."""
    return Model(vocabulary, weights).log_probabilities(tokens, counts)[0]


def statistics(vocabulary: Vocabulary) -> Callable:
    """How often each feature stands before each class, and before each word of a class."""

    def run(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        context = contexts(tokens, counts)
        classes, places = vocabulary.outcome(tokens)
        outer, inner = rows_of(context, classes)
        head = places >= 0
        cells = np.concatenate([(outer * CLASSES + classes).ravel(), (_SPLIT + inner[:, head] * WIDTH + places[head]).ravel()])
        return np.bincount(cells, minlength=_SIZE + 1)

    return run


def gradient(vocabulary: Vocabulary, weights: np.ndarray) -> Callable:
    """Observed less expected feature counts; the last cell is the log likelihood."""

    model = Model(vocabulary, weights)

    def run(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        _, _, first, second = model.tasks(tokens, counts)
        out = np.zeros(_SIZE + 1)
        by_class, by_word = out[:_SPLIT].reshape(CLASS_ROWS, CLASSES), out[_SPLIT:_SIZE].reshape(WORD_ROWS, WIDTH)
        by_class[:, model.live], of_classes = model.classes.slope(*first)
        by_word[:], of_words = model.words.slope(*second)
        out[_SIZE] = of_classes + of_words
        return out

    return run


def few_tasks(rows: DataFrame) -> DataFrame:
    """The same rows in fewer partitions, as each gives one set of cells whatever it holds."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(WAVES * cores, -(-rows.rdd.getNumPartitions() // JOINED)))


def gather(rows: DataFrame, terms: Callable) -> np.ndarray:
    """The sum over all texts of what ``terms`` gives, added up in tasks and then by groups of ``CELLS`` cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-(_SIZE + 1) // CELLS) * CELLS)
        seen = False
        for batch in batches:
            for _, _, words, counts in text_parts(batch.column(0)):
                total[: _SIZE + 1] += terms(*with_ends(words, counts))
                seen = True
        if seen:
            for at, cells in enumerate(total.reshape(-1, CELLS)):
                if cells.any():
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([cells.tobytes()])], names=["at", "cells"])

    def add(part: pa.Table) -> pa.Table:
        cells = np.sum([np.frombuffer(b, np.float64) for b in part["cells"].to_pylist()], axis=0)
        return pa.table({"at": part["at"][:1], "cells": [cells.tobytes()]})

    schema = "at int, cells binary"
    out = np.zeros(-(-(_SIZE + 1) // CELLS) * CELLS)
    for at, cells in few_tasks(rows.select("text")).mapInArrow(run, schema).groupBy("at").applyInArrow(add, schema).collect():
        out[at * CELLS : (at + 1) * CELLS] = np.frombuffer(cells, np.float64)
    return out[: _SIZE + 1]


def count_words(rows: DataFrame) -> DataFrame:
    """Written ``word, c, every`` of ``text, learn`` rows: tokens in training rows, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learn = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for i, j, words, counts in text_parts(batch.column(0)):
                tokens, sizes = with_ends(words, counts)
                word, at, every = np.unique(tokens, return_inverse=True, return_counts=True)
                c = np.bincount(at, np.repeat(learn[i:j], sizes), minlength=len(word)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(c), pa.array(every)], names=["word", "c", "every"])

    found = rows.select("text", "learn").mapInArrow(run, "word long, c long, every long")
    return cut_lineage(found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("every").alias("every")))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """What tasks look up: words that are frequent in training rows, or in all, at most ``LOOKUP`` of each by arithmetic."""
    total, distinct, every = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("every")).first()
    total, distinct, every = total or 0, distinct or 0, every or 0
    frequent = counts.where((F.col("c") * LOOKUP >= max(total, 1)) | (F.col("every") * LOOKUP >= max(every, 1))).select("word", "c").toPandas()
    words = frequent["word"].to_numpy(np.int64).view(U)
    order = np.argsort(words)
    words, c = words[order], frequent["c"].to_numpy(np.int64)[order]
    rank = np.full(len(words), -1)
    own = np.flatnonzero((c * HEAD >= total) & (c > 0))
    rank[own[np.argsort(-c[own], kind="stable")]] = np.arange(len(own))

    head = words[own]
    word_mass = np.zeros(HEAD)
    word_mass[rank[own]] = c[own] + 1
    word_mass = word_mass.reshape(-1, WIDTH)

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(TAIL)
        for batch in batches:
            word, n = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy()
            tail = ~np.isin(word, head)
            sums += np.bincount((mix(word[tail] + _SEED[5]) & U(TAIL - 1)).astype(np.int64), n[tail] + 1.0, minlength=TAIL)
        yield pa.RecordBatch.from_arrays([pa.array(range(TAIL), pa.int32()), pa.array(sums)], names=["t", "mass"])

    parts = counts.where("c > 0").select("word", "c").mapInArrow(masses, "t int, mass double").groupBy("t").agg(F.sum("mass").alias("mass"))
    tail_mass = np.ones(TAIL)  # one for words of no training text
    for t, mass in parts.collect():
        tail_mass[t] += mass
    mass = np.concatenate([word_mass.sum(axis=1), tail_mass])
    with np.errstate(divide="ignore", invalid="ignore"):
        class_bias = np.where(mass > 0, np.log(mass / mass.sum()), NONE).astype(np.float32)
        word_bias = np.where(word_mass > 0, np.log(word_mass / word_mass.sum(axis=1, keepdims=True)), NONE).astype(np.float32)
    return Vocabulary(total, distinct, words, c, rank, class_bias, word_bias, tail_mass)


def first_weights(vocabulary: Vocabulary, seen: np.ndarray) -> np.ndarray:
    """A share of every feature's own smoothed log ratio."""

    def ratios(table: np.ndarray, prior: np.ndarray) -> np.ndarray:
        prior = np.maximum(prior, 1e-9)
        return START * np.log((table + SMOOTH * prior) / ((table.sum(axis=1, keepdims=True) + SMOOTH) * prior))

    by_class = seen[:_SPLIT].reshape(CLASS_ROWS, CLASSES)
    by_word = seen[_SPLIT:_SIZE].reshape(WORD_ROWS, WIDTH)
    usual = by_word.sum(axis=0) / max(by_word.sum(), 1)
    parts = [ratios(by_class, np.exp(vocabulary.class_bias.astype(float))), ratios(by_word, usual)]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def fit(rows: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of ``id, text`` rows: feature statistics of all rows, then gradient updates that take every row once.

    Rows are dealt to ``rounds`` parts by a hash of what they hold, and each update goes along the gradient on one part, each cell by its expected
    count there.  Steps are those of iterative scaling, a share of ``TEMPLATES`` for each feature, and get shorter.
    """
    seen = gather(rows, statistics(vocabulary))
    weights = first_weights(vocabulary, seen)
    size = seen[:_SIZE] / max(rounds, 1) + 2.0
    for at in range(rounds):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(rounds)) == at)
        slope = gather(part, gradient(vocabulary, weights))[:_SIZE]
        step = np.clip(slope / size / (TEMPLATES * (1 + at / 2)), -0.5, 0.5)
        weights = (weights + step).astype(np.float32)
    return weights


def training_rows(id_col: str) -> Column:
    """True for rows that are learned from: crc32 of the id as text leaves another remainder than 2 by seven."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 != 2, F.lit(False))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Words are runs other than ASCII white space, A-Z lowered; an end follows the last.  ``base_score`` is the text's log10 probability by
    word counts of the training rows, plus one each; ``score`` that of a maximum-entropy model with hashed n-gram and skip features.
    The model gives a class and then a word in it.  Frequent words have classes of ``WIDTH`` words with weights of their own;
    others share ``TAIL`` classes by hash, in which their counts, plus one, decide, with one more for all
    words of no training text.  Each class and each word in it follow from features of the three words before.

    Tasks look up frequent words in a table of bounded size; only others move, to meet their counts, so no key is hot.
    Words are told by 64 bits of hash.  NULL and empty texts are an end alone.  Rows with a NULL id are held out.  Repeated rows each
    count and get equal scores.  Without training rows every word is unknown and the base is 0.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), training_rows(id_col).alias("learn"), F.monotonically_increasing_id().alias("k")
    )
    counts = count_words(rows)
    vocabulary = vocabulary_of(counts)
    weights = fit(rows.where("learn"), vocabulary, rounds)
    uniform = np.log10(vocabulary.total + vocabulary.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language = Model(vocabulary, weights)
        for batch in batches:
            for i, j, words, sizes in text_parts(batch.column(0)):
                tokens, sizes = with_ends(words, sizes)
                starts = np.cumsum(sizes) - sizes
                place, found = vocabulary.find(tokens)
                known = np.where(found, vocabulary.counts[place] if len(vocabulary.words) else 0, 0)
                here = np.log10(known + 1.0)
                model, tail = language.log_probabilities(tokens, sizes)
                model = model / np.log(10) + np.where(tail, here, 0.0)
                row = np.repeat(np.arange(len(sizes)), sizes)
                away = np.bincount(row[~found], minlength=len(sizes))
                rare, n_rare = distinct_per_row(tokens[~found], away)
                times = _times(tokens[~found], away)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, j - i) for c in (1, 2, 3)],
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.add.reduceat((known > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(here, starts) - sizes * uniform),
                        pa.array(np.add.reduceat(model, starts)),
                        list_column(rare.view(np.int64), n_rare, pa.int64()),
                        list_column(times, n_rare, pa.int64()),
                    ],
                    names=["id", "learn", "k", "n_tokens", "known", "base", "model", "rare", "times"],
                )

    found = cut_lineage(
        rows.select("text", "id", "learn", "k").mapInArrow(
            run, f"id {kind}, learn boolean, k long, n_tokens long, known long, base double, model double, rare array<long>, times array<long>"
        )
    )
    rare = found.select("k", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("k", F.col("w.rare").alias("word"), F.col("w.times").alias("m"))
    rare = rare.join(counts.where("c > 0").select("word", "c"), "word")
    more = rare.groupBy("k").agg(F.sum("m").alias("more_known"), F.sum(F.col("m") * F.log10(F.col("c") + 1.0)).alias("more"))
    more_log = F.coalesce("more", F.lit(0.0))
    return found.join(more, "k", "left").select(
        "id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more_log).alias("base_score"),
        (F.col("model") + more_log).alias("score"),
    )


def _times(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each of a row's distinct tokens stands in the row, in the order of ``distinct_per_row``."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((tokens, row))
    t, r = tokens[order], row[order]
    begin = np.ones(len(t), bool)
    begin[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    return np.diff(np.append(np.flatnonzero(begin), len(t))).astype(np.int64)
