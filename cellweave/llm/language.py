"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import U, mix, small_batches

#: Length of a vector.
DIMENSIONS = 1024
#: Letters in an n-gram.
GRAM = 3
#: Documents of a language that are learned from at most, about; chosen by a hash of the text.
TRAIN_ROWS = 20_000
#: Languages at most.
MAX_LANGUAGES = 2_000
#: Characters of a text that are looked at in one step.
STEP_CHARS = 1 << 20
#: n-gram vectors that a worker remembers.
CACHE_GRAMS = 16_384
#: n-grams whose vectors are added up in one step.
STEP_GRAMS = 1024
#: Distinct n-grams of texts that a learning task keeps before it bundles them.
PENDING_GRAMS = 1 << 18
UNKNOWN = "und"
#: Share of the cosine that a text of a language has on average, below which it is not of that language.
EXPECTED = 0.25

_CODE_BITS = 21


def letter_vectors(codes: np.ndarray, shift: int) -> np.ndarray:
    """Random vectors of -1 and 1, one per letter, permuted (rotated) ``shift`` times."""
    words = np.arange(DIMENSIONS // 64, dtype=U)
    with np.errstate(over="ignore"):
        bits = mix(mix(codes.astype(U)[:, None] * U(0x9E3779B97F4A7C15)) + words * U(0xD1B54A32D192ED03))
    flat = np.unpackbits(bits.view(np.uint8), axis=1)
    return np.roll(flat, shift, axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Each n-gram's vector: the product of its letters' vectors, permuted by their place."""
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in range(GRAM):
        codes, at = np.unique(grams >> (_CODE_BITS * place) & ((1 << _CODE_BITS) - 1), return_inverse=True)
        out *= letter_vectors(codes, place)[at]
    return out


class Profiler:
    """Bundles of texts; keeps the vectors of n-grams it has met, in ``rows`` of a table of fixed size."""

    def __init__(self):
        self.letter = np.zeros(0x110000, bool)
        self.letter[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        self.grams = np.empty(0, np.int64)
        self.rows = np.empty(0, np.int64)
        self.vectors = np.empty((CACHE_GRAMS, DIMENSIONS), np.int8)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the lowered letters, with their counts; other characters are one space."""
        keys, n, last = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64)
        for at in range(0, len(text), STEP_CHARS):
            codes = np.frombuffer(text[at : at + STEP_CHARS].lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
            codes = np.where(self.letter[codes], codes, 0)
            codes = np.concatenate([last, codes, np.zeros(1 if at + STEP_CHARS >= len(text) else 0, np.int64)])
            codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
            last = codes[-(GRAM - 1) :]
            if len(codes) >= GRAM:
                grams = codes[: len(codes) - GRAM + 1].copy()
                for place in range(1, GRAM):
                    grams = grams << _CODE_BITS | codes[place : len(codes) - GRAM + 1 + place]
                new, m = np.unique(grams, return_counts=True)
                if len(keys) == 0:
                    keys, n = new, m
                else:
                    keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([n, m])).astype(np.int64)
        return keys, n

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the n-grams' vectors."""
        total = np.zeros(DIMENSIONS, np.float64)
        kind = np.float32 if counts.sum() < 1 << 24 else np.float64  # whole numbers stay exact
        for at in range(0, len(grams), STEP_GRAMS):
            some, n = grams[at : at + STEP_GRAMS], counts[at : at + STEP_GRAMS].astype(kind)
            place = np.searchsorted(self.grams, some)
            known = place < len(self.grams)
            known[known] = self.grams[place[known]] == some[known]
            if not known.all():
                new = some[~known]
                if len(self.grams) + len(new) > CACHE_GRAMS:
                    self.grams, self.rows, new = np.empty(0, np.int64), np.empty(0, np.int64), some
                used = len(self.grams)
                self.vectors[used : used + len(new)] = gram_vectors(new)
                grams_, rows = np.concatenate([self.grams, new]), np.concatenate([self.rows, np.arange(used, used + len(new))])
                order = np.argsort(grams_)
                self.grams, self.rows = grams_[order], rows[order]
                place = np.searchsorted(self.grams, some)
            total += n @ self.vectors[self.rows[place]].astype(kind)
        return total


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """One prototype per language: the bundle of all n-grams of its texts.

    Of a language with more than ``train_rows`` labelled rows, those whose text hashes below the
    matching share are used, so the fit reads a bounded sample and is the same on each run.
    What comes back to the driver is one vector per language; after it stands how many n-grams are in it.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null"
    )
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for kv in sizes.items() for x in (kv[0], min(1.0, train_rows / kv[1]))])[F.col("lang")]
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(), {}  # lives as long as the task
        found: dict[str, list] = {}

        def add() -> None:  # a bundle is a sum, so the n-grams of several texts are counted first
            for lang, pairs in found.items():
                grams, where = np.unique(np.concatenate([g for g, _ in pairs]), return_inverse=True)
                n = np.bincount(where, np.concatenate([n for _, n in pairs]))
                sums[lang] = sums.get(lang, 0) + np.append(profiler.bundle(grams, n), n.sum())
            found.clear()

        pending = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                grams, n = profiler.counts(text.as_py())
                if grams.any():
                    found.setdefault(lang, []).append((grams, n))
                    pending += len(grams)
                if pending >= PENDING_GRAMS:
                    add()
                    pending = 0
        add()
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "v": pa.array([np.rint(total).astype(np.int64)], pa.list_(pa.int64()))})

    parts = chosen.mapInArrow(run, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    return {r["lang"]: np.array([x["x"] for x in r["v"]], np.float64) for r in found}


def scorer(prototypes: dict[str, np.ndarray]):
    """A function from texts to lists of their languages, scores and expected scores."""
    names = sorted(prototypes)
    lengths = [np.linalg.norm(prototypes[k][:DIMENSIONS]) for k in names]
    table = np.array([prototypes[k][:DIMENSIONS] / x for k, x in zip(names, lengths, strict=True)]).reshape(len(names), DIMENSIONS)
    # length of a language's n-gram shares as a vector: a bundle of unlike vectors is as long as its counts, times the root of DIMENSIONS
    shares = [x / np.sqrt(DIMENSIONS) / prototypes[k][DIMENSIONS] for k, x in zip(names, lengths, strict=True)]

    state: list[Profiler] = []  # each task has its own copy, which goes with it

    def run(texts: pa.Array) -> tuple[list[str], list[float], list[float]]:
        if not state:
            state.append(Profiler())
        profiler = state[0]
        langs, scores, expected = [], [], []
        for value in texts:
            text = value.as_py()
            lang, score, usual = UNKNOWN, 0.0, 0.0
            if text and names:
                grams, n = profiler.counts(text)
                if len(grams) and grams.any():
                    v = profiler.bundle(grams, n)
                    norm = np.linalg.norm(v)
                    cosines = table @ v / norm if norm else np.zeros(len(names))
                    best = int(np.argmax(cosines))
                    lang, score = names[best], float(min(1.0, max(0.0, cosines[best])))
                    usual = float(min(1.0, shares[best] * n.sum() / np.linalg.norm(n.astype(float))))
            langs.append(lang)
            scores.append(score)
            expected.append(usual)
        return langs, scores, expected

    return run


def predictor(prototypes: dict[str, np.ndarray]):
    """A function from a text column to ``struct<lang, score, expected>``."""
    score = scorer(prototypes)

    def run(texts: pa.Array) -> pa.Array:
        langs, scores, expected = score(texts)
        columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(expected, pa.float64())]
        return pa.StructArray.from_arrays(columns, ["lang", "score", "expected"])

    return F.arrow_udf(run, "lang string, score double, expected double")


def identify(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", into: str = "language") -> DataFrame:
    """``docs`` with the column ``into``, a struct of the predicted ``lang``, its ``score`` and the ``expected`` one.

    A document's vector is the bundle of its letter n-grams: each letter has a random vector, an
    n-gram binds its letters' vectors, permuted by place, and the text adds up its n-grams.
    The language is that of the prototype with the largest cosine (a tie goes to the first name),
    the score is that cosine, at least 0.  ``expected`` is the cosine that a text of this language
    with as many and as evenly repeated n-grams has on average.  NULL texts, texts without a letter, and any text when
    nothing could be learned are ``und`` with score 0.  Repeated rows get equal answers; an empty
    table gives an empty one; any length of text is read whole, in steps.
    """
    small_batches(docs.sparkSession)
    predict = predictor(learn(labelled, text_col, lang_col))
    return docs.withColumn(into, predict(F.col(text_col).cast("string")))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """True for rows that may be learned from: crc32 of the id as text is not a multiple of five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 != 0, F.lit(False))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows with a NULL id are held out."""
    learned = training_rows(docs)
    rows = identify(docs.select("doc_id", "text"), docs.where(learned).select("text", "lang"))
    return rows.select(
        "doc_id", (~training_rows(rows)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def keep_known(docs: DataFrame, min_score: float) -> DataFrame:
    """Documents whose language is known with a cosine of ``min_score`` and ``EXPECTED`` of the expected one or more; all columns as they were."""
    small_batches(docs.sparkSession)
    score = scorer(learn(docs.where(training_rows(docs))))

    def run(texts: pa.Array) -> pa.Array:
        known = [lang != UNKNOWN and x >= max(min_score, EXPECTED * usual) for lang, x, usual in zip(*score(texts), strict=True)]
        return pa.array(known, pa.bool_())

    return docs.where(F.arrow_udf(run, "boolean")(F.col("text").cast("string")))
