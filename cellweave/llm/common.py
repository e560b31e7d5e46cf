"""Shared pieces: table access, hot-key joins, and vectorised word hashing over Arrow text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it holds at least one row in so many; so at most this many keys are hot.
HOT_PARTS = 1000
#: Numbers in the filter before a join, at most.
MAX_BUCKETS = 1 << 20
#: Text bytes that one vectorised step looks at.
STEP_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and Python, unless the session's configuration names them.
BATCH_BYTES = 1 << 20

U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of ``BATCH_BYTES``; a longer text is a batch of its own.

    Both sides hold several copies of a batch outside the heap, for each core of an executor.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hot_join(big: DataFrame, counted: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``counted``, which has one row per key and the rows of ``big`` with it in ``count``.

    Keys with at least ``total / HOT_PARTS`` rows are at most ``HOT_PARTS`` by arithmetic, so their
    part of ``counted`` is broadcast.  The other keys are small and meet in a shuffle, through which
    rows of hot keys pass under a hash of the whole row, which spreads them.
    ``how`` is inner or left; NULL keys match nothing.
    """
    limit = max(2, total // HOT_PARTS)
    extra = [c for c in counted.columns if c not in (key, count)]
    hot = F.broadcast(
        counted.where(F.col(count) >= limit)
        .select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__h_{c}") for c in extra])
    )
    first = big.join(hot, F.col(key) == F.col("__hot"), "left")
    # the flag is never true here, but keeps rows of hot keys, which have a key of no meaning, from a match
    rest = counted.where(F.col(count) < limit).select(
        F.col(key).alias("__cold"), (F.col(count) < 0).alias("__flag"), *[F.col(c).alias(f"__c_{c}") for c in extra]
    )
    aside = F.col("__hot").isNotNull() | F.col(key).isNull()
    spread = F.when(aside, F.xxhash64(*big.columns).cast(big.schema[key].dataType)).otherwise(F.col(key))
    both = first.withColumn("__aside", aside).withColumn("__k", spread)
    out = both.join(rest, (F.col("__k") == F.col("__cold")) & (F.col("__aside") == F.col("__flag")), "left")
    if how == "inner":
        out = out.where(F.col("__hot").isNotNull() | F.col("__cold").isNotNull())
    return out.select(
        *[F.col(c) for c in big.columns], *[F.coalesce(f"__h_{c}", f"__c_{c}").alias(c) for c in extra]
    )


def may_match(df: DataFrame, hashed: Column, keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, str]:
    """``df`` with a flag that is NULL for rows whose hash is in no bucket of ``keys``; and the flag's name.

    Used before a shuffle join on the hash, so that rows without a partner need not move.  The
    buckets are a set of at most ``MAX_BUCKETS`` numbers whatever the tables' sizes, and are
    broadcast; with more keys than that, more rows are flagged, and the result is the same.
    """
    buckets = min(MAX_BUCKETS, 1 << max(10, (16 * n_keys).bit_length()))
    name = fresh(df, "may_match")
    found = keys.select(F.pmod(F.col(key), F.lit(buckets)).alias(name)).distinct()
    return df.join(F.broadcast(found), F.pmod(hashed, F.lit(buckets)) == F.col(name), "left"), name


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


_BYTE = random_words(256, 11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base, dtype=U)
            step[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[i] = np.multiply.accumulate(step)
    return _POWERS


def _hashes_of(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; ``breaks`` are offsets where a text starts."""
    n = len(data)
    if n == 0:
        return np.empty(0, U), np.empty(0, np.int64)
    word = _WORD[data]
    fresh = np.zeros(n, dtype=bool)
    fresh[breaks[breaks < n]] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | fresh[1:]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | fresh[1:]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=U)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[_LOWER[data]] * power[:n], out=sums[1:])
        return mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U)), s


def text_parts(column: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, last row, word hashes, words per row`` for runs of rows of about ``step`` bytes.

    Words are maximal runs of bytes other than ASCII white space, with A-Z lowered.  NULL is an
    empty text.  A text longer than a step is cut at white space, so memory stays in proportion
    to its words and not to a multiple of its bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return
    validity, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    begin, end = offsets[:-1].copy(), offsets[1:].copy()
    if column.null_count:
        none = np.asarray(column.is_null())
        end[none] = begin[none]
    i = 0
    while i < n:
        j = i + 1
        while j < n and end[j] - begin[i] <= step:
            j += 1
        if j == i + 1 and end[i] - begin[i] > step:
            pieces, at = [], begin[i]
            while at < end[i]:
                to = min(at + step, end[i])
                while to < end[i] and _WORD[raw[to]]:
                    gap = np.flatnonzero(~_WORD[raw[to : to + step]])
                    to = to + gap[0] if len(gap) else min(to + step, end[i])
                pieces.append(_hashes_of(raw[at:to], np.zeros(1, np.int64))[0])
                at = to
            words = np.concatenate(pieces)
            yield i, j, words, np.array([len(words)])
        else:
            base = begin[i]
            words, first = _hashes_of(raw[base : end[i:j].max()], begin[i:j] - base)
            row = np.searchsorted(begin[i:j] - base, first, "right") - 1
            inside = first + base < end[i:j][row]
            yield i, j, words[inside], np.bincount(row[inside], minlength=j - i)
        i = j


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows and their number per row; a shorter text is one window."""
    total = len(words)
    if total == 0:
        return np.empty(0, U), np.zeros(len(counts), np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    padded = np.concatenate([words, np.zeros(k - 1, U)])
    seeds = random_words(k, 23)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    left = np.repeat(starts + counts, counts) - np.arange(total)  # words from here to the end of the row
    out = np.zeros(total, U)
    with np.errstate(over="ignore"):
        for d in range(k):
            part = mix(padded[d : d + total] + seeds[d])
            out += np.where(left > d, part, seeds[d]) * seeds[k - 1 - d]
    short = counts < k
    valid = left >= k
    valid[starts[short & (counts > 0)]] = True
    return mix(out[valid]), np.bincount(row[valid], minlength=len(counts))


def distinct_per_row(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of every row, and their number."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, row))
    values = values[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.bincount(row[keep], minlength=len(counts))


def list_column(values: np.ndarray, counts: Sequence[int], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
