"""Document fingerprints of closed syncmers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Units in a k-mer and in its inner substrings.
K, S = 6, 3
#: Characters of a unit at most: words are units, longer ones are cut.
UNIT = 16
#: Ids that share a task when neighbours are sought, about.
BUCKET_ROWS = 2_000

col, lit = F.col, F.lit


def _hash(units: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(units, at + i) for i in range(n)])


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """``array<struct<at, key>>``: the closed syncmers of a text, in order.

    A text is a row of units (words, cut at ``UNIT`` characters).  Of each window of ``k`` units
    the hashes of its inner substrings of ``s`` units are compared; the window is chosen if the
    smallest lies at its first or last place.  The choice depends on the window alone, so equal
    passages have equal anchors wherever they stand.  Texts of fewer than ``k`` units have one
    anchor, all their units; a text without units has none.
    """
    units = F.regexp_extract_all(text, lit(rf"\S{{1,{UNIT}}}"), lit(0))
    # one array at a time, each bound once as the variable of a transform over a single element
    inner = lambda u: F.when(F.size(u) >= k, F.transform(F.sequence(lit(0), F.size(u) - s), lambda i: _hash(u, i, s)))

    def choose(u: Column, h: Column) -> Column:
        span = k - s
        low = lambda i: F.least(*[F.get(h, i + d) for d in range(span + 1)])
        closed = lambda i: (F.least(F.get(h, i), F.get(h, i + span)) == low(i))
        places = F.filter(F.sequence(lit(0), F.size(u) - k), closed)
        long = F.transform(places, lambda i: F.struct(i.alias("at"), _hash(u, i, k).alias("key")))
        short = F.array(F.struct(lit(0).alias("at"), F.xxhash64(u).alias("key")))
        none = F.array().cast("array<struct<at:int,key:bigint>>")
        return F.when(F.size(u) >= k, long).when(F.size(u) > 0, short).otherwise(none)

    bound = F.transform(F.array(units), lambda u: F.struct(u.alias("u"), inner(u).alias("h")))
    return F.flatten(F.transform(bound, lambda x: choose(x["u"], x["h"])))


def fingerprint(anchor: Column) -> Column:
    """The distinct keys in order, 8 hexadecimal digits each."""
    short = F.transform(anchor, lambda a: F.lpad(F.lower(F.hex(F.shiftrightunsigned(a["key"], 32))), 8, "0"))
    return F.array_join(F.array_sort(F.array_distinct(short)), "")


def _keys(print_: Column) -> Column:
    return F.regexp_extract_all(print_, lit(".{8}"), lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' keys; 1 for two empty ones."""
    same = F.size(F.array_intersect(_keys(a), _keys(b)))
    all_ = (F.length(a) + F.length(b)) / 8 - same
    return F.when(a == b, lit(1.0)).otherwise(same / all_)


def with_next(docs: DataFrame, id_col: str, columns: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with ``next_<column>``: the values of the row that follows in descending id order.

    The last row is followed by the first.  Ids fall into buckets of equal width, so rows move once;
    the first row of a bucket is also the one after the last of the bucket above, found by a
    join on the bucket.  Ties of an id are in the order of their values.  NULL ids come last.
    """
    n, low, high = docs.agg(F.count(id_col), F.min(id_col), F.max(id_col)).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) * bucket_rows // max(1, n)))
    rows = docs.withColumn("__bucket", F.coalesce(F.floor((col(id_col) - lit(low or 0)) / width).cast("long"), lit(-1)))
    # rows without an id: any number of them, so they are dealt to buckets below all others
    spread = F.pmod(F.xxhash64(*columns), lit(max(1, bucket_rows)))
    rows = rows.withColumn("__bucket", F.when(col(id_col).isNull(), -1 - spread).otherwise(col("__bucket")))
    order = Window.partitionBy("__bucket").orderBy(col(id_col).desc_nulls_last(), *columns)
    ranked = rows.select(
        "*",
        F.row_number().over(order).alias("__rank"),
        *[F.lead(c).over(order).alias(f"__next_{c}") for c in columns],
        F.lead(lit(True)).over(order).alias("__inside"),
    )
    filled = rows.select("__bucket").distinct()
    above = Window.orderBy(col("__bucket").desc())
    # one row per bucket; the lowest is followed by the highest
    chain = filled.select(
        "__bucket", F.coalesce(F.lead("__bucket").over(above), F.max("__bucket").over(Window.partitionBy(lit(1)))).alias("__to")
    )
    heads = ranked.where("__rank = 1").select(col("__bucket").alias("__to"), *[col(c).alias(f"__head_{c}") for c in columns])
    heads = heads.join(chain, "__to").withColumnRenamed("__bucket", "__at").drop("__to")
    joined = ranked.join(heads, (col("__bucket") == col("__at")) & col("__inside").isNull(), "left")
    out = [F.when(col("__inside"), col(f"__next_{c}")).otherwise(col(f"__head_{c}")).alias(f"next_{c}") for c in columns]
    return joined.select(*docs.columns, *out)


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many (or
    all) of the next document in descending id order.  NULL is the empty text.  Equal texts,
    repeated rows among them, have equal fingerprints; a row alone is followed by itself.  Texts
    of any length are read whole.  An empty table gives an empty result.
    """
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), lit("")).alias("text"))
    prints = texts.withColumn("fp", fingerprint(anchors(col("text"), k, s)))
    near = with_next(prints, "id", ["text", "fp"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = near.select(
        "id",
        n.cast("long").alias("n_chars"),
        "fp",
        "next_fp",
        F.concat(F.substring(col("text"), lit(1), n - half), F.substring(col("next_text"), lit(1), half)).alias("edited"),
    )
    done = edited.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", fingerprint(anchors(col("edited"), k, s)).alias("edited_fp"), "next_fp"
    )
    return done.select(
        "id",
        "n_chars",
        "edited_sha256",
        col("fp").alias("fingerprint"),
        col("edited_fp").alias("edited_fingerprint"),
        likeness(col("fp"), col("edited_fp")).alias("near_edited"),
        likeness(col("fp"), col("next_fp")).alias("near_next"),
    )
