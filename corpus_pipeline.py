"""From raw documents to token ids, in five stages of which each works on all that the one before kept.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again for the next one.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.bpe import round_trip
from cellweave.llm.common import fresh, table
from cellweave.llm.decontaminate import matches
from cellweave.llm.language import keep_known
from cellweave.llm.line_dedup import drop_recurring_lines
from cellweave.llm.near_dedup import keep_one
from cellweave.llm.queries import tokenizer_path
from cellweave.session import shared_folder

#: A document whose best language is less alike than this is in none of the learned languages, whatever its
#: length.  Unrelated vectors have cosines around 0.03; texts of a word or two, or of one line over and over,
#: still reach 0.1.  What is asked of others grows with their different n-grams (``language.EXPECTED``).
MIN_LANGUAGE_SCORE = 0.05


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language.  NULL texts and texts without letters go, as does what is unlike every language."""
    return keep_known(docs, MIN_LANGUAGE_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs; the first line of each template stays."""
    name = fresh(docs, "dropped")
    return drop_recurring_lines(docs, into=name).drop(name)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    name = fresh(docs, "matches")
    return matches(docs, table(spark, sf_dir, "benchmark"), into=name).where(F.size(name) == 0).drop(name)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    both = docs.select("doc_id", "lang", "source", round_trip(spark, tokenizer_path())("text").alias("both"))
    return both.select("doc_id", "lang", "source", "both.ids", "both.decoded").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language identification", identify_language),
    ("line dedup", dedup_lines),
    ("near-duplicate documents", dedup_documents),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding and decoding", encode),
]

#: Random letter vectors and the tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
