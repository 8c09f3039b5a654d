"""Documents to token ids: quality, language, near duplicates, benchmark leaks, pieces.

Each stage takes what the one before kept, and reads it from the Parquet it was written to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import decontaminate, language_id, quality, sentence_pieces, simhash
from martwright.llm.common import bucket_of, table, written
from martwright.llm.queries import ACCEPT, piece_model

#: Least share of a document's letters that lie in scripts of the learned languages, all together.
KNOWN_LETTERS = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts.

    Every row is scored by its whole text; null and empty texts have the score of a text without
    words, repeated rows the same one. A null key is in neither of the classifier's parts.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"), bucket_of("doc_id", 5) != 0)
    scored = quality.score(docs, model, out="__quality")
    return scored.filter(F.col("__quality") >= ACCEPT).select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages: one, or several side by side.

    Null texts, texts without a letter (`und`) and texts of which most letters are in scripts that
    no learned language uses go; a text in two learned languages stays, whatever their shares.
    """
    model = language_id.train(docs, bucket_of("doc_id", 4) != 2)
    out = ("__lang", "__score", "__spans")
    found = language_id.identify(docs, model, out=out, known="__known")
    learned = (F.col("__lang") != language_id.UNDECIDED) & (F.col("__known") >= KNOWN_LETTERS)
    return found.filter(learned).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest key.

    Documents without a word have one fingerprint, so one of them stays (none gets here from the
    stage before). Of rows that repeat a key one stays; null keys come last. Long texts are
    fingerprinted whole.
    """
    return simhash.deduplicate(docs, width=3, most=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of `decontaminate.LEAST` equal words or more.

    Null and empty texts hold none and stay; all rows of a repeated or null key go together; a
    benchmark item of fewer words makes no document go.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they read back as its text.

    Null and empty texts have no id and read back; repeated rows stay; giant texts are encoded by
    chunks, with the ids of the whole.
    """
    encoded = sentence_pieces.encode(docs, piece_model(), keep=["doc_id"])
    return encoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip"
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("language_id", keep_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("sentence_pieces", encode_pieces),
]
#: SQL expresses neither the classifiers nor the pieces; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
