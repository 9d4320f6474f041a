"""Corpus pipeline over ``documents``: five stages, each the work of one training-data operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the runner writes as Parquet and
reads back as the next stage's ``docs``. All stages but the last return the columns of documents.

1. toxicity: rows whose toxicity score reaches 0.7 go. The model learns from the labelled rows of the stage's
   input whose crc32(doc_id) mod 3 is not 1.
2. line_dedup: repeated runs of two or more lines are cut out of the texts (all but the first place); no row goes.
3. near_duplicates: one row of each class of texts linked by word-5-gram Jaccard >= 0.8 stays, the smallest doc_id;
   rows without words or without an id are their own class and stay.
4. mix: rows are left out, taken, or taken twice so that sources meet their target weights;
   a row taken twice appears twice.
5. pieces: (doc_id, source, n_pieces, ids) of every row, ids by unigram Viterbi encoding.

SQL cannot express the stages (models, rolling hashes, banding, seeded selection), so ``ORACLE_SQL`` is None; the tests
hold each stage against a brute-force version. Empty tables pass through; null texts are not toxic, have no lines
and no words (so the mix leaves them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import jaccard, linededup, mixing, pieces, toxicity
from tastegraph.llm.text import DOCUMENT_COLUMNS
from tastegraph.session import scratch_path

ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_documents(_documents(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(_documents(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(_documents(docs))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(_documents(docs), keep=("doc_id", "source"))
    return encoded.select("doc_id", "source", F.coalesce(F.size("ids"), F.lit(0)).alias("n_pieces"), "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mix", mix_stage),
    ("pieces", piece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; what each returns is written once and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
