"""A corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableloom.llm import curriculum, fragment_join, secret_links, sentencepiece_table, toxicity
from tableloom.llm.queries import table, tokenizer
from tableloom.session import apply_settings, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of this folder."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, out="_toxic").filter("_toxic < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by four fifths of their five-word shingles."""
    return fragment_join.one_of_each(docs.select(*COLUMNS))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret and every linked weak part masked."""
    clean = secret_links.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it; a document is never cut."""
    mixed = curriculum.mix(docs.select(*COLUMNS))
    return curriculum.in_training_order(mixed, repeat=True).select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per training document with its ids as a digest."""
    return sentencepiece_table.digest(docs, tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", to_tokens),
]
#: Toxicity and token ids are no matter for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder."""
    apply_settings(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
