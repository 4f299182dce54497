"""A corpus pipeline: five stages over the documents, each by one operator of the library.

Every stage is a function of (spark, docs, sf_dir); its rows are written and
read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import kneser_ney, mixing, pieces, simhash, toxicity
from riskspark.llm.common import table
from riskspark.llm.queries import MODEL
from riskspark.sources.scratch import job, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay, empty ones too."""
    scored = toxicity.label(docs, table(spark, sf_dir, "labels"))
    mark = scored.columns[-1]
    return scored.filter(F.col(mark) < 0.5).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity stay; texts NULL or empty go."""
    return kneser_ney.keep(docs, kneser_ney.trusted_ids(table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their SimHash fingerprints one row of the smallest id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``exact`` (decoding gave the text back) of every row."""
    return pieces.encode(docs, pieces.load(spark, MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The fitted models and the piece vocabulary cannot be written in SQL; the tests hold brute force against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with job(spark):  # what a stage writes for itself goes when its rows are written
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
