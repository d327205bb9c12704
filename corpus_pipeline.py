"""From documents to packed training sequences, in five stages.

Low-quality documents go, then lines that many documents share, then all but one
document of each group of near duplicates; the rest is mixed to target weights by
source (a document may come to have several copies) and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metascope.llm import jaccard, line_dedup, mixing, packing, quality
from metascope.llm.common import saved, table
from metascope.llm.queries import tokenizer_path


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts, with all their columns.

    It learns from the labels of ``sf_dir``; without labels of two grades all stay.
    NULL, empty and wordless texts are rejected by a model.  Repeated rows are judged
    alike; an empty table gives an empty one.
    """
    model = quality.train(docs, quality.ratings_of(table(spark, sf_dir, "labels")))
    return quality.grade_quality(docs, model).filter("kept").select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that ten or more of them have; ``n_chars`` is that of what is left.

    A NULL text comes back empty.  Repeated rows count as documents each and all stay;
    an empty table gives an empty one.
    """
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id (NULLs last).

    Texts without words are no one's duplicates and all stay; of equal rows one stays;
    an empty table gives an empty one.
    """
    return jaccard.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents at the target weights of their sources: a row per copy, some none.

    A NULL source is one of its own; texts without words cost nothing.  Equal rows are
    taken together or not at all; an empty table gives an empty one.
    """
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2,048 tokens.

    NULL and empty texts are the end token alone; every row is packed, repeated ones
    and those without an id too; an empty table gives an empty one.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", accept_quality),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Models, token ids and hashed orders can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
