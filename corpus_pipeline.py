"""From `documents` to packed training sequences, in five stages.

A stage takes what its predecessor kept as a written table, and its decisions
take effect. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm._spark import keep, match_keys, shared_dir
from glyphmill.llm.decontaminate import find_leaks
from glyphmill.llm.jaccard_join import JaccardParams, jaccard_components
from glyphmill.llm.packing import pack_documents
from glyphmill.llm.quality import keep_good, train_quality
from glyphmill.llm.substring_dedup import find_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labels of these documents.

    A document without text or words is judged by the bias alone, so all such
    stay or go together, as do repeated rows; a null id is judged like any
    other; without labels all documents stay; an empty table stays empty.
    """
    return keep_good(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at a similarity of 0.8.

    Documents without words link with nothing and stay, as do those with a
    null id; rows that repeat an id stay or go together; an empty table stays
    empty; long texts are compared whole.
    """
    groups = jaccard_components(docs, JaccardParams(shingle=5, percent=80))
    copies = keep(groups.where("doc_id <> component_id").select("doc_id").distinct(), f"{shared_dir(spark, 'copies')}/ids")
    return match_keys(docs, copies, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 20-word passages that an earlier one holds too; a document of which nothing is left goes.

    Documents without words stay as they are, a null text stays null; null
    ids come first in the order, and of repeated rows the first keeps its
    words; an empty table stays empty. n_chars is that of what is left.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    found = find_repeats(docs, carry=others).where("n_words = 0 or n_removed < n_words")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[columns.get(c, F.col(f"carried.{c}")).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within the edit budget.

    Null and empty texts hold none and stay, as do rows with a null id; rows
    that repeat an id stay or go together; without benchmark items all
    documents stay; an empty table stays empty.
    """
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = keep(leaks.select("doc_id").distinct(), f"{shared_dir(spark, 'leaks')}/ids")
    return match_keys(docs, ids, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 ids, filled by lexical neighbours.

    A null or empty text is its end id alone, repeated rows are packed each,
    null ids stay null, long texts are cut at window ends; an empty table
    gives no rows.
    """
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packed),
]

#: The stages train a model, search near copies and pack by retrieval: SQL expresses none of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = shared_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"{at}/stage{number}")
    return docs
