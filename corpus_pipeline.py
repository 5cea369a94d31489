"""From raw documents to packed training sequences.

Stages in order: reject documents of low quality, keep one of equal texts, keep
one of near copies, drop documents that hold benchmark passages, pack what is
left. Each stage is written to the shared folder and read again by the next.

An empty table passes all stages and packs into no rows. Rows that repeat an id and
a text are one document from the second stage on. Columns beyond those of documents
are carried to the packing, whatever their names, and dropped there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adtrail.llm.common import stored, table
from adtrail.llm.decontaminate import keep_clean
from adtrail.llm.exact_dedup import keep_distinct
from adtrail.llm.packing import pack
from adtrail.llm.quality import keep_good
from adtrail.llm.simhash import keep_one_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the labels teach to be good; a null text is judged as an empty one."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest id of each distinct text; null counts as empty."""
    return keep_distinct(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies; all texts without words are one group."""
    return keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no window of a benchmark item occurs in; texts without words stay."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; a null or empty text is its end token alone."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: Fitted weights and seeded 64-bit hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, f"pipeline-{name}")
    return docs
