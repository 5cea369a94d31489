"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import sql
from adtrail.llm.common import table
from adtrail.llm.decontaminate import contamination
from adtrail.llm.exact_dedup import exact_groups
from adtrail.llm.extract import extract
from adtrail.llm.infill import restore, transform
from adtrail.llm.interaction import audit
from adtrail.llm.language import identify
from adtrail.llm.packing import pack
from adtrail.llm.quality import scored
from adtrail.llm.sharding import shard
from adtrail.llm.simhash import near_groups
from adtrail.llm.substring_dedup import remove_repeats
from adtrail.llm.token_counts import token_counts
from adtrail.llm.warc import round_trip


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = restore(transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op13_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_quality,
        op3_language,
        op4_extract,
        op5_decontaminate,
        op6_packing,
        op7_exact_dedup,
        op8_substrings,
        op9_sharding,
        op10_simhash,
        op11_infill,
        op12_token_counts,
        op13_interaction,
    )
}

ORACLE: dict[str, str] = {name: sql.SQL[name] for name in QUERIES if name in sql.SQL}
