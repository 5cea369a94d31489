"""Exact dedup that a hot group of copies cannot slow: combine in three steps.

Copies are combined inside each task, then among the groups of a digest and a
salt, then among the salt winners of a digest. Every step compares the full
normalised text; the digest only decides where rows meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm.common import ascii_lower, first_of, stored, whole_rows

#: Groups a hot digest is dealt into. Each holds 1/SALTS of the copies.
SALTS = 16


def _keyed(docs: DataFrame, salts: int, ident: str, text: str) -> DataFrame:
    norm = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return (
        docs.select(F.col(ident).alias("doc_id"), norm.alias("norm"))
        .withColumn("digest", F.sha2("norm", 256))
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    )


def winners(docs: DataFrame, salts: int = SALTS, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per digest and salt: the largest id of the whole group, and its size.

    ``norm`` is the text where two texts share a digest, else null, so that the
    result stays slim.
    """
    salted = _keyed(docs, salts, ident, text).groupBy("digest", "salt", "norm").agg(
        F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n")
    )
    same_text = Window.partitionBy("digest", "norm")
    same_digest = Window.partitionBy("digest")
    return (
        salted.repartition("digest")
        .select(
            "digest",
            "salt",
            "norm",
            F.max("winner").over(same_text).alias("keep_id"),
            F.sum("n").over(same_text).alias("group_size"),
            (F.min("norm").over(same_digest) != F.max("norm").over(same_digest)).alias("clash"),
        )
        .withColumn("norm", F.when(F.col("clash"), F.col("norm")))
        .drop("clash")
    )


def exact_groups(docs: DataFrame, salts: int = SALTS, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. The largest id of a group stays. A null id never wins against
    another; a group of null ids alone has a null ``keep_id`` and all its rows
    are ``kept``. Rows that repeat an id and a text are one document and share
    ``kept`` (``keep_distinct`` keeps one of them). Other columns are ignored.
    An empty table gives an empty result.
    """
    won = stored(winners(docs, salts, ident, text), "dedup-winners")
    keyed = _keyed(docs, salts, ident, text)
    clashing = won.where(F.col("norm").isNotNull())
    if clashing.isEmpty():
        matched = keyed.drop("norm").join(won.drop("norm"), ["digest", "salt"])
    else:
        bad = clashing.select("digest").distinct()
        matched = (
            keyed.join(bad, "digest", "left_anti").drop("norm").join(won.drop("norm"), ["digest", "salt"])
        ).unionByName(
            keyed.join(bad, "digest", "left_semi").join(clashing, ["digest", "salt", "norm"]).drop("norm")
        )
    return matched.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, salts: int = SALTS, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one row per distinct text.

    Of equal texts, null and empty ones among them, the row with the largest id
    stays, and one of those that repeat it; a row without an id stays only
    where none of its group has one. An empty table stays empty; other columns
    go along whatever their names.
    """
    groups = exact_groups(docs, salts, ident, text).where("kept")
    stay = groups.select(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha")).distinct()
    sha = F.sha2(ascii_lower(F.coalesce(docs[text], F.lit(""))), 256)
    rows = whole_rows(docs, id=docs[ident].cast("long"), sha=sha)
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")))
    return first_of(kept, "id", "sha").select("row.*")
