"""What several operators share: shared tables, lower case, word patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.session import work_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It is computed once, its lineage ends there, and a lost executor loses
    nothing of it.
    """
    return stored_for_now(df, name)[0]


def stored_for_now(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same and its folder, for a caller that removes it once nothing reads it any more."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged.

    On text without characters beyond ASCII ``lower`` does the same, faster.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_key(ident: Column, text: Column) -> Column:
    """Tells rows apart that repeat an id with another text, or have no id."""
    return F.struct(ident.alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"))


def whole_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """``df``'s rows as one column ``row``, beside columns that its names cannot clash with."""
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def first_of(df: DataFrame, *keys: str) -> DataFrame:
    """One row of those that repeat ``keys``."""
    rows = Window.partitionBy(*keys).orderBy(F.lit(1))
    return df.withColumn("__n", F.row_number().over(rows)).where("__n = 1").drop("__n")


def ranked(df: DataFrame, group: str, order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with the place of each row in its group, from 0 without gaps.

    A group is dealt over as many tasks as its rows need: rows are sorted by
    range, and each task's count per group gives where the next one begins.
    ``name`` counts by ``order``; rows alike in it stand in any order.
    """
    place = F.col("__place")
    rows = (
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("__place", F.monotonically_increasing_id())
        .withColumn("__task", F.shiftright(place, 33))
    )
    rows = stored(rows, "ranked")
    tasks = rows.groupBy(group, "__task").agg(F.count(F.lit(1)).alias("__count"), F.min("__place").alias("__first"))
    earlier = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("__count").over(earlier), F.lit(0))
    tasks = tasks.select(group, "__task", (begins - F.col("__first")).alias("__shift"))
    return (
        rows.join(tasks, [group, "__task"])
        .withColumn(name, (place + F.col("__shift")).cast("long"))
        .drop("__place", "__task", "__shift")
    )
