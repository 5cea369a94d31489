"""Large JSON arrays, each read by as many tasks as its bytes need.

A file is cut at every closing brace, which the text reader does in byte ranges. A cut
may lie inside a string or a nested object, and a range does not know how it began. So
each range is summed up twice, once for a start inside a string and once outside of one:
its quotes, its braces, and where the nesting is least. Running sums over the ranges of a
file tell which of the two holds and where the last record before each range ended. Then
the pieces up to the first end in a range go to the range their record began in, and every
range cuts its own records, which start from a known state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.registry import SourceSpec
from adtrail.session import work_folder

RANGE = ["file", "range"]
#: Ranges up to which their summary, some 100 bytes each, goes to every task.
MAX_RANGES = 500_000
#: The owner of the pieces before the first end of a file.
BEGIN = -1
NO_ARRAY = "not one JSON array of objects: "


def split_json_arrays(spark: SparkSession, path: str | list[str], spec: SourceSpec) -> DataFrame:
    """The records of files that hold one JSON array of objects each, as ``json_arrays`` gives them.

    ``spark.sql.files.maxPartitionBytes`` bounds a task's range. A file that is no such
    array fails the read; an empty file has no records. The pieces are written to the
    work folder once, so the ranges are the same however often they are read.
    """
    folder = work_folder(spark, "json-splits")
    _pieces(spark, path).write.parquet(f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    _ranges(pieces).write.parquet(f"{folder}/ranges")
    ranges = spark.read.parquet(f"{folder}/ranges")
    broken = ranges.where("broken").select("file").first()
    if broken is not None:
        raise ValueError(NO_ARRAY + broken["file"])
    if ranges.count() <= MAX_RANGES:
        ranges = F.broadcast(ranges)
    record = F.from_json("text", spec.schema, {"mode": "FAILFAST"})
    # A generator decodes once; a projection would once per field.
    return _record_texts(pieces, ranges).select(F.inline(F.array(record)))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing braces, its quotes, and its opening braces outside of strings.

    An escape never goes over a cut, as none ends in a brace.
    """
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    return (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("n"),
            "value",
            _count(plain, '"').alias("quotes"),
            _count(_outside(plain), "{").alias("opens_outside"),
            _count(_outside(F.concat(F.lit('"'), plain)), "{").alias("opens_inside"),
        )
    )


def _outside(text: Column) -> Column:
    """What is in no string, of a text that begins outside of one."""
    return F.regexp_replace(text, r'"[^"]*("|\z)', "")


def _count(text: Column, sign: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))


def _nesting(inside: Column) -> Column:
    """By how much a piece and the brace after it change the nesting; ``inside``: it begins in a string."""
    ends_inside = (F.col("quotes") + inside.cast("int")) % 2 == 1
    opens = F.when(inside, F.col("opens_inside")).otherwise(F.col("opens_outside"))
    return opens - F.when(ends_inside, 0).otherwise(1)


def _ranges(pieces: DataFrame) -> DataFrame:
    """``file, range, first_end`` (a piece), ``owner`` of the pieces up to it, ``broken``.

    The last piece of a range is kept apart: in the last range of a file it is what
    follows the last record, and the brace after it is none.
    """
    order = Window.partitionBy(*RANGE).orderBy("n")
    quotes_before = F.sum("quotes").over(order) - F.col("quotes")
    rows = pieces.drop("value").withColumns(
        {"odd": quotes_before % 2 == 1, "last": F.lead("n").over(order).isNull()}
    )
    rows = rows.withColumns(
        {
            "outside": F.sum(_nesting(F.col("odd"))).over(order),
            "inside": F.sum(_nesting(~F.col("odd"))).over(order),
        }
    )
    summary = [F.sum("quotes").alias("quotes"), F.max("n").alias("last_n")]
    for start in ("outside", "inside"):
        level = F.when(~F.col("last"), F.col(start))
        least = F.max(F.struct((-level).alias("low"), (-F.col("n")).alias("first")))
        summary += [
            F.max(F.when(F.col("last"), F.col(start))).alias(f"{start}_last"),
            F.struct((-least["low"]).alias("low"), (-least["first"]).alias("first")).alias(start),
        ]
    ranges = rows.groupBy(*RANGE).agg(*summary)

    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts_inside = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    ranges = ranges.withColumn("starts_inside", starts_inside)
    chosen = {
        name: F.when(F.col("starts_inside"), F.col(f"inside{part}")).otherwise(F.col(f"outside{part}"))
        for name, part in (("low", ".low"), ("first", ".first"), ("change", "_last"))
    }
    ranges = ranges.select(*RANGE, "quotes", "last_n", "starts_inside", *[c.alias(n) for n, c in chosen.items()])
    ranges = ranges.withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    ranges = ranges.withColumns(
        {
            "final": F.lead("range").over(Window.partitionBy("file").orderBy("range")).isNull(),
            "low": F.col("low") + F.col("depth"),
            "end_depth": F.col("change") + F.col("depth"),
        }
    )
    first_end = F.when(F.col("low") == 0, F.col("first")).when(F.col("end_depth") == 0, F.col("last_n"))
    ends_inside = (F.col("quotes") + F.col("starts_inside").cast("int")) % 2 == 1
    broken = (
        F.coalesce(F.col("low") < 0, F.lit(False))
        | (F.col("final") & ((F.col("end_depth") != -1) | ends_inside))
        | (~F.col("final") & (F.col("end_depth") < 0))
    )
    ranges = ranges.select(*RANGE, first_end.alias("first_end"), broken.alias("broken"))
    owner = F.last(F.when(F.col("first_end").isNotNull(), F.col("range")), ignorenulls=True).over(earlier)
    return ranges.withColumn("owner", F.coalesce(owner, F.lit(BEGIN).cast("long")))


def _record_texts(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """``text`` of each record. A range and the rest of its last record are one group."""
    own = F.when(F.col("n") > F.col("first_end"), F.col("range")).otherwise(F.col("owner"))
    rows = pieces.join(ranges, RANGE).withColumn("owner", own)
    order = Window.partitionBy("file", "owner").orderBy("range", "n")
    odd = (F.sum("quotes").over(order) - F.col("quotes")) % 2 == 1
    rows = rows.withColumn("odd", odd).withColumn("depth", F.sum(_nesting(F.col("odd"))).over(order))
    is_end = (F.col("depth") == 0).cast("int")
    rows = rows.withColumn("record", F.sum(is_end).over(order) - is_end)
    parts = F.array_sort(F.collect_list(F.struct("range", "n", "value")))
    texts = rows.groupBy("file", "owner", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "}").alias("text"),
        (F.min("depth") < 0).alias("rest"),
    )
    begins = (F.col("owner") == BEGIN) & (F.col("record") == 0)
    shape = (
        F.when(begins & F.col("rest"), F.lit(r"^\uFEFF?\s*\[\s*\]\s*$"))
        .when(F.col("rest"), F.lit(r"^\s*\]\s*$"))
        .when(begins, F.lit(r"^\uFEFF?\s*\[\s*\{"))
        .otherwise(F.lit(r"^\s*,\s*\{"))
    )
    good = F.regexp(F.col("text"), shape)
    body = F.concat(F.regexp_replace("text", r"^[^{]*", ""), F.lit("}"))
    checked = F.when(good, body).otherwise(F.raise_error(F.concat(F.lit(NO_ARRAY), "file")))
    return texts.where(~F.col("rest") | ~good).select(checked.alias("text"))
