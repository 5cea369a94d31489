"""File scans with declared schemas; no type is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions.payload import CORRUPT
from adtrail.registry import SourceSpec


def json_arrays(spark: SparkSession, path: str | list[str], spec: SourceSpec) -> DataFrame:
    """Files that each hold one JSON array, one record per element.

    Such a file cannot be split, so parallelism is the number of files. A file
    that is no JSON fails the read: its records could not be told apart.
    """
    reader = spark.read.schema(spec.schema).option("multiLine", True)
    return reader.option("mode", "FAILFAST").json(path)


def csv_with_header(
    spark: SparkSession, path: str | list[str], spec: SourceSpec, line_breaks: bool = False
) -> DataFrame:
    """Headered CSV, every value a string, columns found by header name.

    The header of one file gives the column order; a file with another header
    fails the read. An empty value is an empty string, a value missing from a
    short line is NULL, a quote inside a quoted value is doubled. Only with
    ``line_breaks`` may a quoted value span lines; a file is then one task.
    """
    options = {"header": True, "escape": '"', "multiLine": line_breaks}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .options(**options)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    whole_line = F.col(CORRUPT).isNull()
    return rows.select(
        *[
            F.when(whole_line, F.coalesce(F.col(name), F.lit(""))).otherwise(F.col(name)).alias(name)
            for name in spec.fields
        ]
    )
