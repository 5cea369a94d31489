"""Split of decoded rows into valid and invalid, with reasons and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.payload import CORRUPT, decode
from adtrail.functions.timing import event_date, event_time
from adtrail.registry import UNDECODABLE, SourceSpec

REASON = "reason"
LOG_COLUMNS = ("raw_value", "topic", "partition", "offset", "ingest_time")
METRIC_NAME = "data_quality"


class DataQualityError(ValueError):
    """Invalid rows were found where none are allowed."""


DEAD_COLUMNS = ["raw_value", "topic", "partition", "offset", REASON, "ingest_time"]


def valid_records(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is TRUE."""
    return df.filter(rule)


def invalid_records(df: DataFrame, rule: Column) -> DataFrame:
    """All other rows: the rule is FALSE or NULL."""
    return df.filter(~F.coalesce(rule, F.lit(False)))


def rule_of(spec: SourceSpec) -> Column:
    """All rules of a source as one condition."""
    return reduce(lambda a, b: a & b, [F.expr(rule.predicate) for rule in spec.rules])


def first_failed(spec: SourceSpec) -> Column:
    """The first rule a row fails, NULL for a valid row."""
    label = F.lit(None).cast("string")
    for rule in reversed(spec.rules):
        passes = F.coalesce(F.expr(rule.predicate), F.lit(False))
        label = F.when(~passes, F.lit(rule.reason)).otherwise(label)
    return label


def decode_log(log: DataFrame, spec: SourceSpec) -> DataFrame:
    """Log rows with the fields of the source, ``event_time`` and a reason.

    The payload is decoded by a generator: Catalyst copies a projected
    expression into every filter above it and would parse each message once
    per rule, and does not push a filter below a generator.
    """
    record = F.struct(decode(F.col("raw_value"), spec).alias("record"))
    decoded = log.select(
        F.col("value").alias("raw_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ingest_time"),
    ).select(*LOG_COLUMNS, F.inline(F.array(record)))
    broken = F.col("record").isNull()
    if spec.codec == "json":
        broken = broken | F.col(f"record.{CORRUPT}").isNotNull()
    rows = decoded.select(
        *LOG_COLUMNS,
        *[F.col(f"record.`{name}`").alias(name) for name in spec.fields],
        broken.alias("broken"),
    )
    failed = first_failed(spec)
    reason = F.when(failed.isNotNull(), F.when(F.col("broken"), UNDECODABLE).otherwise(failed))
    return rows.select(
        *LOG_COLUMNS, *spec.fields, event_time().alias("event_time"), reason.alias(REASON)
    )


def valid_part(decoded: DataFrame, spec: SourceSpec) -> DataFrame:
    """Valid rows of a decoded log, still with their place in the log."""
    return valid_records(decoded, rule_of(spec)).drop(REASON, "raw_value")


def dead_letters(decoded: DataFrame, spec: SourceSpec) -> DataFrame:
    """Invalid rows as they arrived, with the reason."""
    return invalid_records(decoded, rule_of(spec)).select(*DEAD_COLUMNS)


def curated_columns(valid: DataFrame, spec: SourceSpec) -> DataFrame:
    """The columns of a curated table: fields, event time and its date."""
    return valid.select(*spec.fields, "event_time", event_date().alias("event_date"))


def error_counts(dead: dict[str, DataFrame]) -> DataFrame:
    """Invalid rows by source and reason; counted inside each task before the shuffle."""
    tagged = [df.select(F.lit(name).alias("source"), REASON) for name, df in dead.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("source", REASON).agg(
        F.count(F.lit(1)).alias("errors")
    )


def row_counts(decoded: dict[str, DataFrame]) -> DataFrame:
    """Total, valid and invalid rows by source."""
    tagged = [df.select(F.lit(name).alias("source"), REASON) for name, df in decoded.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("source").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(REASON).isNull()).alias("rows_valid"),
        F.count_if(F.col(REASON).isNotNull()).alias("data_quality_errors"),
    )


def check(counts: DataFrame, allowed: int = 0) -> int:
    """Raise if more than ``allowed`` invalid rows were counted, else return their number."""
    total = counts.agg(F.coalesce(F.sum("errors"), F.lit(0)).alias("n")).first()["n"]
    if total > allowed:
        raise DataQualityError(f"data quality errors: {total}")
    return total


def reasons_of(spec: SourceSpec) -> list[str]:
    """All reasons a row of the source can be rejected for."""
    return [UNDECODABLE, *(rule.reason for rule in spec.rules)]


def count_columns(spec: SourceSpec) -> list[Column]:
    """Counts of decoded rows: all, invalid ones, and those by reason."""
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(REASON).isNotNull()).alias("data_quality_errors"),
        *[F.count_if(F.col(REASON) == r).alias(r) for r in reasons_of(spec)],
    ]


def observed(decoded: DataFrame, spec: SourceSpec) -> DataFrame:
    """Count rows while they pass, for batch writes and for streams that keep no counts."""
    return decoded.observe(f"{METRIC_NAME}_{spec.name}", *count_columns(spec))
