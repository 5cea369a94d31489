"""Advertising topics derived from a generic ``events`` table.

The table has ``event_id, ts, user_id, event_type, value, props``. Views stand
for bid requests, clicks for impressions and purchases for conversions. In
every topic, errors are messages cut off in transit and signups are messages
without a user, so each topic has valid rows and two kinds of invalid ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.registry import BIDS, CLICKS, IMPRESSIONS, SourceSpec

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DAY = "yyyy-MM-dd'T'00:00:00'Z'"
MAIN_TYPE = {BIDS.name: "view", IMPRESSIONS.name: "click", CLICKS.name: "purchase"}
BROKEN, ANONYMOUS = "error", "signup"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a pattern the path may be one file or a folder of files.
    return spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet*")


def records(
    events: DataFrame, spec: SourceSpec, time_format: str = ISO, user: Column | None = None
) -> DataFrame:
    """The records of a source, and the event each comes from."""
    event_id = F.col("event_id").cast("string")
    common = {
        "user_id": F.col("user_id").cast("string") if user is None else user,
        "timestamp": F.date_format("ts", time_format),
    }
    own = {
        BIDS.name: {
            "auction_id": event_id,
            "targeting_criteria": F.from_json("props", "map<string,string>"),
        },
        IMPRESSIONS.name: {"ad_creative_id": event_id, "website": F.col("event_type")},
        CLICKS.name: {"campaign_id": event_id, "conversion_type": F.col("event_type")},
    }[spec.name]
    columns = common | own
    return events.select(
        "event_id", "event_type", "ts", *[columns[f].alias(f) for f in spec.fields]
    )


def valid_side(
    events: DataFrame, spec: SourceSpec, user: Column | None = None, time_format: str = ISO
) -> DataFrame:
    """Clean records of a source with ``event_time``, as a curated table holds them."""
    main = events.filter(F.col("event_type") == MAIN_TYPE[spec.name])
    event_time = F.col("ts").cast("timestamp").alias("event_time")
    return records(main, spec, time_format, user).select(*spec.fields, event_time)


def kinds_of(name: str) -> list[str]:
    """The event types of a source's messages."""
    return [MAIN_TYPE[name], BROKEN, ANONYMOUS]


def topic(
    events: DataFrame, spec: SourceSpec, time_format: str = ISO, named: Column | None = None
) -> DataFrame:
    """The message log of a source, JSON payloads, the event id as offset; ``named`` replaces the user."""
    kinds = kinds_of(spec.name)
    name = F.col("user_id").cast("string") if named is None else named
    user = F.when(F.col("event_type") != ANONYMOUS, name)
    rows = records(events.filter(F.col("event_type").isin(kinds)), spec, time_format, user)
    # A NULL field is left out of the text.
    whole = rows.withColumn("text", F.to_json(F.struct(*spec.fields)))
    cut = F.expr("left(text, length(text) - 1)")
    text = F.when(F.col("event_type") == BROKEN, cut).otherwise(F.col("text"))
    return whole.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(spec.name).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
