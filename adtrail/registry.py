"""What the library knows about each source: schema, codec, rules, keys, tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Field names, codecs and rules of the three record kinds.
IMPRESSION_SCHEMA = T.StructType(
    [
        T.StructField("ad_creative_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("website", T.StringType()),
    ]
)
CLICK_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("conversion_type", T.StringType()),
    ]
)
BID_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("auction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("targeting_criteria", T.MapType(T.StringType(), T.StringType())),
    ]
)
BID_AVRO_SCHEMA = (
    '{"type": "record", "name": "BidRequest", "fields": ['
    '{"name": "user_id", "type": "string"}, '
    '{"name": "auction_id", "type": "string"}, '
    '{"name": "timestamp", "type": "string"}, '
    '{"name": "targeting_criteria", "type": {"type": "map", "values": "string"}}]}'
)

# Columns of a message log, as the Kafka source names them.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

ATTRIBUTION_TABLE = "attribution"
# Attribution of users too busy for the stream, written by batch runs.
BUSY_ATTRIBUTION_TABLE = "attribution_busy"
#: Days attributed again because rows came late, in place of the stream's.
LATE_ATTRIBUTION_TABLE = "attribution_late"


@dataclass(frozen=True)
class Rule:
    """A row passes when ``predicate`` (a SQL expression on its fields) is TRUE."""

    reason: str
    predicate: str


@dataclass(frozen=True)
class SourceSpec:
    """One topic with its curated and dead-letter tables."""

    name: str
    schema: T.StructType
    rules: tuple[Rule, ...]
    codec: str = "json"
    avro_schema: str | None = None
    dedup_keys: tuple[str, ...] = ("user_id", "timestamp")

    @property
    def table(self) -> str:
        return self.name

    @property
    def dead_letter_table(self) -> str:
        return f"dead_letter_{self.name}"

    @property
    def fields(self) -> list[str]:
        return self.schema.fieldNames()

    def with_codec(self, codec: str) -> "SourceSpec":
        return replace(self, codec=codec)

    def with_event_time(self) -> "SourceSpec":
        """Also reject rows whose timestamp does not parse; streams need this."""
        if any(rule.reason == BAD_TIMESTAMP.reason for rule in self.rules):
            return self
        return replace(self, rules=self.rules + (BAD_TIMESTAMP,))


HAS_USER = Rule("missing_user_id", "user_id IS NOT NULL")
HAS_CREATIVE = Rule("missing_ad_creative_id", "ad_creative_id IS NOT NULL")
BAD_TIMESTAMP = Rule("bad_timestamp", "try_to_timestamp(`timestamp`) IS NOT NULL")
UNDECODABLE = "undecodable"

IMPRESSIONS = SourceSpec("ad_impressions", IMPRESSION_SCHEMA, (HAS_USER, HAS_CREATIVE))
CLICKS = SourceSpec("clicks_conversions", CLICK_SCHEMA, (HAS_USER,))
BIDS = SourceSpec(
    "bid_requests", BID_SCHEMA, (HAS_USER,), codec="avro", avro_schema=BID_AVRO_SCHEMA
)

SOURCES: dict[str, SourceSpec] = {spec.name: spec for spec in (IMPRESSIONS, CLICKS, BIDS)}
CURATED_TABLES: tuple[str, ...] = (*SOURCES, ATTRIBUTION_TABLE)
DEAD_LETTER_TABLES: tuple[str, ...] = tuple(s.dead_letter_table for s in SOURCES.values())


def json_sources() -> dict[str, SourceSpec]:
    """The registry with every topic in JSON, for clusters without spark-avro."""
    return {name: spec.with_codec("json") for name, spec in SOURCES.items()}
