"""Bulk publish: one distributed write of encoded records to a topic."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.payload import ConnectorMissing, encode
from adtrail.registry import SourceSpec
from adtrail.sources.topics import FileTopics, KafkaTopics, Topics


def messages(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Each record as one message: JSON text in UTF-8 or a bare Avro datum, without key."""
    return df.select(F.lit(None).cast("binary").alias("key"), encode(spec).alias("value"))


def publish(df: DataFrame, spec: SourceSpec, topics: Topics, first_offset: int = 0) -> None:
    """Append the records to the topic of the source."""
    encoded = messages(df, spec)
    if isinstance(topics, KafkaTopics):
        _publish_to_kafka(encoded, spec.name, topics)
    else:
        append_to_log(encoded, spec.name, topics, first_offset)


def append_to_log(
    encoded: DataFrame, topic: str, topics: FileTopics, first_offset: int = 0
) -> None:
    """Append messages to a file log.

    The task is the partition and counts its offsets from ``first_offset``: a
    log that is appended to again needs a higher one each time.
    """
    row = F.monotonically_increasing_id()
    encoded.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        (row.bitwiseAND(F.lit((1 << 33) - 1)) + first_offset).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).write.mode("append").parquet(topics.path(topic))


def _publish_to_kafka(encoded: DataFrame, topic: str, topics: KafkaTopics) -> None:
    writer = (
        encoded.write.format("kafka")
        .option("kafka.bootstrap.servers", topics.bootstrap_servers)
        .option("topic", topic)
    )
    try:
        writer.save()
    except AnalysisException as error:
        if "Failed to find data source: kafka" not in str(error):
            raise
        raise ConnectorMissing("publishing needs the spark-sql-kafka-0-10 package") from error
