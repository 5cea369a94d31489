from __future__ import annotations

import json

import pytest

from adtrail.functions.payload import ConnectorMissing
from adtrail.plans import jobs
from adtrail.registry import (
    BIDS,
    CLICKS,
    CURATED_TABLES,
    DEAD_LETTER_TABLES,
    IMPRESSIONS,
    SOURCES,
    json_sources,
)
from adtrail.sinks.publish import messages, publish
from adtrail.sources.files import csv_with_header, json_arrays
from adtrail.sources.topics import FileTopics, KafkaTopics, read_topics, schema_text

TIME = "2024-06-01T08:00:00Z"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_registry():
    assert CURATED_TABLES == ("ad_impressions", "clicks_conversions", "bid_requests", "attribution")
    assert DEAD_LETTER_TABLES == tuple(f"dead_letter_{n}" for n in CURATED_TABLES[:3])
    assert {s.codec for s in SOURCES.values()} == {"json", "avro"}
    assert {s.codec for s in json_sources().values()} == {"json"}


def test_json_array_file(spark, tmp_path):
    rows = [
        {"ad_creative_id": "1", "user_id": "u1", "timestamp": TIME, "website": "a.test"},
        {"ad_creative_id": 2, "user_id": None, "timestamp": TIME, "other": True},
    ]
    path = write(tmp_path / "in.json", json.dumps(rows, indent=4))
    got = json_arrays(spark, path, IMPRESSIONS)
    assert got.schema == IMPRESSIONS.schema
    assert [tuple(r) for r in got.orderBy("ad_creative_id").collect()] == [
        ("1", "u1", TIME, "a.test"),
        ("2", None, TIME, None),
    ]


def test_bid_file_keeps_the_map(spark, tmp_path):
    rows = [
        {"user_id": "u1", "auction_id": "1", "timestamp": TIME, "targeting_criteria": {"age": "25"}},
        {"user_id": "u2", "auction_id": "2", "timestamp": TIME, "targeting_criteria": {"city": "x"}},
    ]
    got = json_arrays(spark, write(tmp_path / "bids.json", json.dumps(rows)), BIDS)
    assert {r.user_id: r.targeting_criteria for r in got.collect()} == {
        "u1": {"age": "25"},
        "u2": {"city": "x"},
    }


def test_csv_columns_are_found_by_name(spark, tmp_path):
    text = "user_id,extra,timestamp,conversion_type,campaign_id\nu1,9,%s,signup,007\n" % TIME
    got = csv_with_header(spark, write(tmp_path / "c.csv", text), CLICKS)
    assert got.columns == CLICKS.fields
    assert [tuple(r) for r in got.collect()] == [(TIME, "u1", "007", "signup")]


def test_csv_empty_value_is_empty_text_and_missing_value_is_null(spark, tmp_path):
    text = f"timestamp,user_id,campaign_id,conversion_type\n{TIME},,1,signup\n{TIME},u2\n"
    got = csv_with_header(spark, write(tmp_path / "c.csv", text), CLICKS)
    rows = {r.campaign_id: r for r in got.collect()}
    assert rows["1"].user_id == ""
    assert rows[None].user_id == "u2" and rows[None].conversion_type is None


def test_csv_quotes(spark, tmp_path):
    text = 'timestamp,user_id,campaign_id,conversion_type\n"a,b","say ""hi""","","x\ny"\n'
    path = write(tmp_path / "c.csv", text)
    got = csv_with_header(spark, path, CLICKS, line_breaks=True)
    assert [tuple(r) for r in got.collect()] == [("a,b", 'say "hi"', "", "x\ny")]


def test_broken_json_file_fails(spark, tmp_path):
    path = write(tmp_path / "in.json", '[{"user_id": "u1"}, {"user')
    with pytest.raises(Exception, match="(?i)malformed"):
        json_arrays(spark, path, IMPRESSIONS).collect()


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", f"timestamp,user_id,campaign_id,conversion_type\n{TIME},u1,1,x\n")
    write(tmp_path / "in" / "b.csv", f"user_id,timestamp,campaign_id,conversion_type\nu1,{TIME},1,x\n")
    with pytest.raises(Exception, match="header"):
        csv_with_header(spark, str(tmp_path / "in"), CLICKS).collect()


def test_kafka_options():
    topics = KafkaTopics(
        "broker:9092", max_offsets_per_trigger=1000, min_partitions=64, extra={"kafka.x": "y"}
    )
    assert topics.options("bid_requests") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "bid_requests",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
        "kafka.x": "y",
    }


def test_kafka_without_its_package_says_so(spark):
    topics = KafkaTopics("broker:9092")
    df = spark.createDataFrame([("1", "u1", TIME, "a")], IMPRESSIONS.schema)
    for use in (
        lambda: topics.stream(spark, "ad_impressions"),
        lambda: topics.table(spark, "ad_impressions"),
        lambda: publish(df, IMPRESSIONS, topics),
    ):
        with pytest.raises(ConnectorMissing, match="spark-sql-kafka"):
            use()


def test_messages_are_json_text_without_key(spark):
    df = spark.createDataFrame([("1", "ü1", TIME, "a.test")], IMPRESSIONS.schema)
    row = messages(df, IMPRESSIONS).first()
    assert row.key is None
    assert bytes(row.value).decode("utf-8") == (
        '{"ad_creative_id":"1","user_id":"ü1","timestamp":"%s","website":"a.test"}' % TIME
    )


def test_seed_publishes_every_record(spark, tmp_path):
    impressions = [{"ad_creative_id": str(n), "user_id": f"u{n}", "timestamp": TIME} for n in range(5)]
    bids = [
        {"user_id": f"u{n}", "auction_id": str(n), "timestamp": TIME, "targeting_criteria": {"a": "1"}}
        for n in range(4)
    ]
    files = jobs.InputFiles(
        write(tmp_path / "i.json", json.dumps(impressions)),
        write(tmp_path / "c.csv", f"timestamp,user_id,campaign_id,conversion_type\n{TIME},u1,1,x\n"),
        write(tmp_path / "b.json", json.dumps(bids)),
    )
    topics = FileTopics(str(tmp_path / "topics"))
    jobs.seed(spark, files, topics, json_sources())
    logs = read_topics(spark, topics, json_sources())
    assert {name: log.count() for name, log in logs.items()} == {
        "ad_impressions": 5,
        "clicks_conversions": 1,
        "bid_requests": 4,
    }
    places = logs["ad_impressions"].select("partition", "offset").distinct()
    assert places.count() == 5
    bid = logs["bid_requests"].selectExpr("CAST(value AS STRING) AS v").first().v
    assert json.loads(bid)["targeting_criteria"] == {"a": "1"}


def test_appended_log_needs_a_higher_first_offset(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    df = spark.createDataFrame([("1", "u1", TIME, "a")], IMPRESSIONS.schema)
    publish(df, IMPRESSIONS, topics)
    publish(df, IMPRESSIONS, topics, first_offset=1 << 40)
    log = topics.table(spark, "ad_impressions")
    assert log.select("partition", "offset").distinct().count() == 2


def test_schema_text(spark):
    df = spark.createDataFrame([], IMPRESSIONS.schema)
    assert schema_text(df).splitlines()[:2] == ["root", " |-- ad_creative_id: string (nullable = true)"]
