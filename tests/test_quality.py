from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtrail.functions.payload import ConnectorMissing, avro_available, decode, from_json
from adtrail.operators import quality
from adtrail.plans.ingest import ingest
from adtrail.registry import BIDS, CLICKS, IMPRESSIONS

JSON_BIDS = BIDS.with_codec("json")

# payload, reason (None for a valid row), decoded creative
IMPRESSION_CASES = [
    ("{bad", "undecodable", None),
    ('"2024-05-31T12:00:00Z,abc,456,signup"', "undecodable", None),
    ('[{"user_id":"u9"}]', "undecodable", None),
    (None, "undecodable", None),
    ("", "undecodable", None),
    ("{}", "missing_user_id", None),
    ('{"user_id":null,"ad_creative_id":"1"}', "missing_user_id", "1"),
    ('{"user_id":"u1"}', "missing_ad_creative_id", None),
    ('{"ad_creative_id":"1"}', "missing_user_id", "1"),
    ('{"ad_creative_id":"1","user_id":""}', None, "1"),
    ('{"ad_creative_id":5,"user_id":"u1"}', None, "5"),
    ('{"ad_creative_id":"7","user_id":"u1","extra":1}', None, "7"),
]


def test_reason_of_every_edge_payload(log):
    decoded = quality.decode_log(log([case[0] for case in IMPRESSION_CASES]), IMPRESSIONS)
    rows = decoded.orderBy("offset").select("reason", "ad_creative_id").collect()
    assert [(r.reason, r.ad_creative_id) for r in rows] == [c[1:] for c in IMPRESSION_CASES]


def test_text_without_a_closing_brace_is_not_parsed(log):
    """And comes out as the parser would have it, as does other text that was cut off."""
    texts = ["", " ", "null", "[]", "5", "{", '{"user_id":"u1","ad_creative_id":"1"', "\x00", '"a}', "}", "{}}", '{"user_id":"u"}x', None]
    texts += ['{"user_id":{"a":"b"}', '{"user_id":"u","ad_creative_id":"}"', '{"ad_creative_id":"1","user_id":"u"} {']
    parsed = [r[0] for r in log(texts).select(from_json("value", IMPRESSIONS.schema)).collect()]
    decoded = [r[0] for r in log(texts).select(decode("value", IMPRESSIONS)).collect()]

    def seen(record):
        broken = record is None or record["_corrupt_record"] is not None
        return broken, *(None if record is None else record[name] for name in IMPRESSIONS.fields)

    assert list(map(seen, decoded)) == list(map(seen, parsed)) and len(parsed) == len(texts)
    skipped = [t for t, d, p in zip(texts, decoded, parsed) if d is None and p is not None]
    assert skipped == ["null", "[]", "5", "{", '{"user_id":"u1","ad_creative_id":"1"', "\x00"]


def test_parts_are_disjoint_and_whole(log):
    decoded = quality.decode_log(log([case[0] for case in IMPRESSION_CASES]), IMPRESSIONS)
    valid = {r.offset for r in quality.valid_part(decoded, IMPRESSIONS).collect()}
    dead = {r.offset for r in quality.dead_letters(decoded, IMPRESSIONS).collect()}
    assert valid == {9, 10, 11}
    assert dead == set(range(9))


def test_dead_letters_keep_the_payload(log):
    dead = ingest(log(["{bad"]), IMPRESSIONS).invalid.first()
    assert bytes(dead.raw_value) == b"{bad"
    assert (dead.topic, dead.partition, dead.offset) == ("ad_impressions", 0, 0)
    assert dead.ingest_time is not None


@settings(max_examples=15)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.text(max_size=8),
            st.fixed_dictionaries(
                {},
                optional={
                    "user_id": st.one_of(st.none(), st.sampled_from(["", "u1", "u2"])),
                    "ad_creative_id": st.one_of(st.none(), st.integers(0, 3)),
                    "timestamp": st.sampled_from(["2024-05-31T12:00:00Z", "never"]),
                },
            ).map(json.dumps),
        ),
        max_size=12,
    )
)
def test_split_loses_and_doubles_nothing(log, payloads):
    decoded = quality.decode_log(log(payloads), IMPRESSIONS)
    valid = [r.offset for r in quality.valid_part(decoded, IMPRESSIONS).collect()]
    dead = [r.offset for r in quality.dead_letters(decoded, IMPRESSIONS).collect()]
    assert sorted(valid + dead) == list(range(len(payloads)))
    reasons = {r.offset: r.reason for r in decoded.collect()}
    assert all(reasons[o] is None for o in valid)
    assert all(reasons[o] is not None for o in dead)


def test_null_condition_counts_as_invalid(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    rule = F.col("v") > 0
    assert [r.v for r in quality.valid_records(df, rule).collect()] == [1]
    assert {r.v for r in quality.invalid_records(df, rule).collect()} == {None, -1}


def test_clicks_and_bids_need_a_user_only(log):
    payloads = ['{"user_id":"u1"}', '{"campaign_id":"1"}']
    for spec in (CLICKS, JSON_BIDS):
        result = ingest(log(payloads, spec.name), spec)
        assert [r.user_id for r in result.valid.collect()] == ["u1"]
        assert [r.reason for r in result.invalid.collect()] == ["missing_user_id"]


def test_bid_map_is_decoded(log):
    row = ingest(
        log(['{"user_id":"u1","auction_id":"1","targeting_criteria":{"age":"25","n":3}}']), JSON_BIDS
    ).valid.first()
    assert row.targeting_criteria == {"age": "25", "n": "3"}


def test_bad_timestamp_is_a_rule_with_event_time_only(log):
    payloads = ['{"user_id":"u1","timestamp":"never"}', '{"user_id":"u2"}']
    assert ingest(log(payloads), CLICKS).valid.count() == 2
    timed = ingest(log(payloads), CLICKS.with_event_time())
    assert timed.valid.count() == 0
    assert {r.reason for r in timed.invalid.collect()} == {"bad_timestamp"}


def test_payload_is_decoded_once(log):
    """A filter must not be pushed through the decode: it would parse again per rule."""
    decoded = quality.decode_log(log(["{}"]), IMPRESSIONS)
    for part in (quality.valid_part, quality.dead_letters):
        plan = part(decoded, IMPRESSIONS)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1


def test_counts_by_reason_and_check(log):
    decoded = quality.decode_log(log([case[0] for case in IMPRESSION_CASES]), IMPRESSIONS)
    counts = quality.error_counts({"ad_impressions": quality.dead_letters(decoded, IMPRESSIONS)})
    assert {(r.source, r.reason, r.errors) for r in counts.collect()} == {
        ("ad_impressions", "undecodable", 5),
        ("ad_impressions", "missing_user_id", 3),
        ("ad_impressions", "missing_ad_creative_id", 1),
    }
    with pytest.raises(quality.DataQualityError, match="9"):
        quality.check(counts)
    assert quality.check(counts, allowed=9) == 9
    totals = quality.row_counts({"ad_impressions": decoded}).first()
    assert (totals.rows_read, totals.rows_valid, totals.data_quality_errors) == (12, 3, 9)


def test_avro_needs_its_package(log):
    if avro_available():
        pytest.skip("spark-avro is on the class path")
    with pytest.raises(ConnectorMissing, match="spark-avro"):
        ingest(log(["{}"]), BIDS)


def test_avro_round_trip(spark):
    if not avro_available():
        pytest.skip("needs spark-avro")
    from adtrail.sinks.publish import messages
    from adtrail.functions.payload import from_avro

    bids = spark.createDataFrame([("u1", "201", "2024-05-31T12:00:00Z", {"age": "25"})], BIDS.schema)
    back = messages(bids, BIDS).select(from_avro("value", BIDS.avro_schema).alias("b")).select("b.*")
    assert back.collect() == bids.collect()
