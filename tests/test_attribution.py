from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtrail.operators import attribution, skew
from adtrail.registry import BID_SCHEMA, CLICK_SCHEMA, IMPRESSION_SCHEMA

START = datetime(2024, 5, 31, 12, tzinfo=timezone.utc)
HOUR = timedelta(hours=1)


def stamp(minutes: float) -> str:
    return (START + timedelta(minutes=minutes)).isoformat()


def frames(spark, bids, impressions, clicks):
    """(user, minute) per side; the position is the id."""
    b = [(u, f"a{n}", stamp(m), {"age": str(n)}) for n, (u, m) in enumerate(bids)]
    i = [(f"c{n}", u, stamp(m), "site") for n, (u, m) in enumerate(impressions)]
    c = [(stamp(m), u, f"p{n}", "signup") for n, (u, m) in enumerate(clicks)]
    made = [
        spark.createDataFrame(rows, schema)
        for rows, schema in ((b, BID_SCHEMA), (i, IMPRESSION_SCHEMA), (c, CLICK_SCHEMA))
    ]
    return [df.withColumn("event_time", F.try_to_timestamp("timestamp")) for df in made]


def expected(bids, impressions, clicks, window=None):
    """Nested loops over the ids; ``window`` in minutes per side."""
    found = Counter()
    for bn, (bu, bm) in enumerate(bids):
        shown = [
            (n, m)
            for n, (u, m) in enumerate(impressions)
            if u == bu and (window is None or bm <= m <= bm + window[0])
        ]
        for n, m in shown or [(None, None)]:
            clicked = [
                k
                for k, (u, cm) in enumerate(clicks)
                if n is not None and u == bu and (window is None or m <= cm <= m + window[1])
            ]
            for k in clicked or [None]:
                found[(f"a{bn}", n if n is None else f"c{n}", k if k is None else f"p{k}")] += 1
    return found


def result(flat):
    return Counter(
        (r.auction_id, r.ad_creative_id, r.campaign_id)
        for r in flat.select("auction_id", "ad_creative_id", "campaign_id").collect()
    )


FAN_OUT = (
    [("u1", 0), ("u1", 1), ("u2", 0), ("u3", 0)],
    [("u1", 2), ("u1", 3), ("u1", 4), ("u3", 5)],
    [("u1", 6), ("u1", 7), ("u2", 1), ("u9", 1)],
)


def test_all_combinations_of_a_user(spark):
    flat = attribution.attribute_by_user(*frames(spark, *FAN_OUT))
    got = result(flat)
    assert got == expected(*FAN_OUT)
    assert sum(n for (a, _, _), n in got.items() if a in ("a0", "a1")) == 12


def test_bid_with_click_but_no_impression_gets_no_click(spark):
    row = [
        r
        for r in attribution.attribute_by_user(*frames(spark, *FAN_OUT)).collect()
        if r.user_id == "u2"
    ]
    assert len(row) == 1 and row[0].ad_creative_id is None and row[0].campaign_id is None


def test_nested_record(spark):
    flat = attribution.attribute_by_user(*frames(spark, *FAN_OUT))
    record = attribution.nested(flat).filter("user_id = 'u2'").first()
    assert record.bid_requests.asDict() == {
        "auction_id": "a2",
        "targeting_criteria": {"age": "2"},
        "timestamp": stamp(0),
    }
    # A side without a partner is a struct of NULLs and not NULL.
    assert record.ad_impressions is not None and record.ad_impressions.ad_creative_id is None
    assert record.clicks_conversions is not None
    assert attribution.nested(flat).columns == [
        "user_id",
        "bid_requests",
        "ad_impressions",
        "clicks_conversions",
    ]
    from_impression = attribution.nested(flat, reference_user_id=True)
    users = {r.bid_requests.auction_id: r.user_id for r in from_impression.collect()}
    assert users["a2"] is None and users["a3"] == "u3"


def test_key_of_the_second_join_changes_nothing(spark):
    """Joining clicks on the impression's user gives the same rows."""
    b, i, c = frames(spark, *FAN_OUT)
    b, i, c = (df.drop("event_time") for df in (b, i, c))
    first = attribution.join_impressions(b, i)
    literal = first.join(
        c.alias("clicks"), F.col("ad_impressions.user_id") == F.col("clicks.user_id"), "left"
    ).select("auction_id", "ad_creative_id", "campaign_id")
    assert result(literal) == result(attribution.attribute_by_user(b, i, c))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_exchanges_for_two_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = frames(spark, *FAN_OUT)
        for flat in (
            attribution.attribute_by_user(*sides),
            attribution.attribute_by_interval(*sides, HOUR, HOUR),
        ):
            plan = plan_of(flat)
            assert plan.count("Exchange hashpartitioning") == 3
            assert plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SHAPES = {
    "bids": (300, 4, 3),
    "impressions": (3, 300, 2),
    "clicks": (2, 3, 300),
    "all": (25, 25, 25),
    "bids_only": (400, 0, 0),
    "bids_and_clicks": (200, 0, 200),
    "no_clicks": (40, 60, 0),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_hot_user_is_split_and_whole(spark, shape):
    nb, ni, nc = SHAPES[shape]
    cold = [(f"u{n}", n) for n in range(12)]
    data = (
        [("hot", n) for n in range(nb)] + cold,
        [("hot", n) for n in range(ni)] + cold[::2],
        [("hot", n) for n in range(nc)] + cold[::3],
    )
    sides = frames(spark, *data)
    hot = attribution.find_hot_users(*sides, tasks=8)
    assert [r.user_id for r in hot.collect()] == ["hot"]
    flat = attribution.attribute_by_user(*sides, hot, tasks=8)
    assert result(flat) == expected(*data)
    per_task = flat.filter("user_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 2


def test_no_group_is_hot_in_even_data(spark):
    even = [(f"u{n % 50}", n) for n in range(200)]
    assert attribution.find_hot_users(*frames(spark, even, even, even), tasks=8) is None
    nothing = frames(spark, [], [], [])
    assert attribution.find_hot_users(*nothing) is None


@settings(max_examples=60)
@given(
    st.integers(0, 10**9), st.integers(0, 10**9), st.integers(0, 10**9), st.floats(2.0, 4000.0)
)
def test_grid_stays_within_its_bounds(nb, ni, nc, cells):
    splits = skew.grid(nb, ni, nc, cells)
    for pieces, rows in zip(splits, (nb, ni, nc)):
        assert 1 <= pieces <= max(rows, 1)
    assert splits[0] * splits[1] * splits[2] <= 8 * cells + 8


def test_interval_bounds_are_inclusive(spark):
    data = (
        [("u1", 0)],
        [("u1", 0), ("u1", 60), ("u1", 60.01), ("u1", -0.01)],
        [("u1", 60), ("u1", 120), ("u1", 120.5), ("u1", -5)],
    )
    flat = attribution.attribute_by_interval(*frames(spark, *data), HOUR, HOUR)
    assert result(flat) == expected(*data, window=(60, 60))
    assert result(flat)[("a0", "c1", "p1")] == 1


def test_impression_after_the_window_is_unmatched(spark):
    data = ([("u1", 0)], [("u1", 120)], [("u1", 121)])
    sides = frames(spark, *data)
    interval = attribution.attribute_by_interval(*sides, HOUR, HOUR)
    assert result(interval) == Counter({("a0", None, None): 1})
    assert result(attribution.attribute_by_user(*sides)) == Counter({("a0", "c0", "p0"): 1})


events = st.lists(
    st.tuples(st.sampled_from(["u1", "u2"]), st.integers(-300, 300)), max_size=14, unique=True
)


@settings(max_examples=10)
@given(events, events, events, st.integers(1, 90), st.integers(1, 90), st.sampled_from([1, 2, 4]))
def test_buckets_lose_and_double_nothing(spark, bids, imps, clicks, w1, w2, factor):
    windows = (timedelta(minutes=w1), timedelta(minutes=w2))
    sides = frames(spark, bids, imps, clicks)
    flat = attribution.attribute_by_interval(*sides, *windows, bucket_factor=factor)
    assert result(flat) == expected(bids, imps, clicks, (w1, w2))


def test_buckets_before_1970_and_far_ahead(spark):
    for years in (-100, 7900):
        minute = years * 365 * 24 * 60
        data = ([("u1", minute + n) for n in range(9)], [("u1", minute + 7)], [("u1", minute + 8)])
        window = timedelta(minutes=3)
        flat = attribution.attribute_by_interval(
            *frames(spark, *data), window, window, bucket_factor=1
        )
        assert result(flat) == expected(*data, window=(3, 3))


INTERVAL_SHAPES = {
    "bids": (300, 5, 4),
    "impressions": (4, 300, 5),
    "clicks": (4, 5, 300),
    "all": (40, 40, 40),
    "bids_only": (300, 0, 0),
}


@pytest.mark.parametrize("slots", [1_000_000, 0])
@pytest.mark.parametrize("shape", INTERVAL_SHAPES)
def test_hot_interval_is_split_and_whole(spark, monkeypatch, shape, slots):
    monkeypatch.setattr(attribution, "MAX_SLOTS", slots)
    cold = [(f"u{n}", n * 7) for n in range(20)]
    data = [
        [("hot", n * 37 / rows) for n in range(rows)] + cold for rows in INTERVAL_SHAPES[shape]
    ]
    sides = frames(spark, *data)
    windows = (timedelta(minutes=4), timedelta(minutes=6))
    hot = attribution.find_hot_intervals(*sides, *windows, tasks=8)
    assert {r.user_id for r in hot.collect()} == {"hot"}
    flat = attribution.attribute_by_interval(*sides, *windows, hot)
    assert result(flat) == expected(*data, window=(4, 6))


@settings(max_examples=6)
@given(
    events,
    events,
    events,
    st.integers(1, 90),
    st.integers(1, 90),
    st.tuples(*[st.integers(1, 3)] * 3),
)
def test_any_grid_keeps_the_result(spark, bids, imps, clicks, w1, w2, splits):
    """Also for groups that are not hot, with any number of pieces per axis."""
    windows = (timedelta(minutes=w1), timedelta(minutes=w2))
    sides = frames(spark, bids, imps, clicks)
    width = 4 * (w1 + w2) * 60_000_000
    columns = "s_bids int, s_impressions int, s_clicks int, any_impressions boolean, any_clicks boolean"
    first = int(START.timestamp()) * 1_000_000
    buckets = {(first + m * 60_000_000) // width for m in range(-400, 400)}
    rows = [(u, k, *splits, True, True) for u in ("u1", "u2") for k in buckets]
    hot = spark.createDataFrame(rows, "user_id string, time_bucket bigint, " + columns)
    flat = attribution.attribute_by_interval(*sides, *windows, hot)
    assert result(flat) == expected(bids, imps, clicks, (w1, w2))
    shown, clicked = {u for u, _ in imps}, {u for u, _ in clicks}
    users = [(u, *splits, u in shown, u in clicked) for u in ("u1", "u2")]
    hot = spark.createDataFrame(users, "user_id string, " + columns)
    assert result(attribution.attribute_by_user(*sides, hot)) == expected(bids, imps, clicks)
    pairs = attribution.join_impressions(*sides[:2], hot).withColumn("campaign_id", F.lit(None))
    assert result(pairs) == expected(bids, imps, [])


def test_clicks_in_blocks_are_all_compared(spark, monkeypatch):
    """More clicks than a block has, several at one time, at and beyond both bounds, and none for one bid."""
    monkeypatch.setattr(attribution, "BLOCK", 3)
    clicks = [("u1", m / 2) for m in range(40)] + [("u1", 5)] * 4 + [("u1", 16)] * 7
    data = ([("u1", 0), ("u1", 3), ("u1", 500)], [("u1", 5), ("u1", 6), ("u1", 501)], clicks)
    windows = (timedelta(minutes=5), timedelta(minutes=11))
    sides = frames(spark, *data)
    assert attribution._blocks(sides[2], ["user_id"], windows[1]).count() > len(clicks) // 3
    assert result(attribution.attribute_by_interval(*sides, *windows)) == expected(*data, window=(5, 11))


def test_blocks_of_a_stream_hold_every_click_once(spark, monkeypatch):
    """Made in Arrow batches: users, buckets and cells apart, short in time and in rows, NULLs kept."""
    monkeypatch.setattr(attribution, "BLOCK", 3)
    clicks = [("u1", m / 2) for m in range(40)] + [("u2", 5)] * 7 + [("u3", m) for m in (1, 9, 300)]
    window = timedelta(minutes=8)
    side = frames(spark, [], [], clicks)[2].withColumn("conversion_type", F.lit(None).cast("string"))
    side = side.withColumn("time_bucket", F.lit(1)).repartition(2, "user_id")
    blocks = attribution._stream_blocks(side, ["user_id", "time_bucket"], window).collect()
    assert all(1 <= len(b.clicks) <= 3 for b in blocks) and 20 < len(blocks) < len(clicks) * 2 // 3
    for b in blocks:
        times = [c.event_time for c in b.clicks]
        assert b.first == min(times) and b.event_time == max(times)
        assert b.event_time - b.first <= attribution.block_length(window) and b.time_bucket == 1
    held = Counter((b.user_id, c.campaign_id, c.timestamp, c.conversion_type) for b in blocks for c in b.clicks)
    assert held == Counter((u, f"p{n}", stamp(m), None) for n, (u, m) in enumerate(clicks))


def test_blocks_are_few_rows_until_opened(spark):
    """What a table of busy users shuffles by date: rows per block of clicks, not per click."""
    data = [[("u1", n / 10) for n in range(20)]] * 3
    windows = (timedelta(minutes=5), timedelta(minutes=11))
    blocks = attribution.blocks_by_interval(*frames(spark, *data), *windows)
    whole = expected(*data, window=(5, 11))
    assert blocks.count() < sum(whole.values()) / 4
    flat = attribution.opened_blocks(blocks.withColumn("kept", F.lit(1)), windows[1], "kept")
    assert result(flat) == whole and "kept" in flat.columns


def test_interval_joins_have_tasks_by_their_output(spark, monkeypatch):
    """Adaptive execution would merge them by their input; no time is found by the calendar."""
    monkeypatch.setattr(attribution, "TASK_ROWS", 10)
    sides = frames(spark, *[[("u1", n / 10) for n in range(30)]] * 3)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = attribution.interval_tasks(*sides, HOUR, HOUR)
    assert tasks > width
    flat = attribution.attribute_by_interval(*sides, HOUR, HOUR, tasks=tasks)
    assert flat.rdd.getNumPartitions() == tasks
    assert "INTERVAL" not in plan_of(flat)


def test_bid_without_time_is_kept_unmatched(spark):
    b, i, c = frames(spark, [("u1", 0)], [("u1", 1)], [("u1", 2)])
    b = b.withColumn("event_time", F.lit(None).cast("timestamp"))
    flat = attribution.attribute_by_interval(b, i, c, HOUR, HOUR)
    assert result(flat) == Counter({("a0", None, None): 1})
