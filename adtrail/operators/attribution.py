"""Attribution: bids, the impressions they led to, and the clicks after those."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions.timing import interval, micros
from adtrail.operators import skew

USER = ["user_id"]
BUCKET = "time_bucket"
SLOTS = "slots"
# Slots of all hot groups together up to which they are broadcast: some 50 MB. More are joined by a shuffle.
MAX_SLOTS = 1_000_000
# Clicks that are compared with a pair of bid and impression at once.
BLOCK = 64
# A stream's blocks are no longer than this part of the click window. Its state keeps bids so much longer,
# so streams that began with one number need it to their end.
STREAM_SLOTS = 2
# Rows a task within windows should make: they cost less there than more copies of the events.
TASK_ROWS = 50_000_000

# What tells the rows of one user apart, per source.
BID_IDENTITY = ["auction_id", "timestamp"]
IMPRESSION_IDENTITY = ["ad_creative_id", "website", "timestamp"]
CLICK_IDENTITY = ["campaign_id", "conversion_type", "timestamp"]

# Columns of a flat row before its click.
SHOWN = [
    "impression_user_id",
    "auction_id",
    "targeting_criteria",
    "bid_requests_timestamp",
    "ad_creative_id",
    "website",
    "ad_impressions_timestamp",
]


def join_impressions(
    bids: DataFrame,
    impressions: DataFrame,
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Every bid with each impression of its user, or once with none; batch only.

    ``hot`` comes from ``find_hot_users``.
    """
    return _first_join(bids, impressions, None if hot is None else skew.without_clicks(hot), tasks)


def _first_join(
    bids: DataFrame, impressions: DataFrame, hot: DataFrame | None, tasks: int | None
) -> DataFrame:
    """Bids with impressions, in the cells the join with clicks needs.

    The bids, and so the joins, get a fixed number of tasks: adaptive execution
    would merge tasks by their input, which says little about their output.
    """
    tasks = tasks or int(bids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = USER
    if hot is not None:
        bids = skew.spread_bids(bids, hot, USER, BID_IDENTITY, F.col(skew.ANY_IMPRESSIONS))
        impressions = skew.spread_impressions(
            impressions, hot, USER, IMPRESSION_IDENTITY, F.col(skew.ANY_CLICKS)
        )
        keys = [*USER, skew.CELL]
    b = _named(bids.repartition(tasks, *keys), "bid_requests")
    i = _named(impressions, "ad_impressions")
    joined = b.join(i, _equal("bid_requests", "ad_impressions", keys), "left")
    if hot is not None:
        found = F.col("ad_impressions.user_id").isNotNull()
        joined = joined.filter(found | ~F.col(skew.HAS_IMPRESSION))
    return joined


def attribute_by_user(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """All bid x impression x click combinations of a user, flat; batch only.

    Both joins use the bid's user: a click joins where there is an impression,
    so this equals joining on the impression's user, the first join's
    partitioning is used again and unmatched bids do not share one NULL key.
    """
    keys = USER
    if hot is not None:
        clicks = skew.spread_clicks(clicks, hot, USER, CLICK_IDENTITY)
        keys = [*USER, skew.CELL]
    shown = F.col("ad_impressions.user_id").isNotNull()
    joined = _first_join(bids, impressions, hot, tasks).join(
        _named(clicks, "clicks_conversions"),
        _equal("bid_requests", "clicks_conversions", keys) & shown,
        "left",
    )
    if hot is not None:
        found = F.col("clicks_conversions.user_id").isNotNull()
        joined = joined.filter(found | ~shown | ~F.col(skew.HAS_CLICK))
    return _flat(joined)


def attribute_by_interval(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    hot: DataFrame | None = None,
    bucket_factor: int = 4,
    tasks: int | None = None,
) -> DataFrame:
    """Impressions within a window after the bid, clicks within one after the impression.

    Works on batch frames and on streams; all sides need ``event_time``, on
    streams with a watermark. The join key is the user and a time bucket of
    the bid, ``bucket_factor`` times as wide as both windows: an impression or
    click near the start of a bucket is also placed in the bucket before. A
    user's rows are then compared within a bucket and not over all time, and a
    busy user is spread over buckets. In batch, clicks near in time are compared as one
    block, and the joins get ``tasks`` tasks (see ``interval_tasks``), as in ``_first_join``.

    ``hot`` comes from ``find_hot_intervals``, on streams from
    ``find_hot_users`` over tables of earlier events.
    """
    windows = (impression_window, click_window)
    joined = _join_by_interval(bids, impressions, clicks, *windows, hot, bucket_factor, tasks)
    if bids.isStreaming:
        return _flat(joined, F.col("impression_user_id"))
    return opened_blocks(_shown_blocks(joined), click_window)


def blocks_by_interval(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``attribute_by_interval`` in batch before the clicks of a block are rows of their own.

    These rows may be shuffled once more before ``opened_blocks`` makes the combinations.
    """
    windows = (impression_window, click_window)
    joined = _join_by_interval(bids, impressions, clicks, *windows, hot, tasks=tasks)
    return _shown_blocks(joined)


def stream_blocks_by_interval(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    click_delay: str,
    hot: DataFrame | None = None,
    bucket_factor: int = 4,
) -> DataFrame:
    """``blocks_by_interval`` on streams, for ``opened_blocks``.

    A join looks up each row of the state by itself, so a pair of bid and impression meets blocks of
    clicks in place of clicks. Blocks are made inside each Arrow batch and need no state; where a
    batch has one click of a user it is a block of its own. The watermark of the clicks, which
    must have none yet, follows their last one by ``click_delay``.
    """
    windows = (impression_window, click_window)
    joined = _join_by_interval(
        bids, impressions, clicks, *windows, hot, bucket_factor, click_delay=click_delay
    )
    return _shown_blocks(joined)


def block_length(click_window: timedelta) -> timedelta:
    """How long a block of a stream may be, and how much longer than both windows the stream waits."""
    return click_window / STREAM_SLOTS


def _shown_blocks(joined: DataFrame) -> DataFrame:
    return joined.select("bid_requests.user_id", *SHOWN, "shown_at", "clicks")


def opened_blocks(rows: DataFrame, click_window: timedelta, *others: str) -> DataFrame:
    """All combinations of ``blocks_by_interval`` rows, flat, and columns to keep."""
    click_time = F.col("click.event_time")
    return (
        rows.withColumn("click", F.explode_outer("clicks"))
        .filter(F.col("click").isNull() | _within(click_time, F.col("shown_at"), click_window))
        .select(
            "user_id",
            *SHOWN,
            "click.campaign_id",
            "click.conversion_type",
            F.col("click.timestamp").alias("clicks_conversions_timestamp"),
            *others,
        )
    )


def _join_by_interval(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    hot: DataFrame | None = None,
    bucket_factor: int = 4,
    tasks: int | None = None,
    click_delay: str | None = None,
) -> DataFrame:
    """The joins of ``attribute_by_interval``, in batch and with ``click_delay`` with ``clicks`` as blocks."""
    reach = impression_window + click_window
    width = bucket_factor * micros(reach)
    b, i, c = _bucketed(bids, impressions, clicks, impression_window, click_window, width)
    keys = [*USER, BUCKET]
    if hot is not None:
        b, i, c = _spread_interval(b, i, c, hot, impression_window, click_window, width)
        keys = [*keys, skew.CELL]
    if not bids.isStreaming:
        tasks = tasks or int(bids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        b = b.repartition(tasks, *keys)
        c = _blocks(c.repartition(tasks, *keys), keys, click_window)
    elif click_delay is not None:
        c = _stream_blocks(c, keys, click_window).withWatermark("event_time", click_delay)
    b = _named(b, "bid_requests")
    i = _named(i, "ad_impressions")
    c = _named(c, "clicks_conversions")

    bid_time = F.col("bid_requests.event_time")
    shown_at = F.col("ad_impressions.event_time")
    if bids.isStreaming:  # reads from interval bounds when to drop state
        near = (shown_at >= bid_time) & (shown_at <= bid_time + interval(impression_window))
    else:
        near = _within(shown_at, bid_time, impression_window)
    first = b.join(i, _equal("bid_requests", "ad_impressions", keys) & near, "left")
    if hot is not None:
        found = F.col("ad_impressions.user_id").isNotNull()
        first = first.filter(found | ~F.col(skew.HAS_IMPRESSION))
    # Streams allow one event-time column after a join. It has to be the bid's:
    # an unmatched bid has no impression time and would stay in state for ever.
    # The expression turns the impression's time into an ordinary column.
    first = first.select(
        "bid_requests.*",
        F.col("ad_impressions.user_id").alias("impression_user_id"),
        "ad_creative_id",
        "website",
        "ad_impressions_timestamp",
        (shown_at + interval(timedelta(0)) if bids.isStreaming else shown_at).alias("shown_at"),
        *([] if hot is None else [skew.HAS_CLICK]),
    ).alias("bid_requests")
    shown = F.col("impression_user_id").isNotNull()

    def in_window(time: str) -> Column:
        return _within(F.col(time), F.col("shown_at"), click_window)

    clicked_at = F.col("clicks_conversions.event_time")
    if bids.isStreaming and click_delay is not None:
        clicked = (
            (in_window("first") | in_window("clicks_conversions.event_time"))  # the last one's
            # Implied by the above, as a block is no longer than this; for the state, see below.
            & (clicked_at >= bid_time)
            & (clicked_at <= bid_time + interval(reach + block_length(click_window)))
        )
    elif bids.isStreaming:
        clicked = (
            (clicked_at >= F.col("shown_at"))
            & (clicked_at <= F.col("shown_at") + interval(click_window))
            # Implied by the above; streams need bounds on the bid's time to drop state.
            & (clicked_at >= bid_time)
            & (clicked_at <= bid_time + interval(reach))
        )
    else:  # a block is no longer than the window: one of the two is in it if any click is
        clicked = in_window("first") | in_window("last")
    same = _equal("bid_requests", "clicks_conversions", keys)
    joined = first.join(c, same & shown & clicked, "left")
    if hot is not None:
        found = F.col("clicks_conversions.user_id").isNotNull()
        joined = joined.filter(found | ~shown | ~F.col(skew.HAS_CLICK))
    return joined


def _blocks(clicks: DataFrame, keys: list[str], window: timedelta) -> DataFrame:
    """Arrays of at most ``BLOCK`` clicks of a group, none longer than ``window``, with first and last time.

    The clicks are partitioned by ``keys``, and so are the blocks.
    """
    slot = _bucket(max(1, micros(window)))
    number = F.row_number().over(Window.partitionBy(*keys, "slot").orderBy("event_time"))
    event = F.struct("campaign_id", "conversion_type", "timestamp", "event_time")
    return (
        clicks.select(*keys, "event_time", slot.alias("slot"), event.alias("event"))
        .withColumn("block", F.floor((number - 1) / BLOCK))
        .groupBy(*keys, "slot", "block")
        .agg(
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
            F.collect_list("event").alias("clicks"),
        )
        .drop("slot", "block")
    )


def _stream_blocks(clicks: DataFrame, keys: list[str], window: timedelta) -> DataFrame:
    """``_blocks`` of a stream, with the time of the last click as ``event_time``."""
    slot, most = _bucket(max(1, micros(block_length(window)))), BLOCK
    event = ["campaign_id", "conversion_type", "timestamp", "event_time"]
    group = [*keys, "slot"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = pc.sort_indices(batch, sort_keys=[(name, "ascending") for name in [*group, "event_time"]])
            rows, place = batch.take(order), np.arange(batch.num_rows)
            begins = place == 0
            for name in group:
                column = rows.column(name)
                differs = pc.not_equal(column.slice(1), column.slice(0, len(place) - 1))
                begins[1:] |= pc.fill_null(differs, True).to_numpy(zero_copy_only=False)
            begins |= (place - np.maximum.accumulate(np.where(begins, place, 0))) % most == 0
            starts, times = np.flatnonzero(begins), rows.column("event_time")
            ends = np.append(starts[1:], len(place))
            events = pa.StructArray.from_arrays([rows.column(name) for name in event], names=event)
            offsets = pa.array(np.append(starts, len(place)).astype(np.int32))
            columns = [rows.column(key).take(pa.array(starts)) for key in keys]
            columns += [times.take(pa.array(ends - 1)), times.take(pa.array(starts))]
            columns.append(pa.ListArray.from_arrays(offsets, events))
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "event_time", "first", "clicks"])

    fields = {f.name: f for f in clicks.schema}
    schema = T.StructType([fields[key] for key in keys])
    schema = schema.add("event_time", T.TimestampType()).add("first", T.TimestampType())
    schema = schema.add("clicks", T.ArrayType(T.StructType([fields[name] for name in event])))
    return clicks.select(*keys, slot.alias("slot"), *event).mapInArrow(pack, schema)


def interval_tasks(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    bucket_factor: int = 4,
) -> int:
    """Tasks for ``attribute_by_interval`` in batch, by its output if events were even in a bucket."""
    reach = micros(impression_window + click_window)
    width = bucket_factor * reach
    sides = _bucketed(bids, impressions, clicks, impression_window, click_window, width)
    shown = micros(impression_window) / max(1, width + micros(impression_window))
    clicked = micros(click_window) / max(1, width + reach)
    return skew.output_tasks(*sides, [*USER, BUCKET], shown * clicked, TASK_ROWS)


def find_hot_users(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame | None:
    """Hot users for ``attribute_by_user``, without clicks for ``join_impressions``."""
    return skew.find_hot_groups(bids, impressions, clicks, USER, tasks)


def output_tasks(
    bids: DataFrame, impressions: DataFrame, clicks: DataFrame | None = None
) -> int:
    """Tasks for ``attribute_by_user`` and ``join_impressions``, by their estimated output."""
    return skew.output_tasks(bids, impressions, clicks, USER)


def find_hot_intervals(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    bucket_factor: int = 4,
    tasks: int | None = None,
) -> DataFrame | None:
    """Hot users per time bucket for ``attribute_by_interval``."""
    width = bucket_factor * micros(impression_window + click_window)
    sides = _bucketed(bids, impressions, clicks, impression_window, click_window, width)
    return skew.find_hot_groups(*sides, [*USER, BUCKET], tasks)


def nested(flat: DataFrame, reference_user_id: bool = False, others: tuple[str, ...] = ()) -> DataFrame:
    """The attribution record: the user and one struct per source; ``others`` are kept beside it.

    Unmatched sides are structs of NULLs. ``reference_user_id`` takes the user
    from the impression, so that unmatched bids have none.
    """
    user = F.col("impression_user_id" if reference_user_id else "user_id")
    return flat.select(
        user.alias("user_id"),
        F.struct(
            "auction_id", "targeting_criteria", F.col("bid_requests_timestamp").alias("timestamp")
        ).alias("bid_requests"),
        F.struct(
            "ad_creative_id", "website", F.col("ad_impressions_timestamp").alias("timestamp")
        ).alias("ad_impressions"),
        F.struct(
            "campaign_id",
            "conversion_type",
            F.col("clicks_conversions_timestamp").alias("timestamp"),
        ).alias("clicks_conversions"),
        *others,
    )


def _bucketed(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    width: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        in_bucket(bids, width),
        in_buckets(impressions, width, micros(impression_window)),
        in_buckets(clicks, width, micros(impression_window + click_window)),
    )


def in_bucket(bids: DataFrame, width: int) -> DataFrame:
    """Bids in the bucket of their time; bids without one are spread, they match nothing."""
    scattered = F.pmod(F.xxhash64(*BID_IDENTITY), F.lit(4096)).cast("long")
    return bids.withColumn(BUCKET, F.coalesce(_bucket(width), scattered))


def in_buckets(df: DataFrame, width: int, reach: int) -> DataFrame:
    """Rows in the bucket of their time, and in the one before if a bid there can reach them."""
    offset = F.pmod(F.unix_micros("event_time"), F.lit(width))
    own = _bucket(width)
    both = F.when(offset < reach, F.array(own, own - 1)).otherwise(F.array(own))
    return df.filter(F.col("event_time").isNotNull()).select("*", F.explode(both).alias(BUCKET))


def _bucket(width: int) -> Column:
    time = "unix_micros(event_time)"
    return F.expr(f"({time} - pmod({time}, {width}L)) div {width}L")


def _spread_interval(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    hot: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
    width: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three sides with their cells.

    Whether a bid has an impression in its window is read from the first and
    last impression of each slot of its group. A slot is no longer than the
    window, so one of the two is in the window if any of the slot is. Streams
    split bids only.
    """
    keys = [name for name in (*USER, BUCKET) if name in hot.columns]
    slots = width // max(1, micros(min(impression_window, click_window)))
    small = True
    if bids.isStreaming or BUCKET not in keys:
        hot = hot_shown = hot_clicked = skew.bids_only(hot, keys)
        has_impression, has_click = F.col(skew.ANY_IMPRESSIONS), F.col(skew.ANY_CLICKS)
    else:
        small = slots * hot.count() <= MAX_SLOTS  # ``hot`` is a local list
        hot_shown = _with_slots(hot, keys, impressions, impression_window)
        hot_clicked = _with_slots(hot, keys, clicks, click_window)
        has_impression, has_click = _meets(impression_window), _meets(click_window)
    return (
        skew.spread_bids(bids, hot_shown, keys, BID_IDENTITY, has_impression, small),
        skew.spread_impressions(
            impressions, hot_clicked, keys, IMPRESSION_IDENTITY, has_click, small
        ),
        skew.spread_clicks(clicks, hot, keys, CLICK_IDENTITY),
    )


def _with_slots(
    hot: DataFrame, keys: list[str], df: DataFrame, window: timedelta
) -> DataFrame:
    """Hot groups with the first and last time of ``df`` in each slot of the group."""
    slots = (
        df.join(F.broadcast(hot.select(*keys)), keys)
        .groupBy(*keys, _bucket(micros(window)).alias("slot"))
        .agg(F.min("event_time").alias("first"), F.max("event_time").alias("last"))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("first", "last")).alias(SLOTS))
    )
    return hot.join(slots, keys, "left")


def _meets(window: timedelta) -> Column:
    """Whether a slot holds a time within ``window`` after the row's."""
    start = F.col("event_time")
    return F.exists(SLOTS, lambda slot: (slot["last"] >= start) & _until(slot["first"], start, window))


def _within(at: Column, start: Column, window: timedelta) -> Column:
    """Whether ``at`` is in the window from ``start`` on, bounds included."""
    return (at >= start) & _until(at, start, window)


def _until(at: Column, start: Column, window: timedelta) -> Column:
    # Spark adds an interval to a time by way of the calendar, at many times the cost of a subtraction.
    return F.unix_micros(at) - F.unix_micros(start) <= micros(window)


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnRenamed("timestamp", f"{name}_timestamp").alias(name)


def _equal(left: str, right: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{key}") == F.col(f"{right}.{key}") for key in keys]
    )


def _flat(joined: DataFrame, impression_user: Column | None = None) -> DataFrame:
    shown_to = F.col("ad_impressions.user_id") if impression_user is None else impression_user
    return joined.select(
        F.col("bid_requests.user_id").alias("user_id"),
        shown_to.alias("impression_user_id"),
        "auction_id",
        "targeting_criteria",
        "bid_requests_timestamp",
        "ad_creative_id",
        "website",
        "ad_impressions_timestamp",
        "campaign_id",
        "conversion_type",
        "clicks_conversions_timestamp",
    )
