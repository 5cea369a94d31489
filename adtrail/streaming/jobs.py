"""Streaming queries: curated tables, dead letters, attribution, single-read fan-out."""

from __future__ import annotations

from datetime import timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adtrail.functions.timing import as_delay, event_date, interval
from adtrail.operators import quality
from adtrail.operators.attribution import attribute_by_interval, nested, opened_blocks, stream_blocks_by_interval
from adtrail.operators.dedup import keep_first
from adtrail.plans.ingest import DELAY, ingest
from adtrail.registry import ATTRIBUTION_TABLE, BIDS, CLICKS, IMPRESSIONS, SourceSpec
from adtrail.sinks import tables as sink
from adtrail.sources.tables import Tables, keep_text, kept_text, make_folder, path_exists
from adtrail.streaming import late
from adtrail.streaming import metrics as metrics_log
from adtrail.streaming.dedup import with_delay
from adtrail.streaming.metrics import batch_counts

IMPRESSION_WINDOW = timedelta(hours=1)
CLICK_WINDOW = timedelta(hours=24)
HOT_USERS = "_hot_users"
BUCKETS = "_bucket_factor"
#: Width of a new stream's time buckets, in both windows. A row looks at every row of its user and
#: bucket in the state, one lookup each: of a busy user's clicks 4 windows' worth here, 10 with the batch's 4.
BUCKET_FACTOR = 1
#: The width of streams that began before it was kept with the checkpoint.
FIRST_BUCKET_FACTOR = 4
CLICKS_AS = "_clicks_as"
#: Clicks in the state of a new stream, and of those that began before this was kept with the checkpoint.
BLOCKS, ROWS = "blocks", "rows"
PLACE = ["topic", "partition", "offset"]


def dead_letter_rows(invalid: DataFrame) -> DataFrame:
    return invalid.withColumn(sink.INGEST_DATE, F.to_date("ingest_time"))


def start_curated(
    log: DataFrame,
    spec: SourceSpec,
    tables: Tables,
    delay: timedelta = DELAY,
    collapse_copies: bool = False,
    **run,
) -> StreamingQuery:
    """Valid rows of a topic, without copies, into the curated table; late ones too."""
    valid = ingest(log, spec, delay, collapse_copies=collapse_copies).valid
    return sink.append_stream(valid, tables, spec.table, **run)


def start_dead_letters(log: DataFrame, spec: SourceSpec, tables: Tables, **run) -> StreamingQuery:
    """Invalid rows of a topic into the dead-letter table, counted per micro-batch."""
    return _start_split(log, spec.with_event_time(), tables, spec.dead_letter_table, False, **run)


def start_fan_out(
    log: DataFrame,
    spec: SourceSpec,
    tables: Tables,
    delay: timedelta = DELAY,
    collapse_copies: bool = False,
    **run,
) -> StreamingQuery:
    """Both tables from one read and one decode of the topic.

    Copies are valid rows with the same key of the source, or invalid ones with
    the same place in the log. The first in the log stays. Copies are looked up in
    the tables' key index, so one is found however late it is, a micro-batch that
    is run again adds nothing, and the stream keeps no state. ``collapse_copies``
    guards a state and changes nothing here: copies are dropped inside each task
    before the shuffle. Days of rows more than ``delay`` behind the source's event
    time are noted for ``plans.jobs.attribute_late``.
    """
    return _start_split(log, spec.with_event_time(), tables, f"fan_out_{spec.name}", True, delay, **run)


def _start_split(
    log: DataFrame,
    spec: SourceSpec,
    tables: Tables,
    name: str,
    curated: bool,
    delay: timedelta = DELAY,
    files_per_date: int | None = None,
    **run,
) -> StreamingQuery:
    """Micro-batches are counted, split and appended; files are gathered by size, not by ``files_per_date``.

    One pass over the micro-batch gives its counts and dates. The calendar bounds
    the dates; far fewer are usual. Between the passes valid rows are kept without their
    payload and others without fields; of valid rows that go to no table only their number.
    """
    spark = log.sparkSession
    decoded = quality.decode_log(log, spec)
    is_valid = F.col(quality.REASON).isNull()
    keys, places = list(spec.dedup_keys), PLACE
    day, times = F.to_date("ingest_time"), {}
    if curated:
        day = F.when(is_valid, event_date()).otherwise(day)
        times = {f.__name__: f(F.col("event_time").cast("timestamp_ntz")) for f in (F.min, F.max)}
        kept = {c: F.when(is_valid, F.col(c)).alias(c) for c in (*spec.fields, "event_time")}
        kept["raw_value"] = F.when(~is_valid, F.col("raw_value")).alias("raw_value")
        decoded = decoded.select(*[kept.get(c, F.col(c)) for c in decoded.columns])
    else:
        decoded = decoded.select(*[F.when(~is_valid, F.col(c)).alias(c) for c in quality.DEAD_COLUMNS])

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            counts, seen = metrics_log.counted(batch, spec, day, times)
            valid_days = [g["day"] for g in seen if g[quality.REASON] is None]
            dead_days = list(dict.fromkeys(g["day"] for g in seen if g[quality.REASON] is not None))
            query = metrics_log.query_of(spark)
            metrics_log.commit(spark, tables, spec, query, number, counts)
            steps = []
            if curated and valid_days:
                rows = batch.filter(is_valid).select(*spec.fields, "event_time", "partition", "offset")
                first = keep_first(rows, keys, ["partition", "offset"], drop_order=True)
                valid = quality.curated_columns(first, spec)
                to = (valid, tables, spec.table, keys, sink.EVENT_DATE, True, valid_days)
                steps.append(partial(sink.append_once, *to))
            if dead_days:
                dead = dead_letter_rows(batch.filter(~is_valid).select(*quality.DEAD_COLUMNS))
                to = (dead, tables, spec.dead_letter_table, places, sink.INGEST_DATE, False, dead_days)
                steps.append(partial(sink.append_once, *to))
            sink.together(spark, steps)
            if curated:
                began = min((g["min"] for g in seen if g["min"] is not None), default=None)
                ended = max((g["max"] for g in seen if g["max"] is not None), default=None)
                late.note(spark, tables, spec.name, f"{query}-{number}", valid_days, began, ended, delay)
        finally:
            batch.unpersist()

    writer = (
        decoded.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", tables.checkpoint(name))
    )
    return sink.start(writer, decoded, **run)


def curated_schema(spec: SourceSpec) -> T.StructType:
    return T.StructType(
        [
            *spec.schema.fields,
            T.StructField("event_time", T.TimestampType()),
            T.StructField(sink.EVENT_DATE, T.DateType()),
        ]
    )


def attribution_stream(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    impression_window: timedelta = IMPRESSION_WINDOW,
    click_window: timedelta = CLICK_WINDOW,
    delay: timedelta | None = None,
    hot: DataFrame | None = None,
    bucket_factor: int = FIRST_BUCKET_FACTOR,
) -> DataFrame:
    """Attribution of three streams without copies, flat; a bid is final once both windows closed.

    ``delay`` sets watermarks on streams that have none yet. ``hot`` lists
    users whose bids are split over several keys. Both it and ``bucket_factor``
    are part of the join key and stay with a checkpoint.
    """
    sides = (bids, impressions, clicks)
    if delay is not None:
        sides = tuple(with_delay(df, delay) for df in sides)
    return attribute_by_interval(*sides, impression_window, click_window, hot, bucket_factor)


def without_busy(
    sides: tuple[DataFrame, DataFrame, DataFrame],
    busy: DataFrame,
    impression_window: timedelta,
    click_window: timedelta,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bids, impressions and clicks a stream still needs when others attribute busy users.

    ``busy`` has ``user_id`` and ``since``, a user once: bids from then on are
    not the stream's. Impressions and clicks stay as long as an earlier bid can
    reach them. The list is no part of a join key, so it may grow at any restart by users
    with a ``since`` the stream has not reached. It has fewer rows than the joins have tasks and is broadcast.
    """
    reaches = (timedelta(0), impression_window, impression_window + click_window)
    listed = F.broadcast(busy.select(F.col("user_id").alias("busy_user"), "since"))
    return tuple(
        df.join(listed, F.col("user_id") == F.col("busy_user"), "left")
        .where(F.col("since").isNull() | (F.col("event_time") < F.col("since") + interval(reach)))
        .select(*df.columns)
        for df, reach in zip(sides, reaches)
    )


def start_attribution(
    spark: SparkSession,
    tables: Tables,
    impression_window: timedelta = IMPRESSION_WINDOW,
    click_window: timedelta = CLICK_WINDOW,
    delay: timedelta = DELAY,
    hot: DataFrame | None = None,
    max_files_per_trigger: int | None = None,
    busy: DataFrame | None = None,
    **run,
) -> StreamingQuery:
    """Attribution from the curated tables, which are read as streams.

    The topics are not read a second time and rows are deduplicated once.
    ``hot`` splits the bids of some users; ``busy`` leaves users to
    ``plans.jobs.attribute_busy``, which splits all their rows. Rows are gathered by
    date with their clicks in blocks, and opened where they are written.
    """
    for spec in (BIDS, IMPRESSIONS, CLICKS):
        if tables.in_catalog:
            empty = spark.createDataFrame([], curated_schema(spec))
            sink.create_if_absent(empty, tables, spec.table)
        else:
            make_folder(spark, tables.path(spec.table))
    bids, impressions, clicks = (
        tables.stream(spark, spec.table, curated_schema(spec), max_files_per_trigger)
        for spec in (BIDS, IMPRESSIONS, CLICKS)
    )
    if busy is not None:
        sides = (bids, impressions, clicks)
        bids, impressions, clicks = without_busy(sides, busy, impression_window, click_window)
    windows = (impression_window, click_window)
    pinned = (pinned_hot_users(spark, tables, hot), pinned_bucket_factor(spark, tables))
    if pinned_clicks(spark, tables) == ROWS:
        flat = attribution_stream(bids, impressions, clicks, *windows, delay, *pinned)
        return sink.append_stream(attribution_rows(flat), tables, ATTRIBUTION_TABLE, **run)
    sides = (with_delay(bids, delay), with_delay(impressions, delay), clicks)
    blocks = stream_blocks_by_interval(*sides, *windows, as_delay(delay), *pinned)
    opened = partial(open_blocks, click_window=click_window)
    return sink.append_stream(dated_blocks(blocks), tables, ATTRIBUTION_TABLE, opened=opened, **run)


def dated_blocks(blocks: DataFrame) -> DataFrame:
    """Rows whose clicks are in blocks, with the date of the bid."""
    return blocks.withColumn(sink.EVENT_DATE, bid_date("bid_requests_timestamp"))


def open_blocks(rows: DataFrame, click_window: timedelta) -> DataFrame:
    """The attribution records of ``dated_blocks``."""
    return nested(opened_blocks(rows, click_window, sink.EVENT_DATE), others=(sink.EVENT_DATE,))


def attribution_rows(flat: DataFrame) -> DataFrame:
    """Nested attribution records with the date of the bid."""
    return nested(flat).withColumn(sink.EVENT_DATE, bid_date("bid_requests.timestamp"))


def bid_date(timestamp: str) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(timestamp)))


def pinned_hot_users(
    spark: SparkSession, tables: Tables, hot: DataFrame | None
) -> DataFrame | None:
    """The hot users the query was first started with.

    They are part of the join key, so state written with one list cannot be
    read with another. The first list is kept with the checkpoint.
    """
    pins = Tables(tables.checkpoint(ATTRIBUTION_TABLE + HOT_USERS))
    if pins.exists(spark, "list"):
        return pins.read(spark, "list")
    if hot is None or path_exists(spark, tables.checkpoint(ATTRIBUTION_TABLE)):
        return None
    hot.write.parquet(pins.path("list"))
    return hot


def pinned_bucket_factor(spark: SparkSession, tables: Tables) -> int:
    """The width of the buckets the query was first started with, which are part of the join key too."""
    pin = tables.checkpoint(ATTRIBUTION_TABLE + BUCKETS)
    kept = kept_text(spark, pin)
    if kept:
        return int(kept)
    if path_exists(spark, tables.checkpoint(ATTRIBUTION_TABLE)):
        return FIRST_BUCKET_FACTOR
    keep_text(spark, pin, str(BUCKET_FACTOR))
    return BUCKET_FACTOR


def pinned_clicks(spark: SparkSession, tables: Tables) -> str:
    """Whether the query was first started with clicks as ``ROWS`` or in ``BLOCKS``, which the state holds."""
    pin = tables.checkpoint(ATTRIBUTION_TABLE + CLICKS_AS)
    kept = kept_text(spark, pin)
    if kept:
        return kept
    if path_exists(spark, tables.checkpoint(ATTRIBUTION_TABLE)):
        return ROWS
    keep_text(spark, pin, BLOCKS)
    return BLOCKS


def finish(queries: list[StreamingQuery]) -> None:
    """Wait for queries over the available data; an error of any is raised."""
    for query in queries:
        query.awaitTermination()


def metrics(spark: SparkSession, tables: Tables, spec: SourceSpec) -> list[dict[str, int]]:
    """The counts of the source's micro-batches in order; ``batch_counts`` has them as a table."""
    counts = batch_counts(spark, tables, spec)
    if counts is None:
        return []
    return [row.asDict() for row in counts.orderBy("query", "batch").collect()]
