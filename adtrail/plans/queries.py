"""Queries over the test tables, one or more per operator, with SQL for the same result."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions.payload import CORRUPT, as_binary, as_text, from_json
from adtrail.operators import attribution, dedup, factorised, quality
from adtrail.plans import event_topics as topics_of
from adtrail.plans import jobs
from adtrail.plans.ingest import ingest
from adtrail.registry import ATTRIBUTION_TABLE, BIDS, BUSY_ATTRIBUTION_TABLE, CLICKS, IMPRESSIONS, json_sources
from adtrail.session import settings, work_folder
from adtrail.sinks import publish, tables as sink
from adtrail.sources.files import csv_with_header, json_arrays
from adtrail.sources.json_splits import split_json_arrays
from adtrail.sources.tables import Tables, preview
from adtrail.sources.topics import FileTopics, read_streams, read_topics, schema_text
from adtrail.streaming.dedup import drop_copies as drop_stream_copies
from adtrail.streaming import jobs as streaming
from adtrail.streaming.metrics import batch_counts

Query = Callable[[SparkSession, str], DataFrame]

JSON = json_sources()
JSON_BIDS = JSON[BIDS.name]
WINDOW = timedelta(hours=6)
DELAY = timedelta(hours=1)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name with the SQL it must equal."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
                return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        ORACLE[fn.__name__] = sql
        return fn

    return register


# --- what the SQL below shares -------------------------------------------------

ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
DAY_SQL = "strftime(ts, '%Y-%m-%dT00:00:00Z')"


def sides_sql(
    bid_user: str = "CAST(user_id AS VARCHAR)",
    impression_user: str = "CAST(user_id AS VARCHAR)",
    click_user: str = "CAST(user_id AS VARCHAR)",
) -> str:
    return f"""
    WITH b AS (SELECT {bid_user} AS user_id, CAST(event_id AS VARCHAR) AS auction_id, ts,
                      {ISO_SQL} AS bid_timestamp, props->>'$.k' AS target_k
               FROM events WHERE event_type = 'view'),
         i AS (SELECT {impression_user} AS user_id, CAST(event_id AS VARCHAR) AS ad_creative_id,
                      ts, {ISO_SQL} AS impression_timestamp, event_type AS website
               FROM events WHERE event_type = 'click'),
         c AS (SELECT {click_user} AS user_id, CAST(event_id AS VARCHAR) AS campaign_id, ts,
                      {ISO_SQL} AS click_timestamp, event_type AS conversion_type
               FROM events WHERE event_type = 'purchase')"""


ATTRIBUTION_COLUMNS_SQL = """auction_id, target_k, bid_timestamp, ad_creative_id, website,
    impression_timestamp, campaign_id, conversion_type, click_timestamp"""

USER_JOIN_SQL = """FROM b LEFT JOIN i ON b.user_id = i.user_id
    LEFT JOIN c ON i.user_id = c.user_id"""


def interval_join_sql(hours: int) -> str:
    span = f"INTERVAL {hours} HOUR"
    return f"""FROM b LEFT JOIN i ON b.user_id = i.user_id AND i.ts BETWEEN b.ts AND b.ts + {span}
    LEFT JOIN c ON i.user_id = c.user_id AND c.ts BETWEEN i.ts AND i.ts + {span}"""


def user_attribution_sql(sides: str, user: str = "b.user_id") -> str:
    return f"{sides} SELECT {user} AS user_id, {ATTRIBUTION_COLUMNS_SQL} {USER_JOIN_SQL}"


def interval_attribution_sql(sides: str, hours: int) -> str:
    return f"""{sides} SELECT b.user_id AS user_id, {ATTRIBUTION_COLUMNS_SQL}
    {interval_join_sql(hours)}"""


def ingested_sql(main: str, columns: str, time: str = DAY_SQL) -> str:
    """Valid rows of one topic, first one per user and timestamp."""
    return f"""SELECT CAST(user_id AS VARCHAR) AS user_id, {time} AS "timestamp", {columns}
    FROM events WHERE event_type = '{main}'
    QUALIFY row_number() OVER (PARTITION BY user_id, {time} ORDER BY event_id) = 1"""


# A cut-off message no longer decodes; a message without user has no user.
IMPRESSION_INVALID_SQL = """SELECT event_id AS "offset",
    CASE event_type WHEN 'error' THEN 'undecodable' ELSE 'missing_user_id' END AS reason
    FROM events WHERE event_type IN ('error', 'signup')"""

ALL_TOPICS_SQL = """
    SELECT 'ad_impressions' AS source, event_id, event_type FROM events
    WHERE event_type IN ('click', 'error', 'signup')
    UNION ALL SELECT 'clicks_conversions', event_id, event_type FROM events
    WHERE event_type IN ('purchase', 'error', 'signup')
    UNION ALL SELECT 'bid_requests', event_id, event_type FROM events
    WHERE event_type IN ('view', 'error', 'signup')"""

MAIN_ROWS_SQL = """
    SELECT CASE event_type WHEN 'click' THEN 'ad_impressions' WHEN 'purchase' THEN 'clicks_conversions'
           ELSE 'bid_requests' END AS source, event_id, user_id, ts,
           CASE event_type WHEN 'view' THEN props->>'$.k' ELSE event_type END AS detail
    FROM events WHERE event_type IN ('click', 'purchase', 'view')"""

ERROR_COUNTS_SQL = f"""SELECT source,
    CASE event_type WHEN 'error' THEN 'undecodable' ELSE 'missing_user_id' END AS reason,
    count(*) AS errors FROM ({ALL_TOPICS_SQL}) WHERE event_type IN ('error', 'signup')
    GROUP BY ALL"""


# --- helpers -------------------------------------------------------------------


def sides(spark: SparkSession, sf_dir: str, *users) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean bids, impressions and clicks; ``users`` replaces the user per side."""
    events = topics_of.read_events(spark, sf_dir)
    users = users or (None, None, None)
    return tuple(
        topics_of.valid_side(events, spec, user)
        for spec, user in zip((BIDS, IMPRESSIONS, CLICKS), users)
    )


def flat_attribution(nested: DataFrame, *others: str) -> DataFrame:
    """Attribution records without structs and maps."""
    return nested.select(
        *others,
        "user_id",
        F.col("bid_requests.auction_id").alias("auction_id"),
        F.element_at("bid_requests.targeting_criteria", "k").alias("target_k"),
        F.col("bid_requests.timestamp").alias("bid_timestamp"),
        F.col("ad_impressions.ad_creative_id").alias("ad_creative_id"),
        F.col("ad_impressions.website").alias("website"),
        F.col("ad_impressions.timestamp").alias("impression_timestamp"),
        F.col("clicks_conversions.campaign_id").alias("campaign_id"),
        F.col("clicks_conversions.conversion_type").alias("conversion_type"),
        F.col("clicks_conversions.timestamp").alias("click_timestamp"),
    )


def flat_records(df: DataFrame) -> DataFrame:
    """Records without the map column and without derived columns."""
    if "targeting_criteria" in df.columns:
        df = df.withColumn("target_k", F.element_at("targeting_criteria", "k"))
    return df.drop("targeting_criteria", "event_time", "event_date")


def batch_logs(spark: SparkSession, sf_dir: str, time_format: str = topics_of.ISO, user=None):
    events = topics_of.read_events(spark, sf_dir)
    return {name: topics_of.topic(events, spec, time_format, user) for name, spec in JSON.items()}


#: Messages of one staged file, so that a micro-batch has as many tasks as its size needs.
FILE_MESSAGES = 200_000


def staged_topics(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    deliveries: int = 1,
    names=tuple(JSON),
    parts: int = 1,
    user=None,
) -> FileTopics:
    """The derived topics as file logs; each message is delivered ``deliveries`` times.

    With several ``parts`` a micro-batch reads one of them. Messages are dealt to
    files by a hash of their place, so that each part spans the whole time: all but
    the first are full of late rows. A part is one file up to ``FILE_MESSAGES``
    messages in the largest topic, and as many more as it needs beyond.
    """
    topics = FileTopics(f"{folder}/topics")
    logs = batch_logs(spark, sf_dir, user=user)
    each = 1
    if parts > 1:
        kinds = dict(topics_of.read_events(spark, sf_dir).groupBy("event_type").count().collect())
        most = max(sum(kinds.get(kind, 0) for kind in topics_of.kinds_of(name)) for name in names) * deliveries
        each = max(1, math.ceil(most / parts / FILE_MESSAGES))
        topics = FileTopics(topics.root, max_files_per_trigger=each)
    for name in names:
        delivery = F.explode(F.sequence(F.lit(0), F.lit(deliveries - 1)))
        copies = logs[name].withColumn("partition", delivery)
        if parts > 1:
            copies = copies.repartition(parts * each, F.xxhash64("offset", "partition"))
        copies.write.parquet(topics.path(name))
    return topics


def deliver_sentinels(spark: SparkSession, sf_dir: str, topics: FileTopics) -> None:
    """One record per topic, so much later that every window of the others has closed."""
    events = topics_of.read_events(spark, sf_dir)
    last = events.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(-1).cast("long").alias("user_id"),
        F.lit('{"k": 0}').alias("props"),
    )
    for name, spec in JSON.items():
        main = last.withColumn("event_type", F.lit(topics_of.MAIN_TYPE[name]))
        topics_of.topic(main, spec).write.mode("append").parquet(topics.path(name))


#: Records of one JSON array file.
ARRAY_RECORDS = 2000


def json_array_files(df: DataFrame, fields: list[str], path: str) -> None:
    """Files of one JSON array each, of about ``ARRAY_RECORDS`` records."""
    chunks = -(-df.count() // ARRAY_RECORDS) or 1
    text = df.select(
        F.pmod(F.xxhash64("event_id"), F.lit(chunks)).alias("chunk"),
        F.to_json(F.struct(*fields)).alias("record"),
    )
    arrays = text.groupBy("chunk").agg(F.array_join(F.collect_list("record"), ",\n").alias("records"))
    value = F.concat(F.lit("["), "records", F.lit("]")).alias("value")
    arrays.select(value).write.option("maxRecordsPerFile", 1).text(path)


# --- payloads and scans ----------------------------------------------------------


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast to text, decode with a schema, expand the struct."""
    events = topics_of.read_events(spark, sf_dir)
    decoded = events.select("event_id", F.from_json(as_text("props"), "k bigint").alias("data"))
    return decoded.select("event_id", "data.*")


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN props->>'$.k' END AS k,
    event_type = 'error' AS corrupt FROM events"""
)
def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads cut off in transit decode to NULL and are marked."""
    events = topics_of.read_events(spark, sf_dir)
    cut = F.when(
        F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")
    ).otherwise(F.col("props"))
    schema = T.StructType([T.StructField("k", T.StringType())])
    data = F.struct(from_json(cut, schema).alias("data"))
    decoded = events.select("event_id", F.inline(F.array(data)))
    return decoded.select(
        "event_id", F.col("data.k").alias("k"), F.col(f"data.{CORRUPT}").isNotNull().alias("corrupt")
    )


@query(
    "SELECT event_id, epoch_us(ts) AS ts_micros, user_id, event_type, value, props FROM events"
)
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode rows as JSON and decode them again, times to the microsecond."""
    events = topics_of.read_events(spark, sf_dir)
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    text = events.select(F.to_json(F.struct("*"), options).alias("value"))
    rows = text.select(F.from_json("value", events.schema, options).alias("data")).select("data.*")
    return rows.withColumn("ts_micros", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query("SELECT event_id, props AS payload, octet_length(encode(props)) AS bytes FROM events")
def cast_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to binary and back."""
    binary = topics_of.read_events(spark, sf_dir).select(
        "event_id", as_binary("props").alias("value")
    )
    return binary.select(
        "event_id", as_text("value").alias("payload"), F.octet_length("value").alias("bytes")
    )


@query("SELECT event_id, props->>'$.k' AS target_k FROM events")
def map_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value of a string map."""
    events = topics_of.read_events(spark, sf_dir)
    decoded = events.select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return decoded.select("event_id", F.element_at("m", "k").alias("target_k"))


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS ad_creative_id, CAST(user_id AS VARCHAR) AS user_id,
    {ISO_SQL} AS "timestamp", event_type AS website FROM events"""
)
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: files of one JSON array each."""
    path = work_folder(spark, "impressions")
    events = topics_of.read_events(spark, sf_dir)
    json_array_files(topics_of.records(events, IMPRESSIONS), IMPRESSIONS.fields, path)
    return json_arrays(spark, path, IMPRESSIONS)


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS auction_id,
    {ISO_SQL} AS "timestamp", props->>'$.k' AS target_k FROM events"""
)
def bid_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays with a map field."""
    path = work_folder(spark, "bids")
    json_array_files(
        topics_of.records(topics_of.read_events(spark, sf_dir), BIDS), BIDS.fields, path
    )
    return flat_records(json_arrays(spark, path, BIDS))


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS auction_id,
    {ISO_SQL} AS "timestamp", props->>'$.k' AS target_k FROM events"""
)
def split_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``bid_array_scan``, each array cut into ranges that tasks read on their own."""
    path = work_folder(spark, "bids")
    json_array_files(
        topics_of.records(topics_of.read_events(spark, sf_dir), BIDS), BIDS.fields, path
    )
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "50000", "spark.sql.files.openCostInBytes": "50000"}):
        return flat_records(split_json_arrays(spark, path, BIDS))


@query(
    f"""SELECT {ISO_SQL} AS "timestamp", CAST(user_id AS VARCHAR) AS user_id,
    CAST(event_id AS VARCHAR) AS campaign_id, event_type AS conversion_type FROM events"""
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headered CSV, columns found by name."""
    path = work_folder(spark, "clicks")
    rows = topics_of.records(topics_of.read_events(spark, sf_dir), CLICKS)
    rows.select(*reversed(CLICKS.fields)).write.option("header", True).csv(path)
    return csv_with_header(spark, path, CLICKS)


# --- topics ----------------------------------------------------------------------


@query(
    f"""SELECT 'ad_impressions' AS topic,
    '{{"ad_creative_id":"' || event_id || '","user_id":"' || user_id || '","timestamp":"' ||
    {ISO_SQL} || '","website":"' || event_type || '"}}' AS payload FROM events
    UNION ALL SELECT 'bid_requests',
    '{{"user_id":"' || user_id || '","auction_id":"' || event_id || '","timestamp":"' ||
    {ISO_SQL} || '","targeting_criteria":{{"k":"' || (props->>'$.k') || '"}}}}' FROM events"""
)
def json_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published as JSON messages, read back from the topics."""
    topics = FileTopics(work_folder(spark, "published"))
    events = topics_of.read_events(spark, sf_dir)
    for spec in (IMPRESSIONS, JSON_BIDS):
        publish.publish(topics_of.records(events, spec), spec, topics)
    logs = [topics.table(spark, name) for name in (IMPRESSIONS.name, BIDS.name)]
    return logs[0].unionByName(logs[1]).select("topic", as_text("value").alias("payload"))


@query(
    f"""SELECT source AS topic, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS id,
    {ISO_SQL} AS "timestamp", detail FROM ({MAIN_ROWS_SQL})"""
)
def seed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input files (JSON arrays, CSV) published to the three topics."""
    folder = work_folder(spark, "seed")
    events = topics_of.read_events(spark, sf_dir)
    for spec in (IMPRESSIONS, BIDS):
        main = events.filter(F.col("event_type") == topics_of.MAIN_TYPE[spec.name])
        json_array_files(topics_of.records(main, spec), spec.fields, f"{folder}/in/{spec.name}")
    main = events.filter(F.col("event_type") == topics_of.MAIN_TYPE[CLICKS.name])
    rows = topics_of.records(main, CLICKS).select(*CLICKS.fields)
    rows.write.option("header", True).csv(f"{folder}/in/{CLICKS.name}")
    files = jobs.InputFiles(*[f"{folder}/in/{s.name}" for s in (IMPRESSIONS, CLICKS, BIDS)])
    topics = FileTopics(f"{folder}/topics")
    jobs.seed(spark, files, topics, JSON)
    rows = [
        quality.decode_log(log, JSON[name]).select("topic", *record_columns(JSON[name]))
        for name, log in read_topics(spark, topics, JSON).items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(f'SELECT source AS topic, event_id AS "offset" FROM ({ALL_TOPICS_SQL})')
def topic_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three topics as streams, earliest first, at a limited rate."""
    folder = work_folder(spark, "scan")
    staged = staged_topics(spark, sf_dir, folder, parts=4)
    tables = Tables(f"{folder}/tables")
    logs = read_streams(spark, staged, JSON)
    running = [
        sink.append_stream(log.select("topic", "offset"), tables, name, None)
        for name, log in logs.items()
    ]
    streaming.finish(running)
    for stream in running:
        batches = [p for p in stream.recentProgress if p.numInputRows]
        if len(batches) < 2:
            raise AssertionError(f"the rate limit did not bind on {stream.name}")
    read = [tables.read(spark, name) for name in logs]
    return read[0].unionByName(read[1]).unionByName(read[2])


# --- rules, dead letters, metrics ----------------------------------------------------


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS ad_creative_id, CAST(user_id AS VARCHAR) AS user_id,
    {ISO_SQL} AS "timestamp", event_type AS website FROM events WHERE event_type = 'click'"""
)
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions that pass every rule."""
    log = batch_logs(spark, sf_dir)[IMPRESSIONS.name]
    return quality.valid_part(quality.decode_log(log, IMPRESSIONS), IMPRESSIONS).select(
        *IMPRESSIONS.fields
    )


@query(IMPRESSION_INVALID_SQL)
def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other impressions, with the reason."""
    log = batch_logs(spark, sf_dir)[IMPRESSIONS.name]
    return quality.dead_letters(quality.decode_log(log, IMPRESSIONS), IMPRESSIONS).select(
        "offset", "reason"
    )


@query(ERROR_COUNTS_SQL)
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: invalid rows by source and reason."""
    logs = batch_logs(spark, sf_dir)
    dead = {
        name: quality.dead_letters(quality.decode_log(logs[name], spec), spec)
        for name, spec in JSON.items()
    }
    return quality.error_counts(dead)


@query(
    f"""SELECT source, count(*) AS rows_read,
    count(*) FILTER (event_type NOT IN ('error', 'signup')) AS rows_valid,
    count(*) FILTER (event_type IN ('error', 'signup')) AS data_quality_errors
    FROM ({ALL_TOPICS_SQL}) GROUP BY source"""
)
def quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, valid and invalid per source."""
    logs = batch_logs(spark, sf_dir)
    return quality.row_counts(
        {name: quality.decode_log(logs[name], spec) for name, spec in JSON.items()}
    )


# --- dedup and ingest --------------------------------------------------------------


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arbitrary row per key; only the keys are compared."""
    events = topics_of.read_events(spark, sf_dir)
    return dedup.drop_copies(events, ["user_id", "event_type"]).select("user_id", "event_type")


@query(
    """SELECT event_id, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"""
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row per key."""
    events = topics_of.read_events(spark, sf_dir)
    return dedup.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    ingested_sql("click", "CAST(event_id AS VARCHAR) AS ad_creative_id, event_type AS website")
)
def ingest_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode, split, dedup; several impressions of a user share a timestamp."""
    log = batch_logs(spark, sf_dir, topics_of.DAY)[IMPRESSIONS.name]
    return flat_records(ingest(log, IMPRESSIONS).valid)


@query(
    ingested_sql(
        "purchase", "CAST(event_id AS VARCHAR) AS campaign_id, event_type AS conversion_type"
    )
)
def ingest_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As C1 for clicks and conversions."""
    log = batch_logs(spark, sf_dir, topics_of.DAY)[CLICKS.name]
    return flat_records(ingest(log, CLICKS).valid)


@query(
    ingested_sql("view", "CAST(event_id AS VARCHAR) AS auction_id, props->>'$.k' AS target_k")
)
def ingest_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As C1 for bid requests, JSON payloads."""
    log = batch_logs(spark, sf_dir, topics_of.DAY)[BIDS.name]
    return flat_records(ingest(log, JSON_BIDS).valid)


# --- attribution -------------------------------------------------------------------


@query(
    f"{sides_sql()} SELECT b.user_id AS user_id, auction_id, ad_creative_id "
    "FROM b LEFT JOIN i ON b.user_id = i.user_id"
)
def left_join_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bid with the impressions of its user."""
    bids, impressions, _ = sides(spark, sf_dir)
    hot = attribution.find_hot_users(bids, impressions)
    return attribution.join_impressions(bids, impressions, hot).select(
        F.col("bid_requests.user_id").alias("user_id"), "auction_id", "ad_creative_id"
    )


@query(user_attribution_sql(sides_sql()))
def attribution_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution by user."""
    three = sides(spark, sf_dir)
    tasks = attribution.output_tasks(*three)
    hot = attribution.find_hot_users(*three, tasks)
    flat = attribution.attribute_by_user(*three, hot, tasks)
    return flat_attribution(attribution.nested(flat))


@query(user_attribution_sql(sides_sql(), "i.user_id"))
def attribution_reference_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with the user taken from the impression."""
    three = sides(spark, sf_dir)
    flat = attribution.attribute_by_user(*three, attribution.find_hot_users(*three))
    return flat_attribution(attribution.nested(flat, reference_user_id=True))


@query(user_attribution_sql(sides_sql()))
def attribution_factorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 kept as arrays per user, linear in the input, then expanded."""
    path = work_folder(spark, "factorised")
    factorised.factorise(*sides(spark, sf_dir)).write.parquet(path)
    return flat_attribution(attribution.nested(factorised.expand(spark.read.parquet(path))))


@query(
    f"""{sides_sql()} SELECT b.user_id AS user_id, count(DISTINCT auction_id) AS bids,
    count(DISTINCT ad_creative_id) AS impressions, count(DISTINCT campaign_id) AS clicks,
    count(*) AS combinations FROM b LEFT JOIN i ON b.user_id = i.user_id
    LEFT JOIN c ON b.user_id = c.user_id GROUP BY b.user_id"""
)
def attribution_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many combinations each user has, from the sizes of the arrays alone."""
    return factorised.combinations(factorised.factorise(*sides(spark, sf_dir)))


BUSY = "value > 54"


def busy(user: str):
    """A third of the rows belong to one user."""
    return F.expr(f"CASE WHEN {BUSY} THEN '{user}' ELSE CAST(user_id AS STRING) END")


def busy_sql(user: str) -> str:
    return f"CASE WHEN {BUSY} THEN '{user}' ELSE CAST(user_id AS VARCHAR) END"


@query(user_attribution_sql(sides_sql(busy_sql("1"), busy_sql("2"), busy_sql("3"))))
def attribution_busy_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 where one user has a third of the bids, another of the impressions, a third of the clicks."""
    three = sides(spark, sf_dir, busy("1"), busy("2"), busy("3"))
    hot = attribution.find_hot_users(*three)
    return flat_attribution(attribution.nested(attribution.attribute_by_user(*three, hot)))


@query(interval_attribution_sql(sides_sql(), 6))
def attribution_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions within six hours of the bid, clicks within six of the impression."""
    three = sides(spark, sf_dir)
    tasks = attribution.interval_tasks(*three, WINDOW, WINDOW)
    hot = attribution.find_hot_intervals(*three, WINDOW, WINDOW, tasks=tasks)
    flat = attribution.attribute_by_interval(*three, WINDOW, WINDOW, hot, tasks=tasks)
    return flat_attribution(attribution.nested(flat))


@query(interval_attribution_sql(sides_sql(*[busy_sql("1")] * 3), 1))
def attribution_busy_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 where one user has a third of all rows."""
    hour = timedelta(hours=1)
    three = sides(spark, sf_dir, *[busy("1")] * 3)
    tasks = attribution.interval_tasks(*three, hour, hour)
    hot = attribution.find_hot_intervals(*three, hour, hour, tasks=tasks)
    flat = attribution.attribute_by_interval(*three, hour, hour, hot, tasks=tasks)
    return flat_attribution(attribution.nested(flat))


# --- tables --------------------------------------------------------------------------


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS ad_creative_id, CAST(user_id AS VARCHAR) AS user_id,
    {ISO_SQL} AS "timestamp", event_type AS website, strftime(ts, '%Y-%m-%d') AS event_date
    FROM events WHERE event_type = 'click'"""
)
def table_append_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream appended to a table, every message delivered twice."""
    folder = work_folder(spark, "append")
    topics = staged_topics(spark, sf_dir, folder, deliveries=2, names=(IMPRESSIONS.name,))
    tables = Tables(f"{folder}/tables")
    log = topics.stream(spark, IMPRESSIONS.name)
    streaming.finish([streaming.start_curated(log, IMPRESSIONS, tables)])
    return tables.read(spark, IMPRESSIONS.table).select(
        *IMPRESSIONS.fields, F.col("event_date").cast("string").alias("event_date")
    )


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS ad_creative_id, CAST(user_id AS VARCHAR) AS user_id,
    {ISO_SQL} AS "timestamp", event_type AS website, strftime(ts, '%Y-%m-%d') AS event_date
    FROM events WHERE event_type = 'click'"""
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight parts that each span all time, one per micro-batch, default delay; no row is lost."""
    folder = work_folder(spark, "late")
    staged = staged_topics(spark, sf_dir, folder, deliveries=2, names=(IMPRESSIONS.name,), parts=8)
    tables = Tables(f"{folder}/tables")
    log = staged.stream(spark, IMPRESSIONS.name)
    streaming.finish([streaming.start_curated(log, IMPRESSIONS, tables)])
    return tables.read(spark, IMPRESSIONS.table).select(
        *IMPRESSIONS.fields, F.col("event_date").cast("string").alias("event_date")
    )


@query(
    """SELECT event_id AS "offset", 'ad_impressions' AS topic,
    CASE event_type WHEN 'error' THEN 'undecodable' ELSE 'missing_user_id' END AS reason
    FROM events WHERE event_type IN ('error', 'signup')"""
)
def dead_letter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: invalid messages of a stream in their table, with place and reason."""
    folder = work_folder(spark, "dead")
    topics = staged_topics(spark, sf_dir, folder, names=(IMPRESSIONS.name,))
    tables = Tables(f"{folder}/tables")
    log = topics.stream(spark, IMPRESSIONS.name)
    streaming.finish([streaming.start_dead_letters(log, IMPRESSIONS, tables)])
    return tables.read(spark, IMPRESSIONS.dead_letter_table).select("offset", "topic", "reason")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 20")
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the first 20 rows."""
    events = topics_of.read_events(spark, sf_dir)
    return preview(events.select("event_id", "user_id", "event_type"), ["event_id"])


def table_rows_sql(hours: tuple[int, int] = (1, 24)) -> str:
    """All four tables as rows of one shape."""
    return f"""{sides_sql()}
    SELECT 'ad_impressions' AS "table", user_id, ad_creative_id AS id, impression_timestamp AS "timestamp",
           website AS detail, NULL AS shown, NULL AS clicked, strftime(ts, '%Y-%m-%d') AS event_date FROM i
    UNION ALL SELECT 'clicks_conversions', user_id, campaign_id, click_timestamp, conversion_type,
           NULL, NULL, strftime(ts, '%Y-%m-%d') FROM c
    UNION ALL SELECT 'bid_requests', user_id, auction_id, bid_timestamp, target_k,
           NULL, NULL, strftime(ts, '%Y-%m-%d') FROM b
    UNION ALL SELECT 'attribution', b.user_id, auction_id, bid_timestamp, target_k,
           ad_creative_id, campaign_id, strftime(b.ts, '%Y-%m-%d')
    FROM b LEFT JOIN i ON b.user_id = i.user_id AND i.ts BETWEEN b.ts AND b.ts + INTERVAL {hours[0]} HOUR
    LEFT JOIN c ON i.user_id = c.user_id AND c.ts BETWEEN i.ts AND i.ts + INTERVAL {hours[1]} HOUR"""


def record_columns(spec) -> list:
    """A record of any source in one shape."""
    names = {
        IMPRESSIONS.name: ("ad_creative_id", F.col("website")),
        CLICKS.name: ("campaign_id", F.col("conversion_type")),
        BIDS.name: ("auction_id", F.element_at("targeting_criteria", "k")),
    }
    ident, detail = names[spec.name]
    return ["user_id", F.col(ident).alias("id"), "timestamp", detail.alias("detail")]


def table_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of curated tables in one shape."""
    date = F.col("event_date").cast("string").alias("event_date")
    none = F.lit(None).cast("string")
    rows = []
    for name, df in tables.items():
        if name == ATTRIBUTION_TABLE:
            flat = flat_attribution(df, "event_date").select(
                F.lit(name).alias("table"),
                "user_id",
                F.col("auction_id").alias("id"),
                F.col("bid_timestamp").alias("timestamp"),
                F.col("target_k").alias("detail"),
                F.col("ad_creative_id").alias("shown"),
                F.col("campaign_id").alias("clicked"),
                date,
            )
        else:
            columns = record_columns(JSON[name])
            flat = df.select(
                F.lit(name).alias("table"), *columns, none.alias("shown"), none.alias("clicked"), date
            )
        rows.append(flat)
    return reduce(DataFrame.unionByName, rows)


@query(table_rows_sql())
def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's four curated tables, read back."""
    tables = Tables(work_folder(spark, "batch"))
    jobs.process_batch(batch_logs(spark, sf_dir), tables, JSON)
    return table_rows(jobs.read_back(spark, tables))


@query(table_rows_sql().rpartition("FROM b LEFT JOIN i")[0] + USER_JOIN_SQL)
def read_back_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``read_back``, bids attributed by user alone as in the reference."""
    tables = Tables(work_folder(spark, "batch"))
    jobs.process_batch(batch_logs(spark, sf_dir), tables, JSON, windows=None)
    return table_rows(jobs.read_back(spark, tables))


@query(table_rows_sql((6, 6)))
def batch_job_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 K4: the batch job run again on the same log leaves the same tables."""
    tables = Tables(work_folder(spark, "batch"))
    for _ in range(2):
        jobs.process_batch(batch_logs(spark, sf_dir), tables, JSON, (WINDOW, WINDOW))
    return table_rows(jobs.read_back(spark, tables))


@query(table_rows_sql((6, 6)))
def batch_job_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job on a topic that grows, each run reading what is new.

    The log comes in three parts by time; a fourth run finds nothing.
    """
    folder = work_folder(spark, "by-days")
    tables, topics = Tables(f"{folder}/tables"), FileTopics(f"{folder}/topics")
    logs = batch_logs(spark, sf_dir)
    span = topics_of.read_events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    edges = [span[0] + (span[1] - span[0]) * share for share in (0.6, 0.97, 2.0)]
    before = None
    for until in [*edges, None]:
        if until is not None:
            for name, log in logs.items():
                part = log.where(F.col("timestamp") < F.lit(until).cast("timestamp"))
                if before is not None:
                    part = part.where(F.col("timestamp") >= F.lit(before).cast("timestamp"))
                numbered_by_time(part, 0 if before is None else edges.index(until)).write.mode("append").parquet(topics.path(name))
            before = until
        read = jobs.process_new(spark, topics, tables, JSON, (WINDOW, WINDOW))
        if until is None and any(read.values()):
            raise AssertionError(f"messages read again: {read}")
    return table_rows(jobs.read_back(spark, tables))


def numbered_by_time(log: DataFrame, part: int) -> DataFrame:
    """A log whose later parts have higher offsets, as a topic's messages have."""
    return log.withColumn("offset", F.col("offset") + F.lit(part) * (1 << 40))


@query(ERROR_COUNTS_SQL)
def quality_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors counted in the dead-letter tables of a job."""
    tables = Tables(work_folder(spark, "quality"))
    for name, log in batch_logs(spark, sf_dir).items():
        dead = quality.dead_letters(quality.decode_log(log, JSON[name]), JSON[name])
        rows = streaming.dead_letter_rows(dead)
        sink.append(rows, tables, JSON[name].dead_letter_table, sink.INGEST_DATE)
    return jobs.monitor_quality(spark, tables, JSON)


@query(interval_attribution_sql(sides_sql(), 6))
def attribution_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution from date-partitioned tables, some days at a time, one period twice."""
    tables = Tables(work_folder(spark, "periods"))
    for spec, side in zip((BIDS, IMPRESSIONS, CLICKS), sides(spark, sf_dir)):
        sink.append(quality.curated_columns(side, spec), tables, spec.table)
    span = tables.read(spark, BIDS.table).agg(F.min("event_date"), F.max("event_date")).first()
    first, last = span
    step = (last - first) // 3 + timedelta(days=1)
    while first <= last:
        period = (first, min(last, first + step - timedelta(days=1)))
        jobs.attribute_period(spark, tables, *period, WINDOW, WINDOW)
        first += step
    jobs.attribute_period(spark, tables, *period, WINDOW, WINDOW)
    return flat_attribution(tables.read(spark, ATTRIBUTION_TABLE))


# --- streams ---------------------------------------------------------------------------


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful dedup with a watermark."""
    tables = Tables(work_folder(spark, "dedup"))
    stream = topics_of.stream_events(spark, sf_dir).select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_time")
    )
    unique = drop_stream_copies(stream, ["user_id", "event_type"], DELAY)
    rows = unique.select("user_id", "event_type")
    streaming.finish([sink.append_stream(rows, tables, "unique", None)])
    return tables.read(spark, "unique")


@query(interval_attribution_sql(sides_sql(), 6))
def stream_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics to curated tables to attribution, all as streams.

    The job runs twice on the same checkpoints; the second run brings one late
    record per topic, which closes the windows of all bids of the first.
    """
    folder = work_folder(spark, "stream")
    topics, tables = staged_topics(spark, sf_dir, folder), Tables(f"{folder}/tables")
    options = dict(impression_window=WINDOW, click_window=WINDOW, delay=DELAY)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    deliver_sentinels(spark, sf_dir, topics)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    real = tables.read(spark, ATTRIBUTION_TABLE).filter(F.col("user_id") != "-1")
    return flat_attribution(real)


@query(interval_attribution_sql(sides_sql(), 6))
def stream_late_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fifths of all rows come after the windows of their bids have closed.

    The stream drops them; the days they reached are attributed again.
    """
    folder = work_folder(spark, "late-attribution")
    topics, tables = FileTopics(f"{folder}/topics"), Tables(f"{folder}/tables")
    late = F.pmod(F.xxhash64("offset"), F.lit(5)) < 2
    options = dict(impression_window=WINDOW, click_window=WINDOW, delay=DELAY)
    for part in (~late, late):
        for name, log in batch_logs(spark, sf_dir).items():
            log.where(part).write.mode("append").parquet(topics.path(name))
        if part is not late:
            deliver_sentinels(spark, sf_dir, topics)
        jobs.process_streams(spark, topics, tables, JSON, **options)
    jobs.attribute_late(spark, tables, **options)
    real = jobs.read_attribution(spark, tables).filter(F.col("user_id") != "-1")
    return flat_attribution(real)


@query(
    f"""SELECT source AS "table", CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS id,
    {ISO_SQL} AS "timestamp", detail, NULL AS "partition" FROM ({MAIN_ROWS_SQL})
    UNION ALL SELECT 'dead_letter_' || source, NULL, CAST(event_id AS VARCHAR), NULL,
    CASE event_type WHEN 'error' THEN 'undecodable' ELSE 'missing_user_id' END, CAST(p AS VARCHAR)
    FROM ({ALL_TOPICS_SQL}), (VALUES (0), (1)) AS copies(p) WHERE event_type IN ('error', 'signup')"""
)
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each topic read once for its curated and its dead-letter table.

    Every message arrives twice, in several micro-batches; the tables hold it
    once per place in the log (dead letters) or once per key (curated).
    """
    folder = work_folder(spark, "fan-out")
    staged, tables = staged_topics(spark, sf_dir, folder, deliveries=2, parts=2), Tables(f"{folder}/tables")
    logs = read_streams(spark, staged, JSON)
    streaming.finish(
        [streaming.start_fan_out(logs[name], spec, tables) for name, spec in JSON.items()]
    )
    rows = []
    for name, spec in JSON.items():
        good = tables.read(spark, name).select(F.lit(name).alias("table"), *record_columns(spec))
        rows.append(good.withColumn("partition", F.lit(None).cast("string")))
        none = F.lit(None).cast("string")
        rows.append(
            tables.read(spark, spec.dead_letter_table).select(
                F.lit(spec.dead_letter_table).alias("table"),
                none.alias("user_id"),
                F.col("offset").cast("string").alias("id"),
                none.alias("timestamp"),
                F.col("reason").alias("detail"),
                F.col("partition").cast("string").alias("partition"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query(
    f"""SELECT source, count(*) AS rows_read,
    count(*) FILTER (event_type IN ('error', 'signup')) AS data_quality_errors,
    count(*) FILTER (event_type = 'error') AS undecodable,
    count(*) FILTER (event_type = 'signup') AS missing_user_id
    FROM ({ALL_TOPICS_SQL}) GROUP BY source"""
)
def stream_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and errors counted by the streams while they pass.

    Many micro-batches, while Spark itself remembers the progress of one.
    """
    folder = work_folder(spark, "metrics")
    staged, tables = staged_topics(spark, sf_dir, folder, parts=4), Tables(f"{folder}/tables")
    logs = read_streams(spark, staged, JSON)
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1"}):
        running = [streaming.start_dead_letters(logs[name], spec, tables) for name, spec in JSON.items()]
        streaming.finish(running)
    names = ["rows_read", "data_quality_errors", "undecodable", "missing_user_id"]
    totals = [
        batch_counts(spark, tables, spec)
        .agg(*[F.sum(n).alias(n) for n in names])
        .withColumn("source", F.lit(name))
        for name, spec in JSON.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@query(interval_attribution_sql(sides_sql(*[busy_sql("1")] * 3), 1))
def stream_attribution_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_attribution``, a third of all rows on one user.

    The stream leaves that user's bids from the middle of the time on to a batch run.
    """
    hour = timedelta(hours=1)
    folder = work_folder(spark, "stream-busy")
    topics, tables = staged_topics(spark, sf_dir, folder, user=busy("1")), Tables(f"{folder}/tables")
    mean = F.avg(F.unix_micros(F.col("ts").cast("timestamp"))).cast("long")
    middle = topics_of.read_events(spark, sf_dir).agg(mean).first()[0]
    listed = spark.range(1).select(F.lit("1").alias("user_id"), F.timestamp_micros(F.lit(middle)).alias("since"))
    options = dict(impression_window=hour, click_window=hour, delay=DELAY, busy=listed)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    deliver_sentinels(spark, sf_dir, topics)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    jobs.attribute_busy(spark, tables, listed, hour, hour)
    streamed = tables.read(spark, ATTRIBUTION_TABLE).filter(F.col("user_id") != "-1")
    return flat_attribution(streamed).unionByName(
        flat_attribution(tables.read(spark, BUSY_ATTRIBUTION_TABLE))
    )


@query(interval_attribution_sql(sides_sql(*[busy_sql("1")] * 3), 1))
def stream_attribution_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_attribution_busy``, without a list: the job finds the busy user."""
    hour = timedelta(hours=1)
    folder = work_folder(spark, "stream-found")
    topics, tables = staged_topics(spark, sf_dir, folder, user=busy("1")), Tables(f"{folder}/tables")
    options = dict(impression_window=hour, click_window=hour, delay=DELAY, find_busy=True)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    deliver_sentinels(spark, sf_dir, topics)
    jobs.process_streams(spark, topics, tables, JSON, **options)
    return flat_attribution(jobs.read_attribution(spark, tables).filter(F.col("user_id") != "-1"))


SCHEMA_FIELDS = {
    "key": "binary",
    "value": "binary",
    "topic": "string",
    "partition": "integer",
    "offset": "long",
    "timestamp": "timestamp",
    "timestampType": "integer",
}


@query(
    "SELECT t.topic, f.field, f.kind, count(e.event_id) AS messages FROM (VALUES "
    + ", ".join(f"('{name}')" for name in JSON)
    + ") AS t(topic), (VALUES "
    + ", ".join(f"('{field}', '{kind}')" for field, kind in SCHEMA_FIELDS.items())
    + f") AS f(field, kind), ({ALL_TOPICS_SQL}) AS e WHERE e.source = t.topic GROUP BY ALL"
)
def schema_print(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the printed schema of each topic's stream, line by line, with the messages read under it."""
    folder = work_folder(spark, "schema")
    topics = staged_topics(spark, sf_dir, folder)
    rows = []
    for name, log in read_streams(spark, topics, JSON).items():
        text = F.explode(F.split(F.lit(schema_text(log)), "\n"))
        lines = topics.table(spark, name).agg(F.count(F.lit(1)).alias("messages")).select("messages", text.alias("line"))
        field, kind = (F.regexp_extract("line", r"\|-- (\w+): (\w+)", n) for n in (1, 2))
        rows.append(
            lines.select(F.lit(name).alias("topic"), field.alias("field"), kind.alias("kind"), "messages").where("field <> ''")
        )
    return reduce(DataFrame.unionByName, rows)
