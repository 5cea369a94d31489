"""Appends to tables, from batch frames and from streams."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date as Date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from adtrail.session import STREAM_CONF, settings, state_partitions
from adtrail.sinks.keys import KEY, KeyIndex, by_date, digest, without_held_by_table
from adtrail.sources.tables import Tables, files_in, remove_folder

EVENT_DATE = "event_date"
INGEST_DATE = "ingest_date"
MAX_DATES = 1000
#: Files a micro-batch adds to a date.
FILES_PER_DATE = 4
#: For rows that become many in the task that writes them.
OPENED_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}

#: For a stream whose rows become many in the task that writes them: it writes its few dates side by side.
SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def create_if_absent(
    df: DataFrame, tables: Tables, table: str, partition_by: str | None = EVENT_DATE
) -> None:
    """Make a catalog table with the columns of ``df``; tables of files need none."""
    if tables.in_catalog and not tables.exists(df.sparkSession, table):
        empty = df.sparkSession.createDataFrame([], df.schema)
        writer = empty.writeTo(tables.path(table)).using(tables.fmt)
        if partition_by is not None:
            writer = writer.partitionedBy(F.col(partition_by))
        writer.create()


def append(
    df: DataFrame,
    tables: Tables,
    table: str,
    partition_by: str | None = EVENT_DATE,
    rows: int | None = None,
) -> None:
    """Append a batch frame.

    The rebalance hint gathers the rows of a date into files of the advisory
    size: many small tasks do not each leave a file per date, and a date with
    very many rows is still written by many tasks. Few ``rows``, if their number is
    known, need no such care, and their dates are written side by side.
    """
    if tables.in_catalog:
        create_if_absent(df, tables, table, partition_by)
        df.writeTo(tables.path(table)).append()
        return
    if partition_by is None:
        df.write.format(tables.fmt).mode("append").save(tables.path(table))
        return
    writer = by_date(df, partition_by, rows).write.format(tables.fmt).mode("append")
    writer.partitionBy(partition_by).save(tables.path(table))


def replace(
    df: DataFrame,
    tables: Tables,
    table: str,
    date: str = EVENT_DATE,
    opened: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a batch frame in place of all the table holds.

    ``opened`` makes the rows of the table from those of ``df`` after these are gathered
    by date, so that few rows are shuffled where many are written. A task then gets fewer
    bytes, and writes its few dates side by side instead of sorting what was opened.
    """
    if tables.in_catalog:
        df = df if opened is None else opened(df)
        create_if_absent(df, tables, table, date)
        df.writeTo(tables.path(table)).overwrite(F.lit(True))
        return
    rows = df.hint("rebalance", date)
    with settings(df.sparkSession, {} if opened is None else OPENED_CONF):
        writer = (rows if opened is None else opened(rows)).write.format(tables.fmt).mode("overwrite")
        writer.option("partitionOverwriteMode", "static").partitionBy(date).save(tables.path(table))


def replace_dates(
    df: DataFrame,
    tables: Tables,
    table: str,
    period: Column,
    date: str = EVENT_DATE,
) -> None:
    """Write a batch frame over the dates of ``period``, a condition on ``date``.

    All other dates stay. A date of the period that ``df`` has no row of is
    emptied, so this is safe to repeat with other rows.
    """
    spark = df.sparkSession
    if tables.in_catalog:
        create_if_absent(df, tables, table, date)
        df.writeTo(tables.path(table)).overwrite(period)
        return
    old = {}
    if tables.exists(spark, table):
        held = tables.read(spark, table).where(period).select(date).distinct()
        days = [row[0] for row in held.collect()]  # a row per date of the period
        parts = [f"{tables.path(table)}/{date}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in days]
        old = {part: files_in(spark, part) for part in parts}
    writer = df.hint("rebalance", date).write.format(tables.fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(date).save(tables.path(table))
    for part, files in old.items():
        if files_in(spark, part) == files:  # not written again: ``df`` has no row of that date
            remove_folder(spark, part)


def append_once(
    df: DataFrame,
    tables: Tables,
    table: str,
    keys: list[str],
    date: str,
    unique: bool = False,
    days: list[Date | None] | None = None,
) -> int:
    """Append the rows whose key the table does not hold yet; how many they were.

    Equal keys have equal dates, so of the table's key index only the dates of
    ``df`` are read, and of the table nothing: the cost follows ``df``. Copies
    inside ``df`` are dropped before the shuffle, unless it is ``unique`` by key;
    ``days`` spares the look for its dates. Running this again with the same rows
    adds nothing, which makes it safe for a micro-batch that is repeated after a
    failure, also one between table and index. NULL keys equal each other.

    All appends to such a table have to come through here, one at a time.
    """
    spark = df.sparkSession
    index = KeyIndex(spark, tables, table, tuple(keys), date)
    interrupted = index.interrupted
    index.ensure()
    index.begin()
    if days is None:
        days = dates_of(df, date)
    if days is not None and len(days) > MAX_DATES:
        days = None
    rows = df.withColumn(KEY, digest(keys))
    if not unique:  # by the digest, by which they also meet the index: one shuffle for both
        rows = rows.dropDuplicates([KEY])
    if not interrupted:
        fresh = index.without_held(rows, days)
    elif tables.exists(spark, table):
        fresh = without_held_by_table(rows, tables.read(spark, table), keys, _among(df, days, date))
    else:  # the index may have keys whose rows were never written
        fresh = rows
    fresh = fresh.persist()
    try:
        count = fresh.count()
        steps = []
        if count or not tables.exists(spark, table):
            steps.append(lambda: append(fresh.select(*df.columns), tables, table, date, count))
        if interrupted:
            steps.append(lambda: index.add(rows, days))
        elif count:
            steps.append(lambda: index.add(fresh, days, count))
        # In any order: while the marker stands, the next append trusts the table alone.
        together(spark, steps)
    finally:
        fresh.unpersist()
    index.end()
    return count


def together(spark: SparkSession, steps: list[Callable[[], object]]) -> None:
    """Run steps side by side, as jobs of this thread's query, and raise what any of them raised."""
    if len(steps) < 2:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(len(steps)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in done:
        step.result()


def dates_of(df: DataFrame, date: str) -> list[Date | None] | None:
    """The dates of ``df``; None where they are more than ``MAX_DATES``."""
    days = [row[0] for row in df.select(date).distinct().limit(MAX_DATES + 1).collect()]
    return days if len(days) <= MAX_DATES else None


def _among(df: DataFrame, days: list[Date | None] | None, date: str) -> Column:
    """A partition filter for the dates of ``df``: each of them, or their span if they are many."""
    undated = F.col(date).isNull()
    if days is not None:
        return F.col(date).isin([d for d in days if d is not None]) | (undated & F.lit(None in days))
    span = df.agg(F.min(date).alias("low"), F.max(date).alias("high")).first()
    return F.col(date).between(span["low"], span["high"]) | undated


def stream_writer(
    df: DataFrame, tables: Tables, table: str, partition_by: str | None = EVENT_DATE
) -> DataStreamWriter:
    """Append mode with one checkpoint per table."""
    writer = (
        df.writeStream.format(tables.fmt)
        .queryName(table)
        .outputMode("append")
        .option("checkpointLocation", tables.checkpoint(table))
    )
    if tables.in_catalog:  # takes its partitioning from the table
        create_if_absent(df, tables, table, partition_by)
        return writer
    writer = writer.option("path", tables.path(table))
    return writer if partition_by is None else writer.partitionBy(partition_by)


def start(
    writer: DataStreamWriter,
    df: DataFrame,
    once: bool = True,
    every: str = "1 minute",
    partitions: int | None = None,
    to_table: str | None = None,
) -> StreamingQuery:
    """Start a query: over all there is now (``once``) or for good."""
    trigger = {"availableNow": True} if once else {"processingTime": every}
    spark = df.sparkSession
    width = partitions or state_partitions(spark)
    conf = {**STREAM_CONF, "spark.sql.shuffle.partitions": str(width)}
    with settings(spark, conf):
        writer = writer.trigger(**trigger)
        return writer.start() if to_table is None else writer.toTable(to_table)


def append_stream(
    df: DataFrame,
    tables: Tables,
    table: str,
    partition_by: str | None = EVENT_DATE,
    files_per_date: int | None = FILES_PER_DATE,
    opened: Callable[[DataFrame], DataFrame] | None = None,
    **run,
) -> StreamingQuery:
    """Start appending a stream to a table and return the running query.

    A date's rows of a micro-batch are gathered into ``files_per_date`` tasks,
    each of which writes one file; with None every task writes a file per date
    it sees. Tasks are dealt by number, as a hash of so few would give some of them several. ``opened`` makes the rows of the table after that, as in ``replace``. ``run`` is
    passed to ``start``.
    """
    if tables.in_catalog:
        run["to_table"] = tables.path(table)
    if partition_by is not None and files_per_date is not None:
        piece = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if t == "string"]), F.lit(files_per_date))
        place = F.unix_date(partition_by) * files_per_date + piece
        df = df.repartitionById(run.get("partitions") or state_partitions(df.sparkSession), place.cast("int"))
    if opened is not None:
        df = opened(df)
    return start(stream_writer(df, tables, table, partition_by), df, **run)
