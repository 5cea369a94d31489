"""What earlier batch runs have done: the next offset of each partition of a topic.

One small file per source below the tables, written after all rows up to these
offsets are in their tables and attributed. A run that dies before reads the same
range again, and its appends find the rows already there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.sources.tables import Tables, keep_text, kept_text
from adtrail.sources.topics import Offsets

FOLDER = "_offsets"


def _path(tables: Tables, source: str) -> str:
    return tables.side_folder(f"{FOLDER}/{source}.json")


def next_offsets(spark: SparkSession, tables: Tables, source: str) -> Offsets:
    """Where the next run begins; partitions that were never read are not in it."""
    text = kept_text(spark, _path(tables, source))
    return {int(p): n for p, n in json.loads(text).items()} if text else {}


def commit(spark: SparkSession, tables: Tables, source: str, offsets: Offsets) -> None:
    """Let the next run begin at ``offsets``."""
    kept = next_offsets(spark, tables, source) | offsets
    keep_text(spark, _path(tables, source), json.dumps(kept))


def offsets_after(log: DataFrame) -> Offsets:
    """The offsets that follow the rows of a log; a row per partition reaches the driver."""
    rows = log.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()
    return {row["partition"]: row["next"] for row in rows}
