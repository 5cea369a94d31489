"""Shards by jump consistent hashing of a stable key.

The shard follows from key and shard count alone, so no ring is stored, and
with one shard more a key either stays or moves into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import ranked

#: Fixed value of the published algorithm: multiplier of its generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        with np.errstate(over="ignore"):
            state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard.astype(np.int32)


def shard_of(key, shards: int):
    """Column of shards of a column of long keys; a null key counts as 0."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.coalesce(key.cast("long"), F.lit(0)))


def shard(docs: DataFrame, shards: int = 16, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, law ``key``.

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``: bytes of the
    text plus one, its checksum, the shard of ``shards`` and of one more, and a
    gapless place in the shard in the order of the ids. A null text has size 1
    and checksum 0. Null ids count as key 0 and come first; repeated rows get
    places of their own. An empty table gives an empty result; columns beyond
    id and text are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.col("doc_id")
    rows = (
        docs.select(
            F.col(ident).cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
        )
        .withColumn("law", F.lit("key"))
        .withColumn("shard", shard_of(key, shards))
        .withColumn("grown_shard", shard_of(key, shards + 1))
    )
    return ranked(rows, "shard", ["doc_id", "size", "text_crc32"], "slot")
