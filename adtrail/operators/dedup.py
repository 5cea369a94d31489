"""Removal of copies by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one arbitrary row per key; NULL keys equal each other.

    Copies are dropped inside each task before the shuffle, so a key with very
    many copies sends one row per task.
    """
    return df.dropDuplicates(keys)


def keep_first(
    df: DataFrame, keys: list[str], order: list[str], drop_order: bool = False
) -> DataFrame:
    """Keep the row that comes first by ``order`` in each key.

    ``min_by`` is an aggregate with a map-side part: like ``drop_copies``, a
    task sends one row per key. ``order`` should be unique inside a key, and
    NULL comes first. ``drop_order`` leaves the columns of ``order`` out of the
    result and so out of the shuffle's second copy of them.
    """
    columns = [name for name in df.columns if not (drop_order and name in order)]
    others = [name for name in columns if name not in keys]
    if not others:
        return df.select(*columns).dropDuplicates(keys)
    kept = F.min_by(F.struct(*others), F.struct(*order))
    return (
        df.groupBy(*keys)
        .agg(kept.alias("kept"))
        .select(*[F.col(c) if c in keys else F.col(f"kept.`{c}`").alias(c) for c in columns])
    )
