"""Splitting of hot groups in the attribution joins.

A group (a user, or a user in one time bucket) with ``nb`` bids, ``ni``
impressions and ``nc`` clicks is one join key and so one task. A hot group is
cut into a grid of cells instead: bids are hashed along one axis, impressions
along the second, clicks along the third, and each row is copied to the cells
its own axis does not fix. Every bid x impression x click combination then
meets in exactly one cell.

Left joins also keep rows without a partner. Such a row is put in one cell
only; a row that has a partner in some cell is dropped from the cells where it
found none. Which of the two a row is must be known before the join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

CELL = "cell"
BIDS, IMPRESSIONS, CLICKS = "s_bids", "s_impressions", "s_clicks"
AXES = (BIDS, IMPRESSIONS, CLICKS)
ANY_IMPRESSIONS, ANY_CLICKS = "any_impressions", "any_clicks"
HAS_IMPRESSION, HAS_CLICK = "has_impression", "has_click"

# A group is hot from this many times an even share of the work.
HOT_SHARES = 2
# Rows a task of an all-pairs join should read and make.
TASK_ROWS = 5_000_000


def find_hot_groups(
    bids: DataFrame,
    impressions: DataFrame | None,
    clicks: DataFrame | None,
    keys: list[str],
    tasks: int | None = None,
) -> DataFrame | None:
    """Groups with far more work than an even share of ``tasks``, with their splits.

    Runs one aggregation over the key columns. No more than ``tasks / HOT_SHARES`` groups can
    exceed so many shares of a task, so no more rows reach the driver
    whatever the size of the data. Returns None when no group is hot.
    """
    spark = bids.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    largest = (
        _work(bids, impressions, clicks, keys)
        .observe(seen, F.sum("work").alias("total"))
        .orderBy(F.desc("work"))
        .limit(tasks // HOT_SHARES + 1)  # one more, for the group of NULL
        .collect()
    )
    if not largest:
        return None
    share = seen.get["total"] / tasks
    hot = []
    for row in largest:
        if row["work"] <= HOT_SHARES * share or any(row[key] is None for key in keys):
            continue
        splits = grid(row["b"], row["i"], row["c"], row["work"] / share)
        if splits != (1, 1, 1):
            hot.append((*[row[key] for key in keys], *splits, row["i"] > 0, row["c"] > 0))
    if not hot:
        return None
    columns = [f"{key} {bids.schema[key].dataType.simpleString()}" for key in keys]
    columns += [f"{name} int" for name in AXES]
    columns += [f"{name} boolean" for name in (ANY_IMPRESSIONS, ANY_CLICKS)]
    return spark.createDataFrame(hot, ", ".join(columns))


def _work(
    bids: DataFrame, impressions: DataFrame | None, clicks: DataFrame | None, keys: list[str]
) -> DataFrame:
    """Rows of each side per group, and the rows a join of the group reads and makes."""
    tagged = [
        df.select(*keys, *[F.lit(int(name == own)).alias(name) for name in "bic"])
        for own, df in zip("bic", (bids, impressions, clicks))
        if df is not None
    ]
    counts = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(*keys)
        .agg(*[F.sum(n).cast("double").alias(n) for n in "bic"])
    )
    rows = F.col("b") + F.col("i") + F.col("c")
    combinations = F.col("b") * F.greatest("i", F.lit(1.0)) * F.greatest("c", F.lit(1.0))
    joined = F.when(F.col("i") == 0, F.col("b")).otherwise(combinations)
    return counts.withColumn("work", rows + joined)


def output_tasks(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame | None,
    keys: list[str],
    matched: float = 1.0,
    task_rows: int = TASK_ROWS,
) -> int:
    """Tasks that keep a task's share of the join near ``task_rows``, the shuffle width at least.

    ``matched`` is the part of the combinations that the join returns.
    """
    rows = F.col("b") + F.col("i") + F.col("c")
    made = rows + (F.col("work") - rows) * matched
    total = _work(bids, impressions, clicks, keys).agg(F.sum(made)).first()[0] or 0
    width = int(bids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, math.ceil(total / task_rows))


def grid(nb: float, ni: float, nc: float, cells: float) -> tuple[int, int, int]:
    """Splits per axis for about ``cells`` cells.

    Rows are copied least when the pieces of all axes are equally large.
    """
    sizes = [max(n, 1.0) for n in (nb, ni, nc)]
    s_bids = _pieces(nb, (sizes[0] * sizes[1] * sizes[2] / cells) ** (1 / 3), cells)
    cells /= s_bids
    s_impressions = _pieces(ni, math.sqrt(sizes[1] * sizes[2] / max(cells, 1.0)), cells)
    cells /= s_impressions
    return s_bids, s_impressions, _pieces(nc, 1.0, cells)


def bids_only(hot: DataFrame, keys: list[str]) -> DataFrame:
    """The same groups with only their bids split: needs to know of no partners."""
    return hot.select(
        *keys,
        BIDS,
        *[F.lit(1).alias(name) for name in (IMPRESSIONS, CLICKS)],
        *[F.lit(False).alias(name) for name in (ANY_IMPRESSIONS, ANY_CLICKS)],
    )


def without_clicks(hot: DataFrame) -> DataFrame:
    """The same groups for a join of bids and impressions alone."""
    return hot.withColumns({CLICKS: F.lit(1), ANY_CLICKS: F.lit(False)})


def spread_bids(
    bids: DataFrame,
    hot: DataFrame,
    keys: list[str],
    identity: list[str],
    partner: Column,
    small: bool = True,
) -> DataFrame:
    """Bids with their cells; ``partner`` says whether a bid of a hot group has an impression."""
    copies = [F.col(BIDS), F.when(partner, F.col(IMPRESSIONS)), F.when(partner, F.col(CLICKS))]
    return _spread(bids, hot, keys, identity, BIDS, copies, {HAS_IMPRESSION: partner}, small)


def spread_impressions(
    impressions: DataFrame,
    hot: DataFrame,
    keys: list[str],
    identity: list[str],
    partner: Column,
    small: bool = True,
) -> DataFrame:
    """Impressions with their cells; ``partner`` as above for clicks."""
    copies = [F.col(BIDS), F.col(IMPRESSIONS), F.when(partner, F.col(CLICKS))]
    return _spread(impressions, hot, keys, identity, IMPRESSIONS, copies, {HAS_CLICK: partner}, small)


def spread_clicks(
    clicks: DataFrame, hot: DataFrame, keys: list[str], identity: list[str]
) -> DataFrame:
    return _spread(clicks, hot, keys, identity, CLICKS, [F.col(name) for name in AXES], {})


def _spread(
    df: DataFrame,
    hot: DataFrame,
    keys: list[str],
    identity: list[str],
    axis: str,
    copies: list[Column],
    flags: dict[str, Column],
    small: bool = True,
) -> DataFrame:
    """Copy rows of hot groups to their cells; all other rows get cell 0.

    ``identity`` names columns that differ between the rows of a group; their
    hash picks the piece, so a recomputed task picks the same one. ``hot`` has
    fewer rows than the join has tasks and is broadcast for that reason; where
    what it carries is not ``small``, Spark joins it as it sees fit.
    """
    joined = df.join(F.broadcast(hot) if small else hot, keys, "left")
    own = F.pmod(F.xxhash64(*identity), F.col(axis)).cast("int")
    places = [
        F.array(own)
        if name == axis
        else F.sequence(F.lit(0), F.coalesce(number, F.lit(1)) - 1)
        for name, number in zip(AXES, copies)
    ]
    row = F.lit(0).cast("int")
    cells = F.transform(places[0], lambda a: row + a)
    for name, place in zip(AXES[1:], places[1:]):
        cells = _cross(cells, place, F.col(name))
    is_hot = F.col(BIDS).isNotNull()
    return joined.select(
        *df.columns,
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
        F.explode(F.when(is_hot, cells).otherwise(F.array(row))).alias(CELL),
    )


def _cross(cells: Column, places: Column, width: Column) -> Column:
    return F.flatten(F.transform(cells, lambda c: F.transform(places, lambda p: c * width + p)))


def _pieces(rows: float, piece: float, most: float) -> int:
    return max(1, math.ceil(min(rows / max(piece, 1.0), rows, most)))
