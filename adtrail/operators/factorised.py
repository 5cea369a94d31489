"""Attribution by user kept factorised: arrays of the three sides instead of all combinations.

A user with ``b`` bids, ``i`` impressions and ``c`` clicks has ``b * i * c`` combinations
but only ``b + i + c`` events. Here the events of a side are rows of at most ``CHUNK``
events of a user, in time order. What is known from numbers alone, such as how many
combinations a user has, is read from the sizes; ``expand`` gives all combinations.

``packed`` is between the two: a bid with arrays of its user's impressions and clicks,
which may be shuffled once more before ``opened`` makes the combinations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.operators import attribution, skew

CHUNK = 4096
SIDES = ("bids", "impressions", "clicks")
IDENTITIES = (attribution.BID_IDENTITY, attribution.IMPRESSION_IDENTITY, attribution.CLICK_IDENTITY)
#: Cells that bids without a user are dealt to; they match nothing.
SPREAD = 4096
#: Events of an array beside a bid. So few, because a task gets rows by their bytes: the
#: combinations of a row are at most ``PACK / 2`` times its events.
PACK = 32
PACKED = {"impressions": ["ad_creative_id", "website", "timestamp"], "clicks": ["campaign_id", "conversion_type", "timestamp"]}


def factorise(
    bids: DataFrame, impressions: DataFrame, clicks: DataFrame, chunk: int = CHUNK
) -> DataFrame:
    """``user_id, cell, chunk`` and one of the arrays ``bids, impressions, clicks``, the others NULL.

    Every bid is in one array, and every impression and click that has a user, so the
    size is that of the input. A user with far more than a task's share of a side has
    its events dealt to cells first; the list of such users is bounded by the number of
    tasks. Sides without rows give none.
    """
    named = dict(zip(SIDES, (bids, impressions.where("user_id IS NOT NULL"), clicks.where("user_id IS NOT NULL"))))
    chunks = {
        name: _chunks(df, identity, name, chunk)
        for (name, df), identity in zip(named.items(), IDENTITIES)
    }
    types = {name: df.schema[name].dataType for name, df in chunks.items()}
    parts = [
        df.select(
            "user_id",
            "cell",
            "chunk",
            *[F.col(s) if s == name else F.lit(None).cast(types[s]).alias(s) for s in SIDES],
        )
        for name, df in chunks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _chunks(df: DataFrame, identity: list[str], name: str, chunk: int) -> DataFrame:
    """One shuffle, by user and cell; the arrays are cut within it."""
    hot = skew.find_hot_groups(df, None, None, attribution.USER)
    rest = [c for c in df.columns if c not in ("user_id", "timestamp")]
    rows = df.select(
        "user_id",
        F.struct("timestamp", *rest).alias("event"),
        F.xxhash64(*identity).alias("dealt"),
    )
    cells = F.lit(1)
    if hot is not None:
        split = hot.select("user_id", F.col(skew.BIDS).alias("cells"))
        rows = rows.join(F.broadcast(split), "user_id", "left")
        cells = F.coalesce("cells", F.lit(1))
    cells = F.when(F.col("user_id").isNull(), SPREAD).otherwise(cells)
    rows = rows.withColumn("cell", F.pmod("dealt", cells).cast("int"))
    order = Window.partitionBy("user_id", "cell").orderBy("event.timestamp", "dealt")
    numbered = rows.withColumn("n", F.row_number().over(order))
    numbered = numbered.withColumn("chunk", F.floor((F.col("n") - 1) / chunk).cast("int"))
    # Events may hold maps, which have no order: the number alone is compared.
    by_number = F.array_sort(F.collect_list(F.struct("n", "event")), lambda a, b: a["n"] - b["n"])
    return numbered.groupBy("user_id", "cell", "chunk").agg(
        F.transform(by_number, lambda p: p["event"]).alias(name)
    )


def sides(parts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The bids, impressions and clicks again, a row per event."""
    return tuple(
        parts.where(F.col(name).isNotNull())
        .select("user_id", F.explode(name).alias("event"))
        .select("user_id", "event.*")
        for name in SIDES
    )


def expand(parts: DataFrame) -> DataFrame:
    """All combinations, as ``attribute_by_user`` gives them, hot users split over tasks."""
    three = sides(parts)
    tasks = attribution.output_tasks(*three)
    return attribution.attribute_by_user(*three, attribution.find_hot_users(*three, tasks), tasks)


def combinations(parts: DataFrame) -> DataFrame:
    """``user_id, bids, impressions, clicks, combinations``, a row per user that has a bid.

    Only sizes of arrays are read. A bid without an impression is one combination, and so
    is a bid with an impression without a click. Bids without a user are one row.
    """
    totals = parts.groupBy("user_id").agg(
        *[F.sum(F.when(F.col(s).isNotNull(), F.size(s)).otherwise(0)).cast("long").alias(s) for s in SIDES]
    )
    shown = F.col("impressions") > 0
    each = F.when(shown, F.col("impressions") * F.greatest("clicks", F.lit(1))).otherwise(1)
    return totals.where("bids > 0").withColumn("combinations", F.col("bids") * each)


def packed(
    bids: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    hot: DataFrame | None = None,
    tasks: int | None = None,
    pack: int = PACK,
) -> DataFrame:
    """``attribute_by_user`` before its combinations: bids, each with arrays of impressions and clicks.

    A bid is in a row for each pair of its user's arrays, which have at most ``pack``
    events; NULL arrays stand for a side without rows. ``hot`` users are dealt to cells
    as there, and both joins keep the partitioning by user.
    """
    tasks = tasks or int(bids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(attribution.USER)
    if hot is not None:
        b, i, c = attribution.BID_IDENTITY, attribution.IMPRESSION_IDENTITY, attribution.CLICK_IDENTITY
        bids = skew.spread_bids(bids, hot, keys, b, F.col(skew.ANY_IMPRESSIONS))
        impressions = skew.spread_impressions(impressions, hot, keys, i, F.col(skew.ANY_CLICKS))
        clicks = skew.spread_clicks(clicks, hot, keys, c)
        keys.append(skew.CELL)
    else:
        bids = bids.withColumn(skew.HAS_IMPRESSION, F.lit(False))
        impressions = impressions.withColumn(skew.HAS_CLICK, F.lit(False))
    shown = _arrays(impressions, "impressions", keys, tasks, pack, skew.HAS_CLICK)
    clicked = _arrays(clicks, "clicks", keys, tasks, pack)
    bid = F.struct("auction_id", "targeting_criteria", "timestamp").alias("bid")
    found = F.col("impressions").isNotNull()
    first = (
        bids.select(*keys, bid, skew.HAS_IMPRESSION)
        .repartition(tasks, *keys)
        .join(shown, keys, "left")
        .where(found | ~F.col(skew.HAS_IMPRESSION))
    )
    # A click joins where there is an impression.
    first, clicked = first.alias("first"), clicked.alias("clicked")
    same = [F.col(f"first.{key}") == F.col(f"clicked.{key}") for key in keys]
    return (
        first.join(clicked, reduce(lambda x, y: x & y, same) & found, "left")
        .where(F.col("clicks").isNotNull() | ~found | ~F.col(skew.HAS_CLICK))
        .select("first.user_id", "bid", "impressions", "clicks")
    )


def _arrays(df: DataFrame, name: str, keys: list[str], tasks: int, pack: int, *flags: str) -> DataFrame:
    """The events of a side that have a user as arrays, in one shuffle, that of the joins."""
    dealt = F.xxhash64(*PACKED[name])
    rows = df.where("user_id IS NOT NULL").select(*keys, *flags, F.struct(*PACKED[name]).alias("event"), dealt.alias("dealt"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("dealt"))
    numbered = rows.repartition(tasks, *keys).withColumn("chunk", F.floor((number - 1) / pack))
    return numbered.groupBy(*keys, *flags, "chunk").agg(F.collect_list("event").alias(name)).drop("chunk")


def opened(rows: DataFrame, *others: str) -> DataFrame:
    """All combinations of ``packed`` rows, flat as ``attribute_by_user`` gives them, and columns to keep."""
    shown = F.col("impressions").isNotNull()
    one = rows.select("*", shown.alias("shown"), F.explode_outer("impressions").alias("impression"))
    all_of = one.select("*", F.explode_outer("clicks").alias("click"))
    return all_of.select(
        "user_id",
        F.when(F.col("shown"), F.col("user_id")).alias("impression_user_id"),
        "bid.auction_id",
        "bid.targeting_criteria",
        F.col("bid.timestamp").alias("bid_requests_timestamp"),
        "impression.ad_creative_id",
        "impression.website",
        F.col("impression.timestamp").alias("ad_impressions_timestamp"),
        "click.campaign_id",
        "click.conversion_type",
        F.col("click.timestamp").alias("clicks_conversions_timestamp"),
        *others,
    )
