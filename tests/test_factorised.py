from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from adtrail.operators import attribution, factorised, quality
from adtrail.plans import jobs
from adtrail.registry import ATTRIBUTION_TABLE, BID_SCHEMA, IMPRESSIONS
from adtrail.registry import BIDS as BIDS_SPEC, CLICKS as CLICKS_SPEC
from adtrail.session import settings
from adtrail.sources.tables import Tables
from tests.test_attribution import expected, frames, result

BIDS = [("hot", n) for n in range(40)] + [("a", 1), ("a", 0), ("b", 5), ("lonely", 2)]
SHOWN = [("hot", n) for n in range(9)] + [("a", 3), ("a", 1), ("nobody", 1)]
CLICKS = [("hot", n) for n in range(6)] + [("b", 9), ("nobody", 2)]


def test_expansion_equals_all_combinations(spark):
    three = frames(spark, BIDS, SHOWN, CLICKS)
    for chunk in (1, 4, 4096):
        parts = factorised.factorise(*three, chunk=chunk)
        assert result(factorised.expand(parts)) == expected(BIDS, SHOWN, CLICKS)
    whole = attribution.nested(attribution.attribute_by_user(*three))
    got = attribution.nested(factorised.expand(factorised.factorise(*three)))
    assert Counter(map(repr, got.collect())) == Counter(map(repr, whole.collect()))


def test_size_is_linear_and_arrays_are_bounded(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "8"}):
        parts = factorised.factorise(*frames(spark, BIDS, SHOWN, CLICKS), chunk=3)
        rows = parts.collect()
    for name, side in zip(factorised.SIDES, (BIDS, SHOWN, CLICKS)):
        arrays = [r[name] for r in rows if r[name] is not None]
        assert sum(map(len, arrays)) == len(side) and max(map(len, arrays)) <= 3
        for events in arrays:
            assert [e.timestamp for e in events] == sorted(e.timestamp for e in events)
    assert len({r.cell for r in rows if r.user_id == "hot"}) > 1


def test_combinations_from_sizes(spark):
    parts = factorised.factorise(*frames(spark, BIDS, SHOWN, CLICKS), chunk=2)
    got = {r.user_id: tuple(r)[1:] for r in factorised.combinations(parts).collect()}
    assert got == {"hot": (40, 9, 6, 2160), "a": (2, 2, 0, 4), "b": (1, 0, 1, 1), "lonely": (1, 0, 0, 1)}


def test_no_user_copies_and_no_rows(spark):
    three = frames(spark, [("a", 1), ("a", 1)], [("a", 2), ("a", 2)], [])
    assert sum(result(factorised.expand(factorised.factorise(*three))).values()) == 4
    empty = frames(spark, [], [], [])
    assert factorised.factorise(*empty).count() == 0
    assert factorised.expand(factorised.factorise(*empty)).count() == 0
    nobody = spark.createDataFrame([(None, "a1", None, None)], BID_SCHEMA).withColumn("event_time", F.lit(None).cast("timestamp"))
    parts = factorised.factorise(nobody, *empty[1:])
    assert factorised.expand(parts).count() == 1
    assert factorised.combinations(parts).first()["combinations"] == 1


def test_packed_rows_open_to_all_combinations(spark):
    three = frames(spark, BIDS, SHOWN, CLICKS)
    hot = attribution.find_hot_users(*three)
    assert hot is not None
    for listed in (None, hot):
        for pack in (1, 4, 32):
            rows = factorised.packed(*three, listed, pack=pack)
            assert result(factorised.opened(rows)) == expected(BIDS, SHOWN, CLICKS)
    whole = attribution.nested(attribution.attribute_by_user(*three), reference_user_id=True)
    got = attribution.nested(factorised.opened(factorised.packed(*three, hot)), reference_user_id=True)
    assert Counter(map(repr, got.collect())) == Counter(map(repr, whole.collect()))


def test_packed_rows_with_copies_nobody_and_no_rows(spark):
    copies = frames(spark, [("a", 1), ("a", 1)], [("a", 2), ("a", 2)], [])
    assert sum(result(factorised.opened(factorised.packed(*copies))).values()) == 4
    empty = frames(spark, [], [], [])
    assert factorised.opened(factorised.packed(*empty)).count() == 0
    nobody = spark.createDataFrame([(None, "a1", None, None)], BID_SCHEMA).withColumn("event_time", F.lit(None).cast("timestamp"))
    shown = spark.createDataFrame([("i1", None, None, None)], "ad_creative_id string, user_id string, timestamp string, website string")
    opened = factorised.opened(factorised.packed(nobody, shown, empty[2])).collect()
    assert len(opened) == 1 and opened[0].ad_creative_id is None


def test_what_is_shuffled_by_date_is_bids_with_arrays(spark, tmp_path, monkeypatch):
    """A user with 40 x 9 x 6 combinations is gathered by date as 40 rows, not as 2,160."""
    gathered = []
    replace = jobs.sink.replace

    def counted(df, *args, **options):
        gathered.append(df.count())
        replace(df, *args, **options)

    monkeypatch.setattr(jobs.sink, "replace", counted)
    tables = Tables(str(tmp_path))
    for spec, side in zip((BIDS_SPEC, IMPRESSIONS, CLICKS_SPEC), frames(spark, BIDS, SHOWN, CLICKS)):
        jobs.sink.append(quality.curated_columns(side, spec), tables, spec.table)
    with settings(spark, {"spark.sql.shuffle.partitions": "1"}):  # no user is hot
        jobs.attribute_tables(spark, tables, None)
    rows = tables.read(spark, ATTRIBUTION_TABLE)
    assert gathered == [len(BIDS)]
    assert rows.count() == 2160 + 4 + 1 + 1
    assert rows.where("event_date IS NULL OR event_date <> to_date(bid_requests.timestamp)").isEmpty()
