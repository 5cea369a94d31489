from __future__ import annotations

import json
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from adtrail.operators import quality
from adtrail.plans import jobs, ledger
from adtrail.plans.queries import ORACLE, USER_JOIN_SQL
from adtrail.plans.ingest import ingest
from adtrail.registry import IMPRESSIONS, json_sources
from adtrail.session import settings, work_folder
from adtrail.sinks import keys as keys_of
from adtrail.sinks import tables as sink
from adtrail.sources.tables import Tables, files_in, preview
from adtrail.sources.topics import FileTopics


def impression(n, day=31, user=None):
    return json.dumps(
        {
            "ad_creative_id": str(n),
            "user_id": user or f"u{n}",
            "timestamp": f"2024-05-{day:02}T12:00:{n:02}Z",
            "website": "a.test",
        }
    )


def test_date_filter_reaches_the_partitions(spark, log, tmp_path):
    tables = Tables(str(tmp_path))
    rows = [impression(n, day=20 + n % 3) for n in range(9)]
    sink.append(ingest(log(rows), IMPRESSIONS).valid, tables, "ad_impressions")
    one_day = tables.read(spark, "ad_impressions").filter("event_date = DATE'2024-05-21'")
    one_day = one_day.filter("user_id = 'u1'").select("website")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "EqualTo(user_id,u1)" in plan
    assert "ReadSchema: struct<user_id:string,website:string>" in plan
    assert one_day.count() == 1
    # Few rows of a date end in one file, not in one per task.
    files = {path.parent.name for path in tmp_path.rglob("*.parquet")}
    assert len(list(tmp_path.rglob("*.parquet"))) == len(files) == 3


def test_append_once_adds_no_row_twice(spark, log, tmp_path):
    tables = Tables(str(tmp_path))
    keys = list(IMPRESSIONS.dedup_keys)

    def arrive(rows):
        decoded = quality.decode_log(log(rows), IMPRESSIONS)
        valid = quality.curated_columns(quality.valid_part(decoded, IMPRESSIONS), IMPRESSIONS)
        sink.append_once(valid, tables, "ad_impressions", keys, sink.EVENT_DATE)
        return tables.read(spark, "ad_impressions").count()

    first = [impression(n, day=20 + n % 3) for n in range(6)]
    assert arrive(first + first) == 6
    assert arrive(first) == 6
    assert arrive([first[0], impression(7, day=1), impression(8, day=20)]) == 8
    # A row without a time has no date, and is one row too.
    undated = json.dumps({"ad_creative_id": "9", "user_id": "u9"})
    assert arrive([undated, undated]) == 9
    assert arrive([undated, first[1]]) == 9


def test_append_once_shuffles_rows_once_for_copies_and_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "append", lambda *a: None)
    plans, without_held = [], keys_of.KeyIndex.without_held

    def look(self, df, days):
        found = without_held(self, df, days)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(keys_of.KeyIndex, "without_held", look)
    tables, schema = Tables(str(tmp_path)), "a string, b int, more string, event_date date"
    rows = [(None, 1, "x", date(2024, 5, 1)), ("a", 1, "y", date(2024, 5, 1))]
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for new in (2, 1):
            df = spark.createDataFrame([*rows, *rows], schema)
            assert sink.append_once(df, tables, "t", ["a", "b"], sink.EVENT_DATE) == new
            rows.append((None, None, "z", date(2024, 5, 1)))
    # One exchange of the rows, and one of the index once there is one.
    assert [plan.count("Exchange hashpartitioning") for plan in plans] == [1, 2]
    assert all("Exchange hashpartitioning(key_digest" in plan for plan in plans)


def test_append_once_with_more_dates_than_a_list_takes(spark, log, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "MAX_DATES", 2)
    tables = Tables(str(tmp_path))
    for _ in range(2):
        decoded = quality.decode_log(log([impression(n, 10 + n) for n in range(5)]), IMPRESSIONS)
        valid = quality.curated_columns(quality.valid_part(decoded, IMPRESSIONS), IMPRESSIONS)
        sink.append_once(valid, tables, "t", ["user_id", "timestamp"], sink.EVENT_DATE)
    assert tables.read(spark, "t").count() == 5


def test_empty_append_leaves_no_table(spark, log, tmp_path):
    tables = Tables(str(tmp_path))
    assert not tables.exists(spark, "ad_impressions")
    sink.append(ingest(log([]), IMPRESSIONS).valid, tables, "ad_impressions")
    assert not tables.exists(spark, "ad_impressions")


def test_preview_is_ordered_and_complete(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in preview(df, ["id"]).collect()] == list(range(20))


def test_a_query_runs_the_batch_job_by_user():
    assert "attribution" in ORACLE["read_back_by_user"] and ORACLE["read_back_by_user"].endswith(USER_JOIN_SQL)


def test_batch_job_and_read_back(spark, log, tmp_path, capsys):
    sources = json_sources()
    same = {"user_id": "u1", "timestamp": "2024-05-31T12:00:00Z"}
    logs = {
        "ad_impressions": log([json.dumps({**same, "ad_creative_id": "1"}), "{bad"]),
        "clicks_conversions": log([json.dumps({**same, "campaign_id": "9"}), "{}", "{}"]),
        "bid_requests": log([json.dumps({**same, "auction_id": "5"})] * 2),
    }
    tables = Tables(str(tmp_path))
    jobs.process_batch(logs, tables, sources)
    read = jobs.read_back(spark, tables)
    assert {name: df.count() for name, df in read.items()} == {
        "ad_impressions": 1,
        "clicks_conversions": 1,
        "bid_requests": 1,
        "attribution": 1,
    }
    record = read["attribution"].first()
    assert (record.bid_requests.auction_id, record.clicks_conversions.campaign_id) == ("5", "9")
    jobs.show_tables(spark, tables)
    assert "bid_requests:" in capsys.readouterr().out
    errors = jobs.monitor_quality(spark, tables, sources).collect()
    counts = {(r.source, r.reason): r.errors for r in errors}
    assert counts == {
        ("ad_impressions", "undecodable"): 1,
        ("clicks_conversions", "missing_user_id"): 2,
    }
    with pytest.raises(quality.DataQualityError):
        jobs.monitor_quality(spark, tables, sources, allowed=2)


def test_quality_of_no_tables(spark, tmp_path):
    assert jobs.monitor_quality(spark, Tables(str(tmp_path)), allowed=0).count() == 0


def test_work_folder_follows_the_cluster_setting():
    def cluster(master, shared):
        conf = SimpleNamespace(get=lambda key, default=None: shared or default)
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    shared = work_folder(cluster("yarn", "hdfs://shared/checkpoints/"), "x")
    assert shared.startswith("hdfs://shared/checkpoints/adtrail/x-")
    assert work_folder(cluster("local[2]", None), "x").endswith("/x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(cluster("yarn", None), "x")


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with settings(spark, {key: "99"}):
            assert spark.conf.get(key) == "99"
            raise RuntimeError
    assert spark.conf.get(key) == before


def test_period_with_undated_bids_equals_all(spark, log, tmp_path):
    """Some bids have no readable time; periods leave none of them out."""

    def rows(kind, n):
        time = "never" if kind == "auction_id" and n % 10 == 0 else f"2024-05-{1 + n % 9:02}T12:{n % 60:02}:00Z"
        return json.dumps({"user_id": f"u{n % 7}", "timestamp": time, kind: str(n)})

    kinds = {"ad_impressions": "ad_creative_id", "clicks_conversions": "campaign_id", "bid_requests": "auction_id"}
    logs = {name: log([rows(kind, n) for n in range(80)]) for name, kind in kinds.items()}
    tables = Tables(str(tmp_path))
    jobs.process_batch(logs, tables, json_sources())

    def attributed():
        df = tables.read(spark, "attribution")
        return sorted(map(repr, df.collect()))

    whole = attributed()
    assert len(whole) >= 70
    days = [(date(2024, 5, 1), date(2024, 5, 4)), (date(2024, 5, 5), date(2024, 5, 9))]
    for first, last in [*days, days[0]]:
        jobs.attribute_period(spark, tables, first, last, undated=True)
    assert attributed() == whole
    # Bids that have gone from their day leave the attribution too.
    left = tables.read(spark, "bid_requests").where("event_date IS NULL OR event_date <> '2024-05-03'").collect()
    schema = tables.read(spark, "bid_requests").schema
    sink.replace(spark.createDataFrame(left, schema), tables, "bid_requests")
    jobs.attribute_period(spark, tables, *days[0], undated=True)
    days_left = {r.event_date for r in tables.read(spark, "attribution").collect()}
    assert date(2024, 5, 3) not in days_left and None in days_left and date(2024, 5, 7) in days_left


class Recorder:
    """Stands in for a writer of a catalog: notes the calls made on it."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *map(str, args)))
            return self

        return call


def test_calls_on_a_catalog(spark, monkeypatch):
    """Iceberg itself is not here: only what would be asked of it can be tested."""
    tables = Tables("local.ads", fmt="iceberg", side_root="/tmp/side")
    assert tables.path("t") == "local.ads.t"
    assert tables.checkpoint("q") == "/tmp/side/_checkpoints/q"
    writer, known = Recorder(), []
    monkeypatch.setattr(Tables, "exists", lambda self, spark, table: bool(known))
    df = spark.createDataFrame([("u", date(2024, 5, 1))], "user_id string, event_date date")
    monkeypatch.setattr(type(df), "writeTo", lambda self, name: writer.writeTo(name))
    sink.append(df, tables, "t")
    names = [c[0] for c in writer.calls]
    assert names == ["writeTo", "using", "partitionedBy", "create", "writeTo", "append"]
    assert writer.calls[:2] == [("writeTo", "local.ads.t"), ("using", "iceberg")]
    known.append("t")
    writer.calls.clear()
    sink.replace_dates(df, tables, "t", F.col("event_date") == F.lit(date(2024, 5, 1)))
    assert [c[0] for c in writer.calls] == ["writeTo", "overwrite"]
    with pytest.raises(ValueError, match="side_root"):
        Tables("local.ads", fmt="iceberg").checkpoint("q")


def test_key_index_merges_small_files_and_reads_only_the_days_asked(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys_of, "MANY", 3)
    tables = Tables(str(tmp_path / "tables"))
    schema = "id string, n int, event_date date"
    first, other = date(2024, 5, 1), date(2024, 5, 2)
    for n in range(6):
        df = spark.createDataFrame([(f"k{n}", n, first), ("same", n, first), (None, n, None)], schema)
        assert sink.append_once(df, tables, "t", ["id"], sink.EVENT_DATE) == (3 if n == 0 else 1)
    sink.append_once(spark.createDataFrame([("k", 1, other)], schema), tables, "t", ["id"], sink.EVENT_DATE)
    assert tables.read(spark, "t").count() == 9
    index = keys_of.KeyIndex(spark, tables, "t", ("id",), sink.EVENT_DATE)
    assert len(files_in(spark, index.part(first))) <= 4
    assert index.read([first]).distinct().count() == 7 and index.read([other]).count() == 1
    read = index.without_held(spark.createDataFrame([(bytearray(b"x"),)], f"{keys_of.KEY} binary"), [other])
    assert str(other) in " ".join(read.inputFiles()) and str(first) not in " ".join(read.inputFiles())
    assert index.read([date(2024, 6, 1)]) is None


def test_key_index_of_a_table_that_had_none(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"))
    schema = "id string, event_date date"
    rows = spark.createDataFrame([("a", date(2024, 5, 1)), (None, None)], schema)
    sink.append(rows, tables, "t")
    more = rows.union(spark.createDataFrame([("b", date(2024, 5, 1))], schema))
    assert sink.append_once(more, tables, "t", ["id"], sink.EVENT_DATE) == 1
    assert sorted(map(str, tables.read(spark, "t").collect())) == sorted(map(str, more.collect()))


def topic_rows(day, users, first=0):
    at = f"2024-05-{day:02d}T12:00:00Z"
    return {
        name: [json.dumps({"user_id": u, "timestamp": at, field: f"{u}-{day}"}) for u in users]
        for name, field in (("ad_impressions", "ad_creative_id"), ("clicks_conversions", "campaign_id"), ("bid_requests", "auction_id"))
    }


@pytest.fixture
def growing(spark, log, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    sent = {}

    def send(day, users):
        for name, texts in topic_rows(day, users).items():
            first = sent.get(name, 0)
            sent[name] = first + len(texts)
            log(texts, name, first=first).coalesce(1).write.mode("append").parquet(topics.path(name))
        return topics

    return send


def days_written(tmp_path):
    folder = tmp_path / "tables" / "attribution"
    return {p.parent.name.partition("=")[2]: p.name for p in folder.rglob("*.parquet")}


def attributed_ids(spark, tables):
    rows = tables.read(spark, "attribution").collect()
    return sorted((r.bid_requests.auction_id, r.ad_impressions.ad_creative_id, r.clicks_conversions.campaign_id) for r in rows)


def test_batch_job_reads_and_writes_only_what_is_new(spark, growing, tmp_path):
    tables, sources = Tables(str(tmp_path / "tables")), json_sources()
    topics = growing(1, ["u1", "u2"])
    growing(9, ["u1"])
    assert jobs.process_new(spark, topics, tables, sources) == dict.fromkeys(sources, 3)
    before = days_written(tmp_path)
    assert jobs.process_new(spark, topics, tables, sources) == dict.fromkeys(sources, 0)
    assert days_written(tmp_path) == before and set(before) == {"2024-05-01", "2024-05-09"}
    growing(20, ["u3"])
    growing(9, ["u4"])
    assert jobs.process_new(spark, topics, tables, sources) == dict.fromkeys(sources, 2)
    after = days_written(tmp_path)
    assert {d for d in after if after[d] != before.get(d)} == {"2024-05-09", "2024-05-20"}
    assert attributed_ids(spark, tables) == sorted((f"{u}-{d}",) * 3 for u, d in (("u1", 1), ("u2", 1), ("u1", 9), ("u4", 9), ("u3", 20)))


def test_batch_job_that_died_is_repeated(spark, growing, tmp_path, monkeypatch):
    tables, sources = Tables(str(tmp_path / "tables")), json_sources()
    topics = growing(1, ["u1"])
    for place in ("attribute_period", "decode_once"):
        with monkeypatch.context() as broken:

            def fail(*_args, **_kwargs):
                raise RuntimeError("the driver died")

            broken.setattr(jobs, place, fail)
            with pytest.raises(RuntimeError, match="died"):
                jobs.process_new(spark, topics, tables, sources)
    jobs.process_new(spark, topics, tables, sources)
    assert attributed_ids(spark, tables) == [("u1-1",) * 3]
    assert tables.read(spark, "bid_requests").count() == 1


def test_offsets_survive_a_commit_cut_off(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"))
    ledger.commit(spark, tables, "t", {0: 5})
    ledger.commit(spark, tables, "t", {0: 9, 1: 2})
    assert ledger.next_offsets(spark, tables, "t") == {0: 9, 1: 2}
    (tmp_path / "tables" / "_offsets" / "t.json").write_text('{"0": 1')
    (tmp_path / "tables" / "_offsets" / ".t.json.crc").unlink(missing_ok=True)
    assert ledger.next_offsets(spark, tables, "t") == {0: 5}
