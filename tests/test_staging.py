"""Staged topics of the driver's queries: bounded files, the same micro-batches."""

from __future__ import annotations

from pathlib import Path

import pytest

from adtrail.plans import queries
from adtrail.registry import IMPRESSIONS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 100)


def test_parts_are_cut_into_files_of_bounded_size(spark, tmp_path, small_files):
    topics = queries.staged_topics(spark, SF_DIR, str(tmp_path), deliveries=2, parts=2)
    for name in queries.JSON:
        files = [str(p) for p in Path(topics.path(name)).glob("*.parquet")]
        rows = [spark.read.parquet(f).count() for f in files]
        assert len(files) == 2 * topics.max_files_per_trigger > 2
        assert max(rows) < 200  # dealt by a hash: near 100
        assert sum(rows) == 2 * queries.batch_logs(spark, SF_DIR)[name].count()


def test_few_messages_stay_one_file_a_part(spark, tmp_path):
    topics = queries.staged_topics(spark, SF_DIR, str(tmp_path), names=(IMPRESSIONS.name,), parts=4)
    assert topics.max_files_per_trigger == 1
    assert len(list(Path(topics.path(IMPRESSIONS.name)).glob("*.parquet"))) == 4


def test_metrics_of_cut_parts_count_each_part_once(spark, small_files, monkeypatch):
    batches = []
    commit = queries.streaming.metrics_log.commit
    monkeypatch.setattr(
        queries.streaming.metrics_log, "commit", lambda *a: (batches.append((a[2].name, a[4])), commit(*a))
    )
    rows = {r["source"]: r for r in queries.QUERIES["stream_quality_metrics"](spark, SF_DIR).collect()}
    for name, log in queries.batch_logs(spark, SF_DIR).items():
        assert rows[name]["rows_read"] == log.count()
        # Four micro-batches as before, however many files each reads.
        assert sum(source == name for source, _ in batches) == 4
