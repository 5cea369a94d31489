from __future__ import annotations

import json

import pytest
from hypothesis import given, settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtrail.registry import BIDS, IMPRESSIONS
from adtrail.session import settings
from adtrail.sources.files import json_arrays
from adtrail.sources.json_splits import split_json_arrays

TIME = "2024-06-01T08:00:00Z"
TRICKY = ["}", "{", '"', "\\", '\\"}', "],[{", "}}\n{", "ä😀}", "", "plain", "\\\\", '{"a":"}"}']


def in_ranges(spark, path, spec, size):
    """Ranges of ``size`` bytes: every cut of a small file is tried."""
    small = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    with settings(spark, small):
        rows = split_json_arrays(spark, path, spec)
    return sorted(map(repr, rows.collect()))


def whole(spark, path, spec):
    return sorted(map(repr, json_arrays(spark, path, spec).collect()))


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def bid(n, text):
    return {"user_id": f"u{n}", "auction_id": text, "timestamp": TIME, "targeting_criteria": {text + "k": text}}


@pytest.mark.parametrize("size", [13, 1 << 20])
def test_strings_with_braces_and_escapes(spark, tmp_path, size):
    rows = [bid(n, text * (1 + n % 3)) for n, text in enumerate(TRICKY * 3)]
    for indent in (None, 2):
        path = put(tmp_path / f"{indent}.json", json.dumps(rows, indent=indent, ensure_ascii=bool(indent)))
        assert in_ranges(spark, path, BIDS, size) == whole(spark, path, BIDS)


@examples(max_examples=4)
@given(texts=st.lists(st.text(alphabet='{}[]",\\ \nä:', max_size=12), max_size=9), size=st.integers(20, 90))
def test_any_strings_any_cuts(spark, tmp_path, texts, size):
    path = put(tmp_path / "in.json", json.dumps([bid(n, t) for n, t in enumerate(texts)]) + "\n")
    assert in_ranges(spark, path, BIDS, size) == whole(spark, path, BIDS)


def test_several_files_and_empty_ones(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", " [ ]\n"), ("c", ""), ("d", json.dumps([{"user_id": "1"}] * 9)), ("e", '[{}, {"user_id": null}]')):
        put(tmp_path / f"{name}.json", text)
    assert in_ranges(spark, str(tmp_path), IMPRESSIONS, 20) == whole(spark, str(tmp_path), IMPRESSIONS)


@pytest.mark.parametrize(
    "text",
    [
        '[{"user_id": "1"}, {"user_id": "2"',
        '[{"user_id": "1"}, {"user_id": "2"}',
        '[{"user_id": "1"} {"user_id": "2"}]',
        '[{"user_id": "1"}}, {"user_id": "2"}]',
        '[{"user_id": "1"}], {"user_id": "2"}]',
        '[{"user_id": "1}, {"user_id": "2"}]',
        '[{"user_id": "1"}, 5]',
        '[{"user_id": "1", "x"}]',
        "no json",
    ],
)
def test_what_is_no_array_fails(spark, tmp_path, text):
    path = put(tmp_path / "bad.json", text)
    for size in (9, 1000):
        with pytest.raises(Exception):
            in_ranges(spark, path, IMPRESSIONS, size)


def test_one_file_becomes_many_tasks(spark, tmp_path):
    rows = [{"user_id": str(n), "website": "}" * (n % 5), "timestamp": TIME, "ad_creative_id": "c"} for n in range(5000)]
    path = put(tmp_path / "large.json", json.dumps(rows))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}):
        got = split_json_arrays(spark, path, IMPRESSIONS)
    assert got.count() == 5000 and got.agg(F.countDistinct("user_id")).first()[0] == 5000
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}):
        tasks = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) == 8
