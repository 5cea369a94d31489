import numpy as np
import pandas as pd
import pytest

from adtrail.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string"
SF = "/root/testdata/sf0.01"


def test_gradient():
    rng = np.random.default_rng(0)
    dims, n = 12, 40
    rows = np.repeat(np.arange(n), 3)
    buckets, values = rng.integers(0, dims, 3 * n), rng.random(3 * n)
    grade = rng.integers(0, 4, n)
    theta = rng.normal(size=dims + 3) / 2
    args = (rows, buckets, values, grade, dims)
    _, grad = quality._loss(theta, *args)
    for k in range(len(theta)):
        step = np.eye(len(theta))[k] * 1e-6
        slope = (quality._loss(theta + step, *args)[0] - quality._loss(theta - step, *args)[0]) / 2e-6
        assert abs(slope - grad[k]) < 1e-6


def test_orders_grades():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["bad"] * (3 - g) + ["good"] * g + ["the", "of"], 30)) for g in range(3) for _ in range(60)]
    grade = np.repeat(np.arange(3), 60)
    model = quality.fit_sample([quality.features(t) for t in texts], grade)
    tails = model.tails(np.array([model.score(*quality.features(t)) for t in texts]))
    assert (np.diff(model.thresholds) > 0).all() and (tails[:, 0] >= tails[:, 1]).all()
    assert np.corrcoef(tails.sum(axis=1), grade)[0, 1] > 0.8


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 4 <> 0"))
    table = pd.read_parquet(f"{SF}/labels.parquet").merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    table = table[table.doc_id % 4 == 0]
    p = model.tails(np.array([model.score(*quality.features(t)) for t in table.text]))[:, -1]
    good = (table.quality == 1) & (table.toxic == 0)
    assert (p[good] >= quality.KEEP).mean() > 0.97
    assert ((p >= quality.KEEP) == good).mean() > 0.9


@pytest.mark.parametrize("labels", [[], [(4, 1, 0, "x")], [(4, None, None, "x"), (None, 1, 0, "x")]])
def test_nothing_to_learn_keeps_all(spark, docs, odd, labels):
    table = spark.createDataFrame(labels, LABELS)
    got = quality.scored(docs(odd), table).collect()
    assert len(got) == len(odd) and all(r["kept"] and r["expected_grade"] is None for r in got)


def test_odd_rows(spark, docs, odd):
    labels = [(1, 0, 0, "x"), (4, 1, 0, "x"), (5, 1, 0, "x"), (6, 1, 1, "x"), (6, 1, 0, "x"), (10, 0, None, "x"), (99, 1, 0, "x")]
    table = spark.createDataFrame(labels, LABELS)
    got = quality.scored(docs(odd), table)
    assert got.count() == len(odd)
    kept = quality.keep_good(docs(odd), table)
    assert kept.columns == docs([]).columns
    assert kept.count() == got.where("kept").count()
    assert quality.scored(docs([]), table).count() == 0
    assert quality.fit(docs(odd), table, sample=2) is not None
