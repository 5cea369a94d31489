import random

import pytest

from adtrail.llm.decontaminate import contamination, keep_clean
from tests.llm import brute
from tests.llm.conftest import rows_of

ITEMS = "item_id long, text string, words int"


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    vocabulary = [f"w{n}" for n in range(30)] + ["the"] * 30
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(60)]
    items = [(n, " ".join(rng.choices(vocabulary, k=n % 16))) for n in range(24)]
    rows = [(n, t + " " + items[n % 24][1] + ", " + t) for n, t in enumerate(texts)]
    return rows, items


@pytest.mark.parametrize("block", [7, 1000])
def test_brute_force(spark, docs, mixed, block):
    rows, items = mixed
    got = contamination(docs(rows), spark.createDataFrame([(*i, 1) for i in items], ITEMS), block=block)
    assert rows_of(got) == sorted(brute.contamination(rows, items), key=repr)


def test_odd_rows(spark, docs, odd):
    items = [(1, None), (2, "- ?"), (3, "same TEXT"), (3, "here"), (None, "one"), (4, "Ünder"), (5, "word " * 12), (6, "word " * 11)]
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    assert rows_of(contamination(docs(odd), table)) == sorted(brute.contamination(odd, items), key=repr)
    clean = keep_clean(docs(odd), table)
    assert clean.columns == docs([]).columns
    want = [(i, t) for (i, t), r in zip(odd, brute.contamination(odd, items), strict=True) if not r[-1]]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark, docs, odd):
    none = spark.createDataFrame([], ITEMS)
    assert rows_of(contamination(docs(odd), none)) == sorted(brute.contamination(odd, []), key=repr)
    assert contamination(docs([]), spark.createDataFrame([(1, "a b", 1)], ITEMS)).count() == 0
    assert keep_clean(docs(odd), none).count() == len(odd)
