from pyspark.sql import functions as F

from adtrail.llm import exact_dedup
from tests.llm import brute
from tests.llm.conftest import rows_of


def test_odd_rows(docs, odd):
    assert rows_of(exact_dedup.exact_groups(docs(odd))) == sorted(brute.exact(odd), key=repr)


def test_hot_group_and_empty_table(docs):
    rows = [(n, "copy" if n % 3 else f"own {n}") for n in range(300)]
    assert rows_of(exact_dedup.exact_groups(docs(rows), salts=5)) == sorted(brute.exact(rows), key=repr)
    assert exact_dedup.exact_groups(docs([])).count() == 0


def test_texts_that_share_a_digest_stay_apart(docs, monkeypatch):
    keyed = exact_dedup._keyed
    monkeypatch.setattr(
        exact_dedup, "_keyed", lambda *a: keyed(*a).withColumn("digest", F.when(F.col("norm") < "c", "same").otherwise(F.col("digest")))
    )
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, "B"), (5, "d"), (6, "d"), (7, "z")]
    got = [r[:4] for r in rows_of(exact_dedup.exact_groups(docs(rows), salts=2))]
    assert got == [r[:4] for r in sorted(brute.exact(rows), key=repr)]


def test_keep_distinct_keeps_columns_and_one_row(docs, odd):
    kept = exact_dedup.keep_distinct(docs(odd))
    assert kept.columns == docs([]).columns
    texts = [brute.lower(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({brute.lower(t) for _, t in odd})
