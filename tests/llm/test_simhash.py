import random

import numpy as np
import pytest

from adtrail.llm import simhash
from tests.llm import brute
from tests.llm.conftest import rows_of


def near_codes(n, seed):
    rng = random.Random(seed)
    codes = [rng.getrandbits(64) for _ in range(n // 3 + 1)]
    while len(codes) < n:
        code = rng.choice(codes)
        for _ in range(rng.randint(1, 3)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    return np.array(sorted(set(codes)), np.uint64)


def test_fingerprint():
    for text in ("", None, "one", "one two", "A b C d", "straße Über \x1c x", "a  b\tc\nd " * 500, "é" * 9):
        assert simhash.fingerprint(text) == brute.fingerprint(text)


@pytest.mark.parametrize("size", [1, 15, 16, 17, 300, 2000])
def test_index_finds_every_link(size):
    codes = near_codes(size, size)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    a, b = simhash.GrayIndex(codes).links(0, len(codes), 2)
    i, j = np.triu_indices(len(codes), 1)
    near = np.bitwise_count(codes[i] ^ codes[j]) <= 2
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(i[near].tolist(), j[near].tolist(), strict=True))


def test_gray_ranks_neighbours_differ_in_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


@pytest.mark.parametrize("group", [3, 50_000])
def test_components_of_planted_codes(spark, group):
    codes = near_codes(600, 3)
    table = spark.createDataFrame([(int(c), n) for n, c in enumerate(codes.view(np.int64))], "fp long, node long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash.near_links(table, group=group)).collect()}
    label = brute.linked(codes, 2)
    assert [found.get(n, n) for n in range(len(codes))] == label.tolist()


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(n + 1, n) for n in range(200)], "high long, low long")
    assert {r["component"] for r in simhash.components(links).collect()} == {0}


def test_documents(docs, odd):
    rng = random.Random(1)
    base = [f"word{rng.randrange(400)}" for _ in range(600)]
    rows = [(100 + n, " ".join([*base[:n], "changed", *base[n + 1 :]])) for n in range(0, 30, 3)]
    rows += [r for r in odd if r[0] is not None]
    got = [(i, f, c) for i, _, f, c in rows_of(simhash.near_groups(docs(rows)))]
    assert sorted(got) == sorted(brute.simhash(rows))
    assert len({c for _, _, c in got}) < len(rows) - 4
    kept = simhash.keep_one_each(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in got})


def test_null_ids_and_empty_table(docs):
    rows = [(None, "a b c d"), (5, "a b c d"), (None, "else where it stands alone"), (None, "else where it stands alone")]
    assert [(i, c) for i, _, _, c in rows_of(simhash.near_groups(docs(rows)))] == [(5, 5), (None, 5), (None, None), (None, None)]
    assert sorted(r["text"] for r in simhash.keep_one_each(docs(rows)).collect()) == ["a b c d", "else where it stands alone"]
    assert simhash.near_groups(docs([])).count() == 0
