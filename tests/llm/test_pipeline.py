import pytest

import corpus_pipeline
from adtrail.llm.common import stored
from tests.llm.brute import DOCS

CLASH = ", __id long, __own string, __hash long, __sha string, __n int, id int, row string, keep_id int, hash int, sha string"


@pytest.fixture
def tables(spark, odd, monkeypatch):
    """Odd documents with columns of clashing names, labels and a benchmark."""
    extra = (1, "a", 2, "b", 3, 4, "c", 5, 6, "d")
    docs = spark.createDataFrame([(i, t, None, None, None, *extra) for i, t in odd], DOCS + CLASH)
    found = {
        "documents": docs,
        "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "one"), (2, None), (None, "nowhere seen")], "item_id long, text string"),
    }
    monkeypatch.setattr(corpus_pipeline, "table", lambda _spark, _dir, name: found[name])
    return found


def stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), name)
        yield docs


def test_odd_rows_and_clashing_columns(spark, tables, odd):
    docs = tables["documents"]
    ids = []
    for got in stages(spark, docs):
        assert got.columns == docs.columns
        rows = got.collect()
        assert all(r["__id"] == 1 and r["row"] == "c" and r["sha"] == "d" for r in rows)
        ids.append(sorted((r["doc_id"] for r in rows), key=str))
    # No labels: all stay. Then 1 and 2 are equal, 4 to 6 and the null id too, and the null id of its own text stays.
    assert len(ids[0]) == len(odd)
    assert ids[1] == sorted([None, 2, 3, 6, 7, 8, 9, 10, 11], key=str)
    # Empty and blank are near; so are no others.
    assert ids[2] == sorted([None, 2, 6, 7, 8, 9, 10, 11], key=str)
    assert ids[3] == sorted(set(ids[2]) - {9}, key=str)
    packed = corpus_pipeline.run(spark, "").collect()
    assert sorted({str(r["doc_id"]) for r in packed}) == sorted({str(i) for i in ids[3]})


def test_empty_table(spark, tables):
    tables["documents"] = tables["documents"].limit(0)
    assert corpus_pipeline.run(spark, "").collect() == []
