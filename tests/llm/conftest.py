import pytest
from tests.llm.brute import DOCS


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with null and odd values, and columns whose names clash with the operators' own."""

    def build(rows):
        full = [(i, t, None, None, None, None, 1, "x", 2) for i, t in rows]
        extra = ", key string, norm int, digest string, kept int"
        return spark.createDataFrame(full, DOCS + extra)

    return build


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "Same Text Here"),
    (5, "same text here"),
    (6, "SAME TEXT here"),
    (6, "SAME TEXT here"),
    (7, "Ünder ÜNDER straße"),
    (8, "ünder ünder straße"),
    (None, "no id at all"),
    (None, "same text here"),
    (9, "one"),
    (10, "word " * 3000),
    (11, "x" * 20000),
]


@pytest.fixture
def odd():
    return list(ODD)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
