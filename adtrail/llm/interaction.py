"""Interaction of filters by contractions of a contingency tensor.

One pass gives every document a bit per filter, and the documents of a part are
counted by their bits: 2x2x2x2x2 cells. Whatever an order of the filters keeps,
removes or loses at a step is that tensor contracted with one vector per axis
that selects pass, fail or both, so the orders cost no further pass over the data.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import UPPER, stored

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
#: Selectors of an axis: documents that pass, that fail, all of them.
PASS, FAIL, ALL = np.array([[1, 0], [0, 1], [1, 1]])
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def fails(text: Column) -> dict[str, Column]:
    """Whether a text that is not null fails the filters that look at it alone."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    count, chars = F.size(words), F.char_length(text)
    upper = F.octet_length(text) - F.octet_length(F.translate(text, UPPER, ""))
    return {
        "A": count < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * count.cast("long"),
        "C": 100 * upper.cast("long") > UPPER_PERCENT * chars.cast("long"),
        "D": text.rlike(SYMBOLS),
    }


def contract(cells: np.ndarray) -> pd.DataFrame:
    """All orders and steps from counts of all, good and toxic documents, each 2x2x2x2x2."""
    orders = list(permutations(range(len(FILTERS))))
    here = np.zeros((len(orders), len(FILTERS), len(FILTERS), 2), np.int64)  # order, step, axis, selector
    left = here.copy()
    for n, order in enumerate(orders):
        for step, axis in enumerate(order):
            here[n, step], left[n, step] = ALL, ALL
            here[n, step, list(order[:step])] = PASS
            here[n, step, axis] = FAIL
            left[n, step, list(order[: step + 1])] = PASS
    alone, failing = np.empty((2, len(FILTERS), len(FILTERS), 2), np.int64)
    alone[:], failing[:] = PASS, ALL
    for axis in range(len(FILTERS)):
        alone[axis, axis] = failing[axis, axis] = FAIL

    def total(selectors: np.ndarray) -> np.ndarray:
        axes = np.moveaxis(selectors.reshape(-1, len(FILTERS), 2), 1, 0)
        return np.einsum("tabcde,na,nb,nc,nd,ne->tn", cells, *axes, optimize=True)

    axis = np.array(orders)
    removed, good, toxic = total(here).reshape(3, *axis.shape)
    shapley = np.bincount(axis.ravel(), removed.ravel(), len(FILTERS)).astype(np.int64)
    rows = {
        "filter_order": np.repeat(["".join(FILTERS[a] for a in order) for order in orders], len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1), len(orders)),
        "kept": total(left)[0],
        "removed": removed.ravel(),
        "redundant": (total(failing)[0][axis] - removed).ravel(),
        "unique_fails": total(alone)[0][axis].ravel(),
        "good_lost": good.ravel(),
        "toxic_lost": toxic.ravel(),
        "shapley": shapley[axis].ravel(),
    }
    return pd.DataFrame(rows)


def cells(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """``part, cell, n, good, toxic``: documents by the filters they fail, as bits of ``cell`` (A the highest).

    Equal texts meet by their SHA-256; the smallest id of each is found by an
    aggregate and joined back by id, so no key is hot.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    parted = docs.select(
        F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), body.alias("text")
    )
    rows = stored(
        parted.select(
            "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(k) for k, c in fails(F.col("text")).items()]
        ),
        "filter-fails",
    )
    owners = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
    owners = owners.withColumn("own", F.lit(True))
    marks = labels.where(F.col(ident).isNotNull()).groupBy(F.col(ident).cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    joined = rows.join(owners, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    later = F.col("own").isNull() & F.col("doc_id").isNotNull()
    bits = [*(F.col(k) for k in FILTERS[:-1]), later]
    cell = sum((b.cast("int") * (1 << (len(bits) - 1 - k)) for k, b in enumerate(bits)), F.lit(0))
    return joined.groupBy("part", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic")
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row per part, order of the five filters and step, with its counts of documents.

    A null text is empty, a null part the empty string. Repeated rows count one by
    one: none is a copy of the other, for their ids are equal. A row without an id is a
    copy of nothing, has no copies and no label. Of several labels of an id one
    suffices. Parts without documents have no rows, so an empty table gives none;
    other columns are ignored. Beyond the shuffles by text and id only the at most 32
    cells of each part are moved.
    """

    def run(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        tensor = np.zeros((3, 1 << len(FILTERS)), np.int64)
        tensor[:, counts["cell"]] = counts[["n", "good", "toxic"]].to_numpy().T
        rows = contract(tensor.reshape(3, *[2] * len(FILTERS)))
        rows.insert(0, "part", key[0])
        return rows

    return cells(docs, labels, ident, text, part).groupBy("part").applyInPandas(run, SCHEMA)
