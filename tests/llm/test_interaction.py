import re
from collections import Counter
from itertools import permutations

import numpy as np

from adtrail.llm import interaction
from tests.llm.conftest import rows_of


def failing(rows, doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    checks = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
        "E": any(i < doc_id for i, t, _ in rows if t == text and i is not None) if doc_id is not None else False,
    }
    return {f for f, bad in checks.items() if bad}


def brute(rows, labels):
    rows = [(i, t or "", p or "") for i, t, p in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {p for _, _, p in rows}:
        docs = [(i, failing(rows, i, t)) for i, t, p in rows if p == part]
        found, shares = {}, Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total = sum(f in d[1] for d in docs)
                alone = sum(d[1] == {f} for d in docs)
                lost = [sum(d[0] in s for d in gone) for s in (good, toxic)]
                found["".join(order), step] = [len(left), len(gone), total - len(gone), alone, *lost]
                shares[f] += len(gone)
        out += [(part, o, s, *v, shares[o[s - 1]]) for (o, s), v in found.items()]
    return sorted(out, key=repr)


ROWS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " ".join(f"w{k}" for k in range(120)), "en"),
    (4, " ".join(f"w{k}" for k in range(120)), "de"),
    (4, " ".join(f"w{k}" for k in range(120)), "de"),
    (5, " ".join(f"w{k}" for k in range(120)), None),
    (6, "SHOUT " * 150, ""),
    (7, "a # b", "en"),
    (8, " ".join(f"w{k % 90}" for k in range(110)) + " $", "en"),
    (None, "", "en"),
    (None, "a # b", "fr"),
    (9, "ab cd É " + "x\v" * 99, "fr"),
    (10, "long text " * 30_000, "fr"),
]
LABELS = [(1, 1, 0), (3, 1, 0), (4, 1, 1), (4, 0, None), (5, None, 1), (7, 0, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def frames(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, True) for r in rows], "doc_id long, text string, lang string, part string, cell int, own boolean")
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_audit_equals_brute_force(spark):
    docs, labels = frames(spark, ROWS)
    got = interaction.audit(docs, labels)
    assert got.columns == [c.split()[0] for c in interaction.SCHEMA.split(", ")]
    assert rows_of(got) == brute(ROWS, LABELS)


def test_empty_table_gives_no_rows(spark):
    docs, labels = frames(spark, [])
    assert interaction.audit(docs, labels).collect() == []


def test_counts_of_a_step_add_up():
    cells = np.random.default_rng(2).integers(0, 50, (3, 2, 2, 2, 2, 2))
    rows = interaction.contract(cells)
    assert len(rows) == 600
    total = cells[0].sum()
    assert (rows.groupby("filter_order")["removed"].sum() + rows[rows["step"] == 5].set_index("filter_order")["kept"] == total).all()
    removed = rows.assign(f=[o[s - 1] for o, s in zip(rows["filter_order"], rows["step"], strict=True)])
    assert (removed.groupby("f")["removed"].sum() == removed.groupby("f")["shapley"].first()).all()
