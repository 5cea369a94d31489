import hashlib
import random
import re

import numpy as np
import pytest

from adtrail.llm import infill
from tests.llm.conftest import rows_of

MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, len(p), len(m), out


def rows():
    random.seed(5)
    parts = ["a", "bc", "Z", " ", "é", "漢", "<", "P>", "S>", "😀", "\n", "M", ">", "<P", "\0"]
    return [(i, "".join(random.choices(parts, k=random.randrange(60)))) for i in range(200)]


@pytest.mark.parametrize("block", [7, 64, infill.BLOCK])
def test_blocks_of_any_size_scatter_and_gather_alike(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    monkeypatch.setattr(infill, "STEP", block)
    texts = [t.encode() for _, t in rows()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    digests = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i, _ in rows()]
    draws = np.array([[int(x[8 * k : 8 * k + 8], 16) for x in digests] for k in range(4)])
    out, ends, n, form, chars = infill.cut(data, bounds, draws, 90, 20)
    for d, (i, text) in enumerate(rows()):
        _, units, kind, prefix, middle, want = brute(i, text)
        assert (n[d], form[d], out[ends[d] : ends[d + 1]].tobytes().decode()) == (units, kind, want)
        assert tuple(chars[d]) == ((-1, -1) if kind == "plain" else (prefix, middle))
    assert set(form) == {"plain", "psm", "spm"}
    back, places = infill.uncut(out, ends, form == "plain")
    assert back.tobytes() == data.tobytes() and (places == bounds).all()


def test_transform_and_restore_equal_brute_force(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(infill, "CHUNK", 100)
    given = odd + rows() + [(20, "<M> is a marker"), (21, "long " * 300_000)]
    done = infill.transform(docs(given))
    assert rows_of(done) == sorted((brute(i, t) for i, t in given), key=repr)
    back = infill.restore(done).select("doc_id", "restored")
    assert rows_of(back) == sorted(((i, t or "") for i, t in given), key=repr)


def test_empty_table(spark, docs):
    assert infill.restore(infill.transform(docs([]))).collect() == []


def test_an_output_without_its_markers_is_refused():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError, match="each marker once"):
        infill.uncut(data, np.array([0, len(data)]), np.array([False]))
