from collections import Counter
import unicodedata
import zlib

import numpy as np

from adtrail.llm import language
from tests.llm.brute import DOCS

SF = "/root/testdata/sf0.01"


def test_ngrams():
    text = "Aäb 12 aÄB_x ß"
    want = Counter()
    for word in ["aäb", "aäb", "x", "ß"]:
        want.update(word)
        padded = f"_{word}_"
        want.update(padded[i : i + 2] for i in range(len(padded) - 1))
        want.update(padded[i : i + 3] for i in range(len(padded) - 2))
    codes = {sum(ord(c) << 21 * k for k, c in enumerate(reversed(g))): n for g, n in want.items()}
    grams, counts = language.ngrams(text)
    got = dict(zip(grams.tolist(), counts.tolist(), strict=True))
    # The edge that two words share is counted with each pair it stands in.
    assert got == codes


def test_words_are_letters_only():
    assert language.words("² ½ Ⅷ 12 _") == {}
    assert language.words("x²y ab½ ab Ⅷ") == {"x": 1, "y": 1, "ab": 2}


def test_distance():
    profiles = language.Profiles({"a": np.array([3, 1, 2], np.uint64), "b": np.array([9], np.uint64)}, length=5)
    own = np.array([1, 3, 7], np.uint64)
    at = np.searchsorted(profiles.grams, own)
    assert profiles.places[0, at[:2]].tolist() == [1, 0]
    assert profiles.nearest(None) == ("und", 0.0)
    assert profiles.nearest("12 - _") == ("und", 0.0)
    assert profiles.nearest("² ½ Ⅷ") == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) / len(test) > 0.97


def test_odd_rows(spark, docs, odd):
    odd = [*odd, (40, "² ½ Ⅷ")]
    assert {r["lang_pred"] for r in language.identify(docs(odd)).collect()} == {"und"}
    rows = [(i, t, "xx" if i in (4, 9) else None, None, None) for i, t in odd]
    got = language.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(odd)
    for r, (_, t) in zip(sorted(got, key=repr), sorted(odd, key=repr), strict=False):
        assert r["lang_pred"] in ("xx", "und")
    letters = sum(any(unicodedata.category(c).startswith("L") for c in t or "") for _, t in odd)
    assert sum(r["lang_pred"] == "xx" for r in got) == letters
    assert language.identify(spark.createDataFrame([], DOCS)).count() == 0
