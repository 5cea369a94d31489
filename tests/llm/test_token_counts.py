import random

import pytest
from adtrail.llm import token_counts as tokens
from adtrail.llm.common import table
from tests.llm.conftest import rows_of

PARTS = (
    "hello|World| |  \n|\t|don't|'s|'|123|é|é|́|İ|漢字|。|!!|<||endoftext|>|　| |\x1c|क़"
    "|ক|ো|가|각|😀|Σ|ς|ﬁ|①|Ⅷ|½|​|_|-|...|antidisestablishment|\0"
).split("|") + ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a" * 50]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokens.public_vocabulary())
    return lambda text: len(found.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize(("chunk", "overlap"), [(16, 4), (64, 16), (150, 20)])
def test_small_chunks_and_pieces_count_like_the_library(library, chunk, overlap):
    random.seed(chunk)
    counter = tokens.Counter(tokens.public_vocabulary(), chunk, overlap)
    texts = ["".join(random.choices(PARTS, k=random.randrange(120))) for _ in range(400)]
    want = [library(t) for t in texts]
    assert [counter.huge(t) for t in texts] == want
    counter.chunk = 1 << 30
    assert counter.count(texts) == want


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000, "漢" * 9000, "1" * 9000, "́" * 9000, "ab" + " " * 9000 + "c"])
def test_overlaps_widen_until_chunks_align(library, text):
    counter = tokens.Counter(tokens.public_vocabulary(), 256, 32)
    assert counter.huge(text) == library(text)


def test_most_chunks_align_at_the_first_overlap():
    counter = tokens.Counter(tokens.public_vocabulary(), 1000, 100)
    encoded = []
    keep = counter.encode_chunk
    counter.encode_chunk = lambda *a: encoded.append(a[1:]) or keep(*a)
    counter.huge("plain words of a text " * 2000)
    assert len(encoded) <= 44000 // (1000 - 100) + 2


def test_table_and_odd_rows(spark, docs, odd, library):
    given = odd + [(30, "<|endoftext|> inside"), (31, "x1 " * 30_000), (32, "w" * 40_000)]
    want = []
    for i, t in given:
        n = library(t)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert rows_of(tokens.token_counts(docs(given), chunk=500)) == sorted(want, key=repr)
    assert rows_of(tokens.token_counts(docs(given))) == sorted(want, key=repr)
    assert tokens.token_counts(docs([])).collect() == []


def test_documents_count_like_the_library(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = {r["doc_id"]: library(r["text"]) for r in docs.collect()}
    got = tokens.token_counts(docs, chunk=2000).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want


def test_overlapping_special_strings_are_refused(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    changed = Tokenizer.from_file(tokens.public_vocabulary())
    changed.add_special_tokens([AddedToken("|><|", normalized=False)])
    path = str(tmp_path / "other.json")
    changed.save(path)
    with pytest.raises(ValueError, match="may overlap"):
        tokens.Counter(path)
