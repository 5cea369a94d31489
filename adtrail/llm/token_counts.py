"""Token counts of whole texts, huge ones by overlapping chunks that are resynchronised.

A huge text is encoded in chunks that overlap, with offsets. Two neighbours are
spliced at a boundary that both have in their overlap and that is proven: there a
word of the pre-tokenizer begins in the left chunk, which knows all text before
it and enough after it, and one begins in the right chunk too. Words are found
scanning on from where the last one ended and merges stay within a word, so from
there on the right chunk's tokens are the whole text's. Without such a boundary
the overlap is doubled, and the chunk with it.

Shorter texts are counted by their pieces between ASCII white space, where no word
can go on; a piece seen before is not encoded again.
"""

from __future__ import annotations

import bisect
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
#: Code points of a chunk and of the least overlap; a longer text than a chunk is huge.
CHUNK = 32_768
OVERLAP = 512
#: Code points of short texts counted together, and pieces remembered before a fresh start.
TOGETHER = 1 << 20
REMEMBERED = 500_000


class Chunk:
    """Code points ``begin`` to ``end`` of a text, encoded with offsets."""

    def __init__(self, text: str, begin: int, end: int, encoding):
        self.text, self.begin, self.end = text, begin, end
        self.tokens, self.words, self.offsets = len(encoding), encoding.word_ids, encoding.offsets

    def starts(self, low: int, high: int, first: int = 0) -> dict[int, int]:
        """How many tokens stand before each place from ``low`` to ``high`` where a word begins.

        Of the tokens from ``first`` on; a place within a letter, or before a mark
        that may belong to the letter before it, is none.
        """
        found: dict[int, int] = {}
        if self.begin == low == 0 and not first:
            found[0] = 0
        number = max(first, bisect.bisect_left(self.offsets, (low - self.begin,)))
        until = bisect.bisect_right(self.offsets, (high - self.begin, self.end))
        for n in range(number, until):
            place = self.begin + self.offsets[n][0]
            if n == 0:
                proven = self.begin == 0
            else:
                proven = self.words[n] != self.words[n - 1] and self.offsets[n - 1][1] <= self.offsets[n][0]
            if proven and not unicodedata.category(self.text[place]).startswith("M"):
                found.setdefault(place, n)
        return found


class Counter:
    """Counts the tokens of texts as ``tokenizers`` gives them for a vocabulary."""

    def __init__(self, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Scanned from any place, texts give the same special strings only if none overlap and none has white space.
        for a in special:
            if a != "".join(a.split()) or any(a[-k:] == b[:k] for b in special for k in range(1, len(a))):
                raise ValueError(f"special string {a!r} may overlap another or holds white space")
        # Text a chunk must know after a boundary: a cut special string or contraction could move one.
        self.guard = 2 * max(map(len, special), default=0) + 8
        self.chunk, self.overlap = chunk, max(overlap, self.guard)
        self.pieces: dict[bytes, int] = {}

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def encode_chunk(self, text: str, begin: int, end: int) -> Chunk:
        return Chunk(text, begin, end, self.encode(text[begin:end]))

    def huge(self, text: str) -> int:
        """Tokens of a text in chunks; the whole text is one chunk where nothing else splices."""
        left = self.encode_chunk(text, 0, min(len(text), self.chunk))
        total, spliced, more = 0, 0, self.chunk
        while left.end < len(text):
            wide = self.overlap
            while True:
                begin = max(left.begin, left.end - wide)
                right = self.encode_chunk(text, begin, min(len(text), left.end + more))
                proven = left.starts(begin, left.end - self.guard, spliced)
                both = proven.keys() & right.starts(begin, left.end - self.guard).keys()
                if both:
                    break
                wide *= 2
            place = max(both)
            counted = proven[place] - spliced
            # No step forward: a word longer than the chunk, so the next one is twice as long.
            more = self.chunk if counted else 2 * more
            total += counted
            left, spliced = right, right.starts(place, place)[place]
        return total + left.tokens - spliced

    def encode_pieces(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each of some pieces without white space, from one encoding of them all."""
        texts = [p.decode() for p in pieces]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = np.array([low for low, _ in self.encode(" ".join(texts)).offsets], np.int64)
        return np.bincount(np.searchsorted(begins, at, side="right") - 1, minlength=len(pieces))

    def short(self, texts: list[str]) -> list[int]:
        """Tokens of each of some texts, by their pieces; new pieces are encoded together."""
        words = [t.encode().split() for t in texts]
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        new = list(set().union(*words) - self.pieces.keys())
        if new:
            self.pieces.update(zip(new, self.encode_pieces(new).tolist(), strict=True))
        return [sum(map(self.pieces.__getitem__, w)) for w in words]

    def count(self, texts: list[str]) -> list[int]:
        out, held, size = [0] * len(texts), [], 0
        for row, text in enumerate(texts):
            if len(text) > self.chunk:
                out[row] = self.huge(text)
            else:
                held.append(row)
                size += len(text)
            if held and (size > TOGETHER or row == len(texts) - 1):
                for place, found in zip(held, self.short([texts[r] for r in held]), strict=True):
                    out[place] = found
                held, size = [], 0
        return out


_counters: dict[tuple, Counter] = {}


def counter(vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    """One counter per task process and vocabulary."""
    key = (vocabulary, chunk, overlap)
    if key not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_counts(
    docs: DataFrame,
    vocabulary: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per row of ``docs``.

    A null or empty text has no tokens. Begin, end and other tokens of a template
    are not added; special strings inside a text count as the library reads them.
    Repeated rows and null ids are counted like others, ``over_limit`` begins above
    ``limit``. An empty table gives an empty result; columns beyond id and text are
    ignored. The proof of the boundaries holds for vocabularies whose pre-tokenizer
    drops white space and scans words one after another.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = counter(vocabulary or public_vocabulary(), chunk, overlap)
        for batch in batches:
            batch["n_tokens"] = tokens.count(batch.pop("text").tolist())
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(ident).cast("long").alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text")
    )
    counted = rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
