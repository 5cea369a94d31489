"""Language by rank-order profiles.

A language's profile is its most frequent letter n-grams in order. A document's
own most frequent n-grams are compared with each profile by their out-of-place
distance: how far each n-gram stands from its place there, or the full length of a
profile where it is missing. The nearest profile names the language.

Profiles are learnt from a bounded sample of each language
(``SAMPLE`` documents, by hash); every document is judged on its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: About so many documents of a language teach its profile.
SAMPLE = 2000
#: N-grams of a language's profile, and of a document's.
PROFILE = 400
DOCUMENT = 300
#: Stands at both ends of a word.
EDGE = "_"
UNKNOWN = "und"
#: Runs of letters, numerals like ``½`` or ``Ⅷ`` among them.
_WORD = re.compile(r"[^\W\d_]+")
_BITS = np.uint64(21)


def words(text: str) -> Counter:
    """The lower-case words of a text, runs of code points of category L."""
    counts = Counter(_WORD.findall(text.lower()))
    for run in [w for w in counts if not w.isalpha()]:
        times = counts.pop(run)
        for word in "".join(c if c.isalpha() else " " for c in run).split():
            counts[word] += times
    return counts


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Letter n-grams of one to three characters in a text's words, and their counts.

    An n-gram is its code points, 21 bits each, in one number.
    """
    counts = words(text or "")
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = EDGE + EDGE.join(counts) + EDGE
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = code == ord(EDGE)
    sizes = np.fromiter(map(len, counts), np.int64, len(counts)) + 1
    many = np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), sizes)  # a word and the edge before it
    one = code[:-1][~edge[:-1]]
    pair = (code[:-1] << _BITS) | code[1:]
    inner = ~edge[1:-1]
    triple = ((code[:-2] << _BITS | code[1:-1]) << _BITS | code[2:])[inner]
    grams, place = np.unique(np.concatenate((one, pair, triple)), return_inverse=True)
    weight = np.concatenate((many[~edge[:-1]], many, many[:-1][inner]))
    return grams, np.bincount(place, weight).astype(np.int64)


def most_frequent(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` n-grams by count; equal counts in the order of the n-grams."""
    return grams[np.lexsort((grams, -counts))[:most]]


class Profiles:
    """Places of n-grams in each language, for languages in the order of their names."""

    def __init__(self, ranks: dict[str, np.ndarray], length: int = PROFILE):
        self.names = sorted(ranks)
        self.length = length
        self.grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *ranks.values()]))
        self.places = np.full((len(self.names), len(self.grams) + 1), -1, np.int64)  # -1: not in the profile
        for row, name in enumerate(self.names):
            self.places[row, np.searchsorted(self.grams, ranks[name])] = np.arange(len(ranks[name]))

    def nearest(self, text: str | None, most: int = DOCUMENT) -> tuple[str, float]:
        own = most_frequent(*ngrams(text), most)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        known = (at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own)
        places = self.places[:, np.where(known, at, len(self.grams))]
        off = np.where(places < 0, self.length, np.minimum(np.abs(places - np.arange(len(own))), self.length))
        distance = off.sum(axis=1)
        best = int(np.argmin(distance))  # the first of equals
        return self.names[best], 1 - distance[best] / (self.length * len(own))


def held_out(ident: Column) -> Column:
    """Whether a document may not be learnt from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(
    docs: DataFrame, sample: int = SAMPLE, length: int = PROFILE, ident: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Profiles:
    """Profiles of the languages of the documents that are not held out.

    The driver gets a count and a profile per language, no more than the model.
    """
    own = docs.where(~held_out(F.col(ident)) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    own = own.select(F.col(lang).alias("lang"), F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    sizes = {row["lang"]: row["count"] for row in own.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles({}, length)
    rates = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(min(1.0, sample / n)))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    chosen = own.where(draw < rates[F.col("lang")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, rows in batch.groupby("lang"):
                parts = [ngrams(t) for t in rows["text"]]
                grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(place, np.concatenate([c for _, c in parts]), len(grams))
                yield pd.DataFrame({"lang": name, "gram": grams.view(np.int64), "n": n.astype(np.int64)})

    counts = chosen.select("lang", "text").mapInPandas(run, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= length)
    ranks: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "place", "gram").collect():
        ranks.setdefault(row["lang"], []).append((row["place"], row["gram"]))
    return Profiles({name: np.array([g for _, g in sorted(rows)], np.uint64) for name, rows in ranks.items()}, length)


def identify(
    docs: DataFrame, sample: int = SAMPLE, ident: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    ``score`` is one less the distance as a share of the largest possible. A
    text that is null or has no letter is ``und`` with score 0, and so is every
    text where nothing could be learnt. Equal distances go to the first name.
    Rows that repeat an id are judged each on its own. An empty table gives an
    empty result; columns beyond id, text and language are ignored.
    """
    profiles = learn(docs, sample, ident=ident, text=text, lang=lang)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.nearest(t) for t in texts], columns=["lang_pred", "score"])

    return docs.select(
        F.col(ident).alias("doc_id"), held_out(F.col(ident)).alias("held_out"), predict(F.col(text)).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
