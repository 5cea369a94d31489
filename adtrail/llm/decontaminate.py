"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item is cut into windows of item words. A window is found in a
document only if the document holds all its shingles, so at a containment of
one the prefix that has to be joined is a single shingle: the rarest one, by
the order of their counts over all documents. A document word that starts this
shingle gives a candidate; the window must begin and end inside the document
(positional and length bound), and then all its words are compared.

The windows are broadcast in blocks of at most ``BLOCK`` rows, one pass over
the documents each, so what is broadcast has a bound and the documents are
never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm.common import ascii_lower, row_key, stored, whole_rows

WINDOW = 10
#: Words of a shingle; fewer where a window is shorter.
SHINGLE = 3
#: Windows broadcast at once, some 500 bytes each.
BLOCK = 100_000
#: What separates words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in lower case; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def _shingle(source: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(source, at + n) for n in range(size)])


def windows_of(items: DataFrame, width: int, shingle: int, ident: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, words, window_id, length, size``: all windows of all items."""
    cut = items.select(F.col(ident).cast("string").alias("item_id"), words(F.col(text)).alias("all"))
    cut = cut.where(F.size("all") > 0).withColumn("length", F.least(F.size("all"), F.lit(width)))
    return (
        cut.withColumn("start", F.explode(F.expr("sequence(0, size(all) - length)")))
        .select("item_id", F.slice("all", F.col("start") + 1, F.col("length")).alias("words"), "length")
        .withColumn("window_id", F.sha2(F.array_join("words", " "), 256))
        .withColumn("size", F.least(F.col("length"), F.lit(shingle)))
    )


def _places(docs: DataFrame) -> DataFrame:
    return docs.select("key", "words", F.posexplode("words").alias("pos", "word"))


def _prefixes(docs: DataFrame, windows: DataFrame, sizes: list[int], block: int) -> DataFrame:
    """Each distinct window with its rarest shingle and where that starts."""
    shingles = windows.withColumn("offset", F.explode(F.expr("sequence(0, length - size)")))
    at = F.col("offset")
    token = reduce(
        lambda other, size: F.when(F.col("size") == size, _shingle(F.col("words"), at, size)).otherwise(other),
        sizes,
        F.lit(None).cast("long"),
    )
    shingles = stored(shingles.withColumn("token", token), "benchmark-shingles")
    tokens = shingles.select("token", "size").distinct()
    counts = []
    for size in sizes:
        wanted = tokens.where(F.col("size") == size).select("token")
        for part in _blocks(wanted, "token", block):
            found = _places(docs).select(_shingle(F.col("words"), F.col("pos"), size).alias("token"))
            counts.append(found.join(F.broadcast(part), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    seen = reduce(DataFrame.unionByName, counts).groupBy("token").agg(F.sum("n").alias("n"))
    rarest = F.struct(F.coalesce("n", F.lit(0)), "token", "offset")
    return (
        shingles.join(seen, "token", "left")
        .groupBy("window_id")
        .agg(F.min_by(F.struct("token", "offset", "words", "length", "size"), rarest).alias("w"))
        .select("window_id", "w.*")
    )


def _blocks(rows: DataFrame, by: str, most: int) -> list[DataFrame]:
    """``rows`` cut by a hash so that a block holds about ``most`` at the most."""
    parts = -(-rows.count() // most)
    if parts <= 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64(by), F.lit(parts)) == n) for n in range(parts)]


def occurrences(
    docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """``key, start, length, window_id``: each place of ``docs (key, words)`` where a window stands."""
    distinct = stored(windows.drop("item_id").dropDuplicates(["window_id"]), "benchmark-windows")
    sizes = sorted(row[0] for row in distinct.select("size").distinct().collect())  # at most ``shingle`` rows
    if not sizes:
        return docs.select("key", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("window_id")).limit(0)
    prefixes = stored(_prefixes(docs, distinct, sizes, block), "benchmark-prefixes")
    found = []
    for size in sizes:
        for part in _blocks(prefixes.where(F.col("size") == size), "window_id", block):
            wanted = part.select(
                "token", "offset", "window_id", "length", F.col("words").alias("window")
            )
            start = F.col("pos") - F.col("offset")
            places = _places(docs).withColumn("token", _shingle(F.col("words"), F.col("pos"), size))
            inside = (start >= 0) & (start + F.col("length") <= F.size("words"))
            same = F.slice("words", F.when(inside, start + 1).otherwise(1), F.col("length")) == F.col("window")
            joined = places.alias("d").join(
                F.broadcast(wanted).alias("w"), (F.col("d.token") == F.col("w.token")) & inside & same
            )
            found.append(joined.select("key", start.alias("start"), "length", "window_id"))
    return reduce(DataFrame.unionByName, found)


def _hits(docs, items, width, shingle, block, ident, text) -> tuple[DataFrame, DataFrame, DataFrame]:
    keyed = docs.select(row_key(F.col(ident), F.col(text)).alias("key"), words(F.col(text)).alias("words"))
    windows = windows_of(items, width, shingle)
    return keyed, windows, stored(occurrences(keyed, windows, shingle, block), "benchmark-hits").distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    shingle: int = SHINGLE,
    block: int = BLOCK,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A null or wordless text has no words and no hits; an item without words or
    id is no item (a null id counts its hits, not its name). Items that repeat
    an id count once. Rows that repeat id and text each get the result; rows
    that repeat an id with another text are judged apart. With an empty
    benchmark nothing is hit; an empty table gives an empty result. Columns
    beyond id and text are ignored.
    """
    keyed, windows, hits = _hits(docs, items, width, shingle, block, ident, text)
    before = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))))
    spans = hits.select("key", "start", "length").distinct().select("key", covered.alias("new"))
    n_hit = spans.groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    named = windows.select("window_id", "item_id").distinct()
    n_items = (
        hits.select("key", "window_id")
        .distinct()
        .join(named, "window_id")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    found = n_hit.join(n_items, "key", "left").withColumnRenamed("key", "hit_key")
    rows = keyed.select("key", F.size("words").cast("long").alias("n_words"))
    same = (F.col("key.id").eqNullSafe(F.col("hit_key.id"))) & (F.col("key.text_hash") == F.col("hit_key.text_hash"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, same, "left").select(
        F.col("key.id").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    shingle: int = SHINGLE,
    block: int = BLOCK,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns.

    Null, empty and wordless texts stay, repeated rows stay or go together, and
    an empty benchmark or table changes nothing. Other columns go along
    whatever their names.
    """
    _, _, hits = _hits(docs, items, width, shingle, block, ident, text)
    bad = hits.select(F.col("key.id").alias("bad_id"), F.col("key.text_hash").alias("bad_hash")).distinct()
    rows = whole_rows(docs, id=docs[ident], hash=F.xxhash64(F.coalesce(docs[text], F.lit(""))))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash"))
    return rows.join(bad, same, "left_anti").select("row.*")
