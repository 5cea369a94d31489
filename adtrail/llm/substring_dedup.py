"""Substring dedup: suffix automata of reference shards, streamed for matching statistics.

A window of ``WINDOW`` words is removed where a document of a smaller id holds it
too. The windows are routed first: each is known by the least hash of its
``GRAM``-word grams, the same wherever the window stands, and neighbouring
windows of one such key form a segment. Keys that only one document has are
left aside. The distinct segments of the other keys are the reference; they are
dealt by key into shards of bounded size. The automaton of a shard holds for
every state the smallest document that contains its strings; the segments are
streamed through it, and where the matching statistic reaches a window's length
the state names the window's first owner. The answer depends on a segment's
content alone, so documents that share a segment share one stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import stored, stored_for_now
from adtrail.session import settings, work_folder
from adtrail.sources.tables import make_folder, remove_folder

WINDOW = 13
GRAM = 6
#: Windows of a segment at most.
SEGMENT = 64
#: Words of a shard, about.
SHARD = 100_000
#: Distinct segments of a key beyond which its windows are compared one by one.
HOT_KEY = 20_000
#: Bytes of text hashed at once, if a document is not longer.
CHUNK = 2 << 20
#: Larger than any document's id.
NOBODY = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base)
            row[0] = 1
            _powers[name] = np.cumprod(row)
    return _powers["up"], _powers["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _BASE
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word and where it starts; words end at ASCII white space."""
    code = np.frombuffer(text, np.uint8)
    space = ((code == 32) | ((code >= 9) & (code <= 13))).astype(np.int8)
    edge = np.diff(np.concatenate((np.ones(1, np.int8), space, np.ones(1, np.int8))))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(len(code) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[: len(code)])))
    return _mix((total[ends] - total[starts]) * down[starts]), starts


def segments(hashes: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows and numbers of windows of the segments of a stream of words."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = min(GRAM, window)
    gram = np.zeros(len(hashes) - size + 1, np.uint64)
    for at in range(size):
        gram = _mix(gram * np.uint64(31) + hashes[at : at + len(gram)])
    width, least = 1, gram
    wanted = window - size + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    whole = np.flatnonzero(doc[:n] == doc[window - 1 :])
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, owner = least[whole], doc[whole]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(new)
    long = np.arange(len(key)) - np.repeat(first, np.diff(np.concatenate((first, [len(key)]))))
    first = np.flatnonzero(long % SEGMENT == 0)
    return key[first].view(np.int64), whole[first], np.diff(np.concatenate((first, [len(key)])))


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield begin, at
            begin, size = at, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _keys(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for begin, end in _chunks(texts):
            part = texts[begin:end]
            hashes, starts = word_hashes(b"\n".join(part))
            ends = np.cumsum([len(t) + 1 for t in part])
            doc = np.searchsorted(ends, starts, side="right")
            key, first, _ = segments(hashes, doc, window)
            rows = pd.DataFrame({"key": key, "doc_id": batch["doc_id"].to_numpy()[begin + doc[first]]})
            yield rows.drop_duplicates()


def _segment_rows(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Segments of shared keys: where each stands, and then, for each content once,
    its words with the smallest and the largest document of the task.

    A shared key is in ``wanted`` of every document that has it, so the documents of a chunk are
    looked through together.
    """
    reference: dict[tuple[int, int], list] = {}
    unpack = zstandard.ZstdDecompressor().decompress
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        texts = [b" ".join(unpack(body).split()) for body in batch["body"]]
        ids, marks = batch["doc_id"].to_numpy(), batch["text_hash"].to_numpy()
        for begin, end in _chunks(texts):
            part = texts[begin:end]
            stream = b"\n".join(part)
            hashes, starts = word_hashes(stream)
            edges = np.cumsum([len(t) + 1 for t in part])
            doc = np.searchsorted(edges, starts, side="right")
            key, first, n = segments(hashes, doc, window)
            hit = np.isin(key, np.concatenate(batch["wanted"].tolist()[begin:end]))
            key, first, n = key[hit], first[hit], n[hit]
            owner = doc[first]
            after = np.append(starts, len(stream) + 1)[first + n + window - 1] - 1
            who, low = ids[begin + owner], np.empty(len(key), np.uint64)
            rows = zip(key.tolist(), starts[first].tolist(), after.tolist(), who.tolist(), n.tolist(), strict=True)
            for at, (k, begins, ends, doc_id, many) in enumerate(rows):
                words = stream[begins:ends]
                low[at] = mark = digest(words)
                known = reference.get((k, mark))
                if known is None:
                    reference[k, mark] = [doc_id, doc_id, many + window - 1, words]
                elif doc_id < known[0]:
                    known[0] = doc_id
                elif doc_id > known[1]:
                    known[1] = doc_id
            place = first - np.searchsorted(doc, owner)  # in words of its document
            found = {"key": key, "low": low.view(np.int64), "doc_id": who, "text_hash": marks[begin + owner], "first": place}
            yield pd.DataFrame(found).assign(owner=pd.NA, most=pd.NA, n=pd.NA, words=None)
    names = [*reference]
    for at in range(0, len(names), 10_000):
        part = names[at : at + 10_000]
        rows = pd.DataFrame([(k, *reference[k, low]) for k, low in part], columns=["key", "owner", "most", "n", "words"])
        rows["low"] = np.array([low for _, low in part], np.uint64).view(np.int64)
        yield rows.assign(doc_id=pd.NA, text_hash=pd.NA, first=pd.NA)


class Automaton:
    """Suffix automaton of several sequences; each state knows its smallest owner."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NOBODY]

    def _split(self, at: int, symbol: int, target: int) -> int:
        """The copy of ``target`` for the strings one longer than those of ``at``."""
        copy = len(self.next)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[at] + 1)
        self.owner.append(NOBODY)
        self.link[target] = copy
        while at >= 0 and self.next[at].get(symbol) == target:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def add(self, sequence: list[int], owner: int) -> None:
        moves, link, length, owners = self.next, self.link, self.length, self.owner
        last = 0
        for symbol in sequence:
            target = moves[last].get(symbol)
            if target is not None:
                exact = length[target] == length[last] + 1
                last = target if exact else self._split(last, symbol, target)
            else:
                new, at, up = len(moves), last, 0
                moves.append({})
                link.append(0)
                length.append(length[last] + 1)
                owners.append(NOBODY)
                while at >= 0:
                    here = moves[at]
                    if symbol in here:
                        up = here[symbol]
                        if length[up] != length[at] + 1:
                            up = self._split(at, symbol, up)
                        break
                    here[symbol] = new
                    at = link[at]
                link[new] = up
                last = new
            if owner < owners[last]:
                owners[last] = owner

    def settle(self) -> None:
        """Give each state the smallest owner of all strings that end with its own."""
        link, owners = self.link, self.owner
        for state in np.argsort(self.length)[:0:-1].tolist():  # longest first, without the root
            up = link[state]
            if owners[state] < owners[up]:
                owners[up] = owners[state]

    def owners(self, sequence: list[int], window: int) -> list[int]:
        """Of each window, its smallest owner; ``NOBODY`` where it does not occur."""
        moves, link, length, owners = self.next, self.link, self.length, self.owner
        state, matched, out = 0, 0, []
        for at, symbol in enumerate(sequence, 1):
            ahead = moves[state].get(symbol)
            while ahead is None and state:
                state = link[state]
                matched = length[state]
                ahead = moves[state].get(symbol)
            if ahead is not None:
                state, matched = ahead, matched + 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if at >= window:
                out.append(owners[state] if matched >= window else NOBODY)
        return out


def _shard(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    same = {"owner": "min", "most": "max", "words": "first"}
    rows = rows.groupby(["key", "low"], as_index=False, sort=False).agg(same)
    ids: dict[bytes, int] = {}
    sequences = [[ids.setdefault(w, len(ids)) for w in words.split()] for words in rows["words"]]
    reference = Automaton()
    for sequence, owner in zip(sequences, rows["owner"].tolist(), strict=True):
        reference.add(sequence, owner)
    reference.settle()
    rows["owners"] = [reference.owners(s, window) for s in sequences]
    spent = np.fromiter(map(min, rows["owners"]), np.int64, len(rows)) < rows["most"].to_numpy()
    return rows.loc[spent, ["key", "low", "owners"]]


def _window_owners(hot: DataFrame, window: int) -> DataFrame:
    """The same for keys with too many segments for one shard, window by window.

    A window goes by 16 bytes of its SHA-256, two of which are never equal by chance.
    """
    hot = hot.groupBy("key", "low", "words").agg(F.min("owner").alias("owner"))
    cut = hot.select("key", "low", "owner", F.split(F.col("words").cast("string"), " ").alias("w"))
    mark = f"substring(unhex(sha2(array_join(slice(w, i, {window}), ' '), 256)), 1, 16)"
    marks = F.expr(f"transform(sequence(1, size(w) - {window - 1}), i -> {mark})")
    one = cut.select("key", "low", "owner", F.posexplode(marks).alias("at", "mark"))
    least = one.groupBy("mark").agg(F.min("owner").alias("least"))
    return (
        one.drop("owner")
        .join(least, "mark")
        .groupBy("key", "low")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "least"))), lambda x: x["least"]).alias("owners"))
    )


def removals(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD, hot_key: int = HOT_KEY) -> DataFrame:
    """``doc_id, text_hash, taken``: first words of the windows that a smaller id holds.

    ``docs`` has ``doc_id, text_hash, text`` (binary).
    """
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    keys = known.select("doc_id", "text").mapInPandas(lambda b: _keys(b, window), "key long, doc_id long")
    keys, all_keys = stored_for_now(keys, "substring-all-keys")
    # A key in two rows is in two documents or in rows that repeat an id; the latter costs time only.
    shared, shared_keys = stored_for_now(keys.groupBy("key").count().where("count > 1").select("key"), "substring-keys")
    wanted = keys.join(shared, "key").groupBy("doc_id").agg(F.collect_list("key").alias("wanted"))
    rows = packed(known).join(wanted, "doc_id").select("doc_id", "text_hash", "body", "wanted")
    schema = "key long, low long, doc_id long, text_hash long, first int, owner long, most long, n int, words binary"
    found = rows.mapInPandas(lambda b: _segment_rows(b, window), schema)
    # Places and contents in folders of their own, as the latter are read no more once they have owners.
    spark, parts = docs.sparkSession, work_folder(docs.sparkSession, "substring-segments")
    folders = [f"{parts}/content={n}" for n in (0, 1)]
    for folder in folders:
        make_folder(spark, folder)
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):  # else each task sorts its rows
        found.withColumn("content", F.col("doc_id").isNull().cast("int")).write.mode("append").partitionBy("content").parquet(parts)
    for folder in (all_keys, shared_keys):
        remove_folder(spark, folder)
    places, contents = (spark.read.schema(schema).parquet(folder) for folder in folders)
    members = places.select("key", "low", "doc_id", "text_hash", "first")
    reference = contents.select("key", "low", "owner", "most", "words", "n")
    shards = max(1, -(-(reference.agg(F.sum("n")).first()[0] or 0) // shard_words))
    many = stored(reference.groupBy("key").count().where(F.col("count") > hot_key).select("key"), "substring-hot-keys")
    hot = not many.isEmpty()
    cold = reference.join(many, "key", "left_anti") if hot else reference
    dealt = cold.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "low", "owner", "most", "words")
    owners = dealt.groupBy("shard").applyInPandas(
        lambda r: _shard(r.drop(columns="shard"), window), "key long, low long, owners array<long>"
    )
    if hot:
        owners = owners.unionByName(_window_owners(reference.join(many, "key", "left_semi"), window))
    owners = stored(owners, "substring-owners")
    remove_folder(spark, folders[1])
    spent = F.transform("owners", lambda owner, at: F.when(owner < F.col("doc_id"), F.col("first") + at))
    return (
        members.join(owners, ["key", "low"])
        .where(F.array_min("owners") < F.col("doc_id"))
        .select("doc_id", "text_hash", F.array_compact(spent).alias("taken"))
        .groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_list("taken")).alias("taken"))
    )


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text compressed, for the way through a shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            bodies = [None if t is None else pack(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"], "body": bodies})

    return docs.select("doc_id", "text_hash", "text").mapInPandas(run, "doc_id long, text_hash long, body binary")


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD,
    hot_key: int = HOT_KEY,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept`` (words joined by a space, binary).

    Words end at ASCII white space and stay as they are. A null text has no
    words. A document of fewer words than a window keeps all. A null id owns
    no window and loses none. Windows that one document repeats stay; rows that
    repeat an id do not remove each other's words. An empty table gives an
    empty result; columns beyond id and text are ignored.
    """
    plain = docs.select(
        F.col(ident).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc_id, body, taken in zip(batch["doc_id"], batch["body"], batch["taken"], strict=True):
                words = unpack(body).split() if body is not None else []
                if taken is None:
                    out.append((doc_id, len(words), 0, b" ".join(words)))
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                taken = np.asarray(taken)
                np.add.at(gone, taken, 1)
                np.add.at(gone, taken + window, -1)
                left = np.cumsum(gone)[:-1] == 0
                kept = [w for w, stays in zip(words, left.tolist(), strict=True) if stays]
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept)))
            rows = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            yield rows

    spans = removals(plain, window, shard_words, hot_key).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    whole = packed(plain)
    joined = whole.join(spans, (whole["doc_id"] == spans["__id"]) & (whole["text_hash"] == spans["__hash"]), "left")
    return joined.select("doc_id", "body", "taken").mapInPandas(
        run, "doc_id long, n_words long, n_removed long, kept binary"
    )
