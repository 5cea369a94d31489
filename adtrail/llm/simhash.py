"""SimHash near-dedup over a Gray-order hierarchical index.

Two fingerprints of at most two differing bits agree in one of three blocks of
bits, so each distinct fingerprint is sent to three groups, one per block
value; the blocks are as wide as leaves a group about ``SHARE`` fingerprints. In a group the fingerprints are sorted by their Gray rank and become the
leaves of a tree. A node holds the bits on which all below it agree and which no
node above it holds yet; a search walks down, adds up the differences and
leaves a node as soon as they pass the limit. Links of a group leave it as
edges to one member per local component, never as all pairs, and components
are joined by star contraction over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import first_of, row_key, stored, whole_rows

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints of a leaf, and children of an upper node.
FAN = 16
#: Distinct fingerprints of a group beyond which it is cut by three further blocks.
GROUP = 50_000
#: First bit and full width of the blocks.
BLOCKS = ((42, 22), (21, 21), (0, 21))
#: Distinct fingerprints of a group, about, for which blocks are as narrow as can be.
SHARE = 1024
#: Rows of one task of the search.
TASK_ROWS = 50_000
ROUNDS = 60


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: bit n is set if it is set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest, n = xxhash.xxh64_intdigest, len(words) - size + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp``: the fingerprint as a signed long, one row per row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = np.array([fingerprint(t, shingle) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": got.view(np.int64)})

    rows = docs.select(row_key(F.col(ident), F.col(text)).alias("key"), F.col(text).alias("text"))
    rows = rows.select(F.col("key.id").cast("long").alias("doc_id"), F.col("key.text_hash"), "text")
    return rows.mapInPandas(run, "doc_id long, text_hash long, fp long")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Tree over fingerprints sorted by Gray rank; upper nodes hold shared bits."""

    def __init__(self, sorted_codes: np.ndarray, fan: int = FAN):
        self.codes, self.fan = sorted_codes, fan
        every = ~np.uint64(0)
        ones, zeros, levels = sorted_codes, ~sorted_codes, []
        while True:
            starts = np.arange(0, len(ones), fan)
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            levels.append((ones, ones | zeros))
            if len(ones) <= fan:
                break
        self.levels = []
        above: np.ndarray | None = None
        for ones, shared in reversed(levels):
            held = np.zeros(len(ones), np.uint64) if above is None else above[np.arange(len(ones)) // fan]
            self.levels.append((ones, shared & ~held))
            above = shared
        self.rest = every ^ above[np.arange(len(sorted_codes)) // fan]

    def links(self, first: int, last: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), i < j, of at most ``distance`` differing bits, for i from first to last."""
        query = np.arange(first, last)
        ones, bits = self.levels[0]
        who, node = np.repeat(query, len(ones)), np.tile(np.arange(len(ones)), len(query))
        apart = np.bitwise_count((self.codes[who] ^ ones[node]) & bits[node])
        near = apart <= distance
        who, node, apart = who[near], node[near], apart[near]
        for ones, bits in [*self.levels[1:], (self.codes, self.rest)]:
            child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
            who, apart = np.repeat(who, self.fan), np.repeat(apart, self.fan)
            real = child < len(ones)
            who, node, apart = who[real], child[real], apart[real]
            apart = apart + np.bitwise_count((self.codes[who] ^ ones[node]) & bits[node])
            near = apart <= distance
            who, node, apart = who[near], node[near], apart[near]
        later = node > who
        return who[later], node[later]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of each pair, and all that share their labels, one label."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        differ = low != high
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(label, high[differ], low[differ])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def group_links(codes: np.ndarray, group: np.ndarray, distance: int, fan: int = FAN) -> np.ndarray:
    """A label per code, rows of one group being neighbours: the place of a linked row."""
    label = np.arange(len(codes))
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(codes)])))
    small = (sizes > 1) & (sizes <= fan)
    if small.any():  # one leaf: no node to prune
        for shift in range(1, int(sizes[small].max())):
            wide = small & (sizes > shift)
            n = sizes[wide] - shift
            a = np.repeat(starts[wide] - np.cumsum(n) + n, n) + np.arange(n.sum())
            near = np.bitwise_count(codes[a] ^ codes[a + shift]) <= distance
            _merge(label, a[near], a[near] + shift)
    for start, size in zip(starts[sizes > fan].tolist(), sizes[sizes > fan].tolist(), strict=True):
        order = start + np.argsort(gray_rank(codes[start : start + size]), kind="stable")
        index = GrayIndex(codes[order], fan)
        for first in range(0, size, 1024):
            a, b = index.links(first, min(first + 1024, size), distance)
            _merge(label, order[a], order[b])
    return label


def _linked(batches: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Edges of a partition sorted by group; a group may span batches."""
    names, held = ["turn", "value", "part", "part_value"], None

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        group = rows.groupby(names, sort=False).ngroup().to_numpy()
        label = group_links(rows["fp"].to_numpy().view(np.uint64), group, distance)
        node = rows["node"].to_numpy()
        moved = label != np.arange(len(label))
        a, b = node[moved], node[label[moved]]
        return pd.DataFrame({"high": np.maximum(a, b), "low": np.minimum(a, b)}).drop_duplicates()

    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        last = (rows[names] == rows[names].iloc[-1]).all(axis=1).to_numpy()
        held = rows[last].reset_index(drop=True)
        done = rows[~last].reset_index(drop=True)
        if len(done):
            yield edges(done)
    if held is not None:
        yield edges(held)


def _bits(fp, first: int, width: int):
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def near_links(
    classes: DataFrame, distance: int = DISTANCE, group: int = GROUP, share: int = SHARE
) -> DataFrame:
    """``high, low``: edges that connect what lies within ``distance`` bits.

    ``classes`` has ``fp`` (distinct) and ``node``. Near fingerprints share one of any
    three separate blocks of bits, also of narrow ones, whose groups are worth a tree. Groups beyond ``group``
    distinct fingerprints go on to groups by a third of their other bits, which
    two near fingerprints share as well.
    """
    if not 0 <= distance < len(BLOCKS):
        raise ValueError("three blocks find at most two differing bits")
    fp = F.col("fp")
    count = classes.count()
    width = max(1, (-(-count // share) - 1).bit_length())
    blocks = [(first, min(width, full)) for first, full in BLOCKS]
    turns = F.array(*[F.struct(F.lit(n).alias("turn"), _bits(fp, *b).alias("value")) for n, b in enumerate(blocks)])
    sent = classes.select("fp", "node", F.explode(turns).alias("t")).select("fp", "node", "t.*")
    large = sent.groupBy("turn", "value").count().where(F.col("count") > group).drop("count")
    sent = sent.join(large.withColumn("large", F.lit(True)), ["turn", "value"], "left")
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("part_value")))
    cut = whole
    for turn in range(len(BLOCKS)):
        parts = [p for n, (first, width) in enumerate(BLOCKS) if n != turn for p in _halves(first, width)]
        # Three of the four quarters hold enough: two bits spoil two of any three.
        three = [parts[0], parts[1], (parts[2], parts[3])]
        values = [_bits(fp, *p) if not isinstance(p[0], tuple) else _bits(fp, *p[0]) * (1 << 11) + _bits(fp, *p[1]) for p in three]
        pieces = F.array(*[F.struct(F.lit(n).alias("part"), v.alias("part_value")) for n, v in enumerate(values)])
        cut = F.when(F.col("large") & (F.col("turn") == turn), pieces).otherwise(cut)
    keys = ["turn", "value", "part", "part_value"]
    dealt = sent.withColumn("p", F.explode(cut)).select("fp", "node", "turn", "value", "p.*")
    return (
        dealt.repartition(-(-len(BLOCKS) * count // TASK_ROWS) or 1, *keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(lambda batches: _linked(batches, distance), "high long, low long")
        .distinct()
    )


def _halves(first: int, width: int) -> list[tuple[int, int]]:
    low = width // 2
    return [(first, low), (first + low, width - low)]


def components(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of a link.

    Star contraction: each round ties a node's larger neighbours, then its
    smaller ones, to the smallest it knows, until nothing changes.
    """
    edges = stored(links, "simhash-links")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least"))
        least = least.select("high", F.least("high", "least").alias("least"))
        large = both.where("low > high").join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        large = large.where("high <> low").distinct()
        smallest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(smallest, "high").select(
            F.explode(
                F.array(
                    F.struct(F.col("high"), F.col("least").alias("low")),
                    F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.*").where("high <> low").distinct(), "simhash-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    group: int = GROUP,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, fingerprint, component_id``.

    Null, empty and wordless texts have fingerprint zero and are linked like
    others. Documents of one fingerprint are one class whose links all share.
    ``component_id`` is the smallest id reachable; null ids are ignored there
    unless a class has no other (then the class stands alone, with a null
    component). Repeated rows each get the result. An empty table gives an
    empty result. Columns beyond id and text are ignored.
    """
    marked = stored(fingerprints(docs, shingle, ident, text), "simhash-fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-classes")
    found = components(near_links(classes.where(F.col("node").isNotNull()), distance, group))
    named = stored(
        classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")),
        "simhash-components",
    )
    return marked.join(named, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, ident: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` of the smallest id of each component, all columns.

    Of rows that repeat an id and a text one stays; a null id stays only where
    its component has no other. Null, empty and wordless texts are near each
    other. An empty table stays empty; other columns go along whatever their names.
    """
    groups = near_groups(docs, ident=ident, text=text, **how).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = groups.select(F.col("doc_id").alias("keep_id"), F.col("text_hash").alias("keep_hash")).distinct()
    rows = whole_rows(docs, id=docs[ident].cast("long"), hash=F.xxhash64(F.coalesce(docs[text], F.lit(""))))
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("hash") == F.col("keep_hash")))
    return first_of(kept, "id", "hash").select("row.*")
