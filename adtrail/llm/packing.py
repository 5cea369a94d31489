"""Packing token sequences by linear grouping, configurations and best fit.

Only counts by length reach the driver: at most as many rows as a sequence has
tokens. Lengths above ``SMALL`` are sorted, cut into groups of equal
cardinality and rounded up to the longest of their group; with that few sizes
the best mix of configurations is a small linear programme, solved by column
generation. Actual lengths then take the places of the rounded ones, and what
is left is put where it fits best, longest first. All of this is done for runs
of sequences with equal content, so the plan does not grow with the number of
documents. A document finds its place by its rank among those of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import ranked, stored

CAPACITY = 2048
#: Lengths up to this one are left for best fit; at most two longer ones fit together.
SMALL = 900
GROUPS = 48
#: Id that ends a document.
END = 0
#: Text that the tokenizer reads as one id.
SPECIAL = "<|endoftext|>"


@dataclass
class Run:
    """``count`` sequences alike, numbered from ``base``, with ``room`` tokens left."""

    base: int
    count: int
    room: int


@dataclass
class Plan:
    """Where the documents of a length go, by rank."""

    capacity: int
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def open(self, count: int) -> Run:
        self.sequences += count
        return Run(self.sequences - count, count, self.capacity)

    def put(self, run: Run, length: int) -> None:
        """One document of ``length`` into each sequence of ``run``."""
        rank = self.used.get(length, 0)
        self.rows.append((length, rank, run.count, run.base, self.capacity - run.room))
        self.used[length] = rank + run.count
        run.room -= length


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths with counts, longest first, cut into groups of equal cardinality."""
    total = sum(counts.values())
    each, out = max(1, -(-total // groups)), [[]]
    free = each
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not free:
                out.append([])
                free = each
            took = min(left, free)
            out[-1].append((length, took))
            left, free = left - took, free - took
    return [g for g in out if g]


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes of most value that fits the capacity."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    for room in range(1, capacity + 1):
        fit = order[: np.searchsorted(sizes[order], room, side="right")]
        best[room] = best[room - 1]
        if len(fit):
            got = best[room - sizes[fit]] + values[fit]
            top = int(np.argmax(got))
            if got[top] > best[room] + 1e-12:
                best[room], chosen[room] = got[top], fit[top]
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            counts[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down from the linear optimum."""
    kinds = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        value, column = best_configuration(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if value <= 1 + 1e-7:
            break
        amount, change = inverse @ demand, inverse @ column
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.where(change > 1e-9, change, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    amount = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-6).astype(np.int64)
    return [(basis[:, n].astype(np.int64), int(amount[n])) for n in range(kinds) if amount[n] > 0]


def _take(queue: list[list[int]], count: int) -> list[tuple[int, int]]:
    """``count`` documents from a queue of [length, left], fewer if it runs out."""
    out = []
    while count and queue:
        took = min(count, queue[0][1])
        out.append((queue[0][0], took))
        queue[0][1] -= took
        count -= took
        if not queue[0][1]:
            queue.pop(0)
    return out


def make_plan(counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> Plan:
    """A plan for documents of 1 to ``capacity`` tokens, given their number by length."""
    plan, left = Plan(capacity), dict(counts)
    runs: list[Run] = []
    if left.get(capacity):
        plan.put(plan.open(left.pop(capacity)), capacity)
    large = {length: n for length, n in left.items() if length > small}
    if large:
        parts = grouped(large, groups)
        sizes = np.array([g[0][0] for g in parts])
        demand = np.array([sum(n for _, n in g) for g in parts])
        unique = np.unique(sizes)[::-1]
        total = np.array([demand[sizes == s].sum() for s in unique])
        queues = [[list(x) for g, s in zip(parts, sizes, strict=True) if s == u for x in g] for u in unique]
        for config, times in configurations(unique, total, capacity):
            slots = [_take(queues[kind], times) for kind in np.repeat(np.arange(len(unique)), config)]
            slots = [s for s in slots if s]
            filled = [sum(n for _, n in s) for s in slots]
            edges = sorted({0, *filled, *(int(e) for s in slots for e in np.cumsum([n for _, n in s]))})
            for begin, end in zip(edges, edges[1:], strict=False):
                run = plan.open(end - begin)
                for slot in slots:
                    at = 0
                    for length, n in slot:
                        if at <= begin < at + n:
                            plan.put(run, length)
                        at += n
                runs.append(run)
        left = {length: n - plan.used.get(length, 0) for length, n in left.items()}
    _best_fit(plan, runs, left)
    return plan


def _best_fit(plan: Plan, runs: list[Run], left: dict[int, int]) -> None:
    """Put the rest, longest first, each where the least room remains."""
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def keep(run: Run) -> None:
        if run.count and run.room:
            if run.room not in by_room:
                by_room[run.room] = []
                bisect.insort(rooms, run.room)
            by_room[run.room].append(run)

    for run in runs:
        keep(run)
    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                run = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                run = plan.open(max(1, n // (plan.capacity // length)))
            each = min(run.room // length, n)
            use = min(run.count, n // each)
            keep(Run(run.base + use, run.count - use, run.room))
            full = Run(run.base, use, run.room)
            for _ in range(each):
                plan.put(full, length)
            keep(full)
            n -= each * use


_encoders: dict[str, Any] = {}


def encoder(vocabulary: str, ranks: str, pattern: str):
    """Ids of a text. Both libraries read one vocabulary and give equal ids; the
    second, five times as fast, takes the texts that hold no special token. Each is
    loaded for the first text that needs it."""

    def slow():
        if vocabulary not in _encoders:
            from tokenizers import Tokenizer

            _encoders[vocabulary] = Tokenizer.from_file(vocabulary)
        return _encoders[vocabulary]

    def fast():
        if ranks not in _encoders:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            _encoders[ranks] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=pairs, special_tokens={})
        return _encoders[ranks]

    def ids(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(fast().encode_to_numpy(text, disallowed_special=()), np.uint32)

    return ids


def public_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def pieces(
    docs: DataFrame,
    vocabulary: tuple[str, str, str] | None = None,
    capacity: int = CAPACITY,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``; a longer document's first piece is the short one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(*(vocabulary or public_vocabulary()))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, body in zip(batch["doc_id"], batch.pop("text"), strict=True):
                tokens = np.append(ids(body) if body else np.zeros(0, np.uint32), np.uint32(END)).astype("<u4")
                start, end, piece = 0, len(tokens) % capacity or min(capacity, len(tokens)), 0
                while start < len(tokens):
                    out.append((doc_id, piece, start, end - start, zlib.crc32(tokens[start:end].tobytes())))
                    start, end, piece = end, end + capacity, piece + 1
            rows = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            yield rows

    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(cut: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """``cut``, which is read twice, with ``sequence_id`` and ``offset``."""
    numbered = ranked(cut, "length", ["doc_id", "piece", "start"], "rank")
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    plan = make_plan(counts, capacity, small, groups)
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    marks = rows[:, 0] * (1 << 44) + rows[:, 1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch["rank"].to_numpy()
            found = rows[np.searchsorted(marks, batch["length"].to_numpy() * (1 << 44) + rank, side="right") - 1]
            batch["sequence_id"] = found[:, 3] + rank - found[:, 1]
            batch["offset"] = found[:, 4]
            yield batch.drop(columns="rank")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return numbered.select(columns).mapInPandas(run, schema)


def pack(
    docs: DataFrame,
    vocabulary: tuple[str, str, str] | None = None,
    capacity: int = CAPACITY,
    small: int = SMALL,
    groups: int = GROUPS,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens, one row per piece.

    A null or empty text is its end token alone. Repeated rows and null ids are
    packed as documents of their own. Only documents longer than a sequence are
    cut. An empty table gives an empty result; columns beyond id and text are
    ignored.
    """
    # Stored, for sorting by range reads its input twice and texts are encoded once.
    cut = stored(pieces(docs, vocabulary, capacity, ident, text), "packing-pieces")
    return place(cut, capacity, small, groups)
