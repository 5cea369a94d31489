"""Fill-in-middle by displacement scatter.

A document is cut into prefix, middle and suffix, which move as blocks of bytes.
For all documents of a batch the cuts are scanned on one byte buffer; at each cut
a difference array gets the change of displacement, its running sum is the
displacement of every byte, and one scatter writes all outputs. The markers found
in the outputs give the opposite differences, and one gather restores the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = (m[1] for m in MARKS)
WIDE = 3
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text whose outputs are built at a time, and bytes moved at a time.
CHUNK = 8 << 20
BLOCK = 1 << 20
STEP = 4096

COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Marked:
    """Marked bytes of a buffer: how many stand before a place, and where the n-th is."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        edges = np.arange(0, len(flags), STEP)
        counts = np.add.reduceat(flags, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))

    def rank(self, place: int) -> int:
        block = min(place // STEP, len(self.before) - 1)
        return int(self.before[block]) + int(np.count_nonzero(self.flags[block * STEP : place]))

    def select(self, number: int) -> int:
        """The place of marked byte ``number``, counted from 0."""
        block = int(np.searchsorted(self.before, number, side="right")) - 1
        here = np.flatnonzero(self.flags[block * STEP : (block + 1) * STEP])
        return block * STEP + int(here[number - self.before[block]])


def _displaced(places: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each byte's place plus its displacement, by blocks of ``BLOCK`` bytes.

    ``places`` ascend; from each on the displacement is its ``shifts``, and of
    equal places the last one holds.
    """
    changes = np.diff(shifts, prepend=0)
    carry = 0
    for begin in range(0, size, BLOCK):
        end = min(begin + BLOCK, size)
        low, high = np.searchsorted(places, (begin, end))
        moved = np.zeros(end - begin, np.int64)
        np.add.at(moved, places[low:high] - begin, changes[low:high])
        moved[0] += carry
        np.cumsum(moved, out=moved)
        carry = int(moved[-1])
        moved += np.arange(begin, end)
        yield begin, moved


def scatter(data: np.ndarray, places: np.ndarray, shifts: np.ndarray, out: np.ndarray) -> None:
    for begin, moved in _displaced(places, shifts, len(data)):
        out[moved] = data[begin : begin + len(moved)]


def gather(data: np.ndarray, places: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    out = np.empty(size, np.uint8)
    for begin, moved in _displaced(places, shifts, size):
        out[begin : begin + len(moved)] = data[moved]
    return out


def find_marks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of markers that lie in one document, and the documents they lie in."""
    found = []
    for begin in range(0, len(data), BLOCK):
        part = data[begin : begin + BLOCK + WIDE - 1]
        kind = part[1:-1]
        is_mark = (part[:-2] == ord("<")) & (part[2:] == ord(">"))
        found.append(begin + np.flatnonzero(is_mark & ((kind == PREFIX) | (kind == SUFFIX) | (kind == MIDDLE))))
    places = np.concatenate(found) if found else np.zeros(0, np.int64)
    owner = np.searchsorted(bounds, places, side="right") - 1
    inside = places + WIDE <= bounds[owner + 1]
    return places[inside], owner[inside]


def _units(data: np.ndarray, bounds: np.ndarray) -> tuple[Marked, Marked]:
    """First bytes of units (runs of A-Z and a-z, or one other code point), and of code points."""
    lead = (data & 0xC0) != 0x80
    letter = (data | 0x20) - np.uint8(ord("a")) < 26
    first = lead.copy()
    first[1:] &= ~(letter[1:] & letter[:-1])
    begins = bounds[:-1]
    first[begins[begins < bounds[1:]]] = True
    return Marked(first), Marked(lead)


def cut(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, plain_from: int, spm_below: int):
    """Outputs of documents that lie one after another in ``data``.

    Gives the output bytes and their bounds, and by document the units, form,
    and code points of prefix and middle (-1 for plain ones).
    """
    docs = len(bounds) - 1
    units, points = _units(data, bounds)
    n, chars = np.zeros(docs, np.int64), np.full((docs, 2), -1, np.int64)
    cuts = np.stack([bounds[:-1], bounds[1:], bounds[1:]])
    marked = np.zeros(docs, bool)
    marked[find_marks(data, bounds)[1]] = True
    plain = marked | (bounds[1:] == bounds[:-1]) | (draws[2] % 100 >= plain_from)
    for d in range(docs):
        begin, end = int(bounds[d]), int(bounds[d + 1])
        first = units.rank(begin)
        n[d] = units.rank(end) - first
        if not plain[d]:
            pair = sorted(int(h[d]) % int(n[d] + 1) for h in draws[:2])
            a, b = (units.select(first + k) if k < n[d] else end for k in pair)
            cuts[:2, d] = a, b
            at = points.rank(a)
            chars[d] = at - points.rank(begin), points.rank(b) - at
    spm = ~plain & (draws[3] % 100 < spm_below)
    form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
    out_bounds = bounds + np.concatenate(([0], np.cumsum(np.where(plain, 0, WIDE * len(MARKS)))))
    a, b, end = cuts
    prefix, middle, suffix = a - bounds[:-1], b - a, end - b
    base, wide = out_bounds[:-1], WIDE
    at_prefix = np.where(plain, base, np.where(spm, base + 2 * wide + suffix, base + wide))
    at_suffix = np.where(spm, base + wide, base + 2 * wide + prefix)
    at_middle = base + 3 * wide + prefix + suffix
    # A plain document is all prefix: its other two parts are empty, at its end.
    a, prefix = np.where(plain, end, a), np.where(plain, end - bounds[:-1], prefix)
    out = np.empty(int(out_bounds[-1] - out_bounds[0]), np.uint8)
    places = np.stack([bounds[:-1], a, b], axis=1).ravel()
    shifts = np.stack([at_prefix - bounds[:-1], at_middle - a, at_suffix - b], axis=1).ravel()
    scatter(data, places, shifts, out)
    for mark, at in zip(MARKS, (at_prefix, at_suffix, at_middle), strict=True):
        spots = (at - wide)[~plain]
        for k in range(wide):
            out[spots + k] = mark[k]
    return out, out_bounds, n, form, chars


def uncut(data: np.ndarray, bounds: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs, from their markers, and the bounds of the texts."""
    docs = len(bounds) - 1
    places, owner = find_marks(data, bounds)
    keep = ~plain[owner]
    places, owner = places[keep], owner[keep]
    moved = np.flatnonzero(~plain)
    if not np.array_equal(owner, np.repeat(moved, len(MARKS))):
        raise ValueError("an output of prefix, suffix and middle needs each marker once")
    places = places.reshape(-1, len(MARKS))
    kinds = data[places + 1]
    spm = kinds[:, 0] == SUFFIX
    if not np.array_equal(np.sort(kinds, axis=1), np.tile(np.sort([PREFIX, SUFFIX, MIDDLE]), (len(moved), 1))) or (
        kinds[:, 2] != MIDDLE
    ).any():
        raise ValueError("markers in an unknown order")
    ends = np.column_stack([places[:, 1:], bounds[moved + 1]])
    first, second, middle = (ends - places - WIDE).T
    prefix, suffix = np.where(spm, second, first), np.where(spm, first, second)
    from_prefix = np.where(spm, places[:, 1], places[:, 0]) + WIDE
    from_suffix = np.where(spm, places[:, 0], places[:, 1]) + WIDE
    from_middle = places[:, 2] + WIDE
    text_bounds = bounds - np.concatenate(([0], np.cumsum(np.where(plain, 0, WIDE * len(MARKS)))))
    begin, end = text_bounds[:-1], text_bounds[1:]
    starts = np.stack([begin, end, end], axis=1)
    sources = np.stack([bounds[:-1], end, end], axis=1)
    at = begin[moved]
    starts[moved, 1], starts[moved, 2] = at + prefix, at + prefix + middle
    sources[moved] = np.stack([from_prefix, from_middle, from_suffix], axis=1)
    size = int(text_bounds[-1] - text_bounds[0])
    return gather(data, starts.ravel(), (sources - starts).ravel(), size), text_bounds


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of up to ``CHUNK`` bytes, their bytes without copying, and the rows' bounds."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, body = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        until = max(row + 1, int(np.searchsorted(ends, ends[row] + CHUNK, side="right")) - 1)
        yield row, until, data[ends[row] : ends[until]], ends[row : until + 1] - ends[row]
        row = until


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(bounds.astype(np.int32))
    return pa.StringArray.from_buffers(len(bounds) - 1, offsets, pa.py_buffer(data))


def draws_of(ident: Column, seed: int = 1) -> list[Column]:
    """The first four groups of eight hex digits of the digest of seed and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame,
    seed: int = 1,
    plain_from: int = 90,
    spm_below: int = 20,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row of ``docs``.

    A null text is empty; empty texts and texts that hold a marker stay plain,
    as do those whose third draw is ``plain_from`` of 100 or more. The draws
    follow from the id alone, so repeated rows come out alike; a null id draws
    as an empty one. An empty table gives an empty result; columns beyond id and
    text are ignored. Texts of any length pass, at about three times their size
    in memory for the longest.
    """
    key = F.col(ident).cast("long")
    rows = docs.select(
        key.alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *[h.alias(f"h{k}") for k, h in enumerate(draws_of(key, seed), 1)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = np.stack([batch.column(f"h{k}").to_numpy() for k in range(1, 5)])
            for low, high, data, bounds in _chunks(batch.column("text")):
                out, ends, n, form, chars = cut(data, bounds, draws[:, low:high], plain_from, spm_below)
                prefix, middle = (pa.array(c, mask=c < 0) for c in chars.T)
                ids = batch.column("doc_id").slice(low, high - low)
                columns = [ids, pa.array(n), pa.array(form.tolist(), pa.string()), prefix, middle, _strings(out, ends)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COLUMNS.split(", ")])

    return rows.mapInArrow(run, COLUMNS)


def restore(cut_docs: DataFrame) -> DataFrame:
    """``transform``'s rows with ``restored``, the text rebuilt from output and form alone."""
    schema = cut_docs.select("*", F.lit("").alias("restored")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = np.array([f == PLAIN for f in batch.column("form").to_pylist()], bool)
            for low, high, data, bounds in _chunks(batch.column("output")):
                texts = _strings(*uncut(data, bounds, plain[low:high]))
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, texts], [*batch.schema.names, "restored"])

    return cut_docs.mapInArrow(run, schema)
