"""WARC archives with a two-level capture index.

Records go into gzip members of archive files. The index sorts captures by
reversed-host key into compressed blocks; a sparse directory holds the first
key and the place of each block. A search is a binary search in the directory,
one range read of the block, a binary search in it, and one range read of the
record. Archives and blocks are read and written on the executors through
``pyarrow.fs``, so the shared folder may be in any store that it knows. Every
file has a name of its own and is listed in a table that Spark commits; a file
of a lost task is never listed.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm.common import stored
from adtrail.session import work_folder

#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000
#: Bytes after which a task begins a new archive file.
ARCHIVE_BYTES = 256 << 20
#: Captures of an index block, more where the directory would pass ``MAX_BLOCKS``.
BLOCK_LINES = 512
MAX_BLOCKS = 1 << 16
#: Groups a hot payload is dealt into.
SALTS = 16
DATE = "2000-01-01T00:00:00Z"

# Names of the WARC format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID = "urn:x-page:"
NO_ID = -(1 << 63)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def surt(url: str | None) -> str:
    """Key of a URL: host parts reversed, then path and query; the fragment is left out."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0]
    host, mark, tail = re.match(r"([^/?]*)([/?]?)(.*)", rest, re.S).groups()
    host, _, port = host.rpartition("@")[2].lower().partition(":")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{key}){'/' if mark != '/' else ''}{mark}{tail}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


@dataclass
class Capture:
    """A record read back."""

    page_id: int | None
    url: str | None
    record_type: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    refers_to: int | None


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _page(value: str | None) -> int | None:
    digits = (value or "").strip("<>").removeprefix(ID)
    return int(digits) if digits else None


def read_record(raw: bytes) -> Capture:
    """Parse one record; a response's length and digest are those of its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    if kind == "revisit":
        size = int(_fields(http)["content-length"])
        digest, found = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(), None
    else:
        size, digest, found = len(payload), hashlib.sha1(payload).hexdigest(), payload
    return Capture(
        _page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, found, size, digest,
        _page(fields.get("warc-refers-to")),
    )


def _zipped(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _unzipped(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


class _Output:
    """Appends compressed members to files of one task."""

    def __init__(self, folder: str, kind: str, most: int):
        self.store, self.path = arrow_fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.path, recursive=True)
        self.kind, self.most, self.file, self.name, self.size = kind, most, None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.file is None or self.size >= self.most:
            self.close()
            self.name, self.size = f"{uuid.uuid4().hex}.{self.kind}.gz", 0
            self.file = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
        member = _zipped(data)
        self.file.write(member)
        self.size += len(member)
        return self.name, self.size - len(member), len(member)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


class _Input:
    """Range reads; the last file stays open."""

    def __init__(self, folder: str):
        self.store, self.path = arrow_fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.path}/{name}")
        self.file.seek(offset)
        return _unzipped(self.file.read(length))


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def with_roles(pages: DataFrame, least: int = REVISIT_BYTES, salts: int = SALTS) -> DataFrame:
    """``pages`` with ``keep_id``: the largest page of those with an equal payload, null for small ones.

    Payloads are equal when their SHA-256 and length are. Groups are combined by
    salt first, so a payload that most pages share is nobody's single group. Small
    payloads have no partner; a salt of their own deals them evenly, however many are equal.
    """
    size, by_page = F.octet_length(F.coalesce("html", F.lit(""))), F.xxhash64("page_id")
    alone = (-1 - F.pmod(by_page, F.lit(1 << 30))).cast("int")
    keyed = pages.select("page_id", "url", "html").withColumns(
        {
            "sha": F.when(size >= least, F.sha2(_payload(F.col("html")), 256)).otherwise(""),
            "bytes": size,
            "salt": F.when(size >= least, F.pmod(by_page, F.lit(salts)).cast("int")).otherwise(alone),
        }
    )
    key = ["sha", "bytes"]
    salted = keyed.where(F.col("bytes") >= least).groupBy(*key, "salt").agg(F.max("page_id").alias("most"))
    together = salted.withColumn("keep_id", F.max("most").over(Window.partitionBy(*key))).drop("most")
    return keyed.join(stored(together, "warc-roles"), [*key, "salt"], "left")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages (page_id, url, html, keep_id)``; where each went.

    ``surt, page_id, file, offset, length``. A page other than ``keep_id`` is a
    revisit of it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        output = _Output(folder, "warc", archive_bytes)
        for batch in batches:
            out = []
            for page_id, url, html, keep_id in zip(*(batch[c] for c in batch.columns), strict=True):
                page, keep = (None if pd.isna(x) else int(x) for x in (page_id, keep_id))
                payload = html.encode("utf-8", "surrogatepass") if html else b""
                place = output.add(record(page, url, payload, keep, keep is not None and page != keep))
                out.append((surt(url), NO_ID if page is None else page, *place))
            yield pd.DataFrame(out, columns=["surt", "page_id", "file", "offset", "length"])
        output.close()

    wanted = pages.select(F.col("page_id").cast("string"), "url", "html", F.col("keep_id").cast("string"))
    return stored(wanted.mapInPandas(run, "surt string, page_id long, file string, offset long, length long"), "warc-captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write sorted captures as compressed blocks; the directory, a row per block.

    ``surt, page_id`` (of the block's first capture)``, file, offset, length``.
    The directory has at most ``MAX_BLOCKS`` blocks and one for each task.
    """
    lines = max(block_lines, -(-captures.count() // MAX_BLOCKS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        output, held = _Output(folder, "cdx", ARCHIVE_BYTES), []

        def block(rows: list[tuple]) -> tuple:
            return (*rows[0][:2], *output.add("\n".join(map(json.dumps, rows)).encode()))

        for batch in batches:
            held += batch.itertuples(index=False, name=None)
            out = []
            while len(held) >= lines:
                out.append(block(held[:lines]))
                held = held[lines:]
            yield pd.DataFrame(out, columns=["surt", "page_id", "file", "offset", "length"])
        if held:
            yield pd.DataFrame([block(held)], columns=["surt", "page_id", "file", "offset", "length"])
        output.close()

    order = ["surt", "page_id", "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.mapInPandas(run, captures.schema), "warc-directory")


def search(wanted: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures of the keys ``wanted (surt, page_id)``: ``surt, page_id, file, offset, length``.

    A null ``page_id`` asks for all captures of the key. The directory is
    bounded (see ``build_index``) and goes to every task; blocks are read where their searches meet.
    """
    marks = sorted(tuple(row) for row in directory.select("surt", "page_id", "file", "offset", "length").collect())
    firsts = [m[:2] for m in marks]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, low, high in batch.itertuples(index=False, name=None):
                begin = max(0, bisect.bisect_left(firsts, (key, low)) - 1)
                out += [(key, low, high, n) for n in range(begin, bisect.bisect_right(firsts, (key, high)))]
            yield pd.DataFrame(out, columns=["surt", "low", "high", "block"])

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, now, rows, keys = _Input(folder), None, [], []
        for batch in batches:
            out = []
            for key, low, high, block in batch.itertuples(index=False, name=None):
                if block != now:
                    now = block
                    rows = [json.loads(x) for x in source.read(*marks[block][2:]).decode().split("\n")]
                    keys = [(r[0], r[1]) for r in rows]
                out += rows[bisect.bisect_left(keys, (key, low)) : bisect.bisect_right(keys, (key, high))]
            yield pd.DataFrame(out, columns=["surt", "page_id", "file", "offset", "length"])

    span = wanted.select(
        "surt", F.coalesce("page_id", F.lit(NO_ID)).alias("low"), F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("high")
    )
    met = span.mapInPandas(blocks, "surt string, low long, high long, block int")
    met = met.repartition("block").sortWithinPartitions("block")
    return met.mapInPandas(lines, "surt string, page_id long, file string, offset long, length long")


def fetch(captures: DataFrame, folder: str, near: int = 1 << 20, task_bytes: int = 64 << 20) -> DataFrame:
    """Read records back: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    Places of a file within ``near`` bytes are read by one task, in order. The number
    of tasks follows the bytes of the records: those of their places say nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = _Input(folder)
        for batch in batches:
            got = [read_record(source.read(*row)) for row in batch.itertuples(index=False, name=None)]
            yield pd.DataFrame(
                {
                    "page_id": pd.array([c.page_id for c in got], "Int64"),
                    "url": [c.url for c in got],
                    "payload_bytes": [c.payload_bytes for c in got],
                    "payload_digest": [c.payload_digest for c in got],
                    "record_type": [c.record_type for c in got],
                    "refers_to": pd.array([c.refers_to for c in got], "Int64"),
                }
            )

    spark = captures.sparkSession
    places = stored(captures.select("file", "offset", "length"), "warc-places")
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))
    part = F.floor(F.col("offset") / near)
    rows = places.repartition(tasks, "file", part).sortWithinPartitions("file", "offset")
    return rows.mapInPandas(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Archive all ``pages``, index the captures, look each page up and read it back.

    One row per row of ``pages``. A null html is an empty payload; a null url
    has the key of an empty one; a null page id is written without one, never
    wins a group and is a revisit of the group's largest id if there is one. Rows
    that repeat a page id each have a record; those that also repeat the payload
    that stays are both responses. An empty table gives an empty result.
    Columns beyond ``page_id, url, html`` are ignored.
    """

    @F.pandas_udf("string")
    def keys(urls: pd.Series) -> pd.Series:
        return pd.Series([surt(u) for u in urls], dtype=object)

    folder = work_folder(pages.sparkSession, "warc")
    captures = write_archives(with_roles(pages, least), folder, archive_bytes)
    directory = build_index(captures, folder, block_lines)
    wanted = pages.select(keys(F.col("url")).alias("surt"), F.coalesce("page_id", F.lit(NO_ID)).cast("long").alias("page_id"))
    return fetch(search(wanted.distinct(), directory, folder), folder)
