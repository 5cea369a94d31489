import hashlib

from adtrail.llm import warc
from adtrail.session import work_folder
from tests.llm.conftest import rows_of

PAGES = "page_id long, url string, html string, offset int, surt string"
BIG = "<p>ä" * 600


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES)


ROWS = [
    (1, "http://a.example.org/x", BIG),
    (2, "http://a.example.org/x", BIG),
    (9, None, BIG),
    (3, "HTTPS://User@B.example.org:8080?q#f", "small"),
    (4, "http://b.example.org/", "small"),
    (5, "no url\r\nX: y", None),
    (6, "", ""),
    (None, "http://c.example.org", BIG),
    (7, "http://d.example.org/a b", "\r\n\r\nWARC/1.1\r\n\r\n" * 99),
    (7, "http://d.example.org/a b", "\r\n\r\nWARC/1.1\r\n\r\n" * 99),
    (8, "http://[broken", "x" * 300_000),
]


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = len(data) >= 1000 and page != max(ids)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    for sizes in ({}, {"archive_bytes": 200, "block_lines": 2}):
        assert rows_of(warc.round_trip(pages(spark, ROWS), **sizes).drop("url")) == expected(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_search_by_key(spark):
    folder = work_folder(spark, "warc-test")
    many = [(n, f"http://h{n % 9}.example.org/p{n % 40}", f"body {n}") for n in range(400)]
    captures = warc.write_archives(warc.with_roles(pages(spark, many)), folder)
    directory = warc.build_index(captures, folder, block_lines=7)
    assert directory.count() >= 400 / 7
    key = warc.surt("http://h3.example.org/p12")
    wanted = spark.createDataFrame([(key, None), ("org,nowhere)/", None)], "surt string, page_id long")
    found = warc.fetch(warc.search(wanted, directory, folder), folder)
    assert sorted(r["page_id"] for r in found.collect()) == [n for n, u, _ in many if warc.surt(u) == key]


def test_keys():
    assert warc.surt("http://www.Example.org/A?b#c") == "org,example,www)/A?b"
    assert warc.surt("https://u:p@x.org:81?q") == "org,x:81)/?q"
    assert warc.surt(None) == ")/"


def test_record_reads_back():
    raw = warc.record(5, "http://x.org/", b"data", 9, revisit=True)
    got = warc.read_record(raw)
    assert (got.page_id, got.record_type, got.payload, got.payload_bytes, got.refers_to) == (5, "revisit", None, 4, 9)
    assert got.payload_digest == hashlib.sha1(b"data").hexdigest()
