"""Main text of web pages by a host suffix array, helped by the page's own marks.

What several distinct pages of a host have outside their articles is boilerplate. The
pages of a host that a task reads are cut into chunks; the words of all blocks of a chunk
form one stream, and its suffix array, sorted as deep as the shortest repeat of interest,
puts equal substrings side by side. That combines the substrings of a chunk; those of
all chunks are then counted by host, and the repeated ones go back to the chunks that
have them. The words that they cover are removed, unique runs stay, also within a block.

Repeats judge every block outside an ``article``, on every page. Of what they leave, the
elements that name their role (menus, footers, class names of adverts or comments, ...)
go by these marks: a page's own advert or a reader's comment is no repeat. Blocks inside an
``article`` are kept even where pages share them, for copies of an article are still
articles, and what stands in an article makes no boilerplate of its copy elsewhere. A page
is never emptied by repeats alone. The result counts what each of the two took.
"""

from __future__ import annotations

import hashlib
import html
import json
import random
import re
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm.common import stored

#: Words of the shortest repeat, a power of two.
REPEAT = 8
#: Distinct pages that make a repeat boilerplate.
PAGES = 3
#: Characters of html in one chunk, if a page is not longer; no result depends on it.
CHUNK = 2 << 20

# Elements and the roles they have in HTML.
RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|title|canvas|audio|video"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: Elements whose end may be left out; the next of their kind, for ``p`` any block, closes them.
CLOSED_BY_NEXT = set("p li dd dt tr td th option".split())
DROPPED = set("nav footer aside form head menu dialog search button".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe signup sidebar sidebars menu menus "
    "nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies respond "
    "related recommended recommendations share sharing social widget widgets toolbar pagination pager login search "
    "skip".split()
)
#: Of these, only names of this kind count on an article.
REMARKS = set("comment comments reply replies".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

OUT, PLAIN, MAIN, ARTICLE = range(4)


def _zone(tag: str, rest: str, above: int) -> int:
    """What an element's text counts as, inside one that counts as ``above``."""
    if above == OUT or tag in DROPPED or tag == "header" and above < ARTICLE:
        return OUT
    names = {}
    if rest.strip():
        names = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
    if "hidden" in names or names.get("role", "").lower() in ROLES:
        return OUT
    if tag not in ("html", "body", "main"):
        parts = {p.lower() for k in ("class", "id") for p in _PART.findall(names.get(k, ""))}
        if parts & (REMARKS if tag == "article" or tag == "header" else NAMES):
            return OUT
    if tag == "article":
        return ARTICLE
    if tag == "main" or names.get("role") == "main":
        return max(above, MAIN)
    return above


def blocks(page: str | None) -> list[tuple[int, str]]:
    """Zone and text of each block, in page order. White space is one space, ends trimmed."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    zone, parts, at = PLAIN, [], 0
    page = page or ""

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((zone, text))
        parts.clear()

    for token in _TOKEN.finditer(page):
        parts.append(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK
        if block:
            close()
            if not token["end"] and stack and stack[-1][0] in CLOSED_BY_NEXT and (tag == stack[-1][0] or stack[-1][0] == "p"):
                stack.pop()
                zone = stack[-1][1] if stack else PLAIN
        if token["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if not block and stack[depth][1] != (stack[depth - 1][1] if depth else PLAIN):
                        close()
                    del stack[depth:]
                    zone = stack[-1][1] if stack else PLAIN
                    break
        elif tag not in VOID and tag not in ("p", "b", "i", "em", "strong", "a", "li") or token["rest"].strip():
            if tag in VOID or token["rest"].endswith("/"):
                continue
            inner = _zone(tag, token["rest"], zone)
            if not block and inner != zone:
                close()
            if block or inner != zone:
                stack.append((tag, inner))
                zone = inner
    parts.append(page[at:])
    close()
    return out


def _ranks(streams: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank and page of each suffix; equal ranks are suffixes that share ``depth`` words.

    The suffix array is built by prefix doubling. A word of its own ends each page.
    """
    words = max((int(s.max()) for s in streams if len(s)), default=0) + 1
    rank = np.concatenate([np.append(s, words + n) for n, s in enumerate(streams)]).astype(np.int64)
    length = 1
    while length < depth:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-length] = rank[length:] + 1
        rank = np.unique(rank * (len(rank) + words + 1) + ahead, return_inverse=True)[1]
        length *= 2
    return rank, np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])


def _first_places(rank: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """One suffix of each rank and page content, in the order of the suffix array."""
    order = np.lexsort((owner, rank))
    ranks, owners = rank[order], owner[order]
    new = np.concatenate(([True], (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1])))
    return order[new[: len(order)]]


def _spread(starts: np.ndarray, depth: int) -> np.ndarray:
    """The words that ``depth`` words from a start reach."""
    edges = np.zeros(len(starts) + depth + 1, np.int64)
    np.add.at(edges, np.flatnonzero(starts), 1)
    np.add.at(edges, np.flatnonzero(starts) + depth, -1)
    return np.cumsum(edges)[: len(starts)] > 0


def _by_page(flat: np.ndarray, streams: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([len(s) + 1 for s in streams])
    return [part[:-1] for part in np.split(flat, ends[:-1])]


def _touching(judged: list[np.ndarray], depth: int) -> np.ndarray:
    """The suffixes with a judged word among their first ``depth``; a word of its own ends each page."""
    flat = np.concatenate([np.append(j, False) for j in judged]) if judged else np.zeros(0, bool)
    reach = np.concatenate(([0], np.cumsum(flat), np.full(depth, flat.sum())))
    return reach[depth : depth + len(flat)] > reach[: len(flat)]


def repeated(
    streams: list[np.ndarray],
    same: np.ndarray,
    depth: int = REPEAT,
    pages: int = PAGES,
    judged: list[np.ndarray] | None = None,
) -> list[np.ndarray]:
    """Which words of each page lie in a substring of ``depth`` words that ``pages`` distinct pages have.

    ``same`` numbers the pages by content; copies count once. With ``judged`` a page
    counts where a word of the substring is judged in it.
    """
    rank, page = _ranks(streams, depth)
    at = np.arange(len(rank)) if judged is None else np.flatnonzero(_touching(judged, depth))
    first = at[_first_places(rank[at], same[page[at]])]
    distinct = np.bincount(rank[first], minlength=len(rank))
    return _by_page(_spread(distinct[rank] >= pages, depth), streams)


Page = list[tuple[int, str]]


def _judged(page: Page) -> np.ndarray:
    """The words that repeats judge: all outside articles."""
    sizes = [text.count(" ") + 1 for _, text in page]
    return np.repeat(np.array([zone != ARTICLE for zone, _ in page], bool), sizes)


def _unique(text: str, mask: np.ndarray, depth: int = REPEAT) -> str:
    """A block without its repeated words; those that stay are in order.

    Repeats go on from block to block. One that has less than ``depth`` words here
    and not all of the block only reaches in from the next one, and takes nothing.
    """
    if mask.all():
        return ""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))).reshape(-1, 2)
    words, at, left = text.split(" "), 0, []
    for start, end in edges[edges[:, 1] - edges[:, 0] >= depth].tolist():
        left += words[at:start]
        at = end
    return " ".join(left + words[at:])


def _text(page: Page, mask: np.ndarray, depth: int = REPEAT) -> tuple[str, int, int]:
    """Main text of a page of whose judged words ``mask`` are repeats, and the words that repeats and marks took.

    Where repeats leave nothing, the blocks in ``main`` stay, or all if there are none.
    """
    kept, at, repeats, marked, lost = [], 0, 0, 0, 0
    for zone, text in page:
        words = text.count(" ") + 1
        if zone == ARTICLE:
            kept.append(text)
            continue
        if zone == OUT:
            gone = int(mask[at : at + words].sum())
            repeats, marked = repeats + gone, marked + words - gone
        else:
            left = _unique(text, mask[at : at + words], depth)
            lost += words - (left.count(" ") + 1 if left else 0)
            if left:
                kept.append(left)
        at += words
    if kept:
        return "\n".join(kept), repeats + lost, marked
    top = MAIN if any(zone == MAIN for zone, _ in page) else PLAIN
    under = sum(text.count(" ") + 1 for zone, text in page if OUT < zone < top)
    return "\n".join([text for zone, text in page if zone >= top]), repeats + under, marked


def _near(page: Page, depth: int) -> Iterator[tuple[list[str], list[bool]]]:
    """Words that share ``depth`` words with a judged one, in unbroken pieces, and which of them are judged.

    What lies deeper in an article is in no run of interest.
    """
    words: list[str] = []
    judged: list[bool] = []
    for article, group in groupby(page, lambda block: block[0] == ARTICLE):
        text = " ".join([t for _, t in group])
        head = text.split(" ", depth - 1) if article else text.split(" ")
        tail = head.pop().rsplit(" ", depth - 1) if article and len(head) == depth else []
        words += head
        judged += [not article] * len(head)
        if len(tail) == depth:
            yield words, judged
            words, judged, tail = [], [], tail[1:]
        words += tail
        judged += [False] * len(tail)
    yield words, judged


class Words:
    """The pieces of a host's pages near judged words, as word numbers, with the page of each."""

    def __init__(self, pages: list[Page], depth: int = REPEAT):
        ids: dict[str, int] = {}
        pieces = [(n, *piece) for n, page in enumerate(pages) for piece in _near(page, depth)]
        self.depth, self.words = depth, ids
        self.streams = [np.array([ids.setdefault(w, len(ids)) for w in words], np.int64) for _, words, _ in pieces]
        self.judged = [np.array(judged, bool) for _, _, judged in pieces]
        self.page = np.array([n for n, _, _ in pieces], np.int64)
        whole = np.concatenate([np.arange(len(s), -1, -1) >= depth for s in self.streams])
        #: The places with a whole run ahead that touches a judged word.
        self.at = np.flatnonzero(whole & _touching(self.judged, depth))

    def keys(self, host: str) -> np.ndarray:
        """128 bits, in two columns, of the host and the run from each place."""
        flat = np.concatenate([np.append(s, -1) for s in self.streams])
        used, run = np.unique(flat[self.at[:, None] + np.arange(self.depth)], return_inverse=True)
        names = list(self.words)
        digests = np.array([_digest(names[n]) for n in used.tolist()], np.uint64).reshape(-1, 2)
        run = run.reshape(-1, self.depth)
        out = np.tile(np.array(_digest("//" + host), np.uint64) * _FACTORS[self.depth], (len(self.at), 1))
        for k in range(self.depth):
            out += digests[run[:, k]] * _FACTORS[k]
        return out.view(np.int64)


# Odd, so that no bit of a word's digest is lost.
_FACTORS = np.random.default_rng(8).integers(1 << 62, 1 << 63, (REPEAT + 1, 2), np.uint64) | np.uint64(1)


def _digest(text: str) -> tuple[int, int]:
    bits = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(bits[:8], "little"), int.from_bytes(bits[8:], "little")


def runs(host: str, pages: list[Page], depth: int = REPEAT, least: int = PAGES) -> pd.DataFrame:
    """The runs of ``depth`` words with a judged one among them: a row for each and each distinct page.

    The suffix array combines them: one that ``least`` pages have is one row
    without ``content``.
    """
    words = Words(pages, depth)
    texts = (" ".join([t for _, t in page]) for page in pages)
    content = np.array([_digest(t)[0] for t in texts], np.uint64).view(np.int64)
    rank, piece = _ranks(words.streams, depth)
    page, at = words.page[piece], words.at
    order = _first_places(rank[at], content[page[at]])
    first = at[order]
    distinct = np.bincount(rank[first], minlength=len(rank))
    many = distinct[rank[first]] >= least
    one = np.concatenate(([True], rank[first][1:] != rank[first][:-1])) if len(first) else many
    first, order, many = first[~many | one], order[~many | one], many[~many | one]
    keys = words.keys(host)[order]
    return pd.DataFrame(
        {
            "key_1": keys[:, 0],
            "key_2": keys[:, 1],
            "content": pd.Series(content[page[first]], dtype="Int64").mask(many),
        }
    )


def _covered(host: str, pages: list[Page], key_1: np.ndarray, key_2: np.ndarray, depth: int = REPEAT) -> list[np.ndarray]:
    """Which judged words of each page lie in one of the runs."""
    words = Words(pages, depth)
    want = set(zip(key_1.tolist(), key_2.tolist(), strict=True))
    hit = [(a, b) in want for a, b in words.keys(host).tolist()]
    starts = np.zeros(sum(len(s) + 1 for s in words.streams), bool)
    starts[words.at[np.array(hit, bool)]] = True
    masks: list[list[np.ndarray]] = [[] for _ in pages]
    for n, mask, judged in zip(words.page.tolist(), _by_page(_spread(starts, depth), words.streams), words.judged, strict=True):
        masks[n].append(mask[judged])
    return [np.concatenate(m) for m in masks]


def main_texts(pages: list[str | None], repeat: int = REPEAT, least: int = PAGES) -> list[str]:
    """Main texts of pages of one host."""
    cut = [blocks(p) for p in pages]
    ids: dict[str, int] = {}
    streams = [np.array([ids.setdefault(w, len(ids)) for _, t in page for w in t.split(" ")], np.int64) for page in cut]
    contents: dict[bytes, int] = {}
    same = np.array([contents.setdefault(s.tobytes(), len(contents)) for s in streams])
    judged = [_judged(page) for page in cut]
    masks = repeated(streams, same, repeat, least, judged)
    return [_text(page, mask[j], repeat)[0] for page, mask, j in zip(cut, masks, judged, strict=True)]


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def _pack(rows: list[tuple[str | None, str | None, Page]]) -> bytes:
    return zstandard.compress(json.dumps(rows, ensure_ascii=False).encode("utf-8", "surrogatepass"), 6)


def _unpack(body: bytes) -> list[tuple[str | None, str | None, Page]]:
    return json.loads(zstandard.decompress(body).decode("utf-8", "surrogatepass"))


def _result(rows: list[tuple[str | None, str | None, Page]], found: list[tuple[str, int, int]]) -> pd.DataFrame:
    texts = [text for text, _, _ in found]
    return pd.DataFrame(
        {
            "page_id": pd.array([None if i is None else int(i) for i, _, _ in rows], "Int64"),
            "url": [url for _, url, _ in rows],
            "text": texts,
            "n_chars": [len(t) for t in texts],
            "repeat_words": [n for _, n, _ in found],
            "marked_words": [n for _, _, n in found],
        }
    )


RESULT = "page_id long, url string, text string, n_chars long, repeat_words long, marked_words long"
READ = "part long, host string, body binary"
RUNS = "part long, key_1 long, key_2 long, content long"


def _read(pages: DataFrame, chunk: int) -> DataFrame:
    """The blocks of pages of a host that one task read, up to a chunk, compressed together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple]] = {}
        sizes: dict[str, int] = {}
        part = random.SystemRandom()

        def done(hosts: list[str]) -> pd.DataFrame:
            out = [(part.getrandbits(63), host, _pack(held.pop(host))) for host in hosts]
            for host in hosts:
                del sizes[host]
            return pd.DataFrame(out, columns=["part", "host", "body"])

        for batch in batches:
            for page_id, url, page in batch.itertuples(index=False, name=None):
                host = _host(url)
                size = len(page or "")
                if host in held and sizes[host] + size > chunk:
                    yield done([host])
                held.setdefault(host, []).append((page_id, url, blocks(page)))
                sizes[host] = sizes.get(host, 0) + size
                if sum(sizes.values()) > 8 * chunk:
                    yield done(list(held))
        if held:
            yield done(list(held))

    return pages.select(F.col("page_id").cast("string"), "url", "html").mapInPandas(run, READ)


def _all_runs(read: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, host, body in batch.itertuples(index=False, name=None):
                yield runs(host, [page for _, _, page in _unpack(body)]).assign(part=part)

    return read.mapInPandas(run, RUNS)


def extract(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars, repeat_words, marked_words``.

    The last two count the words left out because they repeat, and by marks alone.

    A null or empty html has an empty text; a null or broken url belongs to the
    host without a name. Broken markup is read as far as it goes. Repeated rows
    each get the result and count once among distinct pages. Repeats are counted over
    all pages of a host, wherever they are read: each chunk combines its runs of
    words by a suffix array, and runs of all chunks meet by 128 bits of host and
    words, at most two rows a chunk for each. An empty table gives an empty result. Columns beyond ``page_id, url, html`` are ignored.
    """

    def judged(key: tuple, chunk: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        rows = _unpack(chunk["body"].iloc[0])
        cut = [page for _, _, page in rows]
        masks = _covered(chunk["host"].iloc[0], cut, hits["key_1"].to_numpy(), hits["key_2"].to_numpy())
        return _result(rows, [_text(page, mask) for page, mask in zip(cut, masks, strict=True)])

    read = stored(_read(pages, chunk), "blocks")
    run = Window.partitionBy("key_1", "key_2")
    content = F.col("content")
    seen = _all_runs(read).withColumn("nth", F.dense_rank().over(run.orderBy("content")))
    pages_of = F.max("nth").over(run)  # without the null of a run that one chunk has often enough
    hits = (
        seen.withColumns({"pages": pages_of, "many": F.max(content.isNull()).over(run)})
        .where(F.col("many") | (F.col("pages") >= PAGES))
        .select("part", "key_1", "key_2")
    )
    return read.groupBy("part").cogroup(hits.groupBy("part")).applyInPandas(judged, RESULT)
