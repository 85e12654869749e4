"""Main text of web pages, with a suffix array over the pages of a host.

A page is read into blocks. Elements and classes that say menu, header, footer, advert and
the like are dropped; what is left lies inside an article or main element, or outside of
any. The token streams of all pages of a host are then searched for substrings that occur on
distinct pages, and that decides which container is the main text of a page and what stays of
one that nothing marks (see ``main_text``).

Hosts may be of any size, so their pages are dealt to parts of bounded size, each with one
suffix array. Where the arrays of different parts meet, the distinct prefixes of their suffixes
are exchanged by ranges of their hash, first by a few bits, then whole for those that met: a
prefix that occurs in two parts is repeated whichever part it is in.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import written
from tidegauge.session import shared_folder

#: Tokens of the shortest repeated substring that counts as boilerplate; a power of two.
REPEAT_TOKENS = 8
#: Pages and tokens of a part, over which one suffix array is built. What is found does not
#: depend on them.
HOST_PAGES = 4096
PART_TOKENS = 1_000_000
#: Prefixes, on average, that one range of their hashes holds when they are exchanged.
RANGE_PREFIXES = 1 << 20

# Names of HTML elements and usual class words.
RAW = {"script", "style", "textarea", "title"}
DROPPED = set(
    "script style noscript template iframe object svg canvas head title nav footer aside form "
    "button select textarea menu dialog".split()
)
MAIN = {"article", "main"}
BREAKS = set(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLASS_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header menu modal nav navbar navigation newsletter notice notices popup promo "
    "related share sharing sidebar social sponsor sponsored subscribe toolbar".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_RAW_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HINT_WORDS = re.compile(r"[a-z]+")


def _says_boilerplate(attributes: str) -> bool:
    for found in _HINTS.findall(attributes):
        if not CLASS_WORDS.isdisjoint(_HINT_WORDS.findall("".join(found).lower())):
            return True
    return False


def blocks_of(html: str) -> list[tuple[bool, str]]:
    """The text blocks of a page that are not dropped outright, in page order, as (inside
    a main element, text with single spaces). Missing end tags are borne: an end tag
    closes all that is open inside its element, a stray one nothing, and a main element
    ends an element that was dropped for its class and never closed."""
    out: list[tuple[bool, str]] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # name, dropped, main
    drops = mains = 0

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((mains > 0, text))
            held.clear()

    def close(depth: int) -> None:
        nonlocal drops, mains
        for _, dropped, main in open_[depth:]:
            drops -= dropped
            mains -= main
        del open_[depth:]

    at = 0
    while tag := _MARKUP.search(html, at):
        if not drops and tag.start() > at:
            text = html[at : tag.start()]
            held.append(unescape(text) if "&" in text else text)
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if name in BREAKS:
            flush()
        if tag[1]:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    close(depth)
                    break
            continue
        if name in VOID or tag[3].endswith("/"):
            continue
        hinted = bool(tag[3]) and _says_boilerplate(tag[3])
        main = name in MAIN and not hinted
        if main and drops and not any(n in DROPPED for n, d, _ in open_ if d):
            first = next(k for k, x in enumerate(open_) if x[1])
            close(first)
        if name == "p" and open_ and open_[-1][0] == "p":
            close(len(open_) - 1)
        # A header inside the main text is the heading of that text.
        dropped = name in DROPPED or (name == "header" and not mains) or (
            hinted and name not in ("html", "body")
        )
        open_.append((name, dropped, main))
        drops += dropped
        mains += main
        if name in RAW:
            # Nothing inside is markup: go straight to the end tag.
            last = _RAW_ENDS[name].search(html, at)
            at = last.start() if last else len(html)
    if not drops and at < len(html):
        held.append(unescape(html[at:]))
    flush()
    return out


def suffixes_by_prefix(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``tokens`` in the order of their first ``least`` tokens, and where in it
    each group of suffixes begins that have these in common."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < least:
        ahead = np.zeros(len(rank), np.int64)
        ahead[: len(rank) - width] = rank[width:] + 1
        rank = np.unique(rank << 32 | ahead, return_inverse=True)[1]
        width *= 2
    suffixes = np.argsort(rank, kind="stable")
    ordered = rank[suffixes]
    return suffixes, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def _spread(starts: np.ndarray, n: int, least: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a substring of ``least`` tokens that begins at ``starts``."""
    change = np.zeros(n + least + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + least, -1)
    return np.cumsum(change)[:n] > 0


def covered_tokens(streams: list[list[str]], least: int = REPEAT_TOKENS) -> list[np.ndarray]:
    """For each stream, which of its tokens lie in a substring of ``least`` tokens or more
    that occurs in another, different stream. Equal streams count as one."""
    numbers: dict = {}
    shown: dict[tuple, int] = {}
    page, tokens, begin = [], [], []
    at = 0
    for k, stream in enumerate(streams):
        own = shown.setdefault(tuple(stream), k)
        begin.append(at)
        tokens += [numbers.setdefault(t, len(numbers)) for t in stream]
        tokens.append(-1 - k)  # a separator that occurs once
        page += [own] * (len(stream) + 1)
        at += len(stream) + 1
    n = len(tokens)
    hit = np.zeros(n, bool)
    if n > least:
        suffixes, edge = suffixes_by_prefix(np.array(tokens), least)
        pages = np.array(page)[suffixes]
        low, high = np.minimum.reduceat(pages, edge), np.maximum.reduceat(pages, edge)
        shared = np.repeat(low != high, np.diff(np.append(edge, n)))
        hit = _spread(suffixes[shared], n, least)
    return [hit[b : b + len(s)] for b, s in zip(begin, streams, strict=True)]


def unique_text(blocks: list[str], covered: np.ndarray) -> str:
    """The tokens of the blocks that are not covered, joined by one space."""
    tokens = [t for b in blocks for t in b.split()]
    return " ".join(t for t, c in zip(tokens, covered, strict=True) if not c)


def main_text(main: list[str], other: list[str], in_main: np.ndarray, in_other: np.ndarray) -> str:
    """The main text of a page, from its blocks inside (``main``) and outside (``other``) of
    marked elements and which of their tokens other pages of the host have too.

    Of a page that marks nothing, the unique tokens. A marked element is the main text, whole, as
    an article may quote others or stand on several pages; unless all of it is repeated and more
    unique tokens stand outside of it than it has in all: then it is a notice of the host.
    """
    if main and (not in_main.all() or (~in_other).sum() <= len(in_main)):
        return " ".join(main)
    return unique_text(other, in_other)


class _Part:
    """The token streams of the pages of a part, two to a page, and their prefixes: the places
    (``starts``) of all substrings of ``REPEAT_TOKENS`` tokens, the page (``owner``) and 64 bits
    of hash (``hashes``) of each. Tokens are known by 64 bits of hash, with the host in it. Pages
    of ``followers`` are copies of another page of the host; their owner is -1.
    """

    def __init__(self, pages: list[dict], followers: list[int] | None):
        self.pages = pages
        copies = set(followers or ())
        named = xxhash.xxh3_64_intdigest
        tokens = array("Q")
        ends, owner = [], []
        for k, page in enumerate(pages):
            host = named(page["host"])
            for blocks in (page["main"], page["other"]):
                for block in blocks:
                    tokens.extend([named(token, host) for token in block.split()])
                tokens.append(named(f"\0{len(ends)}"))  # a separator that occurs once
                ends.append(len(tokens))
                owner.append(-1 if k in copies else k)
        self.tokens = np.array(tokens)
        self.ends = np.array(ends, np.int64)
        n = len(tokens)
        sizes = np.diff(np.append(0, self.ends))
        left = np.repeat(self.ends, sizes) - np.arange(n)  # tokens to the end, separator included
        self.starts = np.flatnonzero(left > REPEAT_TOKENS)
        self.owner = np.repeat(np.array(owner, np.int64), sizes)[self.starts]
        many = max(n - REPEAT_TOKENS + 1, 0)
        total = np.zeros(many, np.uint64)
        for k in range(REPEAT_TOKENS):
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += self.tokens[k : k + many]
        total = total[self.starts]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            total = (total ^ (total >> np.uint64(shift))) * np.uint64(factor)
        self.hashes = total ^ (total >> np.uint64(31))

    def by_suffix_array(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each distinct prefix, and how many pages have it: 2 if more, 0 if only
        followers."""
        if not len(self.starts):
            return self.hashes, np.zeros(0, np.uint8)
        suffixes, edge = suffixes_by_prefix(self.tokens, REPEAT_TOKENS)
        place = np.full(len(self.tokens), -1)
        place[self.starts] = np.arange(len(self.starts))
        at = place[suffixes]
        weights = _weights(np.where(at < 0, -1, self.owner[at]), edge)
        # Suffixes that have the end of their stream in the prefix are groups of one.
        firsts = at[edge]
        return self.hashes[firsts[firsts >= 0]], weights[firsts >= 0]

    def met(self, bits: int, met: list[dict] | None) -> np.ndarray:
        """Which places have a prefix that met another one by its first ``bits`` bits."""
        values, inverse = np.unique(self.hashes >> np.uint64(64 - bits), return_inverse=True)
        return _unpacked(met, len(values))[inverse]

    def candidates(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct hashes at the places ``which``, the number of pages of each, up to 2, and
        its index for every such place."""
        values, inverse = np.unique(self.hashes[which], return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        edge = np.searchsorted(inverse[order], np.arange(len(values)))
        return values, _weights(self.owner[which][order], edge), inverse

    def covered(self, places: np.ndarray) -> list[np.ndarray]:
        """For each stream, which of its tokens lie in the substrings at ``places``."""
        hit = _spread(self.starts[places], len(self.tokens), REPEAT_TOKENS)
        return [h[:-1] for h in np.split(hit, self.ends[:-1])]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _weights(owner: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """How many owners each group has that begins at ``edge``: 2 if more, none counts for -1."""
    if not len(edge):
        return np.zeros(0, np.uint8)
    high = np.maximum.reduceat(owner, edge)
    low = np.minimum.reduceat(np.where(owner < 0, np.iinfo(np.int64).max, owner), edge)
    return np.where(high < 0, 0, np.where(low == high, 1, 2)).astype(np.uint8)


def _unpacked(met: list[dict] | None, n: int) -> np.ndarray:
    """The answers for ``n`` values in ascending order, from those of their ranges."""
    flags = np.zeros(n, bool)
    at = 0
    for row in sorted(met or (), key=lambda r: r["range"]):
        raw = pa.decompress(row["bits"], (row["n"] + 7) // 8, codec="zstd", asbytes=True)
        flags[at : at + row["n"]] = np.unpackbits(np.frombuffer(raw, np.uint8), count=row["n"]).astype(bool)
        at += row["n"]
    return flags


_SENT = pa.schema([("part", pa.int64()), ("range", pa.int32()), ("n", pa.int32()), ("sent", pa.binary())])


def _sent(part: int, values: np.ndarray, weights: np.ndarray, bits: int, ranges: int) -> pa.RecordBatch:
    """Distinct ``values`` of ``bits`` bits in ascending order, with their weights, as a row for
    each of the 2 ** ``ranges`` ranges they lie in: differences by planes of bytes, compressed."""
    number = (values >> np.uint64(bits - ranges)).astype(np.int64)
    edge = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(values) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(values))
    sent = []
    for a, b in zip(edge.tolist(), ends.tolist(), strict=False):
        steps = np.diff(values[a:b], prepend=np.uint64(0)).astype("<u8")
        planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + weights[a:b].tobytes()
        sent.append(pa.compress(planes, codec="zstd", asbytes=True))
    rows = [[part] * len(edge), number[edge].tolist(), (ends[: len(edge)] - edge).tolist(), sent]
    return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _SENT, strict=True)], schema=_SENT)


def _met(sent: DataFrame, purpose: str) -> DataFrame:
    """For each part, ``met``: which of the values it sent occur on two pages or more, of any part."""

    def merge(group: pa.Table) -> pa.Table:
        values, weights = [], []
        sizes = group.column("n").to_pylist()
        for n, raw in zip(sizes, group.column("sent"), strict=True):
            planes = np.frombuffer(pa.decompress(raw.as_py(), 9 * n, codec="zstd", asbytes=True), np.uint8)
            steps = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view("<u8").ravel()
            values.append(np.cumsum(steps, dtype=np.uint64))
            weights.append(planes[8 * n :])
        inverse = np.unique(np.concatenate(values), return_inverse=True)[1]
        several = np.bincount(inverse, np.concatenate(weights))[inverse] > 1
        bits = [
            pa.compress(np.packbits(s).tobytes(), codec="zstd", asbytes=True)
            for s in np.split(several, np.cumsum(sizes)[:-1])
        ]
        return group.select(["part", "range", "n"]).append_column("bits", pa.array(bits, pa.binary()))

    answers = sent.groupBy("range").applyInArrow(merge, "part long, range int, n int, bits binary")
    return written(answers, purpose).groupBy("part").agg(
        F.collect_list(F.struct("range", "n", "bits")).alias("met")
    )


def _parts(pages: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``pages`` (``id``, ``url``, ``html``, ``host``) read and dealt to parts: ``part``, ``pages``, two
    numbers ``a``, ``b`` that tell the text of each page, and ``tokens``, their number. Written by
    buckets of ``part``, so that what is joined by it moves no text."""
    most_pages, most_tokens = HOST_PAGES, PART_TOKENS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.StructArray] = []
        digests: list[bytes] = []
        tokens = 0

        def part() -> pa.RecordBatch:
            names = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            structs = pa.concat_arrays(held)
            ends = pa.array([0, len(structs)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(ends, structs),
                    pa.array([names[:, 0]], pa.list_(pa.int64())),
                    pa.array([names[:, 1]], pa.list_(pa.int64())),
                    pa.array([tokens], pa.int64()),
                ],
                ["pages", "a", "b", "tokens"],
            )

        step = min(64, most_pages)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                main, other = [], []
                for page, host in zip(rows.column(2), rows.column(3), strict=True):
                    blocks = blocks_of(page.as_py() or "")
                    main.append([t for m, t in blocks if m])
                    other.append([t for m, t in blocks if not m])
                    text = "\0".join([host.as_py(), " ".join(main[-1]), " ".join(other[-1])])
                    digests.append(xxhash.xxh3_128_digest(_bytes(text)))
                    tokens += text.count(" ") + 2
                texts = [pa.array(x, pa.list_(pa.string())) for x in (main, other)]
                held.append(
                    pa.StructArray.from_arrays(
                        [rows.column(0), rows.column(1), rows.column(3), *texts], ["id", "url", "host", "main", "other"]
                    )
                )
                if len(digests) + step > most_pages or tokens > most_tokens:
                    yield part()
                    held, digests, tokens = [], [], 0
        if held:
            yield part()

    page = f"struct<id:{kinds['id']},url:{kinds['url']},host:string,main:array<string>,other:array<string>>"
    parts = pages.mapInArrow(read, f"pages array<{page}>, a array<long>, b array<long>, tokens long")
    spark = pages.sparkSession
    name = f"html_parts_{uuid.uuid4().hex}"
    writer = parts.withColumn("part", F.monotonically_increasing_id()).write.format("parquet")
    writer = writer.option("compression", "zstd").option("path", shared_folder(spark, "html-parts"))
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").saveAsTable(name)
    return spark.table(name)


def _followers(parts: DataFrame) -> DataFrame:
    """For each part, the places of pages that are the same as an earlier one of their host."""
    each = parts.select("part", F.posexplode(F.arrays_zip("a", "b")).alias("at", "x")).select("part", "at", "x.a", "x.b")
    first = each.groupBy("a", "b").agg(F.min(F.struct("part", "at")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("a", "b", "first")
    later = each.join(first, ["a", "b"]).where(F.struct("part", "at") != F.col("first"))
    return later.groupBy("part").agg(F.collect_list("at").alias("followers"))


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``id``, ``url``, ``text`` of every page: blocks in page order, one space between.

    A null or empty page has an empty text; a null url is a host of its own. Repeated
    pages stay rows and do not make each other boilerplate; further columns are ignored;
    an empty table gives an empty result. Repeats are searched on every page, over all pages
    of its host, however many.
    """
    kinds = dict(pages.dtypes)
    named = pages.select(
        F.col(id).alias("id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:\w+:)?//([^/?#:]*)", 1)).alias("host"),
    )
    parts = _parts(named, {"id": kinds[id], "url": kinds[url]})
    total = parts.agg(F.sum("tokens")).first()[0] or 0
    # So many bits that one prefix in sixteen or fewer meets another one by chance.
    bits = min(max(total.bit_length() + 4, 24), 56)
    ranges = max((total // RANGE_PREFIXES).bit_length(), 4)
    followers = written(_followers(parts), "html-copies")
    parts = parts.select("part", "pages").join(followers, "part", "left")

    def each_part(rows: DataFrame, f: Callable, schema: str) -> DataFrame:
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    values = {c: batch.column(c)[k] for c in batch.schema.names}
                    yield f(values, _Part(values["pages"].as_py(), values["followers"].as_py()))

        return rows.mapInArrow(over, schema)

    def short(row: dict, part: _Part) -> pa.RecordBatch:
        hashes, weights = part.by_suffix_array()
        values, inverse = np.unique(hashes >> np.uint64(64 - bits), return_inverse=True)
        summed = np.minimum(np.bincount(inverse, weights, len(values)), 2).astype(np.uint8)
        return _sent(row["part"].as_py(), values, summed, bits, ranges)

    def whole(row: dict, part: _Part) -> pa.RecordBatch:
        values, weights, _ = part.candidates(part.met(bits, row["short"].as_py()))
        return _sent(row["part"].as_py(), values, weights, 64, ranges)

    def cleaned(row: dict, part: _Part) -> pa.RecordBatch:
        near = part.met(bits, row["short"].as_py())
        values, _, inverse = part.candidates(near)
        repeated = _unpacked(row["whole"].as_py(), len(values))[inverse]
        covered = part.covered(np.flatnonzero(near)[repeated])
        structs = row["pages"].values
        texts = [
            main_text(page["main"], page["other"], covered[2 * k], covered[2 * k + 1])
            for k, page in enumerate(part.pages)
        ]
        return pa.RecordBatch.from_arrays(
            [structs.field("id"), structs.field("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
        )

    sent = "part long, range int, n int, sent binary"
    met = _met(each_part(parts, short, sent), "html-short").withColumnRenamed("met", "short")
    parts = parts.join(met, "part", "left")
    met = _met(each_part(parts, whole, sent), "html-whole").withColumnRenamed("met", "whole")
    parts = parts.join(met, "part", "left")
    found = each_part(parts, cleaned, f"id {kinds[id]}, url {kinds[url]}, text string")
    return found.select(F.col("id").alias(id), F.col("url").alias(url), "text")
