"""Main text of web pages: what the markup says, less what the host's pages repeat.

A page is cut into blocks of visible text. Blocks inside the main element (article, main) that no
menu, header, footer, sidebar, notice, advert, form or comment part encloses are its text; where a
page has no main element, all blocks that nothing encloses are. From either text goes what the host
repeats: substrings of ``long`` tokens or more, and sequences of whole blocks of ``run`` tokens or
more, that stand on half of the host's pages, three at least. A text that would lose nearly all of
itself so is one that half of the host's pages copy, and is kept.

The pages of a host are dealt into batches of bounded size. A batch's token streams are concatenated
and their suffixes sorted (prefix doubling), with the common prefixes of neighbours; an interval of the
array whose common prefix is ``long`` or more is a repeat, and its distinct pages are counted. What
stands on half of the host's pages stands on half of some batch's pages: the repeats that do are the
host's candidates, every batch counts them by their hash, and the sums decide. So no task holds more
than a batch, no page is parsed twice, and the counts are those of the whole host's array.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.llm.common import written

#: Tokens that whole repeated blocks must have together.
RUN = 6
#: Tokens of a repeated substring that may begin and end inside blocks.
LONG = 24
#: Distinct pages, and share of the host's pages, on which boilerplate stands at least. Two pages alone can't tell
#: a menu from a copied text.
PAGES, SHARE = 3, 0.5
#: Share of its own text that a page must lose for the text to count as copied.
COPY = 0.95
#: Pages of a batch, and bytes of html.
BATCH_PAGES, BATCH_BYTES = 200, 4 << 20

MAIN, BOILERPLATE, OPEN = "main", "boilerplate", "open"

# Names of elements, roles and common class words.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img".split())
_SKIPPED = frozenset("aside audio button canvas datalist dialog fieldset footer form head header iframe input map math menu meter "
                     "nav object option output picture progress search select svg textarea title video".split())
_MAIN_ELEMENTS = frozenset(["article", "main"])
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_CLASS_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice paywall popup promo promoted "
    "promotion recommended related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())

#: Words that say nothing of what an element holds, beside a class word.
_PLAIN_WORDS = frozenset("area bar block body bottom box card container content end footer head header inner inline item items left list "
                         "main panel right row section side slot strip top unit wrap wrapper".split())
#: Elements whose class tells nothing inside an article: they hold its sentences.
_SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt em strong b i cite q".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|xmp|noframes)\b[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[\s/]++|[^\s\"'>/=]++(?:\s*+=\s*+"
    r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?+)?+|[\"'=])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _telling(name: str, given: str, zone: str) -> bool:
    """Whether class or id names call an element boilerplate. Inside an article a name only counts if all
    of its words say so ("social-share", not "related-work"), and never on sentences."""
    if zone != MAIN:
        return not _CLASS_WORDS.isdisjoint(_WORDS.findall(_CAMEL.sub(" ", given).lower()))
    if name in _SENTENCES:
        return False
    for one in given.split():
        words = set(_WORDS.findall(_CAMEL.sub(" ", one).lower()))
        if words & _CLASS_WORDS and words <= _CLASS_WORDS | _PLAIN_WORDS:
            return True
    return False


def _marked(name: str, attributes: str, zone: str = OPEN) -> str | None:
    """What an element's attributes make of its content: MAIN, BOILERPLATE or nothing."""
    if not attributes or attributes.isspace():
        return None
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    if role == "main" or "articlebody" in found.get("itemprop", "").lower():
        return MAIN
    if role in _ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "").lower()):
        return BOILERPLATE
    if name not in ("html", "body") and name not in _MAIN_ELEMENTS:
        if _telling(name, f"{found.get('class', '')} {found.get('id', '')}", zone):
            return BOILERPLATE
    return None


def blocks(page: str) -> list[tuple[str, str]]:
    """(zone, text) of a page's blocks of visible text in page order. Text inside boilerplate
    elements is BOILERPLATE, inside a main element MAIN, else OPEN; where a page has a main
    element, what is open lies outside the article and is BOILERPLATE too."""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements and the zone inside
    zone, at = OPEN, 0

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((zone, text))
            parts.clear()

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name not in _INLINE:
                close()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    inner = stack[depth + 1 :]
                    if name in _INLINE and any(x not in _INLINE for x, _ in inner):
                        break  # a stray end tag of an inline element leaves the blocks within open
                    if zone != (stack[depth - 1][1] if depth else OPEN):
                        close()
                    del stack[depth:]
                    zone = stack[-1][1] if stack else OPEN
                    break
            continue
        if name not in _INLINE:
            close()
        if name in _VOID or token["attributes"].endswith("/") and name not in _INLINE and name in ("svg", "path"):
            continue
        inside = zone
        if zone != BOILERPLATE:
            marked = _marked(name, token["attributes"], zone)
            if marked == BOILERPLATE or name in _SKIPPED and not (name == "header" and zone == MAIN):
                inside = BOILERPLATE
            elif marked == MAIN or name in _MAIN_ELEMENTS:
                inside = MAIN
        if inside != zone:
            close()
        stack.append((name, inside))
        zone = inside
    if at < len(page):
        parts.append(page[at:])
    close()
    if any(z == MAIN for z, _ in out):
        return [(BOILERPLATE if z == OPEN else z, t) for z, t in out]
    return out


def _pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, page, host, html). Rows of equal ``page`` are the same page."""
    url, text = F.col("url").cast("string"), F.col("html").cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))
    named = F.col("page_id").cast("string")
    return pages.select(
        "page_id", url.alias("url"),
        F.when(named.isNotNull(), F.xxhash64(named)).otherwise(F.xxhash64(text, F.lit("no id"))).alias("page"),
        host.alias("host"), text.alias("html"))


def _parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with the ``stream`` of blocks in place of html: a sign of the zone and the text of each,
    a line a block, compressed."""
    kept = [f for f in pages.schema.fields if f.name != "html"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                streams = ["\n".join(("-" if zone == BOILERPLATE else "+") + text for zone, text in blocks(page or ""))
                           for page in some.column("html").to_pylist()]
                packed = [press.compress(x.encode("utf-8", "replace")) for x in streams]
                yield pa.RecordBatch.from_arrays([*(some.column(f.name) for f in kept), pa.array(packed, pa.binary())],
                                                 [*(f.name for f in kept), "stream"])

    return pages.mapInArrow(go, T.StructType([*kept, T.StructField("stream", T.BinaryType())]))


#: An odd base of the polynomial token hashes and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Streams:
    """The token streams of some pages of a host, one behind the other."""

    def __init__(self, streams: list[str], pages: np.ndarray) -> None:
        tokens: list[str] = []
        lines, sizes, zones = [0], [], []
        self.bounds = [0]  # of the rows
        for stream in streams:
            for line in stream.split("\n") if stream else ():
                words = line[1:].split(" ")
                tokens += words
                sizes.append(len(words))
                zones.append(line[0] == "+")
            lines.append(len(sizes))
            self.bounds.append(len(tokens))
        self.tokens, self.lines = tokens, lines
        self.ends = np.cumsum(np.array(sizes, np.int64))  # of the blocks
        self.text = np.repeat(np.array(zones, bool), np.array(sizes, np.int64))
        rows = np.diff(self.bounds)
        _, page = np.unique(pages, return_inverse=True)
        self.page = np.repeat(page, rows)
        self.row = np.repeat(np.arange(len(rows)), rows)
        self.pages = int(page.max(initial=-1)) + 1
        column = pa.array(tokens, pa.large_string()).dictionary_encode()
        self.codes = column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = column.dictionary
        new = np.flatnonzero((self.text[1:] != self.text[:-1]) | (self.row[1:] != self.row[:-1])) + 1
        cut = np.append(new, len(tokens))
        self.zone_end = cut[np.searchsorted(cut, np.arange(len(tokens)), side="right")]  # of each token's stretch of one zone

    def units(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of the shortest sequences of a page's whole blocks from and up to each block that
        have ``run`` tokens and touch the text."""
        starts = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        found = []
        for a, z in zip(self.lines[:-1], self.lines[1:], strict=True):
            if a == z:
                continue
            first, last = starts[a:z], self.ends[a:z]
            to = np.searchsorted(last, first + run)
            since = np.searchsorted(first, last - run, side="right") - 1
            fits, reaches = to < z - a, since >= 0
            found += [np.stack((first[fits], last[to[fits]])), np.stack((first[since[reaches]], last[reaches]))]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = len(self.tokens) + 1
        pairs = np.concatenate(found, axis=1)
        low, high = np.divmod(np.unique(pairs[0] * n + pairs[1]), n)
        before = np.concatenate(([0], np.cumsum(self.text)))
        touches = before[high] > before[low]
        return low[touches], (high - low)[touches]

    def windows(self, long: int) -> np.ndarray:
        """Starts of the windows of ``long`` tokens that lie in one zone."""
        at = np.arange(len(self.tokens))
        return at[at + long <= self.zone_end]

    def hashes(self, host: str) -> Callable[[np.ndarray, np.ndarray | int], np.ndarray]:
        """Hashes of any substrings, told apart by host and length."""
        import xxhash

        n = len(self.tokens)
        seed = np.uint64(xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass")))
        word = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.words.to_pylist()), np.uint64, len(self.words))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word[self.codes] * _powers(_BASE, n), dtype=np.uint64)))
        back = _powers(_INVERSE, n + 1)

        def of(start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
            size = np.broadcast_to(np.asarray(size, np.int64), start.shape)
            h = (sums[start + size] - sums[start]) * back[start]
            h = (h ^ seed ^ size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xBF58476D1CE4E5B9)
            return (h ^ h >> np.uint64(29)).view(np.int64)

        return of


class SuffixArray:
    """The sorted suffixes of pages' streams, none reaching past its page, by prefix doubling: ``ranks[k]``
    orders them by their first 2**k tokens, a rank being the place of the first of its equals. Suffixes
    that differ from all others keep their place."""

    def __init__(self, streams: Streams) -> None:
        n, rows = len(streams.codes), len(streams.lines)
        self.end = np.array(streams.bounds[1:], np.int64)[streams.row] if n else np.zeros(0, np.int64)
        counts = np.bincount(streams.codes)
        self.ranks = [(np.cumsum(counts) - counts)[streams.codes]]
        live, step = np.flatnonzero(counts[streams.codes] > 1), 1  # suffixes that equal others so far
        while len(live):
            rank, ahead = self.ranks[-1], live + step
            # a page's end sorts before every token and differs from other pages' ends
            second = np.where(ahead < self.end[live], rank[np.minimum(ahead, n - 1)], -1 - streams.row[live])
            key = rank[live] * (n + rows) + second + rows
            order = np.argsort(key)
            live, key, group = live[order], key[order], rank[live[order]]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(live)))
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))  # of each old group
            inside = np.arange(len(live)) - np.repeat(first, np.diff(np.append(first, len(live))))
            fresh = rank.copy()
            fresh[live] = group + np.repeat(inside[start], size)
            self.ranks.append(fresh)
            live = live[np.repeat(size > 1, size)]
            step *= 2
        self.order = np.argsort(self.ranks[-1], kind="stable") if n else np.zeros(0, np.int64)

    def common(self) -> np.ndarray:
        """Tokens that each suffix of the array shares with the one before it; the first with none."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        shared, room = np.zeros(len(a), np.int64), np.minimum(self.end[a] - a, self.end[b] - b)
        for k in range(len(self.ranks) - 1, -1, -1):
            step, rank = 1 << k, self.ranks[k]
            live = np.flatnonzero(shared + step <= room)
            same = live[rank[a[live]] == rank[b[live]]]
            shared[same] += step
            a[same] += step
            b[same] += step
        return np.concatenate((np.zeros(min(1, len(self.order)), np.int64), shared))

    def interval(self, length: int) -> np.ndarray:
        """Number of each suffix's interval of a common prefix of ``length`` tokens or more."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.common() < length)
        return out

    def equal(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers that are equal for equal substrings: two overlapping powers of two cover each."""
        level = np.int64(np.log2(size)) if len(size) else size
        first, last = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        for k in np.unique(level):
            mine = level == k
            rank = self.ranks[min(k, len(self.ranks) - 1)]
            first[mine], last[mine] = rank[start[mine]], rank[start[mine] + size[mine] - (1 << k)]
        _, both = np.unique(first * len(self.order) + last, return_inverse=True)
        return np.unique(both * (int(size.max(initial=0)) + 1) + size, return_inverse=True)[1]


def _on_pages(group: np.ndarray, page: np.ndarray) -> np.ndarray:
    """For each member of a group the number of distinct pages its group stands on."""
    if not len(group):
        return group
    n = int(page.max()) + 1
    return np.bincount(np.unique(group * n + page) // n, minlength=int(group.max()) + 1)[group]


def candidates(streams: Streams, host: str, run: int, long: int, share: float) -> np.ndarray:
    """Hashes of the repeats that stand on ``share`` of these pages: windows of the suffix array's
    intervals and sequences of whole blocks."""
    if not len(streams.tokens):
        return np.zeros(0, np.int64)
    array = SuffixArray(streams)
    at = streams.windows(long)
    starts, sizes = streams.units(run)
    need = share * streams.pages
    windows = at[_on_pages(array.interval(long)[at], streams.page[at]) >= need]
    often = _on_pages(array.equal(starts, sizes), streams.page[starts]) >= need
    if not len(windows) and not often.any():
        return np.zeros(0, np.int64)
    of = streams.hashes(host)
    return np.unique(np.concatenate((of(windows, long), _unit(of(starts[often], sizes[often])))))


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes of sequences of whole blocks: as many tokens inside a block are something else."""
    return h ^ np.int64(0x5BD1E9955BD1E995)


def _places(streams: Streams, host: str, run: int, long: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, size) of the wanted repeats in the streams."""
    if not len(wanted) or not len(streams.tokens):
        return (np.zeros(0, np.int64),) * 3
    at, (starts, sizes) = streams.windows(long), streams.units(run)
    of = streams.hashes(host)
    h = np.concatenate((of(at, long), _unit(of(starts, sizes))))
    start, size = np.concatenate((at, starts)), np.concatenate((np.full(len(at), long), sizes))
    mine = np.isin(h, wanted)
    return h[mine], start[mine], size[mine]


def _left(streams: Streams, start: np.ndarray, size: np.ndarray, copy: float) -> list[str]:
    """Each row's text less the covered tokens; all of it where it would lose ``copy`` of itself."""
    cover = np.zeros(len(streams.tokens) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + size, -1)
    gone = np.cumsum(cover[:-1]) > 0
    out = []
    for a, z in zip(streams.bounds[:-1], streams.bounds[1:], strict=True):
        text, lost = streams.text[a:z], gone[a:z] & streams.text[a:z]
        keep = text if lost.sum() >= copy * text.sum() else text & ~lost
        out.append(" ".join([streams.tokens[a + i] for i in np.flatnonzero(keep).tolist()]))
    return out


def _batch_streams(row: dict) -> Streams:
    press = zstandard.ZstdDecompressor()
    return Streams(press.decompress(row["streams"]).decode().split("\x00")[:-1], np.frombuffer(row["pages"], np.int64))


def extract(pages: DataFrame, run: int = RUN, copy: float = COPY, long: int = LONG, least: int = PAGES, share: float = SHARE,
            batch_pages: int = BATCH_PAGES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored. Null or empty
    html gives an empty text; a null url is a host of its own name "". Rows of the same page_id,
    and rows without one that have the same html, are the same page, so they don't make each
    other's text repeat. An empty table gives an empty result. Every page is parsed once; its blocks are
    shuffled once, to its batch, and only hashes after that.
    """
    cut = _pages(pages)
    kind = cut.schema["page_id"]
    hosts = cut.groupBy("host", "page").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("bytes")).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.greatest(F.ceil(F.count(F.lit(1)) / batch_pages), F.ceil(F.sum("bytes") / batch_bytes)).alias("batches"))
    hosts = written(hosts, "html-hosts")
    many = hosts.where("batches > 1").select("host", "batches")
    streams = _parsed(cut).join(many, "host", "left").withColumn(
        "batch", F.pmod(F.xxhash64("page"), F.coalesce("batches", F.lit(1))).cast("int")).drop("batches")

    def gather(group: pa.Table) -> pa.Table:
        press, back = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()
        texts = [back.decompress(x) for x in group["stream"].to_pylist()]
        ids = group["page"].to_numpy()
        host = group["host"][0].as_py()
        found = candidates(Streams([t.decode() for t in texts], ids), host, run, long, share)
        return pa.table({
            "host": pa.array([host]), "page_ids": pa.array([group["page_id"].to_pylist()], pa.list_(group.schema.field("page_id").type)),
            "urls": pa.array([group["url"].to_pylist()], pa.list_(pa.string())), "pages": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "streams": pa.array([press.compress(b"".join(t.replace(b"\x00", b" ") + b"\x00" for t in texts))], pa.binary()),
            "found": pa.array([found.tolist()], pa.list_(pa.int64()))})

    shape = T.StructType([
        T.StructField("host", T.StringType()), T.StructField("page_ids", T.ArrayType(kind.dataType)), T.StructField("urls", T.ArrayType(T.StringType())),
        T.StructField("pages", T.BinaryType()), T.StructField("streams", T.BinaryType()), T.StructField("found", T.ArrayType(T.LongType()))])
    batches = written(streams.groupBy("host", "batch").applyInArrow(gather, shape), "html-batches")

    wanted = batches.select("host", F.explode("found").alias("h")).groupBy("host").agg(F.collect_set("h").alias("wanted"))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                one = _batch_streams(row)
                h, start, _ = _places(one, row["host"], run, long, np.array(row["wanted"], np.int64))
                known, number = np.unique(h, return_inverse=True)
                on, n = np.unique(np.unique(number * (one.pages + 1) + one.page[start]) // (one.pages + 1), return_counts=True)
                heads = known[on]
                yield pa.RecordBatch.from_arrays([pa.array([row["host"]] * len(heads), pa.string()), pa.array(heads), pa.array(n.astype(np.int64))],
                                                 ["host", "h", "n"])

    counted = batches.select("host", "pages", "streams").join(wanted, "host").mapInArrow(count, "host string, h long, n long")
    total = counted.groupBy("host", "h").agg(F.sum("n").alias("on")).join(hosts.select("host", "n"), "host")
    gone = written(total.where(F.col("on") >= F.greatest(F.lit(least), F.ceil(F.col("n") * F.lit(share)))).groupBy("host").agg(
        F.collect_list("h").alias("gone")), "html-gone")

    def cleaned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in ("host", "pages", "streams", "gone")}
                one = _batch_streams(row)
                _, start, size = _places(one, row["host"], run, long, np.array(row["gone"] or [], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_ids")[n].values, batch.column("urls")[n].values, pa.array(_left(one, start, size, copy), pa.string())],
                    ["page_id", "url", "text"])

    return batches.drop("found").join(gone, "host", "left").mapInArrow(
        cleaned, T.StructType([kind, T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
