"""Main text of web pages with a suffix array per host.

Method: a page is cut into blocks of text. The token streams of a host's pages
are concatenated, and a suffix array over them, sorted by prefix doubling to
``RUN`` tokens, shows on how many distinct pages each run of that many tokens
stands. Runs that stand on more pages than the page's own text does (its usual
count, 1 unless the page has copies) are repeated among pages that differ; a
block that such runs cover by half is boilerplate, and the other blocks stay, so
copies of a page under several ids keep their text. The page's own markup then has the last word: blocks inside menus,
headers, footers, sidebars, notices, adverts, forms and comments go though they
be unique. Inside an article or main element a passage stays though a few pages
quote it; there it takes ``MANY`` pages, and ``MANY_SHARE`` of the host's, to
make boilerplate. A page's text comes from its article or main elements if they
hold half of what the markup leaves, else from all blocks that it leaves open.

Distribution: pages meet by host; a host of more than ``SHARD`` pages is dealt
into shards of about that many, each with a suffix array of its own, so no task
holds a whole large host. The distinct runs of the shards, of all pages and
zones, meet by host and hash bucket: first ``MARK_BITS`` bits of each, as gaps, of
which a shard learns those that another shard has too; then only such runs with
their whole hashes and pages, which are added up, and the totals go back to the
shards. So the result does not depend on the shard, nor on the marks: runs that
share a mark by chance are told apart by their hashes. Pages travel compressed.

Edge cases: null and empty html give an empty text; a null url belongs to the
host without a name; repeated rows are extracted each and are no distinct pages
of each other; unclosed elements end with what contains them; truncated markup
is read as far as it goes; other columns are ignored."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.hashing import mix64, rows_of, runs, span_hashes
from ridelens.llm.shared import materialise, pieces, ship, text_buffer

#: Tokens of a run that counts as repeated, a power of two.
RUN = 8
#: Pages, and share of its host's pages, that a run in an article or main element stands on to be boilerplate.
MANY, MANY_SHARE = 5, 0.5
#: Pages of a host that share a suffix array.
SHARD = 512
#: Shards whose runs fill a bucket of the count over all shards of a host.
SHARDS_A_BUCKET = 8
#: Bits of a run's hash that the shards compare first, 32 at most.
MARK_BITS = 28
#: Hosts above SHARD pages are broadcast up to this many, else joined by shuffle.
BROADCAST_HOSTS = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|textarea|select|button)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: One attribute after the other, so that no name is found within a value.
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
#: Elements whose text is never main text; a header is, inside an article.
_DROPPED = frozenset("head nav footer aside form menu dialog".split())
#: Words in a class or role that mark an element as such.
_MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations widget toolbar pagination pager copyright disclaimer login search contentinfo complementary dialog".split()
)
#: Words of these that an article's own sections are named by, too.
_AMBIGUOUS = frozenset("notice notices alert search social related menu banner overlay reply replies respond copyright disclaimer promotion dialog".split())
#: Words that may stand beside a mark in a class of an article's part.
_BESIDE = frozenset(
    "area articles bar block bottom box buttons container content form inner item items left link links list panel posts right "
    "section slot stories top unit widget wrap wrapper".split()
)
#: Whole ids that mark an element.
_IDS = frozenset(
    "ad ads advert advertisement sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comments disqus "
    "disqus_thread respond cookie-banner cookie-notice cookie-consent newsletter pagination toolbar".split()
)
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: Elements that end where the next of their kind begins.
_IMPLIED = {"p": _BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
            "th": {"td", "th", "tr"}, "option": {"option"}}

OPEN, MAIN, ARTICLE = 0, 1, 2


def _marked(key: str, value: str, name: str, in_article: bool) -> bool:
    """Whether a class, id or role says that an element is no main text. Inside
    an article only what cannot name a part of the article does."""
    if key == "id":
        return value in _IDS and not (in_article and (name in _PROSE or value == "header"))
    if not in_article or key == "role":
        words = re.split(r"[^a-z0-9]+", value)
        return not _MARKED.isdisjoint(words) or ("header" in words and not in_article)
    for own in value.split():
        words = set(re.split(r"[^a-z0-9]+", own)) - {""}
        marks = words & _MARKED
        if marks - _AMBIGUOUS and words <= _MARKED | _BESIDE or marks and words - marks and words - marks <= _BESIDE:
            return True
    return False


def _kind(name: str, attrs: str, in_article: bool) -> int | None:
    """None: dropped; else the zone that the element opens."""
    if name in _DROPPED or (name == "header" and not in_article):
        return None
    zone = ARTICLE if name == "article" else MAIN if name == "main" else OPEN
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'").strip().lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                return None
            if key == "itemprop":
                zone = ARTICLE if value == "articlebody" else zone
            elif key in ("class", "id", "role"):
                if key == "role" and value in ("main", "article"):
                    zone = max(zone, MAIN if value == "main" else ARTICLE)
                if name in ("article", "main", "body", "html"):
                    if key == "class" and "comment" in re.split(r"[^a-z0-9]+", value):
                        return None
                elif _marked(key, value, name, in_article):
                    return None
    return zone


def _zone(blocks: list[str], zones: list[int]) -> int:
    """The least zone of the page's text: articles, if they hold half of the
    text left by the markup, else articles and main, if these do, else all."""
    sizes = [sum(len(b) for b, z in zip(blocks, zones) if z >= least) for least in (OPEN, MAIN, ARTICLE)]
    return next(z for z in (ARTICLE, MAIN, OPEN) if 2 * sizes[z] >= sizes[OPEN] and (sizes[z] or z == OPEN))


def page_blocks(page: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, and the zone of each; dropped
    blocks have the zone -1."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, int, bool]] = []  # name, dropped, zone, dropped within a block
    state = (False, OPEN, False)

    def add(piece: str) -> None:
        if not state[2]:
            text.append(html.unescape(piece))

    def flush() -> None:
        if text:
            block = " ".join("".join(text).split())
            text.clear()
            if block:
                out.append((block, -1 if state[0] else state[1]))

    def close(depth: int) -> None:
        nonlocal state
        del stack[depth:]
        state = stack[-1][1:] if stack else (False, OPEN, False)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        block = name in _BLOCKS
        if block:
            flush()
        if m["end"] or m["end2"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            continue
        if name in _VOID:
            if name in ("br", "hr"):
                add(" ")
            continue
        while stack and stack[-1][0] in _IMPLIED and name in _IMPLIED[stack[-1][0]]:
            close(len(stack) - 1)
        kind = _kind(name, m["attrs"] or "", state[1] == ARTICLE)
        if block or kind is None:
            dropped = state[0] or (block and kind is None)
            stack.append((name, dropped, max(state[1], kind or OPEN), state[2] or (not block and kind is None)))
            state = stack[-1][1:]
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _pack(blocks: list[tuple[str, int]]) -> bytes:
    """The blocks of a page, which hold no line feeds, and their zones."""
    zones = np.array([z for _, z in blocks], np.int8).tobytes()
    return zlib.compress(np.array([len(blocks)], "<u4").tobytes() + zones + "\n".join(b for b, _ in blocks).encode(), 1)


def _unpack(packed: bytes) -> tuple[list[str], list[int]]:
    raw = zlib.decompress(packed)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    return (raw[4 + n :].decode().split("\n") if n else []), np.frombuffer(raw, np.int8, n, 4).tolist()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        parsed = [_pack(page_blocks(page or "")) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(parsed, pa.binary())],
            names=["page_id", "url", "host", "packed"],
        )


_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


class Runs(NamedTuple):
    """The runs of RUN tokens of a shard's pages, by its suffix array."""

    at: np.ndarray  # first token of each block, and the number of tokens
    page: np.ndarray  # page of each token
    suffixes: np.ndarray  # first tokens of the runs, equal runs side by side
    sizes: np.ndarray  # how many suffixes each distinct run has
    hashes: np.ndarray  # a hash of each distinct run, the same in every shard
    pages: np.ndarray  # on how many distinct pages of the shard each run stands


def shard_runs(blocks: list[str], page_of_block: np.ndarray, page_key: np.ndarray, left: np.ndarray) -> Runs:
    """Blocks are in page order; pages of the same key count as one. No run
    crosses pages, nor from blocks that the markup has dropped into those left."""
    data, offsets = text_buffer(pa.array(blocks, pa.large_string()))
    starts, ends = runs(_WORD[data], offsets)
    at = rows_of(starts, offsets)
    page = np.repeat(page_of_block, np.diff(at))
    n = len(starts)
    none = np.empty(0, np.int64)
    if n < RUN:
        return Runs(at, page, none, none, none.view(np.uint64), none)
    # prefix doubling: the rank of each suffix by its first 1, 2, 4, ... tokens
    value = span_hashes(data, starts, ends)
    rank = np.unique(value, return_inverse=True)[1]
    size = 1
    while size < RUN:
        rank = np.unique(rank[:-size] * np.int64(n + 1) + rank[size:], return_inverse=True)[1]
        value = mix64(value[:-size] * _STEP + value[size:])
        size *= 2
    part = np.cumsum(np.append(True, (page_of_block[1:] != page_of_block[:-1]) | (left[1:] != left[:-1])))
    part = np.repeat(part, np.diff(at))
    where = np.flatnonzero(part[: len(rank)] == part[RUN - 1 :])
    if not len(where):
        return Runs(at, page, none, none, none.view(np.uint64), none)
    key = page_key[page[where]]
    order = np.lexsort((key, rank[where]))
    suffixes, key = where[order], key[order]  # the suffix array
    other = np.append(True, rank[suffixes][1:] != rank[suffixes][:-1])
    group = np.flatnonzero(other)
    pages = np.add.reduceat((other | np.append(True, key[1:] != key[:-1])).astype(np.int64), group)
    return Runs(at, page, suffixes, np.diff(np.append(group, len(suffixes))), value[suffixes[group]], pages)


def covered_blocks(own: Runs, hit: np.ndarray) -> np.ndarray:
    """Which blocks are covered, by half at least, by the runs at ``hit``."""
    n = len(own.page)
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + RUN, -1)
    inner = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:n] > 0)])
    return 2 * (inner[own.at[1:]] - inner[own.at[:-1]]) >= np.maximum(np.diff(own.at), 1)


def usual_pages(own: Runs, on: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each suffix, on how many pages the text of its page stands: the
    lower quartile of the counts of the page's runs, in the blocks that the
    markup has left. It is 1 on a page of its own, and the number of copies on
    a copied page; boilerplate stands on more pages, whose other text differs."""
    token = np.repeat(left, np.diff(own.at))
    inside = np.flatnonzero(token[own.suffixes]) if len(own.suffixes) else own.suffixes
    page = own.page[own.suffixes]
    usual = np.ones(len(own.page) and int(own.page[-1]) + 1, np.int64)
    if len(inside):
        order = inside[np.lexsort((on[inside], page[inside]))]
        first = np.flatnonzero(np.append(True, page[order][1:] != page[order][:-1]))
        n = np.diff(np.append(first, len(order)))
        usual[page[order[first]]] = on[order[first + (n - 1) // 4]]
    return usual[page]


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each key, which stand side by side."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        own = list(zip(*(table[k].to_pylist() for k in keys)))
        a = 0
        for b in range(1, len(own) + 1):
            if b < len(own) and own[b] == own[a]:
                continue
            if held and last != own[a]:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last, a = own[a], b
    if held:
        yield pa.concat_tables(held)


def _runs_of(table: pa.Table) -> tuple[list[list[str]], list[list[int]], np.ndarray, Runs]:
    """The blocks of each page and their zones, which of them the markup has
    left, and the runs."""
    pages = [_unpack(x) for x in table["packed"].to_pylist()]
    blocks, zones = [b for b, _ in pages], [z for _, z in pages]
    page = np.repeat(np.arange(len(blocks)), [len(p) for p in blocks])
    left = np.array([z >= 0 for own in zones for z in own], bool)
    return blocks, zones, left, shard_runs([b for own in blocks for b in own], page, table["key"].to_numpy(), left)


_MARKS = pa.schema([("host", pa.string()), ("bucket", pa.int64()), ("shard", pa.int64()), ("marks", pa.binary())])
_COUNTS = pa.schema([("host", pa.string()), ("bucket", pa.int64()), ("shard", pa.int64()), ("hashes", pa.binary()), ("pages", pa.binary())])


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema)], schema=schema)


def _pack_marks(marks: np.ndarray) -> bytes:
    """Ascending numbers below 2^32 as compressed gaps, byte by byte."""
    gaps = np.diff(marks, prepend=np.uint64(0)).astype("<u4")
    return zlib.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_marks(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view("<u4").ravel(), dtype=np.uint64)


def _buckets(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The buckets of runs, which all shards of a host share, and their runs by hash."""
    buckets = -(-shards // SHARDS_A_BUCKET)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return ((k, order[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a)


def _mark_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - MARK_BITS)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks of the distinct runs of a shard, by bucket."""
    for table in _groups(batches, "host", "shard"):
        host, shard, shards = (table[c][0].as_py() for c in ("host", "shard", "shards"))
        if shards > 1:
            own = _runs_of(table)[3]
            for k, part in _buckets(own.hashes, shards):
                yield _row(_MARKS, host, k, shard, _pack_marks(np.unique(_mark_of(own.hashes[part]))))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each shard, its marks that other shards have too."""
    for table in _groups(batches, "host", "bucket"):
        each = [_unpack_marks(x) for x in table["marks"].to_pylist()]
        found, which, n = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        for k, (marks, own) in enumerate(zip(each, np.split(n[which] > 1, np.cumsum([len(x) for x in each])[:-1]))):
            if own.any():
                yield _row(_MARKS, table["host"][0].as_py(), table["bucket"][0].as_py(), table["shard"][k].as_py(), _pack_marks(marks[own]))


def _evidence(table: pa.Table, met: pa.Table) -> pa.Table:
    """Of a shard's distinct runs those whose marks, in ``met``, another shard
    has too: hashes and numbers of pages by bucket. Pages of different shards are
    distinct."""
    rows = []
    if table.num_rows and met.num_rows:
        host, shard, shards = (table[c][0].as_py() for c in ("host", "shard", "shards"))
        own, marks = _runs_of(table)[3], dict(zip(met["bucket"].to_pylist(), met["marks"].to_pylist()))
        for k, part in _buckets(own.hashes, shards):
            if k in marks:
                part = part[np.isin(_mark_of(own.hashes[part]), _unpack_marks(marks[k]))]
                rows.append(_row(_COUNTS, host, k, shard, own.hashes[part].tobytes(), zlib.compress(own.pages[part].astype(np.int32).tobytes(), 1)))
    return pa.Table.from_batches(rows, schema=_COUNTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each shard, its runs that other shards have too, and on how many
    pages of the host they stand."""
    for table in _groups(batches, "host", "bucket"):
        hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        pages = [np.frombuffer(zlib.decompress(x), np.int32).astype(np.int64) for x in table["pages"].to_pylist()]
        cuts = np.cumsum([0, *map(len, hashes)])
        which = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        total = np.bincount(which, weights=np.concatenate(pages)).astype(np.int64)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            all_pages = total[which[a:b]]
            more = all_pages > pages[k]
            if more.any():
                place = (table["host"][0].as_py(), table["bucket"][0].as_py(), table["shard"][k].as_py())
                yield _row(_COUNTS, *place, hashes[k][more].tobytes(), zlib.compress(all_pages[more].tobytes(), 1))


def _decide(table: pa.Table, met: pa.Table) -> pa.Table:
    """The blocks of each page that stay; ``met`` is what _merge gave the shard."""
    blocks, zones, left, own = _runs_of(table)
    pages = own.pages.copy()
    if met.num_rows:
        order = np.argsort(own.hashes)
        for hashes, total in zip(met["hashes"].to_pylist(), met["pages"].to_pylist()):
            pages[order[np.searchsorted(own.hashes[order], np.frombuffer(hashes, np.uint64))]] = np.frombuffer(zlib.decompress(total), np.int64)
    on = np.repeat(pages, own.sizes)  # of each suffix
    among_others = on > usual_pages(own, on, left)
    repeated = covered_blocks(own, own.suffixes[among_others])
    # a marked passage may be quoted: it takes a share of the host's pages
    many = max(MANY, MANY_SHARE * (table["host_pages"][0].as_py() or table.num_rows))
    everywhere = covered_blocks(own, own.suffixes[among_others & (on >= many)])
    first = np.concatenate([[0], np.cumsum([len(p) for p in blocks])])
    stay = []
    for i, (page, kinds) in enumerate(zip(blocks, zones)):
        zone = _zone(page, kinds)
        flags = (everywhere if zone else repeated)[first[i] : first[i + 1]]
        stay.append([b for b, z, r in zip(page, kinds, flags) if z >= zone and not r])
    return pa.table([table["page_id"], table["url"], pa.array(stay, pa.list_(pa.string()))], names=["page_id", "url", "blocks"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).withColumn("host", host)
    large = rows.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") > SHARD)
    large = materialise(large, "large-hosts")
    large = F.broadcast(large) if large.count() <= BROADCAST_HOSTS else large
    parsed = rows.mapInArrow(_parse, "page_id long, url string, host string, packed binary")
    placed = parsed.withColumn("key", F.xxhash64("page_id", "url")).join(large, "host", "left")
    placed = placed.withColumn("shards", F.coalesce(F.ceil(F.col("host_pages") / SHARD), F.lit(1)))
    placed = placed.withColumn("shard", F.pmod("key", "shards")).repartition("host", "shard")
    marks, counts = "host string, bucket long, shard long, marks binary", "host string, bucket long, shard long, hashes binary, pages binary"
    met = placed.sortWithinPartitions("host", "shard").mapInArrow(_marks, marks)
    met = met.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_met, marks)
    total = placed.groupBy("host", "shard").cogroup(met.groupBy("host", "shard")).applyInArrow(_evidence, counts)
    total = total.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_merge, counts)
    decided = placed.groupBy("host", "shard").cogroup(total.groupBy("host", "shard"))
    decided = decided.applyInArrow(_decide, "page_id long, url string, blocks array<string>")
    text = F.array_join("blocks", "\n\n")
    return decided.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
