"""Main text of web pages: text lines, compared with the page of the nearest URL on the same host."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import in_chunks, plain, shuffle_partitions, text_of
from millrace.llm.ranges import cut_points, part_of
from millrace.llm.urlrules import host_and_path

# Elements whose start and end separate lines.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is never text of the page.
OPAQUE = "script style title noscript template iframe textarea svg math object select button canvas audio video"
# Elements around furniture.
FURNITURE = frozenset("nav footer aside form dialog menu head header".split())
# Words in class, id and role that name furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv adbox adslot adunit advert advertisement advertising adverts adsense aside announcement banner sponsor sponsored promo promotion cookie cookies consent notice "
    "gdpr notification notifications sidebar widget nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments discussion disqus respond "
    "reply replies share sharing social related newsletter subscribe subscription popup modal overlay login search pagination "
    "pager toolbar topbar contentinfo complementary alert disclaimer".split()
)
# Those of them that make furniture of an article or main element itself.
NOT_THE_ARTICLE = frozenset("ad ads advert advertisement comment comments reply replies related sponsored promo".split())
# Those that make furniture of a paragraph or heading inside an article.
NOT_THE_TEXT = FURNITURE_WORDS - frozenset("search login related alert social share reply header banner announcement notification promotion menu navigation".split())
# Those that a page's title may stand in.
HEADER_WORDS = frozenset(["header", "masthead"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_FLOW = HEADINGS | {"p", "blockquote", "pre"}
CONTAINERS = frozenset(["article", "main"])
# Elements whose end tags end everything that was left open inside.
STRUCTURE = CONTAINERS | FURNITURE | {"body", "html"}

# Quotes hold an attribute's value only behind an equals sign, and if something that may follow a value follows.
_ATTRIBUTES = r"(?:[^>\"'=]|(?>=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|=)|[\"'])*+"
# Opaque elements that may be left open by mistake: such a one ends before the next of its kind or the next block.
_EMBEDDED = "svg|math|object|select|button|canvas|audio|video"
_BLOCK_AHEAD = r"(?=</?(?:p|div|article|main|section|h[1-6]|ul|ol|li|table|blockquote|pre|header|footer|nav|aside|form|body|html)[\s/>])"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:" + _EMBEDDED + r")(?=[\s/])[^>]*/>"
    r"|<(?P<embedded>" + _EMBEDDED + r")(?=[\s/>])[^>]*>(?:(?:(?!<(?P=embedded)[\s/>]).)*?</(?P=embedded)\s*>|.*?" + _BLOCK_AHEAD + r"|.*\Z)"
    r"|<(?P<opaque>" + "|".join(w for w in OPAQUE.split() if w not in _EMBEDDED.split("|")) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=opaque)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>" + _ATTRIBUTES + r")>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


# Names that say what an element has, not what it is: ``has-sidebar``, ``no-ads``.
_HAS = re.compile(r"\b(?:has|with|without|no|non|not)-[\w-]+")


def _named(rest: str) -> set[str]:
    values = (m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(rest))
    return {word for value in values for word in _WORD.findall(_HAS.sub(" ", value.lower()))}


def _kind(tag: str, rest: str, in_article: bool) -> str | None:
    """``furniture``, ``header`` (of which an article keeps the headings), or None."""
    if tag in ("html", "body"):
        return None
    words = _named(rest) if rest else set()
    if tag in CONTAINERS:
        return "furniture" if words & NOT_THE_ARTICLE else None
    if in_article and tag in TEXT_FLOW:
        # a paragraph is called after what it is about, too
        return "furniture" if words & NOT_THE_TEXT or (rest and _HIDDEN.search(rest)) else None
    if tag == "header" or words & HEADER_WORDS:
        kind = "header" if in_article else "furniture"
        return "furniture" if words & (FURNITURE_WORDS - HEADER_WORDS) else kind
    return "furniture" if tag in FURNITURE or words & FURNITURE_WORDS or (rest and _HIDDEN.search(rest)) else None


def page_lines(page: str) -> list[tuple[str, bool]]:
    """(line, in an article) of a page, without markup and furniture, in page order.

    A line is the text between two block boundaries, character references decoded, white space as single spaces. If the
    page has article or main elements that hold a quarter of its characters or more, lines outside them are left out; otherwise
    they are teasers, and the comparison with the neighbour decides on the lines outside. A header inside an article keeps
    its headings.
    """
    lines: list[tuple[str, bool]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, and whether furniture, a container, an article's header begins here
    opened: dict[str, int] = {}
    dark = articles = headers = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            lines.append((text, articles > 0))

    def close(upto: int) -> None:
        nonlocal dark, articles, headers
        while len(stack) > upto:
            tag_, furniture, container, header = stack.pop()
            opened[tag_] -= 1
            dark -= furniture
            articles -= container
            headers -= header

    at = 0
    for token in _TOKEN.finditer(page):
        if not dark and token.start() > at:
            pieces.append(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br" or tag == "wbr":
            if not dark and tag == "br":
                pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if token["close"]:
            for depth in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if (stack[depth][1] or stack[depth][2]) and tag not in STRUCTURE:
                    break  # a stray end tag does not end what is around it
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if tag == "li" and stack and stack[-1][0] == "li":
            close(len(stack) - 1)
        kind = _kind(tag, token["rest"] or "", articles > 0)
        # of an article's header only the headings are text
        furniture = kind == "furniture" or (headers > 0 and tag in BLOCKS and tag not in HEADINGS | {"div", "section"})
        container = tag in CONTAINERS and not furniture and not dark
        stack.append((tag, furniture, container, kind == "header"))
        opened[tag] = opened.get(tag, 0) + 1
        dark += furniture
        articles += container
        headers += kind == "header"
    if not dark and at < len(page):
        pieces.append(page[at:])
    flush()
    held = sum(len(text) for text, inside in lines if inside)
    if held and 4 * held >= sum(len(text) for text, _ in lines):
        return [(text, True) for text, inside in lines if inside]
    return lines


def shared_lines(own: list[str], other: list[str]) -> list[bool]:
    """Which lines of ``own`` are in a longest common subsequence with ``other``.

    Lines that only one side has are in no common subsequence, so they are put aside first; equal beginnings and ends
    are matched without a table.
    """
    common = set(own) & set(other)
    left = [i for i, line in enumerate(own) if line in common]
    right = [line for line in other if line in common]
    marked = [False] * len(own)
    begin = 0
    while begin < min(len(left), len(right)) and own[left[begin]] == right[begin]:
        marked[left[begin]] = True
        begin += 1
    end_l, end_r = len(left), len(right)
    while end_l > begin and end_r > begin and own[left[end_l - 1]] == right[end_r - 1]:
        end_l, end_r = end_l - 1, end_r - 1
        marked[left[end_l]] = True
    a, b = left[begin:end_l], right[begin:end_r]
    # rows of the length table as bit sets over a: bit i of row j tells whether the length grows at a[i]
    places: dict[str, int] = {}
    for i, at in enumerate(a):
        places[own[at]] = places.get(own[at], 0) | 1 << i
    full, row, rows = (1 << len(a)) - 1, (1 << len(a)) - 1, []
    for line in b:
        rows.append(row)
        match = row & places.get(line, 0)
        row = ((row + match) | (row - match)) & full
    rows.append(row)
    i = len(a)
    for j in range(len(b), 0, -1):
        # where the row above has the same length at i, b[j - 1] is not needed
        low = (1 << i) - 1
        while i and (rows[j] & low).bit_count() != (rows[j - 1] & low).bit_count():
            if own[a[i - 1]] == b[j - 1]:
                marked[a[i - 1]] = True
                i -= 1
                break
            i -= 1
            low >>= 1
    return marked


def main_lines(lines: list[tuple[str, bool]], neighbour: list[tuple[str, bool]] | None) -> list[str]:
    """Lines that are left when those shared with the neighbour are deleted.

    Lines in an article stay in any case: articles are printed on several pages, and a copy of an article is not
    furniture. A page that shares all its lines is a copy, of which nothing can be learned: it keeps them.
    """
    own = [text for text, _ in lines]
    if neighbour is None or all(inside for _, inside in lines):
        return own
    shared = shared_lines(own, [text for text, _ in neighbour])
    if all(shared):
        return own
    return [text for (text, inside), both in zip(lines, shared) if inside or not both]


def _alike(a: str, b: str) -> int:
    """Characters that two paths begin with in common."""
    for n, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return n
    return min(len(a), len(b))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: (id, url, text, n_chars): the main text, its lines joined by two newlines.

    Pages become text lines in the task that reads them. Each is paired with the page of the nearest URL on its host: of
    the pages before and after it in the order of host, path and id, the one whose path begins alike for longer (the
    earlier one if equal). Lines are aligned by longest common subsequence and shared ones deleted; see ``main_lines`` for
    those that stay in any case.

    The order is dealt to parts with known cut points, and the pages at the ends of a part are also sent to the next part
    as neighbours, so the pairs do not depend on the cuts and a host with very many pages is no task of its own. A task
    holds three pages at a time.

    NULL pages and pages without text give an empty text. A NULL URL, or one without ``://``, has an empty host; these
    pages are one host. Repeated rows are neighbours of each other and so copies. NULL ids come first. Other columns are
    not looked at. An empty table gives no rows.
    """
    spark = pages.sparkSession
    parts = shuffle_partitions(spark)
    host, path = host_and_path(text_of(url_column))
    number = F.coalesce(plain(id_column).cast("long"), F.lit(-(2**63)).cast("long"))
    keys = pages.select(host.alias("host"), path.alias("path"), number.alias("number"))
    points = cut_points(keys, parts)
    part = part_of(points, F.col("host"), F.col("path"), F.col("number"))
    ends = keys.withColumn("part", part).groupBy("part").agg(
        F.min(F.struct("host", "path", "number")).alias("first"), F.max(F.struct("host", "path", "number")).alias("last")
    ).orderBy("part").collect()  # one row per part
    sent: dict[tuple, list[int]] = {}
    for here, there in zip(ends, ends[1:]):
        sent.setdefault(tuple(here["last"]), []).append(there["part"])
        sent.setdefault(tuple(there["first"]), []).append(here["part"])

    rows = pages.select(
        plain(id_column).alias("id"), plain(url_column).alias("url"), host.alias("host"), path.alias("path"),
        number.alias("number"), text_of(html_column).alias("html"),
    ).withColumn("part", part)
    schema = rows.drop("html").schema.add("lines", T.BinaryType()).add("guest", T.BooleanType())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "html"):
            packed = [zlib.compress(json.dumps(page_lines(t)).encode(), 1) for t in batch.column("html").to_pylist()]
            kept = batch.drop_columns(["html"])
            columns = [*kept.columns, pa.array(packed, pa.binary()), pa.array([False] * batch.num_rows)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
            guests = [
                dict(zip(kept.schema.names, (c[i].as_py() for c in kept.columns))) | {"part": other, "lines": packed[i], "guest": True}
                for i, key in enumerate(zip(*(kept.column(c).to_pylist() for c in ("host", "path", "number"))))
                for other in sent.get(key, ())
                if other != kept.column("part")[i].as_py()
            ]
            if guests:
                yield pa.RecordBatch.from_pylist(guests, schema=pa.schema([(n, c.type) for n, c in zip(schema.names, columns)]))

    dealt = rows.mapInArrow(read, schema).repartitionById(parts, F.col("part")).sortWithinPartitions("host", "path", "number", "lines")
    out = pages.select(plain(id_column).alias("id"), plain(url_column).alias("url")).schema.add("text", T.StringType())

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flow():
            for batch in batches:
                columns = [batch.column(c) for c in ("host", "path", "guest", "id", "url", "lines")]
                for i in range(batch.num_rows):
                    *key, raw = (c[i].as_py() for c in columns)
                    yield (*key, [tuple(line) for line in json.loads(zlib.decompress(raw))])
            yield None

        before = now = None
        done: list[tuple] = []
        size = 0
        for after in flow():
            if now is not None and not now[2]:
                near = [(-_alike(now[1], page[1]), page) for page in (before, after) if page is not None and page[0] == now[0]]
                neighbour = min(near, key=lambda x: x[0])[1][5] if near else None
                text = "\n\n".join(main_lines(now[5], neighbour))
                done.append((now[3], now[4], text))
                size += len(text)
                if size > 4_000_000 or len(done) >= 2000:
                    yield _batch(done)
                    done, size = [], 0
            before, now = now, after
        if done:
            yield _batch(done)

    def _batch(done: list[tuple]) -> pa.RecordBatch:
        ids, urls, texts = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], out.names)

    return dealt.mapInArrow(pair, out).select(
        F.col("id").alias(id_column), F.col("url").alias(url_column), "text", F.length("text").cast("long").alias("n_chars")
    )
