"""Main text of pages by differencing each page with its nearest page of the same host.

A page becomes lines: one per block element, each with the kind of container it stands in. The
nearest page shares the longest URL path prefix on the same host; among those the smallest or, for
that page itself and its equals, the largest (path, page_id) is taken. The lines of the two pages
are aligned by longest common subsequence and shared lines are deleted. In an article a shared line
may also be a passage that two articles have, which is still their text. There it is deleted only if
it stands on ``REPEATED`` of the host's pages too and the larger part of the article is not
of that kind, so that copies keep their text. Lines in containers that are never main text
(navigation, header, footer, sidebar, notice, advert, comments) are deleted with or without a
partner. A form or a container that only its class or id speaks against is none where an article or
main element opens inside it. Articles of comments, adverts, menus and related pages stay out, those
of sidebars and the like too if the page has others. A form, or a wrapper whose name tells the
layout, is none either if it holds most of a page without articles.

Partners come from a minimum and a maximum per (host, path prefix), so a host with a third of all
pages is one small row per prefix. Repeated lines are counted over all different pages of a host; a
host with fewer than ``LEAST_PAGES`` has none. Only line hashes of partners, and those of repeated
lines, are joined to pages.

Defined cases: null or empty html gives an empty text; a null or unparsable url has host "" and path
"". Path prefixes are compared to a depth of ``DEPTH`` segments. Repeated rows keep their own row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import common

DEPTH = 8
LEAST_PAGES = 3
REPEATED = 0.75

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_CLASS = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
# Elements whose content is no text at all; the rest of the page is read from their end tag on.
_RAW = frozenset("script style noscript template iframe object svg math textarea title select head".split())
_RAW_TEXT = frozenset("script style textarea title iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img".split())
_IN_PARAGRAPH = _INLINE | {"p"}
_BOILERPLATE = frozenset("nav header footer aside form menu dialog button fieldset".split())
_CONTENT = frozenset(["article", "main"])
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isements?|ising)?|banners?|sponsor(?:ed|s)?|promo(?:tion|s)?|nav(?:bar|igation)?|menus?|"
    r"breadcrumbs?|sidebars?|footers?|headers?|masthead|cookies?|consent|gdpr|notices?|popups?|modal|"
    r"newsletters?|subscribe|subscription|share|social|related|recommended|comments?|replies|disqus|"
    r"pagination|pager|toolbar|login|search|widgets?)(?:$|[\s_-])", re.IGNORECASE)

# Names of containers whose articles are not the page's own, and names that tell the layout of a wrapper.
_OWN_ARTICLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:ed|s)?|promo(?:tion|s)?|nav(?:bar|igation)?|menus?|"
    r"footers?|related|recommended|comments?|replies|disqus)(?:$|[\s_-])", re.IGNORECASE)
_HAS_LAYOUT = re.compile(r"(?:has|no|with|without)[_-]", re.IGNORECASE)
_LAYOUT = re.compile(r"[_-](?:wrap|wrapper|container|layout)$", re.IGNORECASE)

CONTENT, PLAIN, BOILERPLATE = 2, 1, 0
# Inside containers that are boilerplate by name, the weaker the larger; in an article of a NAMED one.
FOREIGN, NAMED, WRAPPED, SIDE = -3, -2, -1, 3


def page_lines(html: str) -> list[tuple[int, str]]:
    """(kind, text) per block, in page order, with references decoded and white space folded."""
    lines: list[tuple[int, str]] = []
    piece: list[str] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    kind = PLAIN

    def flush() -> None:
        text = " ".join(unescape("".join(piece)).split())
        piece.clear()
        if text:
            lines.append((kind if kind > NAMED else BOILERPLATE, text))

    at, n = 0, len(html)
    while at < n:
        tag = _TOKEN.search(html, at)
        if not tag:
            piece.append(html[at:])
            break
        piece.append(html[at:tag.start()])
        at = max(tag.end(), at + 1)
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                piece.append(tag[0][9:].removesuffix("]]>"))
            continue
        if not tag[1]:
            if name in _RAW_TEXT:  # no markup inside: skip to the end tag
                if name not in _INLINE:
                    flush()
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
                continue
            if name not in _INLINE and name != "br":
                flush()
            elif name == "br":
                piece.append(" ")
            if name in _VOID or tag[3].endswith("/") and name not in _CONTENT | _BOILERPLATE:
                continue
            if name == "p":  # a paragraph ends where the next begins
                while opened["p"] and stack[-1][0] in _IN_PARAGRAPH:
                    opened[stack.pop()[0]] -= 1
                kind = stack[-1][1] if stack else PLAIN
            stack.append((name, _kind_in(name, tag[3], kind)))
            opened[name] += 1
            kind = stack[-1][1]
        else:
            if name not in _INLINE and name != "br":
                flush()
            if opened[name]:
                last = ""
                while last != name:
                    last = stack.pop()[0]
                    opened[last] -= 1
                kind = stack[-1][1] if stack else PLAIN
    flush()
    size: Counter[int] = Counter()
    for found, text in lines:
        size[found] += len(text)
    side = BOILERPLATE if size[CONTENT] else CONTENT
    most = not size[CONTENT] and not size[SIDE] and size[WRAPPED] > size[PLAIN]
    settled = {SIDE: side, WRAPPED: PLAIN if most else BOILERPLATE}
    return [(settled.get(found, found), text) for found, text in lines]


def _kind_in(name: str, attributes: str, outer: int) -> int:
    if outer == BOILERPLATE or name in _BOILERPLATE and name != "form" or name in _RAW:
        return BOILERPLATE
    if name == "main" or name == "article" and outer != FOREIGN:
        inner = SIDE if name == "article" and outer in (NAMED, SIDE) else CONTENT
    else:
        inner = min(outer, WRAPPED) if name == "form" else outer
    if attributes and name not in ("html", "body"):
        for key, value in _CLASS.findall(attributes):
            value = value.strip("\"'")
            if key.lower() == "role" and value.lower() in (
                    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
                return BOILERPLATE
            if key.lower() in ("class", "id") and name not in _CONTENT:
                inner = min([inner, *map(_kind_of_name, value.split())])
    return inner


def _kind_of_name(token: str) -> int:
    if not _BAD_NAME.search(token):
        return SIDE
    if _HAS_LAYOUT.match(token):
        return WRAPPED
    if _OWN_ARTICLES.search(token):
        return FOREIGN
    return WRAPPED if _LAYOUT.search(token) else NAMED


def line_hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b`` (Hunt and Szymanski)."""
    lead = 0
    while lead < len(a) and lead < len(b) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[int, list[int]] = defaultdict(list)
    for j in range(len(b) - tail - 1, lead - 1, -1):
        places[b[j]].append(j)
    ends: list[int] = []
    best: list[tuple] = []
    for i in range(lead, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            if k < len(ends) and ends[k] == j:
                continue
            node = (i, best[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                best.append(node)
            else:
                ends[k], best[k] = j, node
    middle, node = [], best[-1] if best else None
    while node:
        middle.append(node[0])
        node = node[1]
    return [*range(lead), *reversed(middle), *range(len(a) - tail, len(a))]


def main_text(lines: list[tuple[int, str]], partner: list[int] | None, repeated: list[int] | None = None) -> str:
    """The lines of a page without boilerplate and without what its partner shares; in an article
    only ``repeated`` lines of the host count as shared, and only if most of the article is not.
    Where a page has an article, that is its main text; other lines count where it has none."""
    hashes = [line_hash(text) for _, text in lines]
    shared = set(common_subsequence(hashes, partner)) if partner else set()
    has_article = any(kind == CONTENT for kind, _ in lines)
    least = CONTENT if has_article else PLAIN
    if has_article and shared:
        known = set(repeated or ())
        shared = {i for i in shared if hashes[i] in known}
        size = [len(text) if kind == CONTENT else 0 for kind, text in lines]
        if 2 * sum(size[i] for i in shared) >= sum(size):
            shared = set()
    return " ".join(text for i, (kind, text) in enumerate(lines) if kind >= least and i not in shared)


def _url_parts(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url"),
        common.text_or_empty("html").alias("html"),
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        path.alias("path"))


def nearest_pages(pages: DataFrame) -> DataFrame:
    """(page key, partner key, host as a number): needs ``key``, ``host``, ``path`` and ``page_id``. A key stands for
    a url and its html, so equal rows share one and are never partners of each other."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    keys = pages.select("key", "host", "path", "page_id", segments.alias("segments"))
    depth = F.least(F.size("segments"), F.lit(DEPTH))
    prefixed = keys.select(
        "key", F.struct("path", "page_id", "key").alias("place"), "host",
        F.explode(F.sequence(F.lit(0), depth)).alias("depth"), "segments",
    ).select("key", "place", "depth", F.xxhash64(
        "host", "depth", F.array_join(F.expr("slice(segments, 1, depth)"), "/")).alias("prefix"))
    ends = prefixed.groupBy("prefix").agg(
        F.min("place").alias("low"), F.max("place").alias("high")).filter(
        F.col("low.key") != F.col("high.key"))
    partner = F.when(F.col("low.key") != F.col("key"), F.col("low.key")).otherwise(F.col("high.key"))
    return prefixed.join(ends, "prefix").groupBy("key").agg(
        F.max_by(partner, "depth").alias("partner_key"), F.min_by("prefix", "depth").alias("host"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(host, hashes of the lines that ``REPEATED`` of its pages have); ``lines`` has one row per different page."""
    number = lines.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    held = lines.select("host", F.explode(F.array_distinct("partner")).alias("line"))
    return held.groupBy("host", "line").agg(F.count("*").alias("on")).join(number, "host").filter(
        F.col("on") >= REPEATED * F.col("n")).groupBy("host").agg(F.collect_list("line").alias("repeated"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``."""
    parts = _url_parts(pages).withColumn("key", F.xxhash64("host", "path", "html"))
    near = nearest_pages(parts)

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [[line_hash(t) for _, t in page_lines(h.as_py())] for h in batch.column(2)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lines, pa.list_(pa.int64()))], ["partner_key", "host", "partner"])

    host = F.xxhash64("host", F.lit(0), F.lit("")).alias("host")  # the prefix of depth 0
    # Hashed where they are read: only hashes are shuffled.
    lines = common.written(common.per_batch(
        parts.select("key", host, "html"), hashed, "partner_key bigint, host bigint, partner array<bigint>"
    ).dropDuplicates(["partner_key"]), "page-lines")
    partners = near.join(lines.drop("host"), "partner_key").join(repeated_lines(lines), "host", "left").select(
        "key", "partner", "repeated").dropDuplicates(["key"])

    def extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page_lines(h), p, r) for h, p, r in zip(
            *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return common.per_batch(
        parts.join(partners, "key", "left").select("page_id", "url", "html", "partner", "repeated"),
        extracted, "page_id bigint, url string, text string, n_chars bigint")


def op10_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
