"""Main text of web pages: differencing against the page of the nearest url."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import BROADCAST_BYTES, join_groups, numbered, stage
from pluvio.llm.urls import url_parts

#: Elements that end a block of text.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no prose of the page, and those whose content is not markup.
ASIDE = frozenset("nav header footer aside form head title button select option textarea input label iframe object svg canvas noscript "
                  "template dialog menu".split())
RAW = frozenset("script style textarea title".split())
MAIN = frozenset(("article", "main"))
#: Words of class, id and role that mark menus, notices, adverts and reader comments.
MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|contentinfo|cookies?|consent|disqus|foot(?:er)?|"
                   r"header|menu|modal|nav\w*|newsletter|notices?|popup|promo\w*|related|replies|search|share|sharing|sidebar|social|"
                   r"sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
#: Marks of a whole article, and elements of text, whose classes often are words of the text's own subject.
MAIN_MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|disqus|promo\w*|related|replies|sponsor\w*)(?:$|[\s_-])", re.I)
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr caption figcaption span a b i em strong small mark q cite code time".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
#: What a line is in: an element that is not prose, the page itself, its main element.
OUT, OPEN, KEPT = 0, 1, 2
#: Text of which a page shares this part with another is a copy; nothing in it is a template's.
#: Places of a line in a page beyond which their row of bits is kept.
COPY, FREQUENT = 0.8, 1000


def marked(name: str, attributes: str) -> bool:
    """Whether an element's class, id or role says that it is no prose of the page.

    Containers go by any word of theirs. Elements of text, and articles, go by an
    attribute that has no other word (``class="ad"``, not ``class="social housing"``
    or ``share-price``); articles also by the words of MAIN_MARKS.
    """
    for found in ATTRIBUTE.findall(attributes):
        value = "".join(found)
        if not MARKS.search(value):
            continue
        if name not in TEXT and name not in MAIN or name in MAIN and MAIN_MARKS.search(value):
            return True
        if all(MARKS.search(word) for word in re.split(r"[\s_-]+", value) if word):
            return True
    return False


def page_lines(html: str) -> list[tuple[int, str]]:
    """The page's blocks in order: (OUT, OPEN or KEPT, text), without empty ones."""
    lines: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the state in them
    state = OPEN

    def close() -> None:
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                lines.append((state, text))
            parts.clear()

    at, end = 0, len(html)
    while at < end:
        tag = TAG.search(html, at)
        if not tag:
            parts.append(html[at:])
            break
        if tag.start() > at:
            parts.append(html[at:tag.start()])
        at = max(tag.end(), at + 1)
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            close()
        if tag[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    outer = stack[-1][1] if stack else OPEN
                    if outer != state:
                        close()
                    state = outer
                    break
            continue
        if name in RAW:
            raw = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = raw.end() if raw else end
            continue
        if name in VOID or tag[3].endswith("/"):
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):  # whose end may be left out
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    state = stack[-1][1] if stack else OPEN
                    break
                if stack[k][0] in ("ul", "ol", "table", "dl", "div", "section", "article", "main", "body"):
                    break
        inner = state
        if state != OUT:
            if name in ASIDE or name not in ("html", "body") and marked(name, tag[3]):
                inner = OUT
            elif name in MAIN:
                inner = KEPT
        if inner != state:
            close()
        state = inner
        stack.append((name, state))
    close()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of one longest common subsequence, by rows of bits.

    Lines that the other page lacks are left out first. Every k-th row is kept, k
    the square root of their number, and those between are made again on the walk
    back, so two pages of n lines take n ** 1.5 / 4 bytes and no n * n.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = [(i, i) for i in range(head)]
    both = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    at = [i for i in range(head, len(a) - tail) if a[i] in both]
    bt = [j for j in range(head, len(b) - tail) if b[j] in both]
    x, y = [a[i] for i in at], [b[j] for j in bt]
    where: dict[int, list[int]] = {}
    for j, line in enumerate(y):
        where.setdefault(line, []).append(j)
    every = (1 << len(y)) - 1

    def row_of(places: list[int]) -> int:
        row = bytearray(len(y) // 8 + 1)
        for j in places:
            row[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(row, "little")

    frequent = {line: row_of(places) for line, places in where.items() if len(places) > FREQUENT}

    def following(bits: int, lines: list[int]) -> Iterator[int]:
        for line in lines:
            hit = bits & (frequent[line] if line in frequent else row_of(where[line]))
            bits = (bits + hit | bits - hit) & every
            yield bits

    step = math.isqrt(len(x)) + 1
    kept = [every]
    for i, bits in enumerate(following(every, x), 1):
        if i % step == 0:
            kept.append(bits)
    i, j, middle = len(x), len(y), []
    first, rows = len(x) + 1, []
    while i and j:
        if i - 1 < first:  # the rows from the kept one at or before i - 1 up to i
            first = (i - 1) // step * step
            rows = [kept[first // step], *following(kept[first // step], x[first:i])]
        upper, lower = rows[i - 1 - first], rows[i - first]
        # the row's set bits are places of y that add no line; those that differ in two rows tell where a line was found
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            middle.append((at[i], bt[j]))
        elif upper == lower or (upper & (1 << j) - 1).bit_count() == (lower & (1 << j) - 1).bit_count():
            i -= 1
        else:
            j -= 1
    found += reversed(middle)
    return found + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, states, hashes, sizes = [], [], [], []
        for html in batch["html"]:
            lines = [x for x in page_lines(html.as_py() or "")]
            texts.append([t for k, t in lines if k != OUT])
            states.append([k for k, _ in lines])
            hashes.append([xxhash.xxh64_intdigest(t) - 2**63 for _, t in lines])
            sizes.append([len(t) for _, t in lines])
        out = [*(batch[c] for c in ("page_id", "url", "page", "host", "path")), pa.array(texts, pa.list_(pa.string())),
               pa.array(states, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(out, ["page_id", "url", "page", "host", "path", "texts", "states", "hashes", "sizes"])


def parse_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, page (hash of the html), host, path, texts (blocks that may stay), states, hashes and sizes of all blocks."""
    host, path = url_parts(F.col("url"))
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", F.xxhash64(F.coalesce("html", F.lit(""))).alias("page"), host.alias("host"), path.alias("path"), "html")
    return rows.mapInArrow(_parse, f"page_id {kind}, url string, page long, host string, path string, texts array<string>, "
                                   "states array<int>, hashes array<long>, sizes array<int>")


def lost(page: dict, shared: set[int]) -> set[int]:
    """Of the places that a page shares with another, those whose blocks go: the open ones.

    Text in main elements and beside them are judged apart: a page that shares
    COPY of what it has of either is a copy and loses nothing. Paragraphs of main
    elements stay, as articles of one host have some in common.
    """
    hit, copied = {}, True
    for kind in (OPEN, KEPT):
        at = {i for i, state in enumerate(page["states"]) if state == kind}
        hit[kind] = at & shared
        copied &= sum(page["sizes"][i] for i in hit[kind]) >= COPY * sum(page["sizes"][i] for i in at)
    return set() if copied else hit[OPEN]


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the two or three neighbours of a row, the places of the blocks that each loses."""
    for batch in batches:
        hosts, pages, gone = [], [], []
        for host, near in zip(batch["host"].to_pylist(), batch["near"].to_pylist()):
            near.sort(key=lambda p: p["place"])
            shared = [set() for _ in near]
            for k in range(1, len(near)):
                a, b = near[k - 1], near[k]
                both = common_lines(a["hashes"], b["hashes"])
                for own, side, page in ((shared[k - 1], 0, a), (shared[k], 1, b)):
                    own |= lost(page, {p[side] for p in both})
            for page, own in zip(near, shared):
                if own:
                    hosts.append(host)
                    pages.append(page["page"])
                    gone.append(sorted(own))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
                                         ["host", "page", "gone"])


def shared_lines(parsed: DataFrame) -> DataFrame:
    """(host, page, gone): places of the blocks that a page loses, as it shares them with the nearest of its host.

    Pages of a host stand in order of their paths and are compared in pairs, the
    last three together if their number is odd; copies of a page are one. Only
    hashes of the blocks move, and a pair is a few rows however large its host.
    """
    different = (parsed.filter("host <> ''").groupBy("host", "page")
                 .agg(F.min_by(F.struct("path", "hashes", "sizes", "states"), F.struct("path", "url")).alias("p"))
                 .select("host", "page", "p.*"))
    placed = numbered(different, ["host", "path", "page"], "place")
    hosts = stage(placed.groupBy("host").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    pair = F.greatest(F.lit(0), F.least(F.expr("(place - first) div 2"), F.expr("n div 2 - 1")))
    # dealt by pair: a partitioning by host would leave all pairs of a host in one task
    pairs = (join_groups(placed, hosts, "host").withColumn("pair", pair).repartition("host", "pair").groupBy("host", "pair")
             .agg(F.collect_list(F.struct("place", "page", "hashes", "sizes", "states")).alias("near")).select("host", "near"))
    return pairs.mapInArrow(_difference, "host string, page long, gone array<int>")


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars.

    Text of the page: blocks in its main elements, and of those beside them or
    of a page without any, what it doesn't share with the page of the nearest
    url. Menus, headers, footers,
    sidebars, notices, adverts, forms and comments go by their elements and
    marks, main elements with such a mark too. Null html is empty; pages without
    a host have no neighbours; repeated rows stay; an empty table gives an empty
    result.
    """
    parsed = stage(parse_pages(pages))
    gone = stage(shared_lines(parsed))
    size = gone.agg(F.sum(F.octet_length("host") + 8 + 4 * F.size("gone"))).first()[0] or 0
    # places of the blocks that may stay
    stay = F.filter(F.transform("states", lambda s, i: F.struct(s.alias("s"), i.alias("i"))), lambda x: x["s"] != OUT)
    left = F.filter("texts", lambda t, i: ~F.array_contains("gone", F.get(F.col("stay"), i)["i"]))
    text = F.when(F.col("gone").isNull(), F.array_join("texts", "\n")).otherwise(F.array_join(left, "\n"))
    joined = parsed.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, ["host", "page"], "left")
    return joined.withColumn("stay", F.when(F.col("gone").isNotNull(), stay)).select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
