"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: its elements, told apart by their path of
elements and classes, and its text blocks, told apart by path and text.  A token's
occurrence vector says how often each page of the host has it.  Tokens of one
vector form an equivalence class; a class is valid if its tokens come in one order on
every page, and is nested in the template if it always lies in one gap between
the tokens of the class that all pages share.  Text that belongs to a valid,
nested class of most of a host's pages was written by the template, not by the
author.  What is left are slots; the elements that enclose a slot tell whether it holds
the article or a menu, advert, form and the like.

Vectors are never built: a token's vector is summed up as a hash that pages add to one by one,
so a host may have any number of pages and is aggregated before the shuffle.  Every text block is a token, in the
article or not; elements and classes only tell which of the slots left by the template is the article.
Pages with one and the same content count once, else the copies of an article would look like a template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, pinned, tidy
from applens.llm.url_filter import host_and_path

MIN_PAGES = 3           # differing pages that must hold a text before it can belong to the template
MIN_SHARE = 0.5         # and their share of the host's differing pages
BROADCAST_TOKENS = 500_000      # 8 bytes each; larger template tables are joined by a shuffle
SALTS = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noscript xmp".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
                   "summary table tbody td tfoot th thead title tr ul".split())
_MAIN = frozenset(("article", "main"))
_SKIPPED = frozenset("aside audio button canvas dialog footer form head iframe input label menu nav noscript object script select "
                     "style svg template textarea title video".split())
_SKIPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words in classes and ids that name what is not the article.
_SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login menu menus nav "
    "navbar navigation breadcrumb breadcrumbs sidebar sidebars rail widget widgets footer masthead topbar comment comments reply "
    "replies respond disqus discussion share sharing social related recommended recommendations pagination pager toolbar search "
    "skip".split())
# Those of them that name a box of other texts than the page's own; the rest may as well describe the layout around an article.
_LISTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion popup modal overlay "
    "newsletter sidebar sidebars rail widget widgets comment comments reply replies respond disqus discussion related recommended "
    "recommendations".split())
_ENTRIES = frozenset("comment comments reply replies card cards teaser teasers".split())     # articles of such a box
# Words that go with them in the name of such a box.  Within an article a name with any other word is the author's (related-work).
_BOX_WORDS = frozenset(
    "area articles author avatar bar block body bottom box button buttons card cards center column component container content count cta "
    "date desktop email entry facebook feed fixed form google group header heading icon icons inline inner item items js label large "
    "leaderboard left link links list main media meta mobile module name next outer panel post posts prev previous reading right row "
    "section slot small sticky stories story text thread title to tools top twitter unit videos whatsapp wrap wrapper".split())
_HAS = re.compile(r"(?<!\S)(?:has|with|without|no)[-_]\S*")           # classes that say what is inside or missing
# An open element that a start tag ends, up to the nearest of the elements that hold it.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
         "option": (("option",), ("select",)),
         # a menu or page head left open does not hold the article
         "article": (("nav", "header"), ("article", "main", "aside", "footer", "section")),
         "main": (("nav", "header"), ("article", "aside", "footer"))}
LISTED = 1000


@dataclass
class Block:
    path: int              # hash of the enclosing elements' names and classes
    text: str
    token: int             # hash of path and text
    skipped: bool          # an enclosing element says it is not the article
    main: int              # number of the innermost article or main around it, 0 if there is none
    depth: int             # elements around that article whose class says it is not one, LISTED for a box of other texts; -1 in main itself


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    # (hash, 1 for a text block or 0 for an element), in page order
    tokens: list[tuple[int, int]] = field(default_factory=list)


def _hash(parent: int, *parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"), parent & (1 << 64) - 1)


def _names_box(name: str) -> bool:
    """Whether a class or id names what is not the article, with no word beside that a box would not have."""
    words = {w.lower() for w in _WORDS.findall(name)}
    return not words.isdisjoint(_SKIPPED_WORDS) and words <= _SKIPPED_WORDS | _BOX_WORDS


def parse(html: str) -> Page:
    """Elements and text blocks of a page; lenient about tags left open, stray ends and cut-off pages."""
    page = Page()
    # (name, path, skipped: 1 as a block or 2 within one, number of the article, whether an element's name or role
    # skips it, depth of classes that do, depth of the article)
    stack: list[tuple[str, int, int, int, bool, int, int]] = [("", 0, 0, 0, False, 0, -1)]
    # where in the stack each name's open elements are, and the blocks: no tag searches the elements left open
    places: dict[str, list[int]] = {}
    blocks = [0]
    parts: list[str] = []
    mains = 0

    def nearest(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(depth: int) -> None:
        for i in range(len(stack) - 1, depth - 1, -1):
            places[stack[i][0]].pop()
            if blocks[-1] == i:
                blocks.pop()
        del stack[depth:]

    def flush() -> None:
        if not parts:
            return
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, path, skipped, main, _, _, depth = at[0] if at else stack[-1]
            token = _hash(path, text)
            page.blocks.append(Block(path, text, token, skipped > 0, main, depth))
            page.tokens.append((token, 1))
        at.clear()

    at: list[tuple[str, int, int, int, bool, int, int]] = []          # where the block under way began
    pos, end = 0, len(html)
    while pos < end:
        m = _TOKEN.match(html, pos)
        pos = m.end()
        text = m["text"]
        if text is not None:
            if stack[-1][2] == 2:
                continue
            if not at and not text.isspace():
                at.append(stack[blocks[-1]])
            parts.append(text)
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            depth = nearest((name,))
            if name in _BLOCK or 0 < depth <= blocks[-1]:
                flush()
            if depth:
                close(depth)
            continue
        if name == "br":
            parts.append("\n")
            continue
        attrs = m["attrs"] if m["name"] else m["attrs2"]
        if name in _BLOCK:
            flush()
            if stack[blocks[-1]][0] == "p":                     # a block ends an open paragraph
                close(blocks[-1])
        if name in _ENDS:
            ended, holders = _ENDS[name]
            if nearest(ended) > nearest(holders):
                close(nearest(ended))
        _, path, skipped, main, never, words, depth = stack[-1]
        kinds, marks, never_here, skip_here = "", frozenset(), False, False
        if attrs and "=" in attrs:
            found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            kinds = found.get("class", "")
            marks = {w.lower() for k in ("class", "id") if k in found for w in _WORDS.findall(found[k])}
            never_here = found.get("role", "").lower() in _SKIPPED_ROLES
            skip_here = not marks.isdisjoint(_SKIPPED_WORDS) and (
                not main or any(_names_box(c) for k in ("class", "id") if k in found for c in found[k].split()))
        if name in ("html", "body") or name in _MAIN and "comment" not in marks and "comments" not in marks:
            never_here = skip_here = False                     # a page's own classes name its kind, not what it holds
        if name in _SKIPPED or not main and name == "header":
            never_here = True
        if not main and name in ("div", "section") and "header" in marks:
            skip_here = True
        never = never or never_here
        if skip_here:
            boxes = {w.lower() for k in ("class", "id") if k in found for w in _WORDS.findall(_HAS.sub("", found[k]))}
            words += 1 if boxes.isdisjoint(_LISTS) else LISTED
        path = _hash(path, name, kinds)
        page.tokens.append((path, 0))
        if name in _VOID or attrs and attrs.endswith("/") and name not in _BLOCK:
            continue
        if name in _RAW:
            ending = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, pos)
            pos = ending.start() if ending else end
        if name in _MAIN and not never and not skip_here and not (skipped and marks & _ENTRIES):
            # a class around an article may tell of the layout only; the article's depth says how far to believe it
            mains += 1
            main, skipped = mains, 0
            words = 0 if name == "main" else words
            depth = -1 if name == "main" else words
        elif (never_here or skip_here) and not skipped:
            skipped = 1 if name in _BLOCK else 2
        places.setdefault(name, []).append(len(stack))
        if name in _BLOCK:
            blocks.append(len(stack))
        stack.append((name, path, skipped, main, never, words, depth))
    flush()
    return page


def remaining_text(page: Page, template: set[int]) -> str:
    """Blocks of the slots that hold the article, in page order, one a line.

    The template decides first.  Within an article, the blocks of one path are a slot: it is the template's if all its
    texts are, else its repeated lines stand among the author's and stay.  Of what is left, marked articles are taken if there are any.
    """
    blocks = [b for b in page.blocks if not b.skipped]
    if template:
        own = [_signed(b.token) not in template for b in blocks]
        slots = {(b.main, b.path) for b, o in zip(blocks, own) if o and b.main}
        blocks = [b for b, o in zip(blocks, own) if o or (b.main, b.path) in slots]
    marked = [b for b in blocks if b.main]
    if marked:
        # the articles with the fewest classes against them; those in a box of other texts only if there is nothing else
        least = min((b.depth for b in marked if b.depth >= 0), default=0)
        direct = any(b.depth < 0 for b in marked)
        blocks = [b for b in marked if b.depth < 0 or b.depth == least and not (direct and least >= LISTED)]
    return "\n".join(b.text for b in blocks)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and distinct token."""
    names = ["host", "unit", "token", "is_text", "times", "place"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    for batch in batches:
        rows: list[tuple] = []
        for host, html in zip(batch.column("host").to_pylist(), byte_texts(batch.column("html"))):
            page = parse(html.decode("utf-8", "replace"))
            unit = _signed(xxhash.xxh64_intdigest("\n".join(b.text for b in page.blocks if not b.skipped).encode("utf-8", "surrogatepass")))
            seen: dict[int, list[int]] = {0: [0, 1, -1]}              # token 0 stands for the page itself
            for place, (token, is_text) in enumerate(page.tokens):
                s = seen.setdefault(_signed(token), [is_text, 0, place])
                s[1] += 1
            rows.extend((host, unit, token, *s) for token, s in seen.items())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, template): the text tokens of each host's valid, nested classes.  ``pages`` has host (a number) and html."""
    rows = pages.mapInArrow(tidy(_tokens), "host bigint, unit bigint, token bigint, is_text int, times int, place int")
    # pages of one content, and so of one unit, count once
    rows = pinned(rows.groupBy("host", "unit", "token").agg(F.max("is_text").alias("is_text"), F.max("times").alias("times"),
                                                            F.min("place").alias("place")))
    mark = F.xxhash64("unit", "times")
    low, high = mark.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(mark, 32)
    vectors = rows.groupBy("host", "token").agg(
        F.max("is_text").alias("is_text"), F.count(F.lit(1)).alias("support"), F.max("times").alias("most"),
        F.sum(low).alias("v1"), F.sum(high).alias("v2"))
    n = vectors.filter("token = 0").select("host", F.col("support").alias("n"))
    frequent = (vectors.join(n, "host")
                .filter((F.col("support") >= min_pages) & (F.col("support") >= min_share * F.col("n")) & (F.col("token") != 0)))
    classes = frequent.withColumn("class", F.xxhash64("support", "v1", "v2")).withColumn(
        "is_root", (F.col("support") == F.col("n")) & (F.col("most") == 1))
    held = rows.join(classes.select("host", "token", "class", "is_root", "most", F.col("is_text").alias("text")), ["host", "token"])
    in_page = Window.partitionBy("host", "unit").orderBy("place")
    gap = F.last(F.when(F.col("is_root"), F.col("token")), ignorenulls=True).over(in_page)
    by_page = (held.withColumn("gap", F.coalesce(gap, F.lit(0))).groupBy("host", "unit", "class").agg(
        F.xxhash64(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda x: x["token"])).alias("order"),
        F.min_by("gap", "place").alias("first"), F.max_by("gap", "place").alias("last"), F.first("is_root").alias("is_root")))
    valid = (by_page.groupBy("host", "class").agg(
        F.min("order").alias("o1"), F.max("order").alias("o2"), F.min("first").alias("f1"), F.max("first").alias("f2"),
        F.min("last").alias("l1"), F.max("last").alias("l2"), F.max("is_root").alias("is_root"))
        .filter("o1 = o2 AND (is_root OR (f1 = f2 AND l1 = l2 AND f1 = l1))").select("host", "class"))
    return (classes.filter("is_text = 1").join(valid, ["host", "class"], "left_semi")
            .groupBy("host").agg(F.collect_list("token").alias("template")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[tuple, set[int]] = {}
        texts = []
        for template, html in zip(batch.column("template").to_pylist(), byte_texts(batch.column("html"))):
            key = tuple(template or ())
            texts.append(remaining_text(parse(html.decode("utf-8", "replace")), known.setdefault(key, set(key))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """Per row: page_id, url, text (the article's blocks, one a line; empty if there are none), n_chars (its code points).

    Null and empty html give an empty text; null urls and urls without a host
    form one host of their own; a host of few differing pages has no template and its pages are told by their elements
    alone.  Repeated rows give equal rows; other columns are not read; an empty table gives no rows.
    """
    host, _ = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.xxhash64(host).alias("host"), F.col(html_col).cast("string").alias("html"))
    found = pinned(templates(rows.select("host", "html"), min_pages, min_share))
    size = found.agg(F.sum(F.size("template") + 1)).first()[0] or 0
    if size <= broadcast_tokens:
        told = rows.join(F.broadcast(found), "host", "left")
    else:
        # a host may hold any share of the pages: its rows are dealt over salts, its one template to each of them
        salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS)))).alias("salt")
        told = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            found.select("host", "template", salts), ["host", "salt"], "left")
    return told.select("page_id", "url", "html", "template").mapInArrow(tidy(_extract), "page_id bigint, url string, text string, n_chars bigint")
