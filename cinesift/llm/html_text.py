"""Main text of web pages: site templates are found by counting element subtrees per host.

Every element's subtree is hashed (tag, class, id, text and child subtrees). Spark counts, per
host, the different pages that hold each hash, and subtrees on more than ``MAX_RATIO`` of them
are deleted from all pages of the host.

Rotating boxes stand on fewer pages. A box is a block element that neither stands in a marked
article nor holds one, and is no heading or item of a list or table; its *place* is the path of
tags and classes that leads to it. A box goes from ``BOX_RATIO`` of the pages on if what stands in its place
is by and large such recurring boxes (``SLOT_SHARE`` of all boxes there): an advert's place holds adverts, while
the place of a body's paragraphs holds text of its own on every page, so a paragraph that some
pages share stays.

What templates cannot show (a site of few pages, parts that change with every page) is covered by
the page's own marking: elements that are menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles or reader comments by their tag, role, class or id. What neither shows to be a part
of the site stays, in page order; a marked article (``article``, ``main``) keeps its header and the
wrappers around it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches, written

MAX_RATIO = 0.5
BOX_RATIO = 0.02
SLOT_SHARE = 0.5
MIN_PAGES = 8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Fixed values of the HTML standard.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody tfoot thead tr ul".split())
_SCOPE = set("td th table button caption object template html applet marquee".split())
_CLOSED_BY = {  # an open element that a start tag ends, and where looking for it stops
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_BOXES = _BLOCKS - set("article body caption dd dt h1 h2 h3 h4 h5 h6 hgroup html legend li main optgroup option tbody tfoot thead tr".split())
_OPENS_NO_PARAGRAPH = _BLOCKS - {"body", "html", "option", "optgroup", "tbody", "tfoot", "thead", "tr", "caption", "legend"}
# What marks an element as no part of the article.
_DROP_TAGS = set(
    "head script style noscript template nav footer aside form select button textarea input iframe object svg canvas "
    "dialog menu map audio video title noembed noframes xmp".split())
_DROP_ROLES = set("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
_DROP_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent gdpr notice popup modal overlay comment "
    "comments commentlist respond reply replies disqus share sharing social related newsletter subscribe signup login "
    "pagination pager widget toolbar skip search".split())
_HEADER_WORDS = {"header", "heading"}
_COMMENT_WORDS = set("comment comments commentlist respond reply replies disqus".split())
_BREAK = None  # between blocks; no text can be mistaken for it


class _Frame:
    __slots__ = ("tag", "start", "parts", "junk", "by_name", "ranges", "place")

    def __init__(self, tag: str, start: int, parts: list[bytes], junk: bool, by_name: bool, ranges: int, place: int) -> None:
        self.tag, self.start, self.parts, self.junk, self.by_name, self.ranges = tag, start, parts, junk, by_name, ranges
        self.place = place


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bytes, bytes]:
    """Whether tag or role make an element junk, whether its class or id do, its label for the hash,
    and its step in the path of places (tag and class, without numbers)."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    label = f"{tag}.{found.get('class', '')}#{found.get('id', '')}".encode("utf-8", "replace")
    step = re.sub("[0-9]+", "", f"{tag}.{found.get('class', '')}").encode("utf-8", "replace") if found else tag.encode("utf-8", "replace")
    role = found.get("role", "")
    junk = tag in _DROP_TAGS or role in _DROP_ROLES or (tag == "header" and not in_article)
    names = set(re.split(r"[^a-z]+", f"{found.get('class', '')} {found.get('id', '')}")) if found else set()
    if tag in ("html", "body", "main"):
        return junk, False, label, step
    if tag == "article":
        return junk, bool(names & _COMMENT_WORDS), label, step
    return junk, bool(names & _DROP_WORDS or (names & _HEADER_WORDS and not in_article)), label, step


def parse(page: str, drop: set[int] = frozenset(), article_only: bool = True,
          drop_boxes: set[int] = frozenset()) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """The page's text blocks, the hashes of its elements' subtrees that hold text, and ``(box, place)``
    of those that are boxes, ``box`` being a hash of subtree and place.

    Subtrees whose hash is in ``drop`` are left out of the blocks, and boxes in ``drop_boxes``; with
    ``article_only``, so is what stands outside the articles of a page that marks some.
    """
    out: list[str | None] = []  # pieces of text, and breaks between blocks
    ranges: list[tuple[int, int]] = []  # of pieces that stand in an article
    hashes: list[int] = []
    boxes: list[tuple[int, int]] = []
    stack = [_Frame("", 0, [], False, False, 0, 0)]
    is_open: Counter[str] = Counter()
    articles = 0

    def close() -> None:
        nonlocal articles
        frame = stack.pop()
        is_open[frame.tag] -= 1
        text = any(p[:1] != b"<" for p in frame.parts[1:]) or any(p[:2] == b"<t" for p in frame.parts[1:])
        digest = _hash(b"\x00".join(frame.parts))
        stack[-1].parts.append((b"<t" if text else b"<e") + digest.to_bytes(8, "big", signed=True))
        if text and frame.tag not in ("html", "body", "head"):
            hashes.append(digest)
        is_article = frame.tag in ("article", "main")
        articles -= is_article
        # a wrapper that is named after a part of itself, but holds the article, stays
        holds_none = len(ranges) == frame.ranges
        named = frame.by_name and holds_none
        is_box = text and holds_none and articles == 0 and frame.tag in _BOXES
        box = 0
        if is_box:
            box = _hash(b"%d %d" % (digest, frame.place))
            boxes.append((box, frame.place))
        if frame.junk or named or digest in drop or (is_box and box in drop_boxes):
            del out[frame.start :]
            del ranges[frame.ranges :]
        elif is_article:
            del ranges[frame.ranges :]
            ranges.append((frame.start, len(out)))
        if frame.tag in _BLOCKS:
            out.append(_BREAK)

    def close_open(tags: set[str], until: set[str]) -> None:
        if not any(is_open[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    close()
                return
            if stack[i].tag in until:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            text = entities.unescape(text)
            out.append(text)
            if words := " ".join(text.split()):
                stack[-1].parts.append(words.encode("utf-8", "replace").lstrip(b"<"))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "br":
                out.append(" ")
            elif tag == "p" and not is_open["p"]:
                out.append(_BREAK)
            elif is_open[tag]:
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in _OPENS_NO_PARAGRAPH:
            close_open({"p"}, _SCOPE)
        if tag in _CLOSED_BY:
            close_open(*_CLOSED_BY[tag])
        if tag in _VOID:
            out.append(_BREAK if tag == "hr" else " " if tag == "br" else "")
            continue
        attributes = m[3] or m[6] or ""
        if tag in _RAW:  # its content is no markup
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = stop.start() if stop else end
            if stop:
                at = page.find(">", at) + 1 or end
            continue
        junk, by_name, label, step = _marks(tag, attributes, articles > 0)
        if tag in _BLOCKS:
            out.append(_BREAK)
        elif tag in ("td", "th"):
            out.append(" ")
        place = _hash(b"%d " % stack[-1].place + step)
        stack.append(_Frame(tag, len(out), [label], junk, by_name, len(ranges), place))
        is_open[tag] += 1
        articles += tag in ("article", "main")
    while len(stack) > 1:
        close()
    pieces = [p for a, b in ranges for p in [*out[a:b], _BREAK]] if ranges and article_only else out
    blocks, block = [], []
    for piece in [*pieces, _BREAK]:
        if piece is _BREAK:
            if words := " ".join("".join(block).split()):
                blocks.append(words)
            block = []
        else:
            block.append(piece)
    return blocks, hashes, boxes


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without its port; null and odd URLs form one host of their own."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


_PAGE, _TREE, _BOX, _PLACE = range(4)


def templates(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
              box_ratio: float = BOX_RATIO, slot_share: float = SLOT_SHARE) -> DataFrame:
    """``(host, drop array<long>, drop_boxes array<long>)``: hashes of the subtrees on more than
    ``max_ratio`` of the host's different pages, and of the boxes on more than ``box_ratio`` that stand in a
    place whose boxes are such ones to ``slot_share``; both on ``min_pages`` at least. Equal pages are
    no evidence of a template and count once. A host has at most (mean subtrees a page) / ratio of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            hosts, rows, digests = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = page or ""
                _, hashes, boxes = parse(page)
                held = Counter(place for _, place in boxes)
                own = [(_PAGE, 0, 0, 1), *((_TREE, t, 0, 1) for t in set(hashes)), *((_BOX, x, p, 1) for x, p in set(boxes)),
                       *((_PLACE, p, p, n) for p, n in held.items())]
                rows += own
                hosts += [host] * len(own)
                digests += [_hash(page.encode("utf-8", "replace"))] * len(own)
            kinds, keys, places, ns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(kinds, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (keys, places, ns))], ["host", "page", "kind", "key", "place", "n"])

    seen = shipped(pages.select("host", "html")).mapInArrow(run, "host string, page long, kind int, key long, place long, n long")
    counts = written(
        seen.distinct().groupBy("host", "kind", "key", "place").agg(F.sum("n").alias("n")).where(F.col("n") >= min_pages), "subtrees")
    total = counts.where(F.col("kind") == _PAGE).select("host", F.col("n").alias("total"))
    trees = counts.where(F.col("kind") == _TREE).join(total, "host").where(F.col("n") > max_ratio * F.col("total"))
    boxes = counts.where(F.col("kind") == _BOX).join(total, "host").where(F.col("n") > box_ratio * F.col("total"))
    filled = boxes.groupBy("host", "place").agg(F.sum("n").alias("recurring"))
    slots = counts.where(F.col("kind") == _PLACE).join(filled, ["host", "place"]).where(
        F.col("recurring") >= slot_share * F.col("n")).select("host", "place")
    found = trees.select("host", "kind", "key").unionByName(boxes.join(slots, ["host", "place"], "left_semi").select("host", "kind", "key"))
    return found.groupBy("host").agg(
        F.collect_list(F.when(F.col("kind") == _TREE, F.col("key"))).alias("drop"),
        F.collect_list(F.when(F.col("kind") == _BOX, F.col("key"))).alias("drop_boxes"))


def extract_text(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                 box_ratio: float = BOX_RATIO, slot_share: float = SLOT_SHARE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    Blocks stand in page order, joined by two line feeds; white space within a block is one
    space and character references are decoded. A null or empty html, and a page without main
    text, gives an empty text; boxes stay if nothing would be left without them. A block of the
    body that other pages share stays unless it is on more than ``max_ratio`` of the host's
    different pages. Repeated rows stay repeated, a null page_id or url stays null; an empty table
    gives an empty result. Further columns are not read.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    slim = slim.withColumn("host", host_of(F.col("url")))
    found = written(templates(slim, max_ratio, min_pages, box_ratio, slot_share), "templates")
    joined = slim.join(found, "host", "left").select("page_id", "url", "html", "drop", "drop_boxes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = []
            for page, drop, boxes in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                page, drop = page or "", set(drop or ())
                blocks = parse(page, drop, False, set(boxes or ()))[0]
                if boxes and not blocks:
                    blocks = parse(page, drop, False)[0]
                texts.append("\n\n".join(blocks))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return shipped(joined).mapInArrow(run, "page_id long, url string, text string").select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
