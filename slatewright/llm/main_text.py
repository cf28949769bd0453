"""Main text of web pages: marked blocks, less the runs that repeat across the pages of a host.

1. Pages are parsed into blocks, each with a mark: *main* (inside an article or main
   element), *chrome* (menus, headers, footers, sidebars, notices, adverts, forms, comments) or
   *open* (nothing in the markup tells). A page with main blocks keeps those, any other its open
   blocks.
2. The token streams of a host's pages form one suffix array, ordered by the leading ``RUN`` tokens of
   each suffix; neighbours that agree in them, from different pages, are long substrings that
   repeat across pages. A main block is one run as a whole. Pages on which a run stands are counted
   within tasks before the shuffle, so a host with very many pages, or a line that all of them have,
   is spread over all tasks.
3. Tokens of open blocks that such a substring covers are boilerplate. Pages also quote one another
   inside their articles, so a main block is boilerplate only if it stands on ``MAIN_PAGES`` pages of
   the host and on half of them; the unique runs stay.

Pages with the same token stream count as one page, so copies don't make each other boilerplate.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.llm import textbytes as tb
from slatewright.session import written

RUN = 6
MAIN_PAGES = 5
MAIN, OPEN, CHROME = 0, 1, 2

# fixed values: HTML element names by role
MAIN_ELEMENTS = {"article", "main"}
CHROME_ELEMENTS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
RAW_ELEMENTS = {"script", "style", "noscript", "template", "iframe", "textarea", "svg", "object", "title"}
VOID_ELEMENTS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
}
BLOCK_ELEMENTS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
    "thead", "title", "tr", "ul",
}
# never chrome by class or id
WHOLE_ELEMENTS = {"html", "body"} | MAIN_ELEMENTS
#: elements with an optional end tag: which of them a start tag ends, and the elements it doesn't look beyond
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}),
}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
CHROME_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "sidebar", "menu",
    "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "cookie", "cookies", "consent", "notice",
    "popup", "modal", "newsletter", "subscribe", "share", "social", "related", "comment", "comments", "disqus",
    "pagination", "pager", "toolbar", "masthead", "topbar",
}

# fixed values: parts of a class name after which it doesn't name chrome
NEGATING_PARTS = {"with", "has", "no", "not", "without"}
LAYOUT_PARTS = {"main", "content", "wrapper", "container", "layout", "open", "page", "body", "article", "text"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|([^<]+|<)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def names_chrome(value: str, parts: bool = True) -> bool:
    """Whether a class or id names chrome: by a whole name, or by its first or last part (``cookie-banner``, ``main-menu``)."""
    for name in value.split():
        if name in CHROME_NAMES:
            return True
        own = re.split("[-_]+", name)
        if not parts or len(own) < 2 or not NEGATING_PARTS.isdisjoint(own):
            continue
        if own[-1] in CHROME_NAMES or own[0] in CHROME_NAMES and own[-1] not in LAYOUT_PARTS:
            return True
    return False


def _is_chrome(name: str, attributes: str, in_main: bool, trust: int) -> bool:
    if name in CHROME_ELEMENTS or name == "header" and not in_main:
        return True
    if not attributes.strip():
        return False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id") and trust and name not in WHOLE_ELEMENTS and names_chrome(value, trust > 1):
            return True
        if key == "role" and value in CHROME_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


_MAIN_TAG = re.compile(rf"<(?:{'|'.join(sorted(MAIN_ELEMENTS))})\b", re.I)


def page_blocks(source: str) -> list[tuple[str, int]]:
    """(text, mark) of every block with text, in page order. Anything that is not markup is text.

    Where class names would take away all of a page's main elements, parts of names don't count,
    and if that is not enough, no class or id does.
    """
    found = _blocks(source, 2)
    if _MAIN_TAG.search(source):
        for trust in (1, 0):
            if any(mark == MAIN for _, mark in found):
                break
            less = _blocks(source, trust)
            found = less if any(mark == MAIN for _, mark in less) else found
    return found


def _blocks(source: str, trust: int) -> list[tuple[str, int]]:
    """The blocks with class names taken by their parts (2), whole (1) or not at all (0)."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    opened: list[str] = []  # all open elements
    chrome = 0  # place of the outermost chrome element among them, from 1 on
    depth = 0  # of main elements

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, CHROME if chrome else MAIN if depth else OPEN))

    def leave(names: set[str], bounds: set[str]) -> None:
        """End the innermost open element of these names and all within it, unless a bound is open within it."""
        nonlocal chrome
        for k in range(len(opened), 0, -1):
            if opened[k - 1] in names:
                if k <= chrome:
                    close()
                    chrome = 0
                del opened[k - 1 :]
                return
            if opened[k - 1] in bounds:
                return

    position = 0
    while found := _TOKEN.match(source, position):
        position = found.end()
        ending, name, attributes, text = found.groups()
        if text is not None:
            held.append(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name in RAW_ELEMENTS:
            if not ending and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, position)
                position = end.end() if end else len(source)
            if name in BLOCK_ELEMENTS:
                close()
            continue
        if name == "br" or name in ("td", "th"):
            held.append(" ")
        if name in VOID_ELEMENTS:
            if name == "hr":
                close()
            continue
        if not ending:
            ends, bounds = IMPLIED_ENDS.get(name, (set(), set()))
            if name in BLOCK_ELEMENTS:
                leave({"p"}, BLOCK_ELEMENTS - {"p"})
            if ends:
                leave(ends, bounds)
        starts = not ending and not chrome and _is_chrome(name, attributes, depth > 0, trust)
        if name in BLOCK_ELEMENTS or starts:
            close()
        if ending:
            outside = not chrome
            leave({name}, set() if name in BLOCK_ELEMENTS else BLOCK_ELEMENTS)
            if outside and name in MAIN_ELEMENTS:
                depth = max(0, depth - 1)
        else:
            opened.append(name)
            if starts:
                chrome = len(opened)
            elif not chrome and name in MAIN_ELEMENTS:
                depth += 1
    close()
    return out


def _windows(tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the leading tokens of each suffix, with its block and place; a short block is one suffix."""
    hashes, block, place = [], [], []
    for k, own in enumerate(tokens):
        runs = tb.run_hashes(tb.text_hashes(own), min(RUN, len(own)))
        hashes.append(runs)
        block.append(np.full(len(runs), k))
        place.append(np.arange(len(runs)))
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (hashes, block, place))


def _host() -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s).*?://([^/?#]*)", 1))


def _kept(blocks: list[tuple[str, int]]) -> tuple[bool, list[str]]:
    """Whether a page has main blocks, and the texts of those, or else of its open ones."""
    main = [t for t, m in blocks if m == MAIN]
    return bool(main), main or [t for t, m in blocks if m == OPEN]


def _owners(found: list[list[tuple[str, int]]]) -> pa.Array:
    """A hash of all blocks of each page, equal for copies."""
    return pa.array(tb.text_hashes([" ".join(t for t, _ in own) for own in found]).view(np.int64))


def _parsed(keyed: DataFrame) -> DataFrame:
    """host, h1, h2, owner, unclear, keys of every page, written; no text is.

    unclear: without main blocks, with open ones; keys: hashes of the main blocks, in page order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_blocks(source or "") for source in batch.column(3).to_pylist()]
            main = [[t for t, m in own if m == MAIN] for own in found]
            unclear = [not texts and any(m == OPEN for _, m in own) for texts, own in zip(main, found)]
            bounds = np.concatenate([[0], np.cumsum([len(texts) for texts in main])])
            hashes = pa.array(tb.text_hashes([t for texts in main for t in texts]).view(np.int64))
            keys = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), hashes)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _owners(found), pa.array(unclear, pa.bool_()), keys], names)

    names = ["host", "h1", "h2", "owner", "unclear", "keys"]
    schema = "host string, h1 bigint, h2 bigint, owner bigint, unclear boolean, keys array<bigint>"
    return written(keyed.select("host", "h1", "h2", "html").mapInArrow(run, schema), "parsed")


def _suffixes(keyed: DataFrame) -> DataFrame:
    """host, h1, h2, owner, key, block, place of the suffixes of all blocks outside main elements.

    block: the number among the page's open blocks; null for chrome and on pages with main blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_blocks(source or "") for source in batch.column(3).to_pylist()]
            rows = pa.record_batch([*batch.columns[:3], _owners(found)], names[:4])
            for k, own in enumerate(found):
                outside = [(t, m) for t, m in own if m != MAIN]
                keys, number, place = _windows([t.split() for t, _ in outside])
                is_open = np.array([m == OPEN and len(outside) == len(own) for _, m in outside], dtype=bool)
                number = number.astype(np.int64)
                block = pa.array((np.cumsum(is_open) - 1)[number].astype(np.int32), mask=~is_open[number])
                whole = rows.take(pa.array(np.full(len(keys), k)))
                more = [pa.array(keys.astype(np.uint64).view(np.int64)), block, pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*whole.columns, *more], names)

    names = ["host", "h1", "h2", "owner", "key", "block", "place"]
    schema = "host string, h1 bigint, h2 bigint, owner bigint, key bigint, block int, place int"
    return keyed.select("host", "h1", "h2", "html").mapInArrow(run, schema)


def _common_blocks(parsed: DataFrame) -> DataFrame:
    """host, key of the main blocks on ``MAIN_PAGES`` distinct pages of the host and on half of them.

    Copies are merged first, so that each distinct page counts once; the counts are added up before
    the shuffle, so that no host and no block is one task.
    """
    pages = parsed.groupBy("host", "owner").agg(F.collect_set("keys").alias("keys"))
    size = parsed.select("host", "owner").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    runs = pages.select("host", F.explode(F.array_distinct(F.flatten("keys"))).alias("key"))
    often = runs.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= MAIN_PAGES)
    return often.join(size, "host").where(2 * F.col("n") >= F.col("pages")).select("host", "key")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page row; text is empty where nothing is left.

    Null html counts as empty, a null url as the host "". Rows with the same page_id are kept
    apart. Ties don't arise. An empty table gives an empty result. Other columns are not read.
    What is covered follows from the html and its host, so a page is told by these: by two hashes
    of the html. What is written and shuffled are hashes; pages are parsed again for their texts.
    """
    page = F.coalesce("html", F.lit(""))
    hashes = [F.xxhash64(page).alias("h1"), F.xxhash64(page, F.lit(1)).alias("h2")]
    keyed = pages.select("page_id", "url", _host().alias("host"), "html", *hashes)
    parsed = _parsed(keyed)
    common = written(_common_blocks(parsed), "common")
    runs = parsed.select("host", "h1", "h2", F.posexplode("keys").alias("block", "key")).withColumn("place", F.lit(0))
    covered = runs.join(common, ["host", "key"], "left_semi")
    # where the markup doesn't tell: suffixes of all blocks that pages of the host have outside main elements
    hosts = written(parsed.where("unclear").select("host").distinct(), "hosts")
    suffixes = _suffixes(keyed.join(hosts, "host", "left_semi"))
    # on two distinct pages at least
    repeated = suffixes.groupBy("host", "key").agg(F.min("owner").alias("a"), F.max("owner").alias("b")).where("a < b")
    own = suffixes.where("block is not null").join(repeated, ["host", "key"], "left_semi")
    columns = ["host", "h1", "h2", "block", "place"]
    covered = covered.select(*columns).unionByName(own.select(*columns)).groupBy("host", "h1", "h2")
    # written, so that its size is known: where it is small, the texts are not shuffled
    covered = written(covered.agg(F.collect_set(F.struct("block", "place")).alias("covered")), "covered")
    return _unique_runs(_texts(keyed).join(covered, ["host", "h1", "h2"], "left"))


def _texts(keyed: DataFrame) -> DataFrame:
    """page_id, url, host, h1, h2, main, size, text: the main blocks, or else the open ones, by lines, compressed.

    size: bytes of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            found = [_kept(page_blocks(source or "")) for source in batch.column(5).to_pylist()]
            raw = ["\n".join(texts).encode() for _, texts in found]
            more = [
                pa.array([main for main, _ in found], pa.bool_()),
                pa.array([len(r) for r in raw], pa.int64()),
                pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *more], names)

    kind = keyed.schema["page_id"].dataType.simpleString()
    names = ["page_id", "url", "host", "h1", "h2", "main", "size", "text"]
    schema = f"page_id {kind}, url string, host string, h1 bigint, h2 bigint, main boolean, size bigint, text binary"
    return keyed.select("page_id", "url", "host", "h1", "h2", "html").mapInArrow(run, schema)


def _unique_runs(left: DataFrame) -> DataFrame:
    """page_id, url, text: the main blocks, or else the open ones, without the covered tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            out = []
            for main, size, packed, covered in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                text = codec.decompress(packed, size, asbytes=True).decode()
                gone: dict[int, set[int]] = {}
                for hit in covered or ():
                    gone.setdefault(hit["block"], set()).update(range(hit["place"], hit["place"] + RUN))
                if gone:
                    runs = [
                        t if k not in gone else "" if main else " ".join(w for i, w in enumerate(t.split()) if i not in gone[k])
                        for k, t in enumerate(text.split("\n"))
                    ]
                    text = "\n".join(r for r in runs if r)
                out.append(text)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())], ["page_id", "url", "text"])

    kind = left.schema["page_id"].dataType.simpleString()
    rows = left.select("page_id", "url", "main", "size", "text", "covered")
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
