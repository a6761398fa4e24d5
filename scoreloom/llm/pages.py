"""Main text of web pages by removal of site templates.

1. A page becomes a tree of block elements.  Every element has a key: a digest of the host, its name and class, its texts and the
   keys of the elements in it, so equal subtrees of a host have equal keys.
2. Spark counts for each key in how many contexts it occurs.  A context is the longest block of text that may be main text: copies of a page are
   one context, and a subtree that holds the page's longest block has no other.  A subtree with MANY contexts is template.
3. Template subtrees are deleted, and so are elements that by name, role or class are no part of an article.  What is left
   of the articles (`article`, `main`) is the text; a page without these gives all that is left.

Prose (paragraphs, headings, list items, cells and the like) is no template in an article, however many pages quote it; only
elements that hold other elements are.  In a page without an article prose is deleted where more than half of the host's contexts
have it.  Elements around an article are never deleted as template.

Template keys travel to the tasks as one array up to MOST_KEYS (a bound that is checked); beyond it, each page's keys are joined
with the template keys, and pages get only their own.

Markup may be cut off or badly nested: paragraphs, items and cells end where the next begins, end tags without a start are left
out, an unclosed comment or tag runs to the end.  White space is that of Unicode.  Null or empty html gives an empty text; pages
without a host have no templates.  Repeated rows are pages of their own with equal results.  Other columns are left out.
"""

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.operators.joins import lookup
from scoreloom.session import staged

MANY = 5
MOST_KEYS = 4 << 20  # of 8 bytes
BATCH_BYTES = 4 << 20

# Names of elements, and words of classes, ids and roles.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption td th caption summary address".split())
BLOCKS = PROSE | set("html head body article main section div nav header footer aside form fieldset ul ol dl table thead tbody tfoot tr "
                     "figure details dialog menu center dir hgroup hr search".split())
DROPPED = set("head title script style noscript template iframe noembed noframes object svg canvas audio video nav footer aside form "
              "fieldset button select option textarea label dialog menu search".split())
NOT_P = BLOCKS - {"p"}
ARTICLE = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
WORDS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar cookie cookies consent "
            "gdpr notice alert comment comments disqus reply replies respond nav navbar navigation menu breadcrumb breadcrumbs footer "
            "masthead topbar share sharing social related recommended newsletter subscribe signup login popup modal overlay "
            "pagination pager".split())
NOT_ITSELF = {"has", "with", "no", "without"}
#: An element of the first name ends open elements of the second ones, up to the third ones.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

MARK = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>""")
NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open', name, attributes) and ('close', name, '') in order."""
    at = 0
    while mark := MARK.search(page, at):
        if mark.start() > at:
            yield "text", page[at:mark.start()], ""
        if mark[0] == "<!--":
            end = page.find("-->", mark.start() + 2)
            at = len(page) if end < 0 else end + 3
            continue
        tag = TAG.match(page, mark.start()) if mark[0][1] not in "!?" else None
        end = tag.end() if tag else page.find(">", mark.start()) + 1
        at = end or len(page)
        if not tag:
            continue
        name = tag[1].lower()
        if mark[0][1] == "/":
            yield "close", name, ""
            continue
        yield "open", name, tag[2]
        if name in RAW:
            close = re.compile(f"</{name}(?![^\\s/>])", re.IGNORECASE).search(page, at)
            at = close.start() if close else len(page)
    if at < len(page):
        yield "text", page[at:], ""


def marked_by_name(attributes: str) -> tuple[bool, str]:
    """Whether class, id or role say that this is no part of an article, and the class; the role `main` gives the class 'role=main'."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attributes)}
    if found.get("role", "").lower() == "main":
        return False, "role=main"
    for word in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in PARTS.split(word) if p]
        if parts and parts[0] not in NOT_ITSELF and (parts[0] in WORDS or parts[-1] in WORDS or "header" in (parts[0], parts[-1])):
            return True, "header" if not {parts[0], parts[-1]} & WORDS else found.get("class", "")
    return found.get("role", "").lower() in ROLES, found.get("class", "")


class Page:
    """The block elements of a page, parents first, and its blocks of text.

    Of each element: `name`, `parent`, `key`, `drop` (no part of an article), `article`, `holds` (other elements).  `blocks` has
    (element, text).
    """

    def __init__(self, page: str, host: str):
        self.name, self.parent, self.key, self.drop, self.article, self.holds = ["html"], [-1], [0], [False], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self._items: list[list[bytes]] = [[b"html"]]
        self._open: list[tuple[str, int, bool]] = [("html", 0, False)]  # name, the block element it is or lies in, hidden
        self._count = {"html": 1}
        self._text: list[str] = []
        self._hidden = 0  # open inline elements that are no part of an article
        self._host = host.encode()
        for kind, what, attributes in tokens(page):
            if kind == "text":
                if not self._hidden:
                    self._text.append(html.unescape(what))
            elif kind == "open":
                self._start(what, attributes)
            elif self._count.get(what):
                self._end(what)
        while self._open:
            self._pop()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                element = self._open[-1][1]
                self.blocks.append((element, text))
                self._items[element].append(text.encode())

    def _pop(self) -> None:
        name, element, hidden = self._open[-1]
        self._count[name] -= 1
        if name in BLOCKS:
            self._flush()
            items = self._items[element]
            digest = hashlib.blake2b(self._host, digest_size=8)
            for item in items:
                digest.update(len(item).to_bytes(4) + item)
            self._items[element] = []
            self.key[element] = int.from_bytes(digest.digest(), signed=True)
            if self.parent[element] >= 0 and len(items) > 1:  # empty elements are no part of a subtree
                self._items[self.parent[element]].append(digest.digest())
        self._hidden -= hidden
        self._open.pop()

    def _pop_through(self, names: set[str], borders: set[str]) -> None:
        """End the open elements up to the outermost of `names` that lies within the nearest of `borders`."""
        if not any(self._count.get(n) for n in names):
            return
        last = None
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] in borders:
                break
            if self._open[k][0] in names:
                last = k
        if last is not None:
            while len(self._open) > last:
                self._pop()

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._count.get(name):
            return
        if name not in BLOCKS:
            if name == "br":
                self._text.append(" ")
            if name not in VOID:
                by_name, label = marked_by_name(attributes) if "=" in attributes else (False, "")
                hidden = name in DROPPED or by_name and label != "header"
                self._open.append((name, self._open[-1][1], hidden))
                self._count[name] = self._count.get(name, 0) + 1
                self._hidden += hidden
            return
        if name != "head" and self._count.get("head"):
            self._pop_through({"head"}, {"html"})
        if self._count.get("p"):
            self._pop_through({"p"}, NOT_P)
        if name in ENDS:
            self._pop_through(*ENDS[name])
        self._flush()
        if name in VOID:
            return
        by_name, label = marked_by_name(attributes) if "=" in attributes else (False, "")
        above = self._open[-1][1]
        header = (name == "header" or label == "header") and not self._inside(above)
        element = len(self.name)
        self.name.append(name)
        self.parent.append(above)
        self.key.append(0)
        self.drop.append(name not in ("html", "body") and (name in DROPPED or by_name and label != "header" or header))
        self.article.append(name in ARTICLE or label == "role=main")
        self.holds.append(False)
        self.holds[above] = True
        self._items.append([f"{name} {label}".encode()])
        self._open.append((name, element, False))
        self._count[name] = self._count.get(name, 0) + 1

    def _inside(self, element: int) -> bool:
        """Whether `element` is an article or lies in one."""
        while element >= 0 and not self.article[element]:
            element = self.parent[element]
        return element >= 0

    def _end(self, name: str) -> None:
        if name in BLOCKS:
            while self._open[-1][0] != name:
                self._pop()
            if len(self._open) > 1:
                self._pop()
            return
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] in BLOCKS:
                return
            if self._open[k][0] == name:
                while len(self._open) > k:
                    self._pop()
                return

    def settle(self) -> tuple[list[bool], list[bool], list[bool]]:
        """Of each element: whether it is dropped by its own or an outer name, in an article that counts, and around one."""
        dropped, within, around = [], [], [False] * len(self.name)
        for e, above in enumerate(self.parent):
            dropped.append(self.drop[e] or above >= 0 and dropped[above])
            within.append(not dropped[e] and (self.article[e] or above >= 0 and within[above]))
            if within[e] and (above < 0 or not within[above]):
                while above >= 0 and not around[above]:
                    around[above] = True
                    above = self.parent[above]
        return dropped, within, around

    def candidates(self) -> Iterator[tuple[int, bool]]:
        """(element, whether it is prose) of all elements that may be template."""
        _, within, around = self.settle()
        rooted = any(within)
        for e, name in enumerate(self.name):
            if name in ("html", "head", "body") or around[e]:
                continue
            prose = name in PROSE or within[e] and not self.holds[e]
            if not prose or not rooted:
                yield e, prose

    def context(self) -> int:
        dropped, within, _ = self.settle()
        rooted = any(within)
        longest = max((t for e, t in self.blocks if (within[e] if rooted else not dropped[e])), key=len, default="")
        return int.from_bytes(hashlib.blake2b(longest.encode(), digest_size=8).digest(), signed=True)

    def text(self, template: set[int]) -> str:
        dropped, within, _ = self.settle()
        rooted = any(within)
        gone = {e for e, _ in self.candidates() if self.key[e] in template}
        out = []
        for e, above in enumerate(self.parent):  # parents come first
            out.append(dropped[e] or e in gone or above >= 0 and out[above])
        return "\n\n".join(text for e, text in self.blocks if not out[e] and (within[e] or not rooted))


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.withColumn("host", F.coalesce(host, F.lit("")))


def keys(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple[int, int, bool, int]]]]:
    """(row, [(key, host's key, prose, context), ...]) of the pages that have a host."""
    hosts, pages = batch.column("host").to_pylist(), arrow.texts(batch.column("html"))
    for k, (host, text) in enumerate(zip(hosts, pages, strict=True)):
        if host and text:
            page = Page(text, host)
            name = int.from_bytes(hashlib.blake2b(host.encode(), digest_size=8).digest(), signed=True)
            context = page.context()
            found = {(page.key[e], name, prose, context) for e, prose in page.candidates()}
            yield k, [(name, name, False, context), *sorted(found)]


def templates(pages: DataFrame) -> DataFrame:
    """The keys that are template, from `pages` with their host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "html", BATCH_BYTES):
            rows = [row for _, found in keys(batch) for row in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["key", "site", "prose", "context"])

    found = pages.select("host", "html").mapInArrow(run, "key long, site long, prose boolean, context long")
    counts = staged(found.distinct().groupBy("key", "site", "prose").count().where(f"count >= {MANY}"), "subtrees")
    sites = counts.where("key = site").select("site", F.col("count").alias("contexts"))
    common = counts.where("prose").join(sites, "site").where("2 * count > contexts").select("key")
    return counts.where("not prose and key != site").select("key").unionByName(common).distinct()


def own_templates(pages: DataFrame, found: DataFrame) -> DataFrame:
    """`pages` with `own`: the template keys that each page has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "html", BATCH_BYTES):
            names = batch.column("digest").to_pylist()
            rows = [(names[k], row[0]) for k, some in keys(batch) for row in some]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["digest", "key"])

    named = pages.withColumn("digest", F.md5(F.concat_ws("\n", "host", "html")))
    each = named.select("digest", "host", "html").mapInArrow(run, "digest string, key long").distinct()
    lists = each.join(found, "key", "left_semi").groupBy("digest").agg(F.collect_list("key").alias("own"))
    return lookup(named, lists, ["digest"])


def main_text(pages: DataFrame) -> DataFrame:
    """Every row of `pages` (page_id, url, html): page_id, url, text, n_chars."""
    rows = with_host(pages.select("page_id", "url", "html"))
    found = staged(templates(rows), "templates")
    shared = None
    if found.count() <= MOST_KEYS:
        shared = np.array(sorted(r.key for r in found.collect()), np.int64)
        rows = rows.withColumn("own", F.lit(None).cast("array<long>"))
    else:
        rows = own_templates(rows, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "html", BATCH_BYTES):
            out = []
            for text, host, own in zip(arrow.texts(batch.column("html")), *(batch.column(c).to_pylist() for c in ("host", "own")), strict=True):
                page = Page(text, host)
                if shared is None:
                    known = set(own or ())
                else:
                    all_keys = np.array(page.key, np.int64)
                    at = np.minimum(np.searchsorted(shared, all_keys), max(len(shared) - 1, 0))
                    known = set(all_keys[shared[at] == all_keys].tolist()) if len(shared) and host else set()
                out.append(page.text(known))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return rows.select("page_id", "url", "host", "html", "own").mapInArrow(run, f"{', '.join(kinds)}, text string, n_chars long")


#: What the elements of the driver's pages come to; it knows `article`, paragraphs and a few character references only.
ORACLE = r"""
with a as (
  select page_id, url, regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1) as body from pages
), b as (
  select page_id, url, list_transform(string_split_regex(body, '</?(p|h1)>'), lambda x:
    trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>?', '', 'g'),
      '&quot;', '"'), '&quot', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as blocks from a
), c as (select page_id, url, coalesce(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)), '') as text from b)
select page_id, url, text, length(text) as n_chars from c
"""
