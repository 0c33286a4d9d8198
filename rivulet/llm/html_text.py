"""Main text of web pages: site templates go first, then rules choose the article.

A page is parsed to its elements (with the usual repairs: elements left open
are closed, a tag or page that breaks off just ends).  Every block element's
subtree, anywhere on the page, is hashed; Spark counts on how many different
pages of a host each hash occurs; and subtrees that recur on many of them go,
whatever they are called.  Inside an article or main element that takes ten pages
and four fifths of the host's; on a page that has neither, three pages and half;
beside one, where no article text is to be lost and menus and footers come in
many versions, three pages and a fiftieth.  A hash seen in several such places
takes the most.  An element that holds an article, a main element or the page's
body is never a template.

Of what is left, the article is the main text, else the main element, else the
body; from these go elements whose name, or a word of whose class, says that they
are none of it (menus, adverts, comments and the like, which may differ on every
page and so escape counting).

A page is parsed twice, once to count and once to extract, so that nothing of
its text is written in between.  At most ``subtrees of a page / share`` hashes of
a host can reach such a share, so a host's templates are a short list however
many pages it has.  Parsing and hashing take time linear in the page.

Cases: a null html is an empty page and has an empty text; a null or odd url
has no host, and its pages no templates; pages of a host that are equal count
once; repeated rows are extracted each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, table
from .shingles import POWERS, mix

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style title textarea xmp iframe noembed noframes noscript template nav aside footer form button select option svg math canvas audio video object dialog menu datalist map".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption legend option".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table".split())
# Words in class, id, role or aria-label that mark what is no article text.
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs byline-share comment comments commentlist disqus respond reply replies consent cookie cookies gdpr notice notices alert disclaimer copyright footer menu menus menubar nav navbar navigation navigational newsletter subscribe subscription signup login modal popup overlay pager pagination promo promotion promoted related recommended recommendations search share sharing social sidebar sidebars sponsor sponsored sponsors tagcloud toolbar topbar widget widgets skip skiplink complementary contentinfo alertdialog hidden".split())
KEPT = frozenset("html body article main".split())
# Elements whose content is no text of the page.
UNSHOWN = frozenset("head script style title textarea template".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
MARK = re.compile(r"""(?:^|\s)(class|id|role|aria-label|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=\s|/|$)""", re.I)
PARTS = re.compile(r"[^a-z]+")
HOST = r"(?i)^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def marked(attributes: str) -> bool:
    """Whether class, id, role or label say that this is no article text."""
    for name, a, b, c in MARK.findall(attributes):
        name = name.lower()
        if name == "hidden":
            return True
        for token in (a or b or c).lower().split():
            parts = [p for p in PARTS.split(token) if p]
            # Of compound names such as has-sidebar or article-header the first or last word tells.
            if parts and (parts[0] in BOILERPLATE or (parts[-1] in BOILERPLATE and parts[0] not in ("has", "no", "with", "without", "article", "post", "entry", "content", "main", "body", "page"))):
                return True
    return False


def spread(marks: list[bool], parent: list[int]) -> list[bool]:
    """Whether an element or one above it is marked; parents come before children."""
    out = list(marks)
    for i in range(1, len(out)):
        out[i] = out[i] or out[parent[i]]
    return out


#: Where a subtree is: beside an article or main element, on a page that has neither, inside one;
#: and the pages, and the share of a host's, on which it must recur.
BESIDE, ALONE, INSIDE = 0, 1, 2
LEAST = {BESIDE: (3, 0.02), ALONE: (3, 0.5), INSIDE: (10, 0.8)}


class Page:
    """Elements in page order: name, parent, runs of text from ``first`` to ``last`` (excluded), and whether a rule says that it goes (1 by class, 2 by name)."""

    def __init__(self, source: str) -> None:
        self.name, self.parent, self.first, self.last, self.gone = ["#page"], [-1], [0], [0], [0]
        self.runs: list[str] = []
        self.parse(source)

    def parse(self, source: str) -> None:
        stack, text, pos, n = [0], [], 0, len(source)
        places: dict[str, list[int]] = {}  # the places in the stack of the open elements of a name
        blocks: list[int] = []  # the places of block elements
        edges: list[int] = []  # the places of those that end a run
        kept: list[int] = []  # the places of page, body, article and main elements
        scopes: list[int] = []  # the places of lists and tables

        def flush() -> None:
            if text:
                run = " ".join(html.unescape("".join(text)).split())
                if run:
                    self.runs.append(run)
                text.clear()

        def close(depth: int) -> None:
            if edges and edges[-1] >= depth:
                flush()
            for i in stack[depth:]:
                self.last[i] = len(self.runs)
                places[self.name[i]].pop()
            del stack[depth:]
            for held in (blocks, edges, kept, scopes):
                while held and held[-1] >= depth:
                    held.pop()

        top = lambda held: held[-1] if held else 0
        while pos < n:
            m = TOKEN.search(source, pos)
            if not m:
                text.append(source[pos:])
                break
            if m.start() > pos:
                text.append(source[pos : m.start()])
            pos = m.end()
            name = m[2] or m[6]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    text.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            name, attributes = name.lower(), m[3] if m[2] else m[7]
            if not (m[4] if m[2] else m[8]):
                break  # the page ends inside a tag
            if m[1] or m[5]:
                depth = top(places.get(name))
                # An end tag does not reach out of the article.
                if depth and (name in KEPT or top(kept) < depth):
                    close(depth)
                continue
            if name in VOID:
                if name == "br":
                    text.append(" ")
                elif name == "hr":
                    flush()
                continue
            if name in BLOCK:
                if blocks and self.name[stack[blocks[-1]]] == "p":
                    close(blocks[-1])
                shut = CLOSES.get(name, ())
                while (depth := max((top(places.get(x)) for x in shut), default=0)) > top(scopes):
                    close(depth)
            by_name = name in DROPPED or (name == "header" and not places.get("article") and not places.get("main"))
            gone = 2 if by_name else int(name not in ("html", "body", "main") and bool(attributes) and marked(attributes))
            if name in BLOCK or gone:
                flush()
            i, depth = len(self.name), len(stack)
            self.name.append(name)
            self.parent.append(stack[-1])
            self.first.append(len(self.runs))
            self.last.append(len(self.runs))
            self.gone.append(gone)
            if attributes.rstrip().endswith("/") and name in ("svg", "math"):
                continue
            stack.append(i)
            places.setdefault(name, []).append(depth)
            for held, belongs in ((blocks, name in BLOCK), (edges, name in BLOCK or gone), (kept, name in KEPT), (scopes, name in SCOPE)):
                if belongs:
                    held.append(depth)
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, pos)
                if name in ("textarea", "title"):
                    text.append(source[pos : end.start() if end else n])
                pos = end.start() if end else n
        flush()
        for i in stack:
            self.last[i] = len(self.runs)

    def above(self, marks: list[bool]) -> list[bool]:
        """Whether an element holds a marked one."""
        out = [False] * len(marks)
        for i in range(len(marks) - 1, 0, -1):
            if marks[i] or out[i]:
                out[self.parent[i]] = True
        return out

    def subtrees(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first runs, ends, hashes, places) of the block elements that may be templates."""
        root = [x in ("article", "main") for x in self.name]
        holds, inside = self.above(root), spread(root, self.parent)
        raw = spread([x in UNSHOWN for x in self.name], self.parent)
        at = [i for i in range(1, len(self.name)) if self.name[i] in BLOCK and self.name[i] not in KEPT and not holds[i] and not raw[i] and self.last[i] > self.first[i]]
        first, last = np.array([self.first[i] for i in at], dtype=np.int64), np.array([self.last[i] for i in at], dtype=np.int64)
        # The hash of a range of runs comes from sums over all before its ends, so nested elements cost nothing more.
        POWERS.grow(len(self.runs) + 1)
        each = np.array([xxhash.xxh64_intdigest(r.encode("utf-8", "replace")) for r in self.runs], dtype=np.uint64)
        total = np.zeros(len(each) + 1, dtype=np.uint64)
        np.cumsum(each * POWERS.up[: len(each)], out=total[1:])
        kind = np.array([xxhash.xxh64_intdigest(self.name[i]) for i in at], dtype=np.uint64)
        h = mix((total[last] - total[first]) * POWERS.down[first] + mix(kind + (last - first).astype(np.uint64)))
        elsewhere = BESIDE if any(root) else ALONE
        return first, last, h.view(np.int64), np.array([INSIDE if inside[i] else elsewhere for i in at], dtype=np.int8)

    def main(self, alive: np.ndarray) -> np.ndarray:
        """Which runs are the main text, of those that are ``alive``."""
        n = len(self.name)
        left = np.r_[0, np.cumsum(alive)]
        by_rule, by_name = spread([g > 0 for g in self.gone], self.parent), spread([g > 1 for g in self.gone], self.parent)
        tries = [("article", by_rule), ("main", by_rule), ("article", [by_name[i] or self.gone[i] > 0 for i in range(n)])]
        for kind, barred in tries:
            is_root = [self.name[i] == kind and not barred[i] and left[self.last[i]] > left[self.first[i]] for i in range(n)]
            if any(is_root):
                break
        else:
            is_root = [True] + [False] * (n - 1)
        sure, inside = not is_root[0], spread(is_root, self.parent)
        holds = lambda kind: self.above([self.name[i] == kind and not by_name[i] for i in range(n)])
        wraps = [a and b for a, b in zip(holds("h1"), holds("p"), strict=True)] if not sure else []
        # 1 at the first run and -1 behind the last of each element that stays or goes.
        stay, go = np.zeros(len(self.runs) + 1, dtype=np.int64), np.zeros(len(self.runs) + 1, dtype=np.int64)
        for i in range(n):
            if is_root[i]:
                stay[self.first[i]] += 1
                stay[self.last[i]] -= 1
            # A class word does not take away what holds a heading and text below it: that is a wrapper.
            elif inside[i] and self.gone[i] and (sure or self.gone[i] > 1 or not wraps[i]):
                go[self.first[i]] += 1
                go[self.last[i]] -= 1
        return alive & (np.cumsum(stay)[:-1] > 0) & (np.cumsum(go)[:-1] == 0)


def extract_text(source: str, templates: np.ndarray) -> tuple[str, int]:
    """(the main text, characters that ``templates``, a sorted array of hashes, removed from the page)."""
    page = Page(source)
    alive = np.ones(len(page.runs), dtype=bool)
    if len(templates) and len(page.runs):
        first, last, h, _ = page.subtrees()
        hit = templates[np.minimum(np.searchsorted(templates, h), len(templates) - 1)] == h
        edge = np.zeros(len(page.runs) + 1, dtype=np.int64)
        np.add.at(edge, first[hit], 1)
        np.add.at(edge, last[hit], -1)
        alive = np.cumsum(edge)[:-1] == 0
    removed = sum(len(page.runs[i]) for i in np.flatnonzero(~alive).tolist())
    return " ".join(page.runs[i] for i in np.flatnonzero(page.main(alive)).tolist()), removed


def columns(pages: DataFrame) -> list[Column]:
    return [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]


def host_column() -> Column:
    """The host of ``url``, empty if it has none."""
    host = F.lower(F.regexp_extract("url", HOST, 1))
    return F.coalesce(F.regexp_replace(host, r"^www\.|\.+$", ""), F.lit(""))


def outlines(pages: DataFrame) -> DataFrame:
    """host, a hash of the page's text, and the distinct hashes and places of its subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            body, counts, hashes, places = [], [], [], []
            for source in b.column(1).to_pylist():
                page = Page(source or "")
                _, _, h, place = page.subtrees()
                order = np.lexsort((-place, h))
                known, at = np.unique(h[order], return_index=True)
                body.append(xxhash.xxh64_intdigest("\n".join(page.runs).encode("utf-8", "replace")) - (1 << 63))
                counts.append(len(known))
                hashes.append(known)
                places.append(place[order][at])
            ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32), pa.int32())
            flat = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else [], kind)) for x, kind in ((hashes, pa.int64()), (places, pa.int8()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(body, pa.int64()), *flat], ["host", "body", "hashes", "places"])

    rows = pages.select(*columns(pages)).select(host_column().alias("host"), "html").where("host <> ''")
    return rows.mapInArrow(run, "host string, body long, hashes array<long>, places array<tinyint>")


def templates(pages: DataFrame, least: dict[int, tuple[int, float]] = LEAST) -> DataFrame:
    """host and its list of template hashes; ``least`` has pages and share for each place."""
    rows = materialize(outlines(pages).dropDuplicates(["host", "body"]), "outlines")
    size = rows.groupBy("host").agg(F.count("*").alias("pages"))
    each = rows.select("host", F.explode(F.arrays_zip("hashes", "places")).alias("e")).select("host", F.col("e.hashes").alias("hash"), F.col("e.places").alias("place"))
    count = each.groupBy("host", "hash").agg(F.count("*").alias("n"), F.max("place").alias("place"))
    needed = F.lit(None).cast("double")
    for place, (few, share) in least.items():
        needed = F.when(F.col("place") == place, F.greatest(F.lit(float(few)), F.col("pages") * share)).otherwise(needed)
    often = count.where(f"n >= {min(few for few, _ in least.values())}").join(size, "host").where(F.col("n") >= needed)
    return often.groupBy("host").agg(F.array_sort(F.collect_list("hash")).alias("gone"))


#: Template hashes up to this many (8 bytes each) are sent to all tasks; more are joined by a shuffle.
BROADCAST_HASHES = 500_000


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and template_chars (characters that templates removed) of each page."""
    found = materialize(templates(pages), "templates")
    total = found.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    none = np.zeros(0, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            gone = [none if x is None else np.array(x, dtype=np.int64) for x in b.column(3).to_pylist()]
            out = [extract_text(s or "", t) for s, t in zip(b.column(2).to_pylist(), gone, strict=True)]
            cols = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["page_id", "url", "text", "template_chars"])

    rows = pages.select(*columns(pages)).withColumn("host", host_column()).join(F.broadcast(found) if total <= BROADCAST_HASHES else found, "host", "left")
    return rows.select("page_id", "url", "html", "gone").mapInArrow(run, "page_id long, url string, text string, template_chars long")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "template_chars")
