"""Main text of web pages by consensus host paths (operator 9).

1. Every page is read into elements and text blocks; containers are scored by the text that
   stands in them outside links (half of it counts for the next container up).  The best one is widened
   to an article around it, and to its parent while that adds text of its own (a headline, a lead).  The page
   votes for its path: tags with classes from the root, numbers generalised.
2. Spark counts the votes per (host, path), partial sums first, and keeps each host's
   ``PATHS`` best paths (most votes, then path text).
3. Every page is read again and its blocks are taken from the elements on the first winning path
   that holds text, at least ``SHARE`` of the mean its voters hold there; a page with none of them
   uses its own best container.

Menus, headers, footers, side bars, notices, adverts, forms, scripts, styles and reader comments
are left out by tag, role and class wherever they stand.  A class names one of these if all its words do
(``site-footer``, ``comments-area``); then its element goes, unless an article in it holds most of the page's
text.  Where only a word of a class does (``has-sidebar``, ``no-comments``), or the tag is a form, the
element goes unless it holds most of the page's text itself.  Block text has its character references
decoded and its white space joined to single spaces; blocks are joined by two line feeds.

The winning paths are written as a small table first: under the session's size-checked threshold
Spark broadcasts it, beyond it hosts are dealt out salted, so a host with a third of all pages
is never one task.

Defined cases: null, empty and text-free html give ``""``; a null or odd url is the host ``""``;
equal votes go to the path first in code-point order; repeated pages vote and are returned
each; an empty table gives no rows; input columns ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, lookup, resolve, scratch

PATHS = 8                  # winning paths kept per host; other pages use their own best container
SHARE = 0.25               # of a path's usual text that a page must hold there to be read by it
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
_NUMBER = re.compile(r"\d+")
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var picture map td th img wbr".split())
CONTAINERS = frozenset("article body div main section td center blockquote html".split())
OUT_TAGS = frozenset("head title nav footer aside script style noscript iframe button select textarea template svg dialog menu "
                     "object canvas audio video input".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
OUT_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar "
                      "navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer masthead topbar cookie cookies consent gdpr "
                      "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus reply "
                      "replies respond share sharing social related recommended pagination pager copyright toolbar form".split())
# Words that a class adds to one of the above without changing what it names.
PLAIN_WORDS = frozenset("area bar block body bottom box btn button buttons center col column container content fixed global group header holder icon "
                        "icons inner item items large left level line link links list lists main mobile outer page panel post posts primary "
                        "region right row secondary section site slot small sticky text thread title top unit wrap wrapper zone".split())
HEADLINES = frozenset("h1 h2".split())
MOST = 0.5                 # of the page's text outside links
_ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)),
         "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}


class Page:
    """Elements (parent, path, left out or not, container or not) and blocks of one page."""

    def __init__(self, source: str | None):
        self.parent, self.path, self.out, self.tag = [-1], [""], [False], [""]
        self.blocks: list[tuple[int, str, int]] = []           # owner element, text, characters in links
        self.doubts: dict[int, str] = {}                       # elements that their class or tag may leave out
        self._read(source or "")
        self._settle()

    def _open(self, tag: str, attributes: str, at: int) -> int:
        name, out, doubt = tag, self.out[at], ""
        if attributes and not attributes.isspace():
            found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attributes)}
            classes = sorted(set(_NUMBER.sub("#", found.get("class", "")).split()))
            name = ".".join([tag, *classes])
            if not out and tag not in ("html", "body", "main"):
                out = found.get("role", "").lower() in OUT_ROLES or "hidden" in found
                doubt = max((self._named(c, at) for c in [*found.get("class", "").split(), found.get("id", "")]), default="")
        out = out or tag in OUT_TAGS or (tag == "header" and not self._in_article(at))
        self.parent.append(at)
        self.path.append(f"{self.path[at]}>{name}")
        self.out.append(out)
        self.tag.append(tag)
        if not out and (doubt or tag == "form"):
            self.doubts[len(self.parent) - 1] = doubt or "form"
        return len(self.parent) - 1

    def _named(self, name: str, at: int) -> str:
        """Whether a class or id names something to leave out: ``whole``, in ``part`` only, or not ("")."""
        words = [w.lower() for w in _HINT_WORD.findall(name)]
        named = [w in OUT_WORDS or (w == "header" and not self._in_article(at)) for w in words]
        if not any(named):
            return ""
        return "whole" if all(n or w in PLAIN_WORDS for n, w in zip(named, words)) else "part"

    def _in_article(self, at: int) -> bool:
        while at > 0:
            if self.tag[at] in ("article", "main"):
                return True
            at = self.parent[at]
        return False

    def _read(self, source: str) -> None:
        at, pieces, owner, links, in_link, pos = 0, [], 0, 0, 0, 0

        def flush():
            nonlocal pieces, links
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((owner, text, links))
                pieces, links = [], 0

        def add(raw):
            nonlocal owner, links
            if self.out[at]:
                return
            text = htmllib.unescape(raw) if "&" in raw else raw
            if not pieces:
                owner = at
                while self.tag[owner] in INLINE and self.tag[owner] not in ("td", "th"):
                    owner = self.parent[owner]
            pieces.append(text)
            if in_link:
                links += len(text.strip())

        while True:
            m = _TOKEN.search(source, pos)
            if m is None:
                add(source[pos:])
                break
            if m.start() > pos:
                add(source[pos:m.start()])
            pos = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:                                            # end tag: close up to its start, if open
                up = at
                while up > 0 and self.tag[up] != tag:
                    up = self.parent[up]
                if up > 0:
                    if tag not in INLINE or self.out[up]:
                        flush()
                    elif tag in ("td", "th"):
                        pieces.append(" ")
                    at = self.parent[up]
                elif tag == "p":
                    flush()
                if tag == "a" and in_link:
                    in_link -= 1
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br" and not self.out[at]:
                    pieces.append(" ")
                continue
            if tag not in INLINE:
                flush()
                up = at                                         # a block element ends an open paragraph
                while up > 0 and self.tag[up] in INLINE and self.tag[up] not in ("td", "th"):
                    up = self.parent[up]
                if up > 0 and self.tag[up] == "p":
                    at = self.parent[up]
                    in_link = 0
            if tag in _ENDS:
                mine, scope = _ENDS[tag]
                up = at
                while up > 0 and self.tag[up] not in scope and self.tag[up] not in mine.split():
                    up = self.parent[up]
                if up > 0 and self.tag[up] in mine.split():
                    at = self.parent[up]
            new = self._open(tag, m[3], at)
            if tag in INLINE and self.out[new] and not self.out[at] and pieces:
                pieces.append(" ")
            if not m[3].endswith("/"):
                at = new
                if tag == "a":
                    in_link += 1
                if tag in _RAW_END:
                    end = _RAW_END[tag].search(source, pos)
                    pos = end.start() if end else len(source)
        flush()

    def _settle(self) -> None:
        """Leave out the doubtful elements that do not hold most of the page's text, and what is in them."""
        if not self.doubts:
            return
        held, article = [0] * len(self.parent), [0] * len(self.parent)
        for owner, text, links in self.blocks:
            worth, up, inside = max(0, len(text) - 2 * links), owner, 0
            while up > 0:
                held[up] += worth
                inside = worth if self.tag[up] == "article" else inside
                if up in self.doubts:
                    article[up] += inside
                up = self.parent[up]
        # what is named as a whole does not count as the page's text, unless an article stands in it
        named = [i for i, d in self.doubts.items() if d == "whole"]
        outer = [i for i in named if not self._under(i, set(named))]
        total = sum(max(0, len(t) - 2 * links) for _, t, links in self.blocks) - sum(held[i] - article[i] for i in outer)
        for i, doubt in self.doubts.items():
            mine = article[i] if doubt == "whole" else held[i]
            if total <= 0 or mine < MOST * total:
                self.out[i] = True
        for i in range(1, len(self.parent)):
            self.out[i] = self.out[i] or self.out[self.parent[i]]
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]

    def _under(self, at: int, some: set[int]) -> bool:
        at = self.parent[at]
        while at > 0:
            if at in some:
                return True
            at = self.parent[at]
        return False

    def best(self) -> int:
        """The container that holds most text outside links, widened to what belongs to it."""
        return self._widened(self._densest())

    def _widened(self, at: int) -> int:
        own: dict[int, list[tuple[str, int, bool]]] = {}       # blocks by the container they stand in directly
        for owner, text, links in self.blocks:
            up = owner
            while up > 0 and self.tag[up] not in CONTAINERS:
                up = self.parent[up]
            own.setdefault(up, []).append((text, links, self.tag[owner] in HEADLINES))
        wide, up = at, self.parent[at] if at > 0 else 0
        while up > 0:
            mine = [b for b in own.get(up, []) if len(b[0]) > 2 * b[1]]
            if self.tag[up] == "article" or (mine and (self.tag[up] not in ("body", "html") or any(b[2] for b in mine))):
                wide = up
            elif self.tag[up] in CONTAINERS and not self._article_above(up):
                break
            up = self.parent[up]
        return wide

    def _article_above(self, at: int) -> bool:
        while at > 0:
            if self.tag[at] == "article":
                return True
            at = self.parent[at]
        return False

    def _densest(self) -> int:
        score: dict[int, float] = {}
        for owner, text, links in self.blocks:
            worth, up = float(max(0, len(text) - 2 * links)), owner
            while up > 0 and worth >= 1:
                if self.tag[up] in CONTAINERS:
                    score[up] = score.get(up, 0.0) + worth
                    worth /= 2
                up = self.parent[up]
        return max(score, key=lambda i: (score[i], -i)) if score and max(score.values()) > 0 else 0

    def _inside(self, wanted: set[int]) -> list[bool]:
        inside = [False] * len(self.parent)
        for i in range(len(self.parent)):
            inside[i] = i in wanted or (i > 0 and inside[self.parent[i]])
        return inside

    def worth(self, inside: list[bool]) -> int:
        """Characters of text outside links in the blocks ``inside``."""
        return sum(max(0, len(t) - 2 * links) for o, t, links in self.blocks if inside[o])

    def within(self, wanted: set[int]) -> list[str]:
        """Blocks of the elements ``wanted``, in page order."""
        inside = self._inside(wanted)
        return [t for o, t, _ in self.blocks if inside[o]]

    def vote(self) -> tuple[str | None, int]:
        """The path of the best container and the text outside links it holds."""
        at = self.best()
        return (self.path[at], self.worth(self._inside({at}))) if at else (None, 0)

    def text(self, paths: list[str], usual: list[float] | None = None) -> str:
        """Text by the first path that holds text, and at least ``SHARE`` of what it holds on pages that
        voted for it (``usual``): a teaser on the path of another template's article is passed over."""
        for p, n in zip(paths, usual or [0.0] * len(paths)):
            on = {i for i, q in enumerate(self.path) if q == p and not self.out[i]}
            inside = self._inside(on) if on else []
            if on and self.worth(inside) >= SHARE * n:
                found = [t for o, t, _ in self.blocks if inside[o]]
                if found:
                    return "\n\n".join(found)
        return "\n\n".join(self.within({self.best()}))


def host(url: Column) -> Column:
    """Host of a url in lower case; ``""`` if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, held): the vote of every page (url, html) that has text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cast = [Page(h.as_py()).vote() for h in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p for p, _ in cast], pa.string()), pa.array([n for _, n in cast], pa.int64())],
                                             names=["host", "path", "held"])

    return pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, held long").where("path is not null")


def winners(cast: DataFrame, paths: int = PATHS) -> DataFrame:
    """(host, paths, usual): each host's paths of most votes, best first, and the mean text their voters hold there."""
    counted = cast.groupBy("host", "path").agg(F.count("*").alias("n"), F.avg("held").alias("usual"))
    first = Window.partitionBy("host").orderBy(F.col("n").desc(), "path")
    top = counted.withColumn("k", F.row_number().over(first)).where(F.col("k") <= paths)
    listed = top.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("k", "path", "usual"))).alias("p"))
    return listed.select("host", F.col("p.path").alias("paths"), F.col("p.usual").alias("usual"))


def extract(pages: DataFrame, paths: int = PATHS, drop_html: bool = True) -> DataFrame:
    """``pages`` (page_id, url, html, ...) with ``text`` and ``n_chars`` (code points)."""
    pages = pages.drop("text", "n_chars")
    source_column = resolve(pages, "html")
    at, won_paths, won_usual = fresh(pages, "_host"), fresh(pages, "_paths"), fresh(pages, "_usual")
    won = scratch(winners(votes(pages), paths), "html-paths")
    won = won.select(F.col("host").alias(at), F.col("paths").alias(won_paths), F.col("usual").alias(won_usual))
    known = lookup(pages.withColumn(at, host(F.col("url"))), won, [at], F.xxhash64("url", "page_id"))
    names = [c for c in pages.columns if not (drop_html and c == source_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            source, ways = b.column(b.schema.get_field_index(source_column)), b.column(b.schema.get_field_index(won_paths))
            usual = b.column(b.schema.get_field_index(won_usual))
            texts = [Page(h.as_py()).text(w.as_py() or [], u.as_py()) for h, w, u in zip(source, ways, usual)]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in names]
                + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*names, "text", "n_chars"])

    types = dict(pages.dtypes)
    return (known.select(*pages.columns, won_paths, won_usual)
            .mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in names] + ["text string, n_chars long"])))


# What the given pages' articles hold, stated by their own markup (article, h1 and p elements).
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(replace(x, '<br>', ' '), '</?(?:p|h1)>'),
        lambda t: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', '', 'g'),
          '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS parts FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda t: t <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""
