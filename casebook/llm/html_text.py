"""Main text of web pages by consensus paths per host.

1. Every page is cut into text blocks; each block belongs to the nearest
   container (an element that is no paragraph, list, table part or inline
   element). Elements that are never article text are skipped with all they
   hold (tags, roles and class words below). A container scores the characters
   outside links of its own blocks, and half as much per level of what its
   inner containers score. Containers that only their class or id calls
   secondary (SKIP_WORDS, unless the word is negated or a modifier) are left out
   as a guess; one that holds the article after all is taken back, and the host's
   vote overrules the list. The header inside an article counts as a header.
   The article is the container with the best score, or rather the highest one
   around it that adds ADDS_PCT of text outside links to what it holds (any such
   text, if it is an ``article`` or ``main`` element): titles, leads and sections
   of another class belong to it.
2. The page votes for the path of its article: tags and classes from
   the root, digits generalised to ``#``. Spark counts the votes per host; most
   votes win, then the higher total score, then the smaller path.
3. The text is taken from the containers on the host's winning path; from the
   page's own article if the page has none on it or has no host. It is also
   taken from there if the winning path holds less than COVERS_PCT of it and
   the host knows the path of the page's article as one: at least half of the
   pages that hold the path vote for it (a second template; not a side panel
   that is long on one page).

Character references are decoded, white space inside a block becomes one
space, blocks are joined by ``\\n`` in page order. A null or empty page has an
empty text. Rows that repeat a page_id are extracted one by one. Very long and
broken pages take time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import stage

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var img br wbr".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th caption "
                 "address hr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SKIP = frozenset("head title script style noscript template iframe svg canvas object math button select textarea nav header footer "
                 "aside form dialog menu audio video".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
SKIP_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
                       "navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup "
                       "modal newsletter subscribe share sharing social related comment comments disqus replies respond widget "
                       "pagination pager toolbar alert skip".split())
ADDS_PCT = 5
COVERS_PCT = 50
ARTICLE_WORDS = frozenset("article entry post content story".split())

NOT_FIRST = frozenset("has no not with without is hide show".split())          # has-sidebar says how a page looks, not what it holds
NOT_LAST = frozenset("free open opened closed enabled disabled on off visible active policy".split())
RAW = frozenset("script style title textarea noscript template iframe svg".split())
LONG_PATH = 400
RELEASED_CHARS = 400

_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)|[!?/])")
_QUOTE_OR_END = re.compile("[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)} if text.strip(" /") else {}


def skipped(tag: str, attrs: dict[str, str]) -> bool:
    """Is the element never article text?"""
    if tag in SKIP:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("role", "").lower() in SKIP_ROLES or attrs.get("aria-hidden") == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    return False


def secondary(tag: str, attrs: dict[str, str]) -> bool:
    """Does the element's class or id say that it is no article text? A guess: the page may overrule it."""
    if not attrs or tag in ("html", "body", "main"):
        return False
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
    hits, whole = set(), False
    for name in names:
        parts = _WORD.findall(name)
        found = SKIP_WORDS.intersection(parts)
        if "header" in parts and not ARTICLE_WORDS.intersection(parts):
            found = found | {"header"}
        if not found or len(parts) > 1 and (parts[0] in NOT_FIRST or parts[-1] in NOT_LAST):
            continue
        hits |= found
        whole = whole or len(parts) == 1
    if tag == "article":
        hits &= {"comment", "comments", "ad", "advert", "promo", "related"}
    return bool(hits) and (whole or not ARTICLE_WORDS.intersection(names))


def tokens(source: str):
    """(start, end, is an end tag, tag, attributes' text) of every tag, without tag of comments and elements of raw text.

    Every part of the source is looked at a bounded number of times, whatever is left
    open in it: quotes that led to no end, and names without a later end tag, are remembered.
    """
    at, last = 0, {c: source.rfind(c) for c in ">\"'"}
    dead: set[int] = set()                            # opening quotes after which no tag ends
    no_end: set[str] = set()
    while True:
        m = _OPEN.search(source, at)
        if m is None:
            return
        if m["comment"]:
            end = source.find("-->", m.end())
            at = len(source) if end < 0 else end + 3
            yield m.start(), at, False, None, ""
            continue
        if m.end() > last[">"]:
            return                                    # nothing ends any more: the rest is text
        if not m["tag"]:
            at = source.index(">", m.end()) + 1
            yield m.start(), at, False, None, ""
            continue
        k, seen = m.end(), []
        while True:
            q = _QUOTE_OR_END.search(source, k) if k <= last[">"] else None
            if q is None or q[0] != ">" and (q.start() in dead or q.start() >= last[q[0]]):
                dead.update(seen)
                end = source.index(">", m.end())      # an open quote: the tag ends at the first >
                break
            if q[0] == ">":
                end = q.start()
                break
            seen.append(q.start())
            k = source.index(q[0], q.end()) + 1
        at, tag = end + 1, m["tag"].lower()
        if tag in RAW and not m["end"] and tag not in no_end:
            close = _RAW_END[tag].search(source, at)
            if close:
                at = close.end()
                yield m.start(), at, False, None, ""
                continue
            no_end.add(tag)
        yield m.start(), at, bool(m["end"]), tag, source[m.end():end]


def _below(path: str, tag: str) -> str:
    """Path of a container in another one; that of a very deep one begins with a digest."""
    if len(path) > LONG_PATH:
        path = "#" + hashlib.blake2b(path.encode(errors="replace"), digest_size=12).hexdigest()
    return f"{path}>{tag}"


class Page:
    """Text blocks of a page and the containers that hold them."""

    def __init__(self, source: str):
        self.paths, self.parents = [""], [-1]         # container 0: the root
        self.soft, self.main = [False], [False]       # named as secondary; holds h1, main or an article
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters outside links
        stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]   # tag, container, skipped, in a link
        open_at: dict[str, list[int]] = {}            # where in the stack a tag is open
        solid = [0]                                   # where in the stack the elements are that are not inline
        parts: list[str] = []
        plain = 0

        def flush():
            nonlocal plain
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((stack[-1][1], text, plain))
                parts.clear()
                plain = 0

        def push(tag, box, skip, link):
            open_at.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                solid.append(len(stack))
            stack.append((tag, box, skip, link))

        def cut(k):
            while len(stack) > k:
                open_at[stack.pop()[0]].pop()
            while solid[-1] >= k:
                solid.pop()

        def container(tag, attrs, box, soft):
            classes = sorted({_DIGITS.sub("#", c) for c in attrs.get("class", "").split()})
            self.paths.append(_below(self.paths[box], ".".join([tag, *classes])))
            self.parents.append(box)
            self.soft.append(soft)
            self.main.append(tag in ("main", "article") and not soft)
            return len(self.paths) - 1
        at = 0
        for start, end, closes, tag, inner in tokens(source):
            _, _, skip, link = stack[-1]
            if start > at and not skip:
                text = source[at:start]
                parts.append(text)
                plain += 0 if link else len(text.strip())
            at = end
            if not tag:
                continue
            if closes:
                k = open_at[tag][-1] if open_at.get(tag) else 0
                if tag not in INLINE:
                    flush()
                    if k:
                        cut(k)
                elif k > solid[-1]:                   # an end tag does not reach out of its block
                    cut(k)
                continue
            if tag in INLINE:
                if tag in VOID:
                    parts.append(" ") if not skip else None
                else:
                    attrs = attributes(inner)
                    push(tag, stack[-1][1], skip or skipped(tag, attrs) or secondary(tag, attrs), link or tag == "a")
                continue
            flush()
            k = solid[-1]                             # a block ends an open paragraph, an item the item before it
            if k > 0 and (stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ())):
                cut(k)
            if tag in VOID:
                continue
            _, box, skip, link = stack[-1]
            attrs = attributes(inner)
            skip = skip or skipped(tag, attrs)
            if not skip:
                soft = secondary(tag, attrs)
                if tag not in LEAF or soft:
                    box = container(tag, attrs, box, soft)
                elif tag == "h1":
                    self.main[box] = True
            push(tag, box, skip, link)
        if at < len(source) and not stack[-1][2]:
            parts.append(source[at:])
            plain += len(source[at:].strip())
        flush()
        self._release()

    def _release(self):
        """A secondary container that holds the page's article is none: a wrapper around (nearly) everything,
        or one with more text than all the rest and a main heading, main element or article in it."""
        n = len(self.paths)
        top = [0] * n                                 # the outermost secondary container around each
        nested = [False] * n                          # inside a second one
        for b in range(1, n):
            up = self.parents[b]
            top[b] = top[up] or (b if self.soft[b] else 0)
            nested[b] = nested[up] or bool(top[up] and self.soft[b])
        held, main = [0] * n, [False] * n
        for box, _, plain in self.blocks:
            if not nested[box]:
                held[top[box]] += plain
        for b in range(n):
            if self.main[b] and not nested[b]:
                main[top[b]] = True
        for b in range(1, n):
            if top[b] == b and (held[b] > held[0] and main[b] or held[b] >= RELEASED_CHARS and held[b] > 20 * held[0]):
                self.soft[b] = False

    def best(self) -> tuple[int, float]:
        """The article: its container and the characters outside links it holds."""
        score = [0.0] * len(self.paths)
        live = self.within({0})
        for box, _, plain in self.blocks:
            if live[box]:
                score[box] += plain
        held = [int(x) for x in score]
        for box in range(len(score) - 1, 0, -1):      # inner containers come later
            score[self.parents[box]] += score[box] / 2
            held[self.parents[box]] += held[box]
        top = max((b for b in range(len(score)) if live[b]), key=lambda b: (score[b], -b))     # the first of equals
        box = self.parents[top]
        while box >= 0:
            more = held[box] - held[top]
            tag = self.paths[box].rpartition(">")[2].partition(".")[0]
            if more > 0 and (100 * more >= ADDS_PCT * held[box] or tag in ("article", "main")):
                top = box
            box = self.parents[box]
        return top, held[top]

    def within(self, chosen: set[int]) -> list[bool]:
        """Which containers are among the chosen or inside one, secondary ones inside it left out."""
        inside = [False] * len(self.paths)
        for b in range(len(inside)):
            inside[b] = b in chosen or (b > 0 and inside[self.parents[b]] and not self.soft[b])
        return inside

    def text(self, path: str | None) -> str:
        """Text of the containers on ``path``, or of the article if there are none."""
        inside = self.within({b for b, p in enumerate(self.paths) if p == path} or {self.best()[0]})
        return "\n".join(t for b, t, _ in self.blocks if inside[b])

    def own(self, path: str | None) -> tuple[str, str | None]:
        """Path of the article; its text, if the containers on ``path`` hold too little of it."""
        box, size = self.best()
        chosen = {b for b, p in enumerate(self.paths) if p == path}
        if not chosen or self.paths[box] == path:
            return self.paths[box], None
        inside, article = self.within(chosen), self.within({box})
        covered = sum(plain for b, _, plain in self.blocks if inside[b] and article[b])
        if 100 * covered >= COVERS_PCT * size:
            return self.paths[box], None
        return self.paths[box], "\n".join(t for b, t, _ in self.blocks if article[b])


def _votes(batches):
    """Per batch, host and path: pages that hold it, pages that vote for it, their score."""
    for b in batches:
        held: dict[tuple, list[int]] = {}
        for h, source in zip(b.column("host").to_pylist(), b.column("html")):
            page = Page(source.as_py() or "")
            if page.blocks:
                box, points = page.best()
                for path in set(page.paths):
                    x = held.setdefault((h, path), [0, 0, 0])
                    x[0] += 1
                    if path == page.paths[box]:
                        x[1] += 1
                        x[2] += int(points)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[j] for k in held], pa.string()) for j in (0, 1)]
            + [pa.array([x[j] for x in held.values()], pa.int64()) for j in (0, 1, 2)], ["host", "path", "pages", "votes", "score"])


def _extract(batches):
    for b in batches:
        texts, own, spare = [], [], []
        for s, p in zip(b.column("html"), b.column("path").to_pylist()):
            page = Page(s.as_py() or "")
            texts.append(page.text(p))
            path, text = page.own(p)
            own.append(path)
            spare.append(text)
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("host"), pa.array(own, pa.string()),
                                          pa.array(texts, pa.string()), pa.array(spare, pa.string())],
                                         ["page_id", "url", "host", "own", "text", "spare"])


def host_of(url: Column) -> Column:
    """Lower-case host of a url, null if it has none."""
    host = F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def path_votes(pages: DataFrame) -> DataFrame:
    """(host, path, pages, votes, score) of the paths that have votes."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").where("host is not null")
    return (rows.mapInArrow(_votes, "host string, path string, pages long, votes long, score long").groupBy("host", "path")
                .agg(*(F.sum(c).alias(c) for c in ("pages", "votes", "score"))).where("votes > 0"))


def consensus_paths(votes: DataFrame) -> DataFrame:
    """(host, path): the winning container path of every host."""
    return votes.groupBy("host").agg(F.min(F.struct(-F.col("votes"), -F.col("score"), "path")).alias("w")).select("host", "w.path")


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    votes = stage(path_votes(pages), "html_paths")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(consensus_paths(votes), "host", "left")
    out = rows.select("page_id", "url", "host", "html", "path").mapInArrow(
        _extract, "page_id long, url string, host string, own string, text string, spare string")
    known = votes.where("2 * votes >= pages").select("host", F.col("path").alias("own"), F.lit(True).alias("known"))
    out = out.join(known, ["host", "own"], "left")
    out = out.select("page_id", "url", F.when(F.col("known") & F.col("spare").isNotNull(), F.col("spare")).otherwise(F.col("text")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
