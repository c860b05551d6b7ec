"""HTML main-text extraction by consensus host paths.

A page is parsed into blocks of text and the containers that hold them.  Every
container is known by its generalised path: tags with their class and id words,
digits replaced, positions dropped.  A block is worth its length, less where it
is link text.  Boilerplate is dropped and worth nothing: by element, by role, or
by a class or id whose first or last word (cut at hyphens, underscores and
capitals) names it, unless a word such as ``has`` or ``with`` stands before that
or ``free`` behind it; ``comments`` count anywhere.  A marked element that holds
all of the page's other text in paragraphs is a wrapper and counts as plain, but
never one of comments, replies or notices; marks above a main or the longest
article don't count unless that is itself a comment, or stands in an aside, in
comments or in a notice; hidden text always goes.

A container's score is the sum over its blocks, and a page votes for its best
one, the deeper one on ties.  Spark counts the votes per host and path, and the
path of most pages wins, then the one with the larger scores.  Every page is
then extracted again: from the winning path alone, where its own best container
is only the page's body, the path won on three pages or more and holds a fifth
of the page's worth at least, so that a side column that few pages have goes;
else from all elements on both paths, so that nothing of an article is lost
where the host's path is narrower.

Defined cases: null and empty html, and pages without text, give an empty text;
a null url or one without ``://`` belongs to the host ''; unclosed, crossed and
cut-off markup is closed where the parent ends; a ``<`` that opens no tag is
text; repeated rows are judged alike.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytes_ import slices
from .spark_ import shuffle_parts

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_GAP = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element and class names of HTML pages.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td th center header footer nav aside form blockquote "
                       "table tbody thead tr ul ol dl li dd dt figure figcaption details dialog menu fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre address hr summary legend caption option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_TAGS = frozenset("nav footer aside form button select dialog menu head fieldset label".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
NOISE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead sidebar aside widget widgets ad ads adv advert "
    "adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription share sharing social related "
    "recommended comment comments commentlist disqus respond reply replies pagination pager login signup signin "
    "search toolbar copyright hidden disclaimer".split())
#: Words that also name boilerplate at the end of a class, as in 'site-footer'.
NOISE_ENDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar ad ads advert adverts advertisement banner promo "
    "sponsored cookie cookies consent gdpr notice notices newsletter subscribe share sharing related recommended "
    "replies pagination copyright disclaimer".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
#: Elements with these are never taken for a wrapper of the page.
NEVER_WRAPPERS = COMMENT_WORDS | frozenset(
    "respond reply replies cookie cookies consent gdpr notice notices notification alert newsletter subscribe disclaimer".split())
VOIDING_BEFORE = frozenset("has with no without".split())
VOIDING_AFTER = frozenset(["free"])
SITE_HEADERS = frozenset("site page main top global header".split())
#: Votes and share of a page's worth that let a host's path stand for a page whose own best container is its body.
LEAST_VOTES = 3
LEAST_SHARE = 0.2
#: A new element of these closes an open one of the same group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Closing a group stops at these.
SCOPES = frozenset("table ul ol dl body html article section main div".split())


def class_marks(token: str) -> set[str]:
    """The boilerplate words that a class or id token names its element by; 'header' for a site's header."""
    words = [w.lower() for w in _WORD.findall(token)]
    found = set()
    for k, word in enumerate(words):
        if word in NOISE_WORDS and (k == 0 or word in COMMENT_WORDS or k == len(words) - 1 and word in NOISE_ENDS):
            if words[k - 1: k] and words[k - 1] in VOIDING_BEFORE or words[k + 1: k + 2] and words[k + 1] in VOIDING_AFTER:
                continue
            found.add(word)
    if "header" in words[:2] and words[0] in SITE_HEADERS:
        found.add("header")
    return found


class Page:
    """Blocks of a page: ``node`` holds (parent, label, kind) of containers, ``block`` (node, text, worth)."""

    def __init__(self, source: str):
        self.node: list[tuple[int, str, int]] = [(-1, "", 0)]
        self.block: list[tuple[int, str, float]] = []
        self._stack: list[tuple[str, int]] = []  # open containers and the block elements p, h1..., pre
        self._text: list[str] = []
        self._linked = 0
        self._soft: set[int] = set()  # marked by a class or as a form, which may wrap a whole page
        self._aside: set[int] = set()  # asides, comments and notices: no article in them is the page's
        self._paragraphs: set[int] = set()  # containers that hold paragraphs
        self._found: list[tuple[int, str, float, bool]] = []  # node, text, share of links, heading
        self._parse(source)
        self._settle()

    # kind of a node: 0 plain, 1 boilerplate, 2 header (only its headings count inside an article), 3 hidden
    def _open(self, tag: str, attributes: str) -> None:
        words: list[str] = []
        marks: set[str] = set()
        soft = tag in ("form", "fieldset") or tag not in NOISE_TAGS
        kind = 1 if tag in NOISE_TAGS else 2 if tag == "header" else 0
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    words += value.lower().split()
                    marks = marks.union(*map(class_marks, value.split()))
                    continue
                value = value.lower()
                if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    kind = 3
                elif name == "role" and value in NOISE_ROLES and kind != 3:
                    kind, soft = 1, False
        if tag in ("html", "body", "main"):
            marks = set()
        elif tag == "article":
            marks &= COMMENT_WORDS
        if marks - {"header"}:
            kind = kind if kind == 3 else 1
            soft &= not marks & NEVER_WRAPPERS
        elif marks and not kind:
            kind = 2
        parent = self._stack[-1][1] if self._stack else 0
        if tag in CONTAINERS:
            label = ".".join([tag, *sorted({_DIGITS.sub("#", w) for w in words})])
            self.node.append((parent, label, kind))
            parent = len(self.node) - 1
        elif kind in (1, 3):
            self.node.append((parent, tag, kind))
            parent = len(self.node) - 1
        if kind == 1 and soft:
            self._soft.add(parent)
        if tag == "aside" or marks & NEVER_WRAPPERS:
            self._aside.add(parent)
        if tag == "p":
            self._paragraphs.add(parent)
        self._stack.append((tag, parent))

    def _flush(self) -> None:
        if not self._text:
            return
        raw = "".join(self._text)
        self._text, linked, self._linked = [], self._linked, 0
        text = _GAP.sub(" ", entities.unescape(raw) if "&" in raw else raw).strip()
        if not text:
            return
        at = self._stack[-1][1] if self._stack else 0
        heading = bool(self._stack) and self._stack[-1][0] in HEADINGS
        self._found.append((at, text, min(1.0, linked / max(len(raw), 1)), heading))

    def _settle(self) -> None:
        """Lift boilerplate marks from what wraps the page, then judge the blocks."""
        total = [0] * len(self.node)
        for at, text, _, _ in self._found:
            total[at] += len(text)
        own = list(total)
        for k in range(len(self.node) - 1, 0, -1):  # parents come before their children
            total[self.node[k][0]] += total[k]
        tag = [label.partition(".")[0] for _, label, _ in self.node]
        aside, prose = [False] * len(self.node), [k in self._paragraphs for k in range(len(self.node))]
        for k, (parent, _, _) in enumerate(self.node):
            aside[k] = k in self._aside or (parent >= 0 and aside[parent])
        for k in range(len(self.node) - 1, 0, -1):
            prose[self.node[k][0]] |= prose[k]
        own_text = [k for k in range(len(tag)) if not aside[k] and self.node[k][2] == 0]
        articles = [k for k in own_text if tag[k] == "article"]
        kept = {k for k in own_text if tag[k] == "main"} | set(sorted(articles, key=lambda k: -total[k])[:1])
        plain = own  # text below a node that no mark below it covers
        for k in range(len(self.node) - 1, 0, -1):
            if self.node[k][2] == 0:
                plain[self.node[k][0]] += plain[k]
        if not plain[0]:  # all text is marked: the largest wrapper of paragraphs counts as plain
            covered, wrappers = [False] * len(self.node), []
            for k, (parent, _, kind) in enumerate(self.node):
                above = parent >= 0 and covered[parent]
                covered[k] = above or kind != 0
                if kind == 1 and not above and k in self._soft and prose[k] and total[k]:
                    wrappers.append(k)
            if wrappers:
                k = max(wrappers, key=lambda k: total[k])
                self.node[k] = (*self.node[k][:2], 0)
        for at, text, share, heading in self._found:
            good, k, inside, header, free = True, at, False, False, False
            while k >= 0:
                parent, _, kind = self.node[k]
                good &= kind != 3 and (kind != 1 or free)
                header |= kind == 2
                inside |= tag[k] in ("article", "main")
                free |= k in kept
                k = parent
            good &= not header or (heading and inside)
            # what text() drops is no charge on the container around it
            self.block.append((at if good else -1 - at, text, len(text) * (1 - 2 * share) if good else 0.0))

    def _close_to(self, depth: int) -> None:
        self._flush()
        del self._stack[depth:]

    def _parse(self, source: str) -> None:
        at, size, link = 0, len(source), 0
        while at < size:
            m = _TOKEN.search(source, at)
            piece = source[at: m.start()] if m else source[at:]
            if piece:
                self._text.append(piece)
                if link:
                    self._linked += len(piece)
            if not m:
                break
            at = m.end()
            if not (tag := m[2]):
                continue
            tag = tag.lower()
            if m[1]:
                if tag == "a":
                    link = max(0, link - 1)
                elif tag in BLOCKS or tag in NOISE_TAGS:
                    for depth in range(len(self._stack) - 1, -1, -1):
                        if self._stack[depth][0] == tag:
                            self._close_to(depth)
                            link = 0
                            break
                    else:
                        self._flush()
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    end = re.compile(f"</{tag}", re.I).search(source, at)
                    at = source.find(">", end.end()) + 1 if end else size
                    at = at or size
                continue
            if tag == "a":
                link += 1
            elif tag == "br":
                self._text.append(" ")
            elif tag in BLOCKS or tag in NOISE_TAGS:
                self._flush()
                link = 0
                if tag in VOID:
                    continue
                while self._stack and (self._stack[-1][0] == "p" or self._stack[-1][0] in HEADINGS) and tag in BLOCKS:
                    self._stack.pop()  # a paragraph or heading ends where a block begins
                if group := SIBLINGS.get(tag):
                    for depth in range(len(self._stack) - 1, -1, -1):
                        if self._stack[depth][0] in group:
                            del self._stack[depth:]
                            break
                        if self._stack[depth][0] in SCOPES:
                            break
                self._open(tag, m[3])
        self._flush()

    def paths(self) -> list[str]:
        out: list[str] = []
        for parent, label, _ in self.node:
            out.append(f"{out[parent]}>{label}" if parent >= 0 and out[parent] else label)
        return out

    def scores(self) -> dict[str, float]:
        """Worth of every container path: the sum over the blocks below its elements."""
        paths, total = self.paths(), defaultdict(float)
        for node, _, worth in self.block:
            k, seen = node if node >= 0 else -1 - node, set()
            while k >= 0:
                if paths[k] not in seen:
                    seen.add(paths[k])
                    total[paths[k]] += worth
                k = self.node[k][0]
        for (_, label, kind), path in zip(self.node, paths):
            if kind in (1, 3):
                total.pop(path, None)
        return total

    def text(self, *chosen: str) -> str:
        """Good blocks under the elements on any of the ``chosen`` paths, in page order, joined by an empty line."""
        paths = self.paths()
        inside = [False] * len(paths)
        for k, (parent, _, _) in enumerate(self.node):
            inside[k] = paths[k] in chosen or (parent >= 0 and inside[parent])
        return "\n\n".join(text for node, text, _ in self.block if node >= 0 and inside[node])


def best_path(scores: dict[str, float]) -> str | None:
    """Highest score; of equals the deeper path, then the first in order."""
    good = [(s, p.count(">"), p) for p, s in scores.items() if s > 0]
    if not good:
        return None
    top = max((s, d) for s, d, _ in good)
    return min(p for s, d, p in good if (s, d) == top)


def extracted(source: str, path: str | None, votes: int) -> str:
    """The text of a page, given the winning path of its host and the pages that voted for it."""
    page = Page(source)
    scores = page.scores()
    own = best_path(scores)
    if own is None:
        return ""
    if path is None or scores.get(path, 0) <= 0:
        return page.text(own)
    root = re.split("[.]", own.rpartition(">")[2])[0] in ("", "html", "body")
    if root and votes >= LEAST_VOTES and scores[path] >= LEAST_SHARE * scores[own]:
        return page.text(path)
    return page.text(own, path)


def host_of(url: str | Column) -> Column:
    """Host of a url: after ``://`` up to ``/ ? #``, A-Z lower-cased; '' without ``://``."""
    host = F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) per row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host_of(url_col).alias("_host"),
                        F.col(html_col).alias("_html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_html"):
            total: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])  # summed before the shuffle
            for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                scores = Page(source or "").scores()
                if (own := best_path(scores)) is not None:
                    count = total[host, own]
                    count[0], count[1] = count[0] + 1, count[1] + round(scores[own])
            if total:
                hosts, paths = zip(*total)
                pages_, scores_ = zip(*total.values())
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                                  pa.array(pages_, pa.int64()), pa.array(scores_, pa.int64())],
                                                 names=["_host", "_path", "_pages", "_score"])

    votes = rows.select("_host", "_html").mapInArrow(vote, "_host string, _path string, _pages long, _score long")
    depth = F.length("_path") - F.length(F.replace(F.col("_path"), F.lit(">"), F.lit("")))
    winners = (votes.groupBy("_host", "_path").agg(F.sum("_pages").alias("_pages"), F.sum("_score").alias("_score"))
               .groupBy("_host").agg(F.max(F.struct("_pages", "_score", depth.alias("d"), "_path")).alias("_w"))
               .select("_host", "_w._path", "_w._pages"))
    schema = rows.select("_id", "_url").schema.add("text", "string").add("n_chars", "long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_html"):
            texts = [extracted(source or "", path, won or 0)
                     for source, path, won in zip(*(part.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    # A host may hold a third of all pages: its pages are dealt over `spread` keys, its one winner is repeated for each.
    spread = shuffle_parts(pages.sparkSession)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(spread)))
    winners = winners.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    return (rows.join(winners, ["_host", "_salt"], "left").select("_id", "_url", "_html", "_path", "_pages").mapInArrow(extract, schema)
            .withColumnsRenamed({"_id": id_col, "_url": url_col}))
