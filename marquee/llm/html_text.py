"""Main text of web pages by consensus of their host.

A first pass scores the containers of every page (text in blocks, punctuation, link share) and votes
for the generalised tag-class path of the best one, page by page. Spark sums the votes per host; the
path with most of them wins. A second pass extracts every page of the host by the winning path; a
page that has no such container falls back on its own best one, and a page of a host without votes has
no text.

What is no main text is told by its element (a menu, a form, ...) or by the class, id or role of a container. A
name hides a container if it is one of the known words, or begins or ends with one (`cookie-notice`), but for
names that speak of a state (`has-sidebar`). It never hides a container that holds the page's article, nor one
that holds most of the page's text where there is no article; names of reader comments hide in any case, unless
nothing else is there. Text in `math` and `noscript` elements stays.

Elements are numbered, with the number of the one around them, and so are paths, so a page takes memory in
proportion to its length however deeply it is nested; the text of a path is made for the winner alone.

Defined cases: null or empty html gives an empty text; a null or broken url counts as one host of its
own; unclosed elements end where HTML says or with the page; repeated rows give repeated results; an
empty table gives an empty result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch, bounded_side

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|template|iframe|svg|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img input meta link base area col embed source track param hr "
    "noscript object math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mspace "
    "mtable mtr mtd semantics annotation".split())
VOID = frozenset("br img input meta link base area col embed source track param hr wbr".split())
# An opening tag of the first kind ends an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
HIDDEN_TAGS = frozenset("head nav footer aside form button menu dialog".split())
HIDDEN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar side comment comments "
    "reply replies respond discussion disqus feedback cookie cookies consent gdpr notice notices alert popup modal overlay "
    "menu nav navbar navigation breadcrumb breadcrumbs footer foot masthead share sharing social related recommended "
    "newsletter subscribe signup login search pagination pager widget toolbar skip complementary contentinfo".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond discussion disqus".split())
#: A name that begins with one of these says that something else is or is not there.
STATES = frozenset("has have no not with without is hide show".split())
CONTENT_TAGS = frozenset(("article", "main"))
WORD = re.compile(r"[a-z]+")


def hiding(names: list[str]) -> tuple[bool, bool]:
    """Does one of the names hide its container, and does one speak of reader comments?"""
    hides = comments = False
    for name in names:
        words = WORD.findall(name)
        if words and words[0] not in STATES:
            ends = {words[0], words[-1]}
            hides = hides or not HIDDEN_NAMES.isdisjoint(ends)
            comments = comments or not COMMENT_NAMES.isdisjoint(ends)
    return hides, comments


class Page:
    """The text blocks of a page in order: `found` has (path, element, text, characters in links) of each."""

    def __init__(self):
        self.found: list[tuple[int, int, str, int]] = []
        # Paths: the one above, the last step. Equal paths have one number.
        self.above: list[int] = [0]
        self.steps: list[str] = [""]
        self._paths: dict[tuple[int, str], int] = {}
        # Elements: the one around, hidden by tag, by name, a name of comments, an article or main element.
        self.around: list[int] = [0]
        self.marks: list[tuple[bool, bool, bool, bool]] = [(False, False, False, False)]
        self.hidden: list[bool] = []

    def path(self, above: int, step: str) -> int:
        number = self._paths.setdefault((above, step), len(self.steps))
        if number == len(self.steps):
            self.above.append(above)
            self.steps.append(step)
        return number

    def named(self, path: int) -> str:
        steps = []
        while path:
            steps.append(self.steps[path])
            path = self.above[path]
        return "".join(">" + s for s in reversed(steps))

    def numbered(self, name: str) -> int | None:
        """The path of this name, if the page has it."""
        path = 0
        for step in name.split(">")[1:]:
            path = self._paths.get((path, step))
            if path is None:
                return None
        return path

    def element(self, around: int, *marks: bool) -> int:
        self.around.append(around)
        self.marks.append(marks)
        return len(self.around) - 1

    def settle(self) -> None:
        """Decide which elements are hidden, when all of the page is known."""
        size = [0] * len(self.around)
        tagged = [False] * len(self.around)
        for i in range(1, len(self.around)):
            tagged[i] = tagged[self.around[i]] or self.marks[i][0]
        for _, element, text, _ in self.found:
            if not tagged[element]:
                size[element] += len(text)
        content = [m[3] and not tagged[i] and not m[2] for i, m in enumerate(self.marks)]
        for i in range(len(self.around) - 1, 0, -1):
            size[self.around[i]] += size[i]
            content[self.around[i]] = content[self.around[i]] or content[i]
        self.hidden = [False] * len(self.around)
        for i in range(1, len(self.around)):
            by_tag, by_name, comments, _ = self.marks[i]
            if by_name and not comments:
                by_name = not (content[i] or not content[0] and size[i] * 2 > size[0])
            elif by_name:
                by_name = size[i] < size[0]
            self.hidden[i] = self.hidden[self.around[i]] or by_tag or by_name


def blocks(page: str) -> Page:
    """The text blocks of a page."""
    out = Page()
    # Open elements: tag, path, element, inside an article or main element.
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
    open_tags: dict[str, int] = defaultdict(int)
    text: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush():
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.found.append((stack[-1][1], stack[-1][2], joined, linked))
        text.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked
        piece = entities.unescape(piece) if "&" in piece else piece
        text.append(piece)
        if in_link:
            linked += len(piece)

    def close():
        open_tags[stack.pop()[0]] -= 1

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m["end"] else 1
            elif tag == "br" or tag == "hr":
                text.append(" ")
            if tag == "hr":
                flush()
            continue
        flush()
        in_link = 0
        if tag == "p":
            # A paragraph is a block of the container around it, and ends with the next block.
            continue
        if m["end"]:
            if open_tags[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        while len(stack) > 1 and stack[-1][0] in CLOSES.get(tag, ()):
            close()
        if tag[0] == "h" and tag[1:].isdigit():
            continue
        names = [(a or b or c).lower() for _, a, b, c in NAMES.findall(m["rest"])] if m["rest"] else []
        words = [w for n in names for w in WORD.findall(n)]
        _, path, around, in_content = stack[-1]
        content = tag in CONTENT_TAGS
        by_name, comments = hiding([t for n in names for t in n.split()]) if names and tag not in ("html", "body") else (False, False)
        path = out.path(path, tag + "".join("." + w for w in dict.fromkeys(words)))
        if m["rest"][-1:] != "/" or content:
            by_tag = tag in HIDDEN_TAGS or tag == "header" and not in_content
            element = out.element(around, by_tag, by_name and (comments or not content), comments, content)
            stack.append((tag, path, element, in_content or content))
            open_tags[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    out.settle()
    return out


def best_container(page: Page) -> tuple[str, float] | None:
    """The path of the container with the best score, the deepest and first of equal ones; a content element
    around it stands in for it."""
    scores: dict[int, float] = defaultdict(float)
    for path, element, text, linked in page.found:
        if page.hidden[element] or linked * 2 > len(text):
            continue
        score = min(len(text) / 100, 5) + text.count(",") + text.count(".") / 2 + 0.1
        for share in (1.0, 0.5, 0.25):
            if not path:
                break
            scores[path] += share * score
            path = page.above[path]
    if not scores:
        return None
    depth = [0] * len(page.above)
    for i in range(1, len(page.above)):
        depth[i] = depth[page.above[i]] + 1
    path, score = max(scores.items(), key=lambda x: (x[1], depth[x[0]], -x[0]))
    inner = path
    while inner and page.steps[inner].split(".")[0] not in CONTENT_TAGS:
        inner = page.above[inner]
    return page.named(inner or path), score


def extract(page: Page, path: str) -> str:
    """The blocks inside the containers of this path, one per line."""
    top = page.numbered(path)
    if top is None:
        return ""
    inside = [False] * len(page.above)
    for i in range(len(inside)):
        inside[i] = i == top or i > top and inside[page.above[i]]
    return "\n".join(text for p, element, text, _ in page.found if inside[p] and not page.hidden[element])


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _vote(batches):
    for batch in batches:
        votes: dict[tuple, list] = defaultdict(lambda: [0, 0.0])
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if page and (best := best_container(blocks(page))):
                vote = votes[host, best[0]]
                vote[0] += 1
                vote[1] += best[1]
        yield pa.RecordBatch.from_pydict({
            "host": pa.array([h for h, _ in votes], pa.string()), "path": pa.array([p for _, p in votes], pa.string()),
            "pages": pa.array([v[0] for v in votes.values()], pa.int64()),
            "score": pa.array([round(v[1] * 10) for v in votes.values()], pa.int64())})


def _extract(batches):
    for batch in batches:
        texts = []
        for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist()):
            found = blocks(page or "")
            text = extract(found, path) if path is not None else ""
            if not text and (own := best_container(found)):
                text = extract(found, own[0])
            texts.append(text)
        out = {n: batch.column(n) for n in ("page_id", "url", "path")}
        yield pa.RecordBatch.from_pydict(out | {"text": pa.array(texts, pa.string())})


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, pages: the winning container path of every host."""
    votes = pages.select("host", "html").mapInArrow(_vote, "host string, path string, pages long, score long")
    return (
        votes.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("score").alias("score"))
        .groupBy("host").agg(F.max(F.struct("pages", "score", "path")).alias("best"))
        .select("host", F.col("best.path").alias("path"), F.col("best.pages").alias("pages"))
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, path per page, from all pages of every host."""
    scratch = Scratch(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), F.coalesce(
        F.lower(F.regexp_extract(F.col("url").cast("string"), HOST, 1)), F.lit("")).alias("host"))
    winners = scratch.keep(host_paths(rows), "paths")
    # A hot host stands on the left side, which adaptive execution splits.
    joined = rows.join(bounded_side(scratch, winners.select("host", "path"), "paths"), "host", "left")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    texts = joined.select("page_id", "url", "html", "path").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, path string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
