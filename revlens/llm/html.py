"""HTML extraction by line-block distribution.

1. Markup is stripped into lines: one per block element (a paragraph, a heading, an item, a cell).
   Scripts, styles, comments and forms go, and so do containers that say they are not the article: by
   tag (nav, footer, aside ...), role, or the names in their class and id. A name like ``has-comments`` or
   ``share-enabled`` describes the container, it doesn't say what it is. A container that holds the only
   article or main element of a page is never cut for its names.
2. Each line has a weight: its characters outside links, 0 where links hold half of it or more. Lines in
   an article or main element count whole, links too, with ``surge`` on top, and then the lines outside
   weigh nothing.
3. Window sums ``B[i] = w[i] + ... + w[i + k - 1]`` are the distribution. The text surges at the first
   line with weight whose window reaches ``surge``, and dives where the window falls below ``dive``.
4. Lines between surge and dive are kept. Two kept stretches that only plain short lines part are one
   stretch, a heading just above a surge belongs to it, and so do short plain lines before and after it
   that stand in the same container.

Runs per page inside Arrow batches; pages need no shuffle and share no state.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.registry import query, table

# --- fixed values: tags and the words of class and id that mark what isn't the article -----------
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "textarea", "title"}
SKIP = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "select", "label", "fieldset"}
INLINE = set(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i img ins kbd mark math q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br input mi mn mo mrow msup msub mfrac msqrt mtext semantics annotation".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CODE = {"pre", "code", "samp", "kbd"}
CONTAINERS = set("html body div section article main td th ul ol dl table center blockquote header".split())
NEVER = set(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr popup modal "
    "newsletter subscribe sidebar rail widget related recommended recommendations share sharing social breadcrumb "
    "breadcrumbs menu nav navbar navigation footer copyright comment comments disqus respond reply replies discussion "
    "login signup pagination pager".split()
)
RARELY = set("header masthead topbar toolbar banner notice notices alert side search legal tags skip".split())
CONTENT = set("article content main post entry body story text page".split())
DESCRIBES = set("has have with without no not non is are can show shows hide hides supports allow allows enabled disabled on off open closed count".split())
ROLES = set("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar".split())
# -----------------------------------------------------------------------------------------------

NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>|\Z", re.I) for t in RAW}


class Tag(NamedTuple):
    """A tag or comment at ``page[start:end]``; comments and declarations have no name."""

    start: int
    end: int
    name: str
    closing: bool
    attrs: str


def tags_of(page: str) -> list[Tag]:
    """The tags of a page in order, found in time linear in its length.

    A ``>`` in quotes doesn't end a tag. Where a quote is never closed it is a plain character. The next
    occurrences of ``>`` and of both quotes are remembered, and once a tag has run to the end of the page
    in search of its ``>`` the quotes of later ones are ignored, so nothing is searched again and again.
    """
    out: list[Tag] = []
    size = len(page)
    seen = {c: (0, -1) for c in ">\"'"}
    quoted = True

    def following(c: str, at: int) -> int:
        since, found = seen[c]
        if not since <= at <= found:
            found = page.find(c, at)
            seen[c] = (at, size if found < 0 else found)
        return seen[c][1]

    at = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
            out.append(Tag(at, end, "", False, ""))
            at = end
            continue
        m = NAME.match(page, at)
        if not m and page[at + 1 : at + 2] not in ("!", "?"):
            at += 1
            continue
        first = following(">", at)
        if first >= size:
            break  # no tag ends after this point
        i = m.end() if m else at + 2
        end = first
        while m and quoted:
            end = following(">", i)
            quote = min(following('"', i), following("'", i))
            if end >= size:
                quoted, end = False, first
                break
            if quote > end:
                break
            close = page.find(page[quote], quote + 1) if quote < size else -1
            if close < 0:
                break
            i = close + 1
        name = m[2].lower() if m else ""
        out.append(Tag(at, end + 1, name, bool(m and m[1]), page[m.end() : end] if m else ""))
        at = end + 1
        if name in RAW and not out[-1].closing and not out[-1].attrs.endswith("/"):
            raw = RAW_END[name].search(page, at)
            out[-1] = out[-1]._replace(end=raw.end())
            at = raw.end()
    return out


def attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)} if attrs else {}


def hidden(found: dict[str, str]) -> bool:
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True
    return found.get("role", "").lower() in ROLES


def named_unwanted(found: dict[str, str], inside: bool, heading: bool) -> bool:
    """Whether class and id name something that isn't the article.

    Each blank-separated name is judged by its words; names that only describe (``has-sidebar``) are passed
    over. A name that is all content words outweighs names that mix an unwanted word with others.
    """
    content = pure = mixed = rare = False
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) - {""}
        if not words or words & DESCRIBES:
            continue
        content |= words <= CONTENT
        pure |= words <= NEVER
        mixed |= bool(words & NEVER)
        rare |= bool(words & RARELY) and not words & CONTENT and not (inside and words & {"header", "notice", "notices", "alert", "legal"})
    return pure or mixed and not content or rare and not content and not heading


class Line:
    __slots__ = ("text", "linked", "inside", "heading", "after_cut", "parent")

    def __init__(self, text: str, linked: int, inside: bool, heading: bool, after_cut: bool, parent: int):
        self.text, self.linked, self.inside, self.heading, self.after_cut, self.parent = text, linked, inside, heading, after_cut, parent


def only_articles(tags: list[Tag]) -> dict[int, int]:
    """For each opening tag that holds all wanted article and main elements of the page: its closing tag.

    An article element is wanted if its own names don't speak against it.
    """
    articles = [
        k for k, t in enumerate(tags)
        if t.name in ("article", "main") and not t.closing and not hidden(f := attributes(t.attrs)) and not named_unwanted(f, False, False)
    ]
    if not articles:
        return {}
    out: dict[int, int] = {}
    open_: dict[str, list[int]] = {}
    for k, t in enumerate(tags):
        if t.name in CONTAINERS:
            if not t.closing:
                open_.setdefault(t.name, []).append(k)
            elif open_.get(t.name):
                begin = open_[t.name].pop()
                if begin < articles[0] and articles[-1] < k:
                    out[begin] = k
    for left in open_.values():
        out.update((begin, len(tags)) for begin in left if begin < articles[0])
    return out


def lines_of(page: str) -> list[Line]:
    """The block lines of a page in order, without unwanted containers."""
    out: list[Line] = []
    parts: list[str] = []
    linked = links = depth = code = 0  # characters in links, open links, open article or main and code elements
    heading = cut = False
    parents = [0]  # the open containers, by number
    n_parents = 0
    skipped, nested = "", 0  # the unwanted element that is open, and how many of its tag
    at = 0

    def flush() -> None:
        nonlocal linked, cut
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(Line(text, min(linked, len(text)), depth > 0, heading, cut, parents[-1]))
            cut = False
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not skipped:
            parts.append(text)
            linked += len(text) if links else 0

    tags = tags_of(page)
    holds = only_articles(tags)
    for k, (start, stop, tag, end, attrs) in enumerate(tags):
        say(page[at:start])
        at = stop
        if not tag or tag in RAW:
            continue
        if skipped:
            if tag == skipped and tag not in VOID:
                nested += -1 if end else 1
                if not nested:
                    skipped, cut = "", True
                continue
            begins = not end and tag in ("article", "main") and skipped not in ("article", "section", "div")
            if not (begins and not named_unwanted(attributes(attrs), False, False)) and not (tag == "body" and not end):
                continue
            skipped, cut = "", True  # an unclosed menu ends where the article starts
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            links = 0 if end else 1
        found = {} if end else attributes(attrs)
        if tag in CODE:
            code = max(0, code + (-1 if end else 1))
        if tag in INLINE:
            lone_button = tag == "button" and not (depth and "".join(parts).strip())
            if not end and tag not in VOID and (lone_button or hidden(found) and tag != "math" or not code and not depth and named_unwanted(found, False, False)):
                skipped, nested = tag, 1
            continue
        flush()
        links = 0
        unwanted = not end and tag not in ("html", "body") and (
            tag in SKIP
            or hidden(found)
            or tag != "main" and not code and k not in holds and named_unwanted(found, depth > 0, tag in HEADINGS)
            or tag == "header" and not depth and k not in holds
        )
        if tag in HEADINGS:
            heading = not end
        if unwanted and tag not in VOID and not attrs.endswith("/"):
            skipped, nested = tag, 1
            continue
        if tag in ("article", "main"):
            depth = max(0, depth + (-1 if end else 1))
        if tag in CONTAINERS:
            if not end:
                n_parents += 1
                parents.append(n_parents)
            elif len(parents) > 1:
                parents.pop()
    say(page[at:])
    flush()
    return out


def main_text(page: str | None, window: int = 3, surge: int = 80, dive: int = 20) -> tuple[str, list[tuple[int, int]]]:
    """The kept text, and the (surge, dive) line numbers of its stretches."""
    lines = lines_of(page or "")
    inside = any(x.inside for x in lines)

    def weight(x: Line) -> int:
        if inside:
            return len(x.text) + surge if x.inside else 0
        return 0 if 2 * x.linked >= len(x.text) else len(x.text) - x.linked

    w = [weight(x) for x in lines]
    if not any(w):
        return "", []
    sums = [sum(w[i : i + window]) for i in range(len(w))]
    low, high = (dive, surge) if max(sums) >= surge else (1, 1)  # a page of only a few words: all of them
    kept: list[tuple[int, int]] = []
    i = 0
    while i < len(w):
        if not w[i] or sums[i] < high:
            i += 1
            continue
        j = i
        while j < len(w) and sums[j] >= low:
            j += 1
        last = max(k for k in range(i, min(j + window - 1, len(w))) if w[k])
        # short plain lines around, in the container of the stretch's ends and not parted from it by a cut
        while last + 1 < len(w) and w[last + 1] and not lines[last + 1].after_cut and not lines[last + 1].heading and lines[last + 1].parent == lines[last].parent:
            last += 1
        floor = kept[-1][1] if kept else 0
        while i > floor and w[i - 1] and not lines[i].after_cut and lines[i - 1].parent == lines[i].parent:
            i -= 1
        kept.append((i, last + 1))
        i = max(j, last + 1)
    joined: list[tuple[int, int]] = []
    for a, b in kept:
        while a and lines[a - 1].heading and w[a - 1] and (not joined or joined[-1][1] < a):
            a -= 1
        gap = range(joined[-1][1], a) if joined else ()
        if joined and all(w[k] and not lines[k].after_cut for k in gap) and not (gap and lines[a].after_cut):
            joined[-1] = (joined[-1][0], b)
        else:
            joined.append((a, b))
    text = "\n".join(lines[k].text for a, b in joined for k in range(a, b) if w[k])
    return text, joined


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = 3, surge: int = 80, dive: int = 20
) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars (code points), stretches.

    ``stretches`` lists the surge and dive points as line numbers. Null or empty html, and pages without
    any text of their own, give an empty text. Repeated rows are extracted once each; null ids and urls
    stay null; very long pages are read whole. An empty table gives no rows; other columns, whatever
    their names, are ignored.
    """
    fields = "page_id long, url string, text string, n_chars long, stretches array<struct<surge:int,dive:int>>"
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.struct([("surge", pa.int32()), ("dive", pa.int32())]))]
    names = ["page_id", "url", "text", "n_chars", "stretches"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                found = [main_text(x.as_py(), window, surge, dive) for x in part.column(2)]
                texts = [t for t, _ in found]
                spans = [[{"surge": a, "dive": z} for a, z in s] for _, s in found]
                columns = [part.column(0), part.column(1), texts, [len(t) for t in texts], spans]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, list) else c for c, k in zip(columns, kinds, strict=True)], names)

    src = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return src.mapInArrow(run, fields)


@query("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
