"""HTML extraction: two-pass block rules.

A page is cut into blocks at block-level tags. Pass one labels blocks by
structure, link density, length and stop-word density as good, bad or undecided
(short or nearly good). Pass two gives undecided blocks the label of their
nearest decided neighbours. Where ``article`` or ``main`` holds most of a page's
unlinked text, it is a prior for undecided blocks: those in it are rather good and
look for neighbours in it, those outside rather bad. Blocks with few stop words are
undecided in it, as paragraphs of articles have few now and then, and bad elsewhere.
On a page whose language has none of the known stop words, length and links decide.
A tag or name (class or id) is a feature that the text outweighs: a name of boilerplate
words alone leaves its element out unless that holds four fifths of the page's unlinked
text, a name with such a word, or a form, unless it holds half. Reader comments are left
out by their name whatever they hold.

Defined results: a null, empty or markup-free page without text gives "".
Unclosed elements end with what holds them, or where HTML lets their end tag be left
out; text outside any tag is a block. A very long page is read in one pass. Repeated rows give equal results and extra columns are not returned.
Pages are handled one by one inside an Arrow function: nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .quality import STOP_WORDS
from .shared import table

STOPS = frozenset(STOP_WORDS)
#: Shorter blocks are undecided; longer ones with enough stop words are good.
SHORT, LONG = 70, 140
MOST_LINKS, LEAST_STOPS = 0.33, 0.08
#: Pages with a lower density of known stop words are in a language that these don't tell.
LEAST_TOLD = 0.03

SKIPPED = ("script", "style", "noscript", "template", "svg", "iframe", "object", "math", "canvas", "head")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(x for x in SKIPPED if x != 'head')}|title|textarea)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*+|[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog button select label fieldset head".split())
#: Words that name what isn't an article, and words that say nothing beside them.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar side widget widgets related recommended recommendations menu submenu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead topbar toolbar comment comments commentlist disqus replies reply respond share sharing social pagination pager paywall copyright disclaimer search searchform skip".split()
)
NEUTRAL_WORDS = frozenset("site page main global top bottom left right list box area section block wrap wrapper container inner outer item items content bar group row col panel links link buttons button posts post text body form policy js id".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Start tags that end open elements, as far as the holders named second; a paragraph ends at every block.
IMPLIED = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu")))),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
    **dict.fromkeys(("option", "optgroup"), (frozenset(("option",)), frozenset(("select",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    **dict.fromkeys(("tr",), (frozenset(("tr",)), frozenset(("table",)))),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset(("thead", "tbody", "tfoot")), frozenset(("table",)))),
}
IN_HEAD = frozenset("meta link title base script style noscript template".split())
PARAGRAPH = (frozenset(("p",)), frozenset(("button", "td", "th", "table", "object")))
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|href)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
PARTS = re.compile(r"[a-z]+")
LETTERS = re.compile(r"[^\W\d_]+")
WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")

NO, WEAK, NAMED, STRONG = 0, 1, 2, 3
#: Percent of the page's unlinked text from which an element is kept in spite of its tag or name.
KEPT = {WEAK: 50, NAMED: 80}
#: Words for what readers write, and words that make of them a word about the page.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
FLAG_WORDS = frozenset("no has have with without open closed allow enable disable hide".split())


def boiler(tag: str, rest: str, in_article: bool) -> int:
    """Whether an element is no part of an article by its tag or attributes (STRONG), or is none unless it holds most of the page (NAMED, by its whole name) or half of it (WEAK, by a part of its name; a form)."""
    if tag in BOILER_TAGS or (tag == "header" and not in_article):
        return STRONG
    out = WEAK if tag == "form" else NO
    if not rest or tag in ("html", "body") or tag in ("article", "main") and "comment" not in rest.lower():
        return out
    for name, a, b, c in ATTRIBUTE.findall(rest):
        value = (a or b or c).lower()
        name = name.lower()
        if name in ("class", "id"):
            for word in value.split():
                parts = PARTS.findall(word)
                if not BOILER_WORDS.isdisjoint(parts):
                    named = [x for x in parts if x not in NEUTRAL_WORDS]
                    if named[-1] in COMMENT_WORDS and named[0] not in FLAG_WORDS:
                        return STRONG
                    out = max(out, NAMED if BOILER_WORDS.issuperset(named) else WEAK)
        elif name == "role":
            if value in ROLES:
                return STRONG
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return STRONG
    return out


class Block:
    __slots__ = ("text", "linked", "excluded", "article", "heading", "weak", "label")

    def __init__(self, text: str, linked: int, excluded: bool, article: bool, heading: bool, weak: tuple[tuple[int, int], ...]):
        self.text, self.linked, self.excluded, self.article, self.heading, self.weak = text, linked, excluded, article, heading, weak
        self.label = ""

    @property
    def unlinked(self) -> int:
        return 0 if self.excluded else len(self.text) - self.linked


class Open:
    """The open elements, with implied end tags: what holds an element ends it."""

    def __init__(self):
        self.stack: list[tuple[str, int, tuple[int, int]]] = []  # tag, verdict, (number, percent that keeps it)
        self.tags: dict[str, int] = {}
        self.strong = self.article = self.links = 0
        self.weak: tuple[tuple[int, int], ...] = ()

    def push(self, tag: str, kind: int, number: tuple[int, int]) -> None:
        self.stack.append((tag, kind, number))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        self.strong += kind == STRONG
        self.article += tag in ("article", "main")
        self.links += tag == "a"
        if kind in KEPT:
            self.weak += (number,)

    def pop(self, at: int = -1) -> None:
        tag, kind, number = self.stack.pop(at)
        self.tags[tag] -= 1
        self.strong -= kind == STRONG
        self.article -= tag in ("article", "main")
        self.links -= tag == "a"
        if kind in KEPT:
            self.weak = tuple(x for x in self.weak if x != number)

    def end(self, tag: str) -> None:
        """An end tag: a block ends with all that it holds, an inline element alone. Without its start it is nothing."""
        if not self.tags.get(tag):
            return
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            if tag not in BLOCKS and self.stack[at][0] in BLOCKS:
                at = next(i for i in range(at, -1, -1) if self.stack[i][0] == tag)
                self.pop(at)
                return
            at -= 1
        while len(self.stack) > at:
            self.pop()

    def implied(self, ends: frozenset[str], holders: frozenset[str]) -> None:
        if not any(self.tags.get(x) for x in ends):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in ends:
                while len(self.stack) > at:
                    self.pop()
                return
            if tag in holders:
                return

    def start(self, tag: str) -> None:
        """End what a start tag ends without saying so."""
        if self.tags.get("head") and tag not in IN_HEAD:
            self.end("head")
        if tag in BLOCKS and self.tags.get("p"):
            self.implied(*PARAGRAPH)
        if tag in IMPLIED:
            self.implied(*IMPLIED[tag])
        if tag == "a":
            self.end("a")


def blocks(page: str) -> list[Block]:
    """The blocks in page order with what the rules need."""
    out: list[Block] = []
    parts: list[str] = []
    links: list[str] = []
    opened = Open()
    heading = False
    n_weak = 0

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, len(" ".join(html.unescape("".join(links)).split())), opened.strong > 0, opened.article > 0, heading, opened.weak))
            parts.clear()
            links.clear()

    at = 0
    for m in TOKEN.finditer(page, 0, page.rfind(">") + 1):  # what follows can't be a tag
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if opened.links:
                links.append(piece)
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag in BLOCKS or tag == "head":
                close()
                heading = False
                opened.end(tag)
            else:
                was = opened.strong, opened.weak
                n = len(opened.stack)
                if opened.tags.get(tag) and opened.stack[-1][0] == tag and opened.stack[-1][1]:
                    close()  # an inline element of a telling name is a block of its own
                opened.end(tag)
                if (opened.strong, opened.weak) != was and n == len(opened.stack):
                    close()
            continue
        rest = m["rest"] or ""
        if tag in BLOCKS or tag == "head":
            close()
            heading = tag in HEADINGS
        elif tag == "br":
            parts.append(" ")
        if tag in VOID:
            continue
        opened.start(tag)
        kind = boiler(tag, rest, opened.article > 0)
        if rest.endswith("/") or (tag == "a" and "href" not in rest.lower() and not kind):
            continue
        if kind and tag not in BLOCKS:
            close()
        n_weak += kind in KEPT
        opened.push(tag, kind, (n_weak, KEPT.get(kind, 0)))
    if at < len(page):
        parts.append(page[at:])
    close()
    return outweighed(out)


def outweighed(found: list[Block]) -> list[Block]:
    """Elements whose tag or name may be boilerplate's are so unless they hold their percentage of the page's text."""
    total = sum(b.unlinked for b in found)
    held: dict[tuple[int, int], int] = {}
    for b in found:
        for x in b.weak:
            held[x] = held.get(x, 0) + b.unlinked
    for b in found:
        b.excluded = b.excluded or any(100 * held[x] < x[1] * total for x in b.weak)
    return found


def stop_density(text: str) -> float:
    words = LETTERS.findall(text.lower())
    return sum(map(STOPS.__contains__, words)) / len(words) if words else 0.0


def size(text: str) -> int:
    """Length in characters; those of scripts that write words or syllables count for more."""
    return len(text) + 2 * len(WIDE.findall(text)) if not text.isascii() else len(text)


def first_pass(b: Block, marked: bool, told: bool) -> str:
    """good, bad, short or near; marked: the article holds most of the text; told: stop words tell text from lists on this page."""
    if b.excluded:
        return "bad"
    n = size(b.text)
    if b.linked > MOST_LINKS * len(b.text):
        return "bad"
    inside = marked and b.article
    if "\xa9" in b.text and n < LONG and not inside:
        return "bad"
    if n < SHORT:
        return "short"
    if not told or stop_density(b.text) >= LEAST_STOPS:
        return "good" if n >= LONG or inside else "near"
    if inside:
        return "near"
    return "near" if n >= 4 * LONG and not b.linked else "bad"


def second_pass(found: list[Block], marked: bool) -> None:
    """Undecided blocks take the label of their nearest decided neighbours; a heading that of what follows it."""
    if marked:
        vote([b for b in found if b.article and not b.excluded], True)
        vote([b for b in found if not b.article or b.excluded], False)
    else:
        vote(found, None)


def vote(near: list[Block], prior: bool | None) -> None:
    """Labels for the undecided of blocks that are neighbours; prior: what they rather are."""
    decided = [b.label if b.label in ("good", "bad") else "" for b in near]
    before, last = [], ""
    for x in decided:
        before.append(last)
        last = x or last
    after, last = [], ""
    for x in reversed(decided):
        after.append(last)
        last = x or last
    rather = lambda b: "good" if (b.label == "near" if prior is None else prior) else "bad"
    for b, x, y in zip(near, before, reversed(after), strict=True):
        if b.label in ("good", "bad"):
            continue
        if b.heading and y:
            b.label = y
        elif x == y or not x or not y:
            b.label = x or y or rather(b)
        else:
            b.label = rather(b)


def extract(page: str | None) -> str:
    """The main text: good blocks in page order, one line each."""
    found = blocks(page or "")
    total = sum(b.unlinked for b in found)
    article = sum(b.unlinked for b in found if b.article)
    marked = article > 0 and 2 * article >= total
    told = stop_density(" ".join(b.text for b in found if not b.excluded)) >= LEAST_TOLD
    for b in found:
        b.label = first_pass(b, marked, told)
    second_pass(found, marked)
    return "\n".join(b.text for b in found if b.label == "good")


def extract_pages(df: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, url_col, text, n_chars) of every row."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                b = whole.slice(first, 500)
                texts = [extract(x.as_py()) for x in b.column(2)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["a", "b", "c", "d"])

    return df.select(id_col, url_col, html_col).mapInArrow(run, schema)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


QUERIES = {"op3_html_extraction": op3_html_extraction}
#: Parsing can't be expressed in SQL; tests/llm compares with hand-made pages and a second reader.
ORACLES: dict[str, str] = {}
