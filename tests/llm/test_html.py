import re
from html.parser import HTMLParser

import pytest

from tidemark.llm import html as H

LONG = "The cat is on the mat and the dog is in the house with all of the people that were here before, and it was fine for them."
PAGES = {
    "article": (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>Short.</article><footer>&copy; 2024 the site</footer>", f"Title\n{LONG}\nShort."),
    "comments in the article": (f"<article><p>{LONG}</p><section class='comments'><p>{LONG} I like it.</p></section></article>", LONG),
    "comments by id": (f"<main><p>{LONG}</p></main><div id=comment-list><div><p>{LONG}</p></div></div>", LONG),
    "forms and asides": (f"<article><form><label>Name</label><input></form><aside><p>{LONG}</p></aside><p>{LONG} Yes.</p></article>", f"{LONG} Yes."),
    "notice": (f"<div class='cookie-notice'>{LONG}</div><article><p>{LONG} A.</p></article>", f"{LONG} A."),
    "advert": (f"<article><p>{LONG}</p><div class=\"ad\"><div>{LONG}</div>more</div><p>{LONG} B.</p></article>", f"{LONG}\n{LONG} B."),
    "scripts": (f"<script>var a = '<p>no</p>';</script><style>p > a {{}}</style><!-- <p>no</p> --><article><p>{LONG}<script>x</script></p></article>", LONG),
    "references": ("<article><p>a &amp; b &lt;c&gt; &eacute; &#233; &#x1F600; &amp;amp; x&nbsp;y</p></article>", "a & b <c> é é 😀 &amp; x y"),
    "white space": ("<article><p> a \n\t b<br>c  <b>d</b>e </p></article>", "a b c de"),
    "no markup": (LONG + " " + LONG, LONG + " " + LONG),
    "without article": (f"<div><a href=1>One</a> <a href=2>Two</a></div><h2>Head</h2><p>{LONG} {LONG}</p><p>Short one.</p><p>{LONG} {LONG}</p><p>Terms</p><ul><li><a href=3>Link</a></li></ul>", f"Head\n{LONG} {LONG}\nShort one.\n{LONG} {LONG}"),
    "link list in the article": (f"<article><p>{LONG}</p><ul><li><a href=1>{LONG}</a></li></ul></article>", LONG),
    "unclosed": (f"<article><p><b>{LONG}<br><p>{LONG} C.", f"{LONG}\n{LONG} C."),
    "attribute with a bracket": (f"<article><p title=\"a > b\">{LONG}</p></article>", LONG),
    "empty": ("", ""),
    "only markup": ("<html><body><div></div></body></html>", ""),
}


LIST = "Alpha Bravo Charlie Delta Echo Foxtrot Golf Hotel India Juliet Kilo Lima Mike November Oscar Papa"


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<nav>Menu</nav><h2>Head</h2><div>{LONG} {LONG}</div><p>Short one.</p><div>{LONG} {LONG}</div><article><p>Teaser.</p></article>", f"Head\n{LONG} {LONG}\nShort one.\n{LONG} {LONG}\nTeaser."),
        (f"<article><p>{LONG}</p><p><a href=1>{LIST}</a></p><p>{LIST}</p><p><a href=2>{LIST}</a></p><p>{LONG} {LONG}</p></article>", f"{LONG}\n{LONG} {LONG}"),
        (f"<article><p>{LIST}</p><p>{LIST}.</p></article>", f"{LIST}\n{LIST}."),
        (f"<article><p>{LONG} {LONG} {LONG}</p></article><p>{LONG} {LONG}</p><footer>x</footer><p>{LIST}</p>", f"{LONG} {LONG} {LONG}\n{LONG} {LONG}"),
    ],
    ids=["body beside a small article", "few stop words between links", "other language", "dense block outside"],
)
def test_density_on_all_blocks(page, want):
    assert H.extract(page) == want


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<html><head><title>T</title><meta charset=utf-8><body><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p>", f"{LONG} {LONG}\n{LONG} {LONG}"),
        (f"<article><ul><li class=share>Share<li>{LONG} {LONG}<li>{LONG}</ul><p>{LONG}</p></article>", f"{LONG} {LONG}\n{LONG}\n{LONG}"),
        (f"<div class='content has-sidebar'><p>{LONG} {LONG}</p><div class=sidebar>{LONG}</div></div>", f"{LONG} {LONG}"),
        (f"<div id='post-with-header-image'><p>{LONG} {LONG}</p></div>", f"{LONG} {LONG}"),
        (f"<div class='story comment-count-3'><p>{LONG} {LONG}</p></div><div class='comment-count-3'>{LONG}</div>", f"{LONG} {LONG}"),
        (f"<p><a href=1>Home</p><div><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p></div>", f"{LONG} {LONG}\n{LONG} {LONG}"),
        ("<div>" + "我们在城市的中心看到了很多新的房子，这些房子是在过去的几年里建成的，人们对它们的看法不一。" * 3 + "</div>", "我们在城市的中心看到了很多新的房子，这些房子是在过去的几年里建成的，人们对它们的看法不一。" * 3),
        (f"<article class=card><h3>Other story</h3></article><div><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p></div>", f"Other story\n{LONG} {LONG}\n{LONG} {LONG}"),
        (f"<article><p>{LONG}</p><div class=comments><p>{LONG} {LONG}</p><p>{LONG} {LONG} {LONG}</p></div></article>", LONG),
        (f"<table><tr><td class=menu>Menu<td><p>{LONG} {LONG}<tr><td class=ad>{LONG}<td>{LONG} {LONG}</table>", f"{LONG} {LONG}\n{LONG} {LONG}"),
        (f"<article><p>{LONG} <span class=ad>Buy <b>now</b></span> {LONG}</p></article>", f"{LONG}\n{LONG}"),
        (f"<article><p><b>{LONG}</p><p>{LONG}</b> more</p></article>", f"{LONG}\n{LONG} more"),
    ],
    ids=["no end of head", "no end of li", "has-sidebar", "with-header-image", "comment-count", "unclosed link", "Chinese", "teaser", "more comments than text", "table cells", "inline advert", "crossed tags"],
)
def test_pages_of_real_forms(page, want):
    assert H.extract(page) == want


def brute_labels(found, marked, told):
    """The block rules once more, block by block, with a search for neighbours instead of two sweeps."""
    first = []
    for b in found:
        n = len(b.text) + 2 * len(re.findall("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]", b.text))
        words = re.findall(r"[^\W\d_]+", b.text.lower())
        dense = not told or (bool(words) and sum(w in H.STOPS for w in words) / len(words) >= 0.08)
        inside = marked and b.article
        if b.excluded or b.linked > 0.33 * len(b.text) or ("\xa9" in b.text and n < 140 and not inside):
            first.append("bad")
        elif n < 70:
            first.append("short")
        elif dense:
            first.append("good" if n >= 140 or inside else "near")
        else:
            first.append("near" if inside or (n >= 560 and not b.linked) else "bad")
    out = []
    for i, b in enumerate(found):
        if first[i] in ("good", "bad"):
            out.append(first[i])
            continue
        side = lambda j: not marked or (found[j].article and not found[j].excluded) == (b.article and not b.excluded)
        x = next((first[j] for j in range(i - 1, -1, -1) if side(j) and first[j] in ("good", "bad")), "")
        y = next((first[j] for j in range(i + 1, len(found)) if side(j) and first[j] in ("good", "bad")), "")
        rather = (b.article and not b.excluded) if marked else first[i] == "near"
        if b.heading and y:
            out.append(y)
        elif x and y and x != y:
            out.append("good" if rather else "bad")
        else:
            out.append(x or y or ("good" if rather else "bad"))
    return first, out


def test_block_rules_are_those_of_brute_force(spark, sf):
    """On all pages, and on made ones in which each rule decides some blocks."""
    pages = [r.html or "" for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()]
    made = [p for p, _ in PAGES.values()]
    made += [f"<div><p>{LONG}</p><p>{LIST}</p><p>Short {i}</p><p>{LIST * 6}</p><p><a href=1>{LIST}</a> x</p><article><p>{LONG * (i % 4)}</p><p>{LIST}</p><h2>Head</h2><p>&copy; 2024 {LONG[:40]}</p></article><p>&copy; all</p></div>" for i in range(12)]
    seen = set()
    for page in pages + made:
        found = H.blocks(page)
        total, inside = sum(b.unlinked for b in found), sum(b.unlinked for b in found if b.article)
        marked = inside > 0 and 2 * inside >= total
        told = H.stop_density(" ".join(b.text for b in found if not b.excluded)) >= 0.03
        first, want = brute_labels(found, marked, told)
        assert H.extract(page) == "\n".join(b.text for b, x in zip(found, want) if x == "good")
        seen |= {(f, w) for f, w in zip(first, want)}
    assert seen == {("good", "good"), ("bad", "bad"), ("near", "good"), ("near", "bad"), ("short", "good"), ("short", "bad")}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_hand_made(name):
    page, want = PAGES[name]
    assert H.extract(page) == want


def test_null_long_and_pathological():
    assert H.extract(None) == ""
    many = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert H.extract(many).count("\n") == 4999
    for page in ("<" * 100_000, "<p a='" * 20_000, "<!--" * 20_000, "<div>" * 50_000, '<a "' * 20_000):
        H.extract(page)


class Second(HTMLParser):
    """Another reader of the test pages, for their one form."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.parts = 0, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.on += 1
        if tag in ("p", "h1", "article"):
            self.parts.append("")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.parts.append("")
        self.on -= tag == "article"

    def handle_data(self, data):
        if self.on:
            self.parts[-1] += data


def test_pages_whole(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in H.op3_html_extraction(spark, sf).collect()}
    assert got.keys() == pages.keys()
    for k, p in pages.items():
        reader = Second()
        reader.feed(p.html)
        reader.close()
        want = "\n".join(x for x in (" ".join(b.split()) for b in reader.parts) if x)
        assert got[k].text == want and got[k].n_chars == len(want) and got[k].url == p.url


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "x"), (None, "u", f"<p>{LONG} {LONG}", "x")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, H.extract_pages(df).collect()), key=repr) == sorted([(1, None, "", 0), (1, "u", "", 0), (None, "u", f"{LONG} {LONG}", 2 * len(LONG) + 1)], key=repr)
    assert H.extract_pages(df.limit(0)).count() == 0
    assert re.search("MapInArrow", H.extract_pages(df)._jdf.queryExecution().toString())


A, B, C = ("The harbour was quiet in the morning and the boats lay at the quay while the men mended what the storm had torn.", "In the afternoon it began to rain, and all of them went to the hall where the council was to meet at four.", "Nobody knew then that the bridge would not be there any more when they came back from the meeting in the evening.")
A, B, C = f"{A} They had been out for the whole night and were tired.", f"{B} It was the first time in years that so many came.", f"{C} Some of them had to stay on the other side for a week."
NAV = "<ul><li><a href='/'>Home</a></li><li><a href='/a'>News</a></li><li><a href='/b'>About us</a></li></ul>"
D, E = "Der Hafen war am Morgen still, und die Boote lagen am Kai, als die Leute von der Nacht zurück in die Stadt kamen.", "Am Abend stand das Wasser so hoch, dass niemand mehr über die Brücke gehen konnte, die am Rand der Stadt lag."
D, E = f"{D} Es war die erste Nacht seit Jahren, in der so viele auf dem Wasser waren und erst spät nach Hause kamen.", f"{E} Die Leute auf der anderen Seite mussten eine Woche lang dort bleiben und auf das Boot warten, das sie holt."

#: Pages of several kinds of sites with what a reader would call the article.
SITES = {
    "a form around the page": (f"<body><form method='post' id='aspnetForm' action='./'><input type='hidden' name='__VIEWSTATE' value='x'><div id='header'>{NAV}</div><div id='content'><p>{A}</p><p>{B}</p></div><div id='footer'>Copyright</div></form></body>", [A, B]),
    "a form around the page, no divs": (f"<form id='form1'><p>{A}</p><p>{B}</p><p>{C}</p></form>", [A, B, C]),
    "a search form beside an article": (f"<form action='/s'><label>Search the site for all that you want to read</label><input></form><article><p>{A}</p><p>{B}</p></article>", [A, B]),
    "a sign-up form in an article": (f"<article><p>{A}</p><form class='signup'><p>Get the news of the day by mail and be the first who knows what is on.</p><input></form><p>{B}</p><p>{C}</p></article>", [A, B, C]),
    "a notice that is the page": (f"<div class='notice'><p>{A}</p><p>{B}</p></div>", [A, B]),
    "a notice beside an article": (f"<div class='notice'><p>{C}</p></div><div class='story'><p>{A}</p><p>{B}</p></div>", [A, B]),
    "more comments than article": (f"<article><p>{A}</p><p>{B}</p></article><section class='user-comments'><p>{C}</p><p>{C} So it was.</p><p>{B} I was there.</p><p>{A} Me too.</p></section>", [A, B]),
    "comments in an article": (f"<article><p>{A}</p><p>{B}</p><div id='comment-list'><article class='comment'><p>{C}</p></article></div></article>", [A, B]),
    "comments by a service": (f"<div class='post has-comments'><p>{A}</p><p>{B}</p></div><div id='disqus_thread'><div class='replies'><p>{C}</p></div></div>", [A, B]),
    "a blog": (f"<div id='page'><div id='masthead'><h1>My blog</h1>{NAV}</div><div class='entry'><p>{A}</p><p>{B}</p></div><div class='sidebar'><h3>Links</h3>{NAV}</div></div>", [A, B]),
    "a paper": (f"<header>{NAV}</header><main><h1>Storm at the harbour of the old town</h1><p>{A}</p><p>{B}</p></main><aside><p>{C}</p></aside><footer><p>All rights reserved by the paper and its authors.</p></footer>", ["Storm at the harbour of the old town", A, B]),
    "related articles": (f"<div class='story'><p>{A}</p><p>{B}</p></div><div class='related-posts'><h4>Read also</h4><p><a href='/x'>{C}</a></p></div>", [A, B]),
    "a handbook": (f"<div class='toc-menu'>{NAV}</div><div class='document'><h2>Boats and how they are kept over the winter</h2><p>{A}</p><ul><li>{B}</li><li>{C}</li></ul></div>", ["Boats and how they are kept over the winter", A, B, C]),
    "tables for layout": (f"<table><tr><td>{NAV}</td><td><p>{A}</p><p>{B}</p></td></tr><tr><td colspan=2>\xa9 2024</td></tr></table>", [A, B]),
    "a modal over an article": (f"<div class='modal overlay'><p>{C}</p></div><article><p>{A}</p><p>{B}</p></article>", [A, B]),
    "an advert": (f"<article><p>{A}</p><div class='ad-box'><p>{C}</p></div><p>{B}</p></article>", [A, B]),
    "German": (f"<nav>{NAV}</nav><div class='text'><p>{D}</p><p>{E}</p></div><div class='newsletter'><p>Melden Sie sich an und lesen Sie am Morgen, was in der Stadt war.</p></div>", [D, E]),
    "breadcrumbs and sharing": (f"<div class='breadcrumb'><a href='/'>Home</a> &gt; <a href='/n'>News</a></div><div class='story'><p>{A}</p><div class='social-share'><a href='#'>Share</a></div><p>{B}</p></div>", [A, B]),
    "a cookie bar at the end": (f"<div class='story'><p>{A}</p><p>{B}</p></div><div id='cookie-consent'><p>We use cookies so that we can show you what you like to see on our pages.</p></div>", [A, B]),
    "nothing but menus": (f"<nav>{NAV}</nav><div class='menu'>{NAV}</div>", []),
    "a page in one paragraph": (f"<body><p>{A} {B}</p></body>", [f"{A} {B}"]),
    "hidden text": (f"<div style='display: none'><p>{C}</p></div><article><p>{A}</p><p hidden>{C}</p><p>{B}</p></article>", [A, B]),
}


@pytest.mark.parametrize("name", SITES)
def test_sites(name):
    page, want = SITES[name]
    assert H.extract(page) == "\n".join(want)
