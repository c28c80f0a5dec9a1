import re
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq

from ledgerloom.llm.html_blocks import extract_main_text, main_text, regions_of


def test_parts_beside_the_article_go():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies here</div>
    <div id="sidebar"><p>Beside</p></div><script>var a = "<p>no</p>";</script>
    <div class="content"><h2>Fish &amp; chips</h2><p>A first   paragraph
    with <b>bold</b> words.<br>And a line.</p><p>Short.</p><div class="ad">Buy now</div>
    <p>Another paragraph of some length &eacute;.</p></div>
    <form><p>Subscribe</p></form><section id="comments"><article><p>I liked this article very much indeed.</p></article>
    </section><footer>&copy; nobody</footer></body></html>"""
    assert main_text(page) == ("Fish & chips\n\nA first paragraph with bold words. And a line.\n\nShort.\n\n"
                               "Another paragraph of some length é.")


def test_an_article_element_is_taken_whole():
    assert main_text("<article><h1>X</h1><p>Y.</p><nav>menu</nav><p>Z</p></article><p>A long tail that is outside</p>"
                     ) == "X\n\nY.\n\nZ"


def test_a_teaser_article_does_not_hide_the_body():
    body = [f"Paragraph {k} of the body, " + "with words that go on and on " * 6 + "." for k in range(4)]
    story = "<div class='story'>" + "".join(f"<div>{b}</div>" for b in body) + "</div>"
    teaser = "<article class='card'><p>Read this next, too</p></article>"
    for page in (f"<body>{story}<nav>Menu</nav>{teaser}</body>", f"<body>{teaser}<nav>Menu</nav>{story}</body>",
                 f"<div class='layout sidebar-left'>{story}<div class='related'>Other</div>{teaser * 9}</div>"):
        assert main_text(page) == "\n\n".join(body)
    comments = f"<div class='comments'>{story * 3}</div>"
    article = f"<article><h1>Head</h1><p>{body[0]}</p></article>"
    for page in (article + comments, f"<div class='layout sidebar-left'>{article}{comments}</div>"):
        assert main_text(page) == f"Head\n\n{body[0]}"


def test_a_short_last_paragraph_behind_an_advert_stays():
    body = [f"Paragraph {k} " + "x" * 400 for k in range(3)]
    last = "The last paragraph " + "y" * 180
    advert = "<div class='ad'>Buy</div>"
    text = "".join(f"<p>{b}</p>" for b in body)
    for page in (f"<body><div>{text}{advert}<p>{last}</p></div></body>", f"<body>{text}{advert}<p>{last}</p></body>",
                 f"<body><div>{text}{advert}<aside>No</aside><ul><li>{last}</ul></div></body>",
                 f"<body><div>{text}{advert}{last}</div></body>"):
        assert main_text(page) == "\n\n".join([*body, last])
    # In another container it is still judged alone.
    page = f"<body><div>{text}</div>{advert}<div><p>{last}</p></div></body>"
    assert main_text(page) == "\n\n".join(body)


def test_a_line_of_links_inside_the_body_stays():
    page = "<p>Words before the link.</p><p><a href='/x'>All of it a link</a></p><p>Words behind.</p>"
    assert main_text(page) == "Words before the link.\n\nAll of it a link\n\nWords behind."
    menu = "<ul>" + "<li><a href='/'>Menu entry</a>" * 5 + "</ul>"
    assert main_text(f"{menu}<p>Words before.</p><p>Words behind.</p>{menu}") == "Words before.\n\nWords behind."


def test_common_layouts():
    page = """<HTML><BODY><DIV CLASS="layout sidebar-right"><DIV id='top' title="a > b"><UL class=main-menu><LI>One<LI>Two</UL></DIV>
    <div role="complementary">Beside it all, with a long text that nobody asked for in the first place.</div>
    <article class="post"><header><h1 class="header">Head</h1><p class=byline>By someone</p></header>
    <p>Body one.<aside>Pulled out</aside><p>Body two<table><tr><td>A<td>B</table><div class="advert-box">Buy</div>
    <ol class="commentlist"><li><article><p>First!</p></article></ol><p>Body three</article></DIV>
    <section class="comments"><p>Nice, said a reader at some length, and went on about it.</p></section></BODY></HTML>"""
    assert main_text(page) == "Head\n\nBody one.\n\nBody two\n\nA\n\nB\n\nBody three"
    page = """<div class="page sidebar-left"><p>A page in one element, named for what stands beside it.</p></div>"""
    assert main_text(page) == "A page in one element, named for what stands beside it."


def test_awkward_pages():
    assert main_text(None) == main_text("") == main_text("<p> </p>") == main_text("<script>never closed <p>x</p>") == ""
    assert main_text("plain text &lt;only&gt;") == "plain text <only>"
    assert main_text("<article><p><b>never closed<p>next") == "never closed\n\nnext"
    assert main_text("<p>x < y and a <broken") != ""
    assert len(main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>").split("\n\n")) == 20_000


def test_regions_end_where_the_window_falls_to_nothing():
    assert regions_of([0, 0, 5, 0, 7, 0, 0, 0, 9, 0]) == [(2, 5, 12), (8, 9, 9)]


class _Reader(HTMLParser):
    """Text of the article's blocks, found another way: by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_every_page_of_a_table(spark):
    folder = "/root/testdata/sf0.001/pages.parquet"
    got = {r.page_id: r for r in extract_main_text(spark.read.parquet(folder)).collect()}
    for row in pq.read_table(folder).to_pylist():
        reader = _Reader()
        reader.feed(row["html"])
        blocks = [" ".join(b.split()) for b in reader.blocks]
        assert got[row["page_id"]].text == "\n\n".join(b for b in blocks if b)
        assert got[row["page_id"]].n_chars == len(got[row["page_id"]].text)


def test_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a</p>", "y"), (2, "u", "<p>b</p>", "z"), (2, "u", "<p>b</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(extract_main_text(pages).collect(), key=str)
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("a", 1), ("b", 1), ("b", 1)]
    assert extract_main_text(pages.limit(0)).collect() == []


_PROSE = ["The first paragraph tells at some length what happened on that day, and where it did.",
          "The second paragraph goes on with what came of it, as told by those who were there.",
          "The third paragraph ends the story with a few words about all that has been since then."]


def test_a_form_around_the_page():
    """Servers that put every page into one form; its controls and labels are no text, nor is a form of its own."""
    body = "".join(f"<p>{p}</p>" for p in _PROSE)
    controls = "<label>Your name please</label><input name=a><select><option>One<option>Two</select><button>Send it now</button>"
    search = "<form class=search><label>Find</label> in all pages <input></form>"
    for inner in (body, f"<article>{body}</article>", f"<div id=main><main>{body}</main></div>"):
        for form in ("<form>", "<form id='form1' method=post>", "<form class='search-form' action='/x'>"):
            page = f"<html><body>{search}<div>Top</div>{form}<nav>Menu of it all</nav>{inner}{controls}</form></body></html>"
            assert main_text(page) == "\n\n".join(_PROSE), page
    page = f"<html><body><div>{body}</div><form><p>Leave us your opinion on this story here</p>{controls}</form></body></html>"
    assert main_text(page) == "\n\n".join(_PROSE)


def test_broken_pages_take_linear_time():
    body = "<html><body><article>" + "".join(f"<p>{p}</p>" for p in _PROSE) + "</article>"
    start = time.perf_counter()
    for piece in ("</x><b>", "<head>", "<b>", "</p>", "<b></i>", "<style>", "<svg><p>", "<b><p></p>", "<x><main></x>"):
        assert main_text(body + piece * (200_000 // len(piece)) + "</body></html>").startswith(_PROSE[0])
    assert time.perf_counter() - start < 20
    assert main_text(f"<html><body>{'<b>' * 20_000}{'<p></p>' * 20_000}<p>{_PROSE[0]}</p>") == _PROSE[0]


def test_a_list_of_sources_between_paragraphs_stays():
    links = [f"Source number {k}" for k in range(5)]
    listed = "<ul>" + "".join(f"<li><a href='/{k}'>{text}</a></li>" for k, text in enumerate(links)) + "</ul>"
    text = "\n\n".join([_PROSE[0], *links, _PROSE[1]])
    for page in (f"<body><p>{_PROSE[0]}</p>{listed}<p>{_PROSE[1]}</p></body>",
                 f"<body>{listed}<div><p>{_PROSE[0]}</p>{listed}<p>{_PROSE[1]}</p></div>{listed}</body>",
                 f"<article><p>{_PROSE[0]}</p>{listed}<p>{_PROSE[1]}</p></article>"):
        assert main_text(page) == text
    # Links between two containers are a menu.
    page = f"<div><p>{_PROSE[0]}</p></div><div>{listed}</div><div><p>{_PROSE[1]}</p></div>"
    assert main_text(page) == "\n\n".join(_PROSE[:2])


def test_regions_outweigh_tags():
    """An article or main only adds to the weight of its regions."""
    story = "<div>" + "".join(f"<p>{p}</p>" for p in _PROSE) + "</div>"
    text = "\n\n".join(_PROSE)
    short, long = _PROSE[1][:40], " ".join(_PROSE)
    assert main_text(f"<body>{story}<article><p>{short}</p></article></body>") == text
    assert main_text(f"<body><article><p>{short}</p></article><main></main>{story}</body>") == text
    assert main_text(f"<body>{story}<article><p>{long}</p></article></body>") == long
    # A short article beside the long one is a teaser; one of like size is text.
    page = f"<main>{story}</main><article><p>Next</p></article>"
    assert main_text(page) == text
    assert main_text(f"{page}<article>{story}</article>") == f"{text}\n\n{text}"


class _Lines(HTMLParser):
    """Lines of a page found by the parser of the standard library; parts beside the text are three empty lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.beside, self.raw, self.open = [""], 0, False, []

    def handle_starttag(self, tag, attrs):
        if tag in ("meta", "br"):
            self.lines[-1] += " "
            return
        beside = tag in ("nav", "footer") or ("class", "ad") in attrs
        if tag in ("p", "h1", "div", "section", "body") or beside:
            self.lines.append("")
        if tag == "p" and "p" in self.open:
            self.open.remove("p")
        self.open.append((tag, beside) if beside else tag)
        self.beside += beside
        self.raw |= tag in ("title", "style", "script")

    def handle_endtag(self, tag):
        self.raw = False
        self.lines.append("") if tag in ("p", "h1", "div", "section", "body") else None
        if (tag, True) in self.open:
            self.open.remove((tag, True))
            self.beside -= 1
            self.lines += ["\0"] * 3 + [""]

    def handle_data(self, data):
        if not self.raw and not self.beside:
            self.lines[-1] += data


def test_untagged_copies_of_a_table():
    """Without its article tags every page gives the region of most text, by the definition of surge and dive points."""
    for row in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        page = re.sub(r"(</?)article\b", r"\1section", row["html"])
        reader = _Lines()
        reader.feed(page)
        lines = [" ".join(line.split()) for line in reader.lines]
        lines = [line.strip("\0") for line in lines if line]
        sums = [sum(map(len, lines[k:k + 3])) for k in range(len(lines))]
        regions, k = [], 0
        while k < len(lines):
            if lines[k]:
                dive = next((j for j in range(k, len(lines)) if not sums[j]), len(lines))
                regions.append([line for line in lines[k:dive] if line])
                k = dive
            k += 1
        assert main_text(page) == "\n\n".join(max(regions, key=lambda r: sum(map(len, r)))), row["page_id"]
