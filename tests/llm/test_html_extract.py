import itertools
import random
import time

import pytest

from tablecheck.llm import html_extract as h

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><p>Site name</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<!-- ad --><div class="cookie-notice">We use cookies.</div><article><header><h1>Title &amp; more</h1></header>
<p>First  line<br>second &#233;&nbsp;x</p><form><p>Sign up</p></form><p>Short.</p>
<div class="ad-box">Buy now. Only today, really cheap, for everyone who reads this.</div>
<section id="comments"><p>Great article, I liked reading all of it. Thanks.</p></section></article>
<aside><p>Other stories that you may want to read. They are long, too.</p></aside>
<footer>&copy; 2020</footer></body></html>"""


def test_article_only():
    assert h.main_blocks(PAGE)[0] == ["Title & more", "First line second é x", "Short."]


def test_broken_and_empty_pages():
    assert h.main_blocks("") == ([], 0)
    cut = "<article><h1>T</h1><p><b>Bold text.<br><p>Next one &amp; mo<p cla"
    assert h.main_blocks(cut)[0] == ["T", "Bold text.", "Next one & mo"]
    assert h.main_blocks("<script>never closed")[0] == []
    assert h.main_blocks("<p hidden>no</p><article><p>yes</p></article>")[0] == ["yes"]


def test_page_without_telling_markup():
    text = "A long paragraph with many words in it, and with sentences. It goes on for a while here."
    links = '<div><a href="/">Home</a> <a href="/x">About</a></div>'
    assert h.main_blocks(f"{links}<div>{text}</div><div>{text}</div>{links}")[0] == [text, text]


def test_long_page():
    page = "<article>" + "".join(f"<p>Paragraph number {i}.</p>" for i in range(5000)) + "</article>"
    assert len(h.main_blocks(page + "<footer>end</footer>")[0]) == 5000


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(2, 7)
        blocks = [h.Block("x", 0, False, False, False, False, (0, rng.randint(1, 2), i)) for i in range(n)]
        odds = [rng.choice([-2.0, -0.7, -0.3, 0.2, 0.5, 1.5]) for _ in range(n)]
        edges, last = [], {}
        for i, b in enumerate(blocks):
            if i:
                edges.append((i - 1, i, 0.2 + 0.2 * len(set(b.parents) & set(blocks[i - 1].parents))))
            before = last.get(b.parents[-2])
            if before is not None and before != i - 1:
                edges.append((before, i, 0.3))
            last[b.parents[-2]] = i

        def cost(labels):
            wrong = sum(abs(z) for z, k in zip(odds, labels) if (z > 0) != k)
            return wrong + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert abs(cost(h.label(blocks, odds)) - best) < 1e-6


def test_frame(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, 0), (1, "u", PAGE, 0), (None, None, None, 0)],
        "page_id long, url string, html string, text long",
    )
    rows = h.extract(pages).collect()
    assert sorted((r.text or "")[:5] for r in rows) == ["", "Title", "Title"]
    assert h.extract(pages.limit(0)).collect() == []


LINE = "The river rose by a metre over night, and the two lower bridges had to be closed. "
MAIN = [LINE * n + f"Part {n} ends here." for n in (3, 5, 2, 4)]
CARD = "<article><h3>Another story</h3><p>A short teaser for it.</p></article>"


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_article_cards_do_not_replace_the_main_text():
    for box in ('div class="related"', 'section id="comments"'):
        page = f'<div class="entry">{paragraphs(MAIN)}</div><{box}>{CARD * 4}</{box.split()[0]}>'
        assert h.main_blocks(page)[0] == MAIN


def test_class_words_of_the_article_itself():
    for start, end in (
        ('<article class="post with-sidebar">', "</article>"),
        ('<div class="content share-enabled">', "</div>"),
        ('<div id="social"><article>', "</article></div>"),
    ):
        page = f'<nav><a href="/">Home</a></nav>{start}{paragraphs(MAIN)}{end}<footer>c</footer>'
        assert h.main_blocks(page)[0] == MAIN


def test_neighbours_outvote_a_class_word():
    inner = f'{paragraphs(MAIN[:2])}<p class="notice">{MAIN[1]}</p>{paragraphs(MAIN[2:])}'
    assert h.main_blocks(f"<article>{inner}</article>")[0] == [*MAIN[:2], MAIN[1], *MAIN[2:]]
    outside = f"<article>{paragraphs(MAIN[:2])}</article><p>{MAIN[1]}</p><article>{paragraphs(MAIN[2:])}</article>"
    assert h.main_blocks(outside)[0] == [*MAIN[:2], MAIN[1], *MAIN[2:]]


FRAME = '<nav><a href="/">Home</a></nav>{}<footer><p>Imprint of the site.</p></footer>'


@pytest.mark.parametrize("length", (800, 5000))
@pytest.mark.parametrize("name", ("advert", "cookie-notice", "notice", "sidebar", "ad-slot", "newsletter"))
def test_long_boilerplate_in_and_beside_the_main_text(name, length):
    box = f'<div class="{name}"><p>{LINE * (length // len(LINE))}</p></div>'
    for start, end in (("<article>", "</article>"), ('<div class="post">', "</div>"), ("<div>", "</div>")):
        inside = f"{start}{paragraphs(MAIN[:2])}{box}{paragraphs(MAIN[2:])}{end}"
        assert h.main_blocks(FRAME.format(inside))[0] == MAIN
        for beside in (f"{box}{start}{paragraphs(MAIN)}{end}", f"{start}{paragraphs(MAIN)}{end}{box}"):
            assert h.main_blocks(FRAME.format(beside))[0] == MAIN


def test_pages_that_are_one_form():
    body = f'<div class="header">Site</div><div class="entry">{paragraphs(MAIN)}</div><input name="q">'
    inner = '<form action="/search"><p>Search all the pages of this site.</p></form><div class="ad">Buy now.</div>'
    for whole in (FRAME.format(body + inner), body + inner, f"<div id=\"social\">{body}</div>{inner}"):
        assert h.main_blocks(f'<form id="aspnetForm">{whole}</form>')[0] == MAIN
    # Beside an article, a form stays a form, however long its text is.
    terms = f"<form>{paragraphs([LINE * 30])}<textarea>x</textarea></form>"
    assert h.main_blocks(f"<article>{paragraphs(MAIN)}</article>{terms}")[0] == MAIN


def test_a_named_wrapper_of_the_whole_page():
    inner = f'<article><h1>Title</h1>{paragraphs(MAIN)}<div class="ad">Buy now, only today.</div></article>'
    comments = f'<div class="comments"><article><p>{LINE}</p></article></div>'
    page = f'<p>Read this first.</p><div class="layout sidebar-left">{inner}{comments}</div>'
    assert h.main_blocks(page)[0] == ["Title", *MAIN]


def test_header_of_an_entry():
    page = f'<article><div class="entry-header"><h2>Title</h2></div>{paragraphs(MAIN)}</article>'
    assert h.main_blocks(page)[0] == ["Title", *MAIN]


@pytest.mark.parametrize(
    "piece", ("<div><span>x</span>", "<div></p>", "<b></i>", "<div class=ad>x", "<form>x", "<p><b>x", "<li><b></i>")
)
def test_open_elements_take_linear_time(piece):
    def seconds(n):
        started = time.process_time()
        h.main_blocks(piece * n)
        return time.process_time() - started

    seconds(1000)
    assert seconds(80_000) < max(2.0, 16 * seconds(20_000))
    assert seconds(100_000) < 8
