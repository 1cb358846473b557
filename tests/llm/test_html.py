import random
import re
from collections import Counter

import duckdb
import pytest

from siltstone.llm.html import STOP_WORDS, Block, _label, extract, main_text
from tests.llm.cases import prose

PAGES = "page_id long, url string, html string, text string, own_row int"
SENTENCE = "The river was high and the people of the town were on the banks, as they had been for all of the day. "
LONG = (SENTENCE * 3).strip()


def test_parts_of_a_page():
    page = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p > b {{ }}</style><script>if (a<b) x("</p>");</script></head>
    <body class="page header-fixed"><!-- <p>{LONG}</p> --><header><a href="/">Home</a><p>{LONG}</p></header><nav><ul><li><a href=/a>A</a><li>B</ul></nav>
    <div id="cookie-notice">{LONG}</div><div class="ad">{LONG}</div>
    <article><header class="entry-header"><h1>A &amp; B &lt;3</h1></header><p>{LONG}</p><p>Short.<p>With <a href="x">a link</a> and&nbsp;
       white   space &#x2014; <b>bold<br>next</b><aside>{LONG}</aside><ul><li>One</li><li>Two</li></ul><div hidden>{LONG}</div>
    <form><p>{LONG}</p><input></form><script>document.write("<p>no</p>")</script><blockquote>{LONG}</blockquote>
    <div class="share-buttons"><a href=1>Share</a></div></article>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section>
    <div class="sidebar"><p>{LONG}</p></div><footer>&copy; 2024 {LONG}</footer></body></html>"""
    assert main_text(page).split("\n\n") == [
        "A & B <3", LONG, "Short.", "With a link and white space — bold next", "One", "Two", LONG]


def test_blocks_alone_decide_where_no_part_is_named():
    page = f"""<body><div><a href=a>News</a> <a href=b>Sport</a> <a href=c>More</a></div><h2>Head</h2><div>{LONG}</div><div>Yes.</div>
    <div>{LONG}</div><div>qqq www eee rrr ttt yyy uuu iii ooo ppp aaa sss ddd fff ggg hhh jjj kkk lll zzz xxx ccc vvv</div>
    <div>Terms</div><div>All rights reserved © 2024</div><div><a href=d>{LONG}</a></div></body>"""
    assert main_text(page).split("\n\n") == ["Head", LONG, "Yes.", LONG]


RUSSIAN = "Река поднялась высоко, и жители города стояли на берегах весь день. "
GREEK = "Το ποτάμι ήταν ψηλά και οι κάτοικοι της πόλης στέκονταν στις όχθες όλη τη μέρα. "
JAPANESE = "川の水位が高く、町の人々は一日中岸辺に立っていた。昼も夜も雨は降り続いていた。"


@pytest.mark.parametrize("text", [RUSSIAN, GREEK, JAPANESE], ids=["listed", "unlisted", "unspaced"])
def test_articles_in_any_language_without_article_or_main(text):
    long, middling = (text * 5).strip(), (text * 2).strip()
    page = "<body><div><a href=a>{0}</a></div><h1>{1}</h1><div>{2}</div><div>{3}</div><div>{2}</div><div><a href=b>{0}</a></div><div>© 2024</div></body>"
    assert main_text(page.format(text[:20], text[:15].strip(), long, middling)).split("\n\n") == [text[:15].strip(), long, middling, long]


def test_code_tables_and_names_in_an_article_without_article_or_main():
    names, code = ", ".join(f"Xaver{k} Quill{k}" for k in range(20)), "let counted = rows.map(parse).filter(Boolean).reduce(add, zero);"
    cells = [f"Quill{k}" for k in range(6)]
    table = "<table><tr>" + "".join(f"<td>{c}" for c in cells) + "</table>"
    page = f"<body><div>{LONG}</div><div>{names}</div><div>{names[:120]}</div>{table}<div>{LONG}</div><pre>{code}{code}</pre><div><a href=a>A</a></div></body>"
    assert main_text(page).split("\n\n") == [LONG, names, names[:120].strip(), *cells, LONG, code + code]


def test_a_page_of_middling_blocks_between_links_is_kept():
    middling = SENTENCE.strip()
    page = f"<body><div><a href=a>News</a></div><p>{middling}</p><p>{middling}</p><div><a href=b>More</a></div></body>"
    assert main_text(page).split("\n\n") == [middling] * 2


def test_attribute_values_are_read_in_whole():
    long = '{"a": "' + "b > c, <p>" * 2000 + '"}'
    page = f"""<article><div data-caption="<b>x</b>" data-more='class="ad" hidden'>{LONG}</div><p data-json='{long}'>{LONG}</p>
    <iframe srcdoc="<p>in</iframe>a > b"></iframe><p title = "a > b"class='x'>One</p><p title="not closed>Two</p><p id="next">Three</p></article>"""
    assert main_text(page).split("\n\n") == [LONG, LONG, "One", "Two", "Three"]


@pytest.mark.parametrize("start", [
    "<head><title>Not this</title><meta name=a><link rel=b>", "<html><head><title>Not this", "<title>Not this</title>",
    "<head><style>p > b { }<body>", "<head><script>a()<body><script>b()</script>", "<head><noscript><img></noscript>",
    "<p><iframe src=a>", "<svg><path d=a>", "<object data=a><param>", "<noscript><img>", "<svg><path><div><svg></svg></div>", "<canvas>"])
def test_elements_that_are_never_closed_end_at_the_next_block(start):
    page = f"{start}<article><p>{LONG}</p><svg><g><svg><text>no</text></svg><text>no</text></g></svg><script>x('<p>no')</script><p>{LONG}</p></article>"
    assert main_text(page).split("\n\n") == [LONG, LONG]
    assert main_text(page + "<iframe></iframe><noscript>no</noscript><object><p>no</p></object><style>no</style>").split("\n\n") == [LONG, LONG]


@pytest.mark.parametrize("around", [
    "<div id=page class='site no-sidebar'>%s</div>", "<div class='sticky-header'>%s</div>", "<div class='has-header widget'>%s</div>",
    "<main><article class='post category-social tag-search'>%s</article></main>", "<article class='widget'>%s</article>",
    "<form id=aspnetForm><div>%s</div></form>", "<div class=sidebar><div class=popup>%s</div></div>",
    "<main><div class=banner>%s</div></main>"])
def test_a_wrapper_of_the_article_is_no_part_outside_it(around):
    page = f"<p>{LONG}</p><div class=promo><p>{SENTENCE}</p></div><p>{LONG}</p><div class='comments'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body><nav><a href=a>A</a></nav>{around % page}<footer>{LONG}</footer></body>").split("\n\n") == [LONG, LONG]


def test_the_largest_article_is_the_page_s():
    teaser = "<article class=card><h3>Another story</h3><p>It is the story of a town that was lost in the hills, and of all that came to look for it.</p><a href=x>More</a></article>"
    page = f"<body><main>{teaser}<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p>{teaser}</article><h2>Read next</h2>{teaser}{teaser}</main></body>"
    assert main_text(page).split("\n\n") == ["Head", LONG, LONG]
    assert main_text(f"<main><h1>Head</h1><p>By someone</p><article><p>{LONG}</p></article></main>").split("\n\n") == ["Head", "By someone", LONG]


def test_parts_of_one_article_are_all_kept():
    page = f"<main><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG}</p></article></main>"
    assert main_text(page).split("\n\n") == ["One", LONG, "Two", LONG]
    assert main_text(f"<article><section><article><p>{LONG}</p></article><article><p>{LONG}</p></article></section></article>").split("\n\n") == [LONG, LONG]


@pytest.mark.parametrize("call", [
    "Sign up for our newsletter and get the best of the week.", "Subscribe to our mailing list", "Inscrivez-vous à notre lettre du matin.",
    "Suscríbete a nuestro boletín semanal"])
def test_a_call_to_subscribe_inside_the_article_is_left_out(call):
    page = f"<article><p>{LONG}</p><div class='c-box'>{call}</div><p>{LONG}</p></article>"
    assert main_text(page).split("\n\n") == [LONG, LONG]
    assert main_text(page.replace("article>", "div>")).split("\n\n") == [LONG, LONG]
    prose = f"<article><p>{LONG}</p><p>They had to sign up for the war, and no newsletter told of it.</p></article>"
    assert "sign up for the war" in main_text(prose)


def test_lists_of_links_inside_the_article_and_at_its_end():
    links = "<ul><li><a href=a>First tool we recommend</a><li><a href=b>Second tool</a></ul>"
    page = f"<article><ul><li><a href=h>Home</a></ul><h1>Head</h1><p>{LONG}</p><h2>Tools</h2>{links}<p>{LONG}</p><h2>Related</h2>{links}</article>"
    assert main_text(page).split("\n\n") == ["Head", LONG, "Tools", "First tool we recommend", "Second tool", LONG]
    assert main_text("<article><h1>Head</h1>" + links * 8000 + "</article>") == ""


@pytest.mark.parametrize("name", ["reader-responses", "x17"])
def test_comments_under_any_name_on_a_page_without_an_article(name):
    remarks = "".join(f"<div class=r><div>Reader {k}, today</div><div>{SENTENCE}</div></div>" for k in range(4))
    page = f"<body><h1>Head</h1><div>{LONG}</div><div>{LONG}</div><div>{LONG}</div><div id={name}>{remarks}</div></body>"
    assert main_text(page).split("\n\n") == ["Head", LONG, LONG, LONG]


def test_paragraphs_of_one_class_are_no_cards():
    page = "<body>" + f"<div class=para>{LONG}</div>" * 5 + "".join(f"<section class=s><h2>Part {k}</h2><div>{LONG}</div></section>" for k in range(3)) + "</body>"
    assert main_text(page).split("\n\n") == [LONG] * 5 + [x for k in range(3) for x in (f"Part {k}", LONG)]


def by_rules(blocks):
    """The two passes as the module states them, block by block."""
    words = lambda b: b.text.lower().split()
    density = lambda b: sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words(b)) / len(words(b))

    def listed(some):
        some = [b for b in some if len(b.text) >= 70]
        return sum(len(b.text) * density(b) for b in some) >= 0.15 * sum(len(b.text) for b in some)

    def nearest(labels, order):
        return next((labels[k] for k in order if labels[k] in ("good", "bad")), None)

    main = [b for b in blocks if b.zone == "main"]
    known = listed(main)
    first = []
    for b in main:
        if b.named:
            first.append("bad")
        elif b.is_link:
            first.append("link")
        elif len(b.text) < 70:
            first.append("short")
        else:
            first.append("good" if density(b) >= 0.15 or len(b.text) > 200 or not known else "near")
    if any(x not in ("bad", "link") for x in first):
        solid = [i for i, (b, x) in enumerate(zip(main, first)) if x in ("good", "near") and not b.heading]
        then = ["good" if x == "link" and solid and solid[0] < i < solid[-1] else "bad" if x == "link" else x for i, x in enumerate(first)]
        for i, b in enumerate(main):
            under = [k for k in range(i + 1, len(main)) if not any(main[j].heading for j in range(i + 1, k + 1))]
            if b.heading and under and "link" in first and all(first[k] == "link" and then[k] == "bad" for k in under):
                then[i] = "bad"
        last = []
        for i, x in enumerate(then):
            sides = [nearest(then, range(i - 1, -1, -1)), nearest(then, range(i + 1, len(main)))]
            last.append(x if x in ("good", "bad") else "bad" if sides == ["bad", "bad"] else "good")
        if "good" in last:
            told = dict(zip(map(id, main), last))
            return [told.get(id(b), "bad") for b in blocks]

    loose = [b for b in blocks if not b.zone and not b.named and b.linked <= 0.33 * len(b.text)]
    known = listed(loose)
    first = []
    for b in blocks:
        size = len(b.text)
        if not any(b is x for x in loose) or "©" in b.text and size < 200:
            first.append("bad")
        elif size < 70:
            first.append("near" if b.code else "bad" if b.linked else "short")
        elif size > 200 and (density(b) >= 0.25 or not known):
            first.append("good")
        else:
            first.append("near" if density(b) >= 0.15 or size > 200 or b.code or not known else "few")
    if "good" not in first:
        first = ["good" if x == "near" else x for x in first]
    last = []
    for i, (b, x) in enumerate(zip(blocks, first)):
        left, right = range(i - 1, -1, -1), range(i + 1, len(blocks))
        sides = [nearest(first, left), nearest(first, right)]
        # A side is close if a middling block comes before its nearest good one.
        close = [s == "good" and "near" in [first[k] for k in way if k in way[:next(n for n, k in enumerate(way) if first[k] == "good")]]
                 for s, way in zip(sides, (left, right))]
        if x in ("good", "bad"):
            last.append(x)
        elif x == "near":
            last.append("good" if "good" in sides or sides == [None, None] else "bad")
        elif sides == ["good", "good"]:
            last.append("good")
        elif x == "few":
            last.append("bad")
        else:
            middling = next((first[k] for k in right if first[k] in ("good", "bad", "near")), None) == "near"
            last.append("good" if (sides[1] == "good" or middling if b.heading else any(close)) else "bad")
    return last


@pytest.mark.parametrize("seed", range(6))
def test_both_passes_against_their_rules(seed):
    draw = random.Random(seed)
    kinds = [SENTENCE.strip(), LONG, "Short", "Two words", "qwe rty uio " * 8, "qwe rty uio " * 20, "© 2024 someone", "the " + "zzz " * 25]
    seen = Counter()
    for _ in range(400):
        blocks = []
        for _ in range(draw.randrange(1, 12)):
            text = draw.choice(kinds).strip()
            blocks.append(Block(text, draw.choice([0, 0, 0, len(text), len(text) // 2]), draw.choice(["", "", "out", "main"] if seed % 2 else ["", "", "", "out"]),
                                draw.choice([(), (), (), (1,)]), heading=draw.random() < 0.2, code=draw.random() < 0.1))
        want = by_rules(blocks)
        _label(blocks)
        assert [b.label for b in blocks] == want, [(b.text[:20], b.linked, b.zone, b.named, b.heading, b.code) for b in blocks]
        seen.update(want)
    assert min(seen.values()) > 300


@pytest.mark.parametrize("page", [
    "", "   ", "<", "<p", "<!--", "<script>", "<html></html>", "a < b > c &amp", "<div class='x\" y'>z</div>", '<p title="' + "x" * 9000,
    "<nav>" * 3000, "</div>" * 3000, "<a href='" * 2000, "<" * 20_000, "<b><br>" * 3000])
def test_broken_pages_do_not_fail(page):
    assert isinstance(main_text(page), str)


def test_an_article_ends_a_part_that_was_left_open():
    assert main_text(f"<div class=ad><p>x<nav><article><p>{LONG}</article>") == LONG


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "old", 1), (1, "u", f"<article><p>{LONG}</p></article>", "old", 1),
            (None, None, None, None, None), (2, "v", "", "x", 2), (3, "w", "<article><p>" + " ".join(prose(1, 60_000)) + "</article>", "", 3)]
    found = extract(spark.createDataFrame(rows, PAGES))
    assert found.columns == ["page_id", "url", "own_row", "text"]
    assert [(r["page_id"], r["text"]) for r in found.collect()] == [
        (1, LONG), (1, LONG), (None, ""), (2, ""), (3, " ".join(prose(1, 60_000)))]
    assert extract(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages_hold_the_lines_of_their_documents(spark):
    """The number in a page's address names the document whose lines are its paragraphs, under a heading."""
    folder = "/root/testdata/sf0.01"
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    rows = extract(spark.read.parquet(f"{folder}/pages.parquet")).collect()
    for r in rows:
        text = docs[int(re.search(r"/(\d+)", r["url"])[1])]
        lines = [" ".join(x.split()) for x in text.split("\n")]
        assert r["text"].split("\n\n")[1:] == [x for x in lines if x]
    assert len(rows) == 250
