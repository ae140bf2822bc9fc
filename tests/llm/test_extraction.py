import html
import random
import re
import time

from helpers import prose

from sightline.llm import tagpaths
from sightline.llm.text import table

P = tagpaths.TagPaths()


def test_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = {r["page_id"]: r for r in tagpaths.extracted(pages).collect()}
    for page in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inside)).split())
        assert got[page["page_id"]]["text"] == want and got[page["page_id"]]["n_chars"] == len(want)


def test_other_template():
    page = """<html><body><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies, accept them. All, please.
    Long text, with commas, and more.</p></div><nav><ul><li><a href=x>Home</a><li>Other</ul></nav>
    <div id="content"><h2>Title &amp; more</h2><p>First paragraph, with text&nbsp;and <b>bold</b>ness. It is long enough, surely, to be
    content.</p><p>Second one.<div class=ad>Buy now, cheap, good, fast. Click here, today!</div><p>Third: a&lt;b<br>again; and length.</div>
    <section class="comments"><p>I disagree, strongly, with everything here. Really, all of it, every single word.</p></section>
    <aside>Side, bar, text. Yes.</aside><form>Name <input></form><script>var x = "<p>no</p>";</script><footer>(c) x</footer></body></html>"""
    assert tagpaths.main_text(page, P) == (
        "Title & more First paragraph, with text and boldness. It is long enough, surely, to be content. Second one. "
        "Third: a<b again; and length."
    )


def test_layout_words_around_an_article():
    body = "<article><p>The text, as it is. And more, of it.</p></article>"
    other = "<section id='comments'><article><p>I think, not so. At all, ever, my friend.</p></article></section>"
    assert tagpaths.main_text(f"<div class='has-sidebar'>{body}{other}</div>", P) == "The text, as it is. And more, of it."
    assert tagpaths.main_text(f"<nav>Menu, one. Two, three, four.{body}", P) == "The text, as it is. And more, of it."


LONG = "One long paragraph, with points. " * 20


def test_no_article_element_keeps_all_content():
    def read(body):
        return tagpaths.main_text(f"<html><body><nav>Home, now.</nav>{body}<footer>(c) x</footer></body></html>", P)

    long = LONG.strip()
    assert read(f"<div id=content><h1>Title</h1><p>{LONG}</p><p>short one</p></div>") == f"Title {long} short one"
    assert read(f"<div id=content><h1>Title</h1><p>{LONG}</p></div>") == f"Title {long}"
    assert read(f"<div id=content><h1>Title</h1><div class=text>{LONG}</div></div>") == f"Title {long}"
    small = "The rest, as it is. And more, of it. " * 4
    both = f"<section class=one><p>{LONG}</p></section><section class=two><p>{small}</p></section>"
    assert read(f"<div id=content>{both}</div>") == f"{long} {small.strip()}"


def test_head_left_open():
    for body in (f"<body><p>{LONG}</p></body>", f"<p>{LONG}</p>", f"<b>{LONG}</b>", LONG):
        page = f"<html><head><meta charset=x><title>T</title><script>x()</script><style>p {{}}</style>{body}</html>"
        assert tagpaths.main_text(page, P) == LONG.strip(), body[:9]


def test_marked_wrapper_of_the_whole_page():
    side = "<div class=sidebar><p>Side, bar, text. Yes.</p></div><section id=comments><p>I think, not so. At all.</p></section>"
    for words in ("has-sidebar", "social-science", "search-engines", "related", "notice reply share"):
        for inner in ("", "search-engines"):
            page = f"<nav>Home, now.</nav><div id=page class='{words}'><div class='{inner}'><h1>T</h1><p>{LONG}</p></div>{side}</div>"
            assert tagpaths.main_text(page, P) == f"T {LONG.strip()}", (words, inner)
    page = f"<div id=content><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div>"
    assert tagpaths.main_text(page, P) == LONG.strip()
    page = f"<article>short</article><div class=comments><p>{LONG}</p></div>"
    assert tagpaths.main_text(page, P) == "short"


def test_several_articles_and_their_own_names():
    read = lambda body: tagpaths.main_text(f"<html><body><nav>Home, now.</nav>{body}<footer>(c) x</footer></body></html>", P)
    long, small = LONG.strip(), "A short one, it is."
    assert read(f"<article><p>{LONG}</p></article><article><p>{small}</p></article>") == f"{long} {small}"
    assert read(f"<main><div class=list>One, two.</div><article><p>{LONG}</p></article><article>{small}</article></main>") == f"{long} {small}"
    for name in ("class=search-engines", "id=social-science", "class='related-work history'", "class=reply-to-critics", "id=notice-of-death"):
        body = f"<article><h1>Title</h1><p>{LONG}</p><div {name}><p>{small}</p></div></article>"
        assert read(body) == f"Title {long} {small}", name
    for name in ("class=ad", "class=share-buttons", "id=comments", "class=cookieNotice", "class='x newsletter-signup'", "class=ad-slot", "hidden"):
        body = f"<article><h1>Title</h1><p>{LONG}</p><div {name}><p>{small}</p></div><p>End.</p></article>"
        assert read(body) == f"Title {long} End.", name
    linked = f"<div class=related-reading-here><a href=x>{small}</a> <a href=y>And more.</a></div>"
    assert read(f"<article><p>{LONG}</p>{linked}</article>") == long


def generated(rng, marked):
    """A page without an article element, and what it says: content in nested divs among other parts."""
    words = lambda n: " ".join(prose(rng.random(), n).split())
    content, wanted = [], []
    for _ in range(rng.randint(1, 6)):
        if rng.random() < 0.4:
            title = words(3)
            content.append(f"<h2>{title}</h2>")
            wanted.append(title)
        for _ in range(rng.randint(1, 4)):
            text = words(rng.randint(12, 60)).replace(" ", ", ", 3) + "."
            content.append(rng.choice(["<p>{}</p>", "<p>{}", "<div><p>{}</p></div>", "<section class=part><p>{}</p></section>"]).format(text))
            wanted.append(text)
        if rng.random() < 0.5:
            content.append(f"<div class='{rng.choice(marked)}'><a href=x>{words(4)}</a></div>")
    side = f"<div class=sidebar><ul><li><a href=x>{words(2)}</a><li>{words(2)}</ul></div>"
    body = f"<nav><ul><li>{words(2)}</ul></nav><div class=page><div class=text>{''.join(content)}</div>{side}</div><footer>{words(5)}</footer>"
    return f"<html><head><title>{words(2)}</title><body>{body}", " ".join(wanted)


def test_generated_template_without_article():
    rng = random.Random(8)
    for _ in range(60):
        page, want = generated(rng, ["ad", "share", "related-posts", "newsletter"])
        assert tagpaths.main_text(page, P) == want


def test_deep_and_broken_pages_take_linear_time():
    deep = 16000
    for page in ("<div>" * deep, "<div>" * deep + "</p>" * deep, "<p><button>" + "<div>" * deep, "<div class=search>" * deep + LONG, "<td>" * deep,
                 "<ul><li>" * deep + "a, b.", "<article>" * deep + "a", "<p class=x>a.</p>" * deep, "</div>" * deep, "<div class=search-here>" * deep + "a, b."):
        start = time.perf_counter()
        tagpaths.main_text(page, P)
        assert time.perf_counter() - start < 2.5, page[:30]


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (3, "u", "<nav>Menu</nav>"), (4, None, "plain words only"), (5, "u", "<p>cut off, here. <b"),
        (6, "u", "<div>" * 3000 + "deep, text." + "</div>" * 10), (7, "u", "<p>a, b.</p>" * 4000), (7, "u", "<p>a, b.</p>"),
        (8, "u", "<article>short</article><footer>long footer text, with points. And more, of it.</footer>"), (9, "u", "<script>x()</script>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = [(r["page_id"], r["text"]) for r in tagpaths.extracted(df).collect()]
    assert len(got) == len(rows)
    texts = dict(got[:7])
    assert texts[1] == texts[2] == texts[3] == ""
    assert texts[4] == "plain words only" and texts[6] == "deep, text." and texts[5].startswith("cut off, here.")
    assert dict(got)[8] == "short" and dict(got)[9] == ""
    assert tagpaths.extracted(df.limit(0)).collect() == []
