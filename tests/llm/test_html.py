import random
import time

import pytest
from changeflow.llm.html import PARAGRAPHS, SHARES, _dropped, _score, extract, main_text, parse

P = "One long paragraph, with several words, some commas, and enough length to be an article text. "
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this, buy that, buy all of it now</div>
<article><h1>Title &amp; more</h1><p><b>Bold<br><p>{P}</p><p>caf&eacute;&nbsp;a<i>b</i>c</p></article>
<div class="comments"><p>{P}</p><p>{P}</p></div><footer>&copy; me</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == f"Title & more Bold {P.strip()} café abc"


def test_cut_off_pages():
    cut = PAGE[: PAGE.index("caf&") + 5]
    assert main_text(cut) == f"Title & more Bold {P.strip()} caf&e"
    assert main_text(PAGE[: PAGE.index("</p><p>caf") + 2]).endswith("article text.")


def test_without_article_element():
    body = f"<body><div id=menu><a href=a>Home, sweet, home and many other links</a></div><div><h2>Head</h2><p>{P}</p><p>{P}</p></div><div class=sidebar><p>{P}</p></div></body>"
    assert main_text(body) == f"Head {P.strip()} {P.strip()}"


@pytest.mark.parametrize("name,kept", [
    ("post-comments", False), ("blog-comments", False), ("article-footer", False), ("content-sidebar", False), ("page-header", False), ("post comments", False), ("comments", False),
    ("entry-content", True), ("content has-sidebar", True), ("post category-search", True), ("text", True), ("", True),
])
def test_parts_within_an_article(name, kept):
    other = "Other words, and more of them, that are long enough to be a paragraph of their own."
    page = f"<body><article><p>{P}</p><div class='{name}'><p>{other}</p></div><p>{P}</p></article></body>"
    assert main_text(page) == " ".join([P.strip(), *([other] if kept else []), P.strip()])


def plain_points(root):
    """Points by the definition: every paragraph gives to each of its ancestors."""
    points, tree = {}, []

    def walk(node, up):
        tree.append(node)
        text = lambda n: sum(len(c.strip()) if isinstance(c, str) else text(c) for c in n.children if isinstance(c, str) or not _dropped(c, True))
        commas = lambda n: sum(c.count(",") if isinstance(c, str) else commas(c) for c in n.children if isinstance(c, str) or not _dropped(c, True))
        if node.tag in PARAGRAPHS and text(node) >= 25:
            for k, a in enumerate(up):
                points[id(a)] = points.get(id(a), 0) + (1 + commas(node) + min(text(node) / 100, 3)) / SHARES[min(k, 4)]
        for c in node.children:
            if not isinstance(c, str) and not _dropped(c, True):
                walk(c, [node, *up])

    walk(root, [])
    return points, tree


def test_points_equal_the_definition():
    rng = random.Random(8)

    def some(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice([P, "short, one", "<b>bold, text</b> " + P])
        tag = rng.choice(["div", "section", "p", "blockquote", "ul", "li", "td", "span"])
        return f"<{tag}>" + "".join(some(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{tag}>"

    for _ in range(60):
        root = parse("<article>" + "".join(some(7) for _ in range(3)) + "</article>")
        _score(root)
        points, tree = plain_points(root)
        for node in tree:
            assert node.points == pytest.approx(points.get(id(node), 0) + 5 * node.likely + 25 * (node.tag == "article") * bool(node.n_text))


def test_deep_and_badly_closed_pages_take_linear_time():
    began = time.process_time()
    main_text("<div>" * 20000 + "<blockquote>" * 8000 + P)
    main_text("<div>" * 20000 + "</b></i></section>" * 20000 + P)
    main_text("<p>" + ("<div>" * 20000 + "<p>x") + "<li>" * 20000)
    assert time.process_time() - began < 10


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<p", ""), ("just text", "just text"), ("<script>x", ""), ("a < b", "a < b"), ("<body><p>short</p></body>", "short")])
def test_edges(page, text):
    assert main_text(page) == text


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "y"), (2, "u", "", "z"), (3, "u", "<p>" + "word, " * 200000, "z"), (4, "u", "<div>" * 5000 + "deep", "z")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.n_chars for r in got}[3] == 1200000 - 1
    assert {r.page_id: r.text for r in got}[4] == "deep"
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
