import math
import time
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm.html_extract import content, extract_text, main_text, read_page

PAGE = """<!DOCTYPE html><html><head><title>t &amp; u</title><style>p{}</style></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<!-- <p>no</p> --><div class="cookie-notice">We use cookies, as all do. Fine?</div><div class="ad">Buy this, now. It is cheap.</div>
<article><header><h1>Head &amp; line</h1></header><p>First   para,
 long enough.<br>Yes &mdash; it is.<p>Second <b>bold</b> and <a href="x">linked</a>, unclosed.
<script>if (a < b) { x = "</p><p>js</p>"; }</script><ul><li>one thing, said.<li>two things.</ul>
<table><tr><td>cell a<td>cell b</table><aside>Aside, quite long. Really long.</aside>
<section id="comments"><p>Nice article, thank you for it. I liked it.</p></section></article>
<div class="sidebar"><p>Popular, posts, etc.</p></div><form><label>Name</label><input></form><footer>&copy; All.</footer></body></html>"""


def test_article_alone():
    assert main_text(PAGE).split("\n") == [
        "Head & line", "First para, long enough. Yes — it is.", "Second bold and linked, unclosed.",
        "one thing, said.", "two things.", "cell a", "cell b",
    ]


def test_pages_without_an_article():
    menu = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(30))
    text = "".join(f"<p>Paragraph {k}, with some words in it. And more of them.</p>" for k in range(4))
    page = f"<body><ul>{menu}</ul><div id=c>{text}<p>Short.</p></div><div class=share>Share, now. Please do.</div></body>"
    found = main_text(page).split("\n")
    assert len(found) == 5 and found[-1] == "Short." and found[0].startswith("Paragraph 0")


def test_odd_pages():
    for page in (None, "", " \n", "<p></p>", "<script>x", "<!-- open", "<nav>menu</nav>"):
        assert main_text(page) == ""
    assert main_text("plain, text. no tags") == "plain, text. no tags"
    assert main_text("<p>a &lt;b&gt; &#233;&nbsp;&amp;amp; &bogus;") == "a <b> é &amp; &bogus;"
    long = "<article>" + "<p>word, and more. </p>" * 20_000 + "</article>"
    assert main_text(long).count("\n") == 19_999
    assert main_text("<div>" * 3000 + "deep, text. here") == "deep, text. here"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='x", "'>", "<b", ">", "text, a. ", "&am", "<!--", "-->", "<script>", "</script>", "\"", "<a href=x>", "</a>", "<article>", "</div>", "<li>", "<"]), max_size=30).map("".join))
def test_any_markup_is_read(page):
    text = main_text(page)
    assert all(line == " ".join(line.split()) and line for line in text.split("\n")) or text == ""


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (None, "v", "<p>ü, é.</p>", "t")],
        "page_id long, url string, html string, text string",
    )
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract_text(pages).collect()}
    assert extract_text(pages).count() == 4
    assert found[(2, None)] == ("", 0) and found[(None, "v")] == ("ü, é.", 5)
    assert extract_text(pages.limit(0)).count() == 0


def test_short_blocks_and_linked_headings_of_an_article():
    long = "Words of a paragraph, and more of them. " * 8
    paragraphs = "".join(f"<p>{long}{k}</p>" for k in range(10))
    cells = [f"c{k:03}" for k in range(40)]
    items = [f"item {k:03}" for k in range(20)]
    table = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in cells[k : k + 4]) + "</tr>" for k in range(0, 40, 4))
    listed = "".join(f"<li>{i}</li>" for i in items)
    for tag in ("article", "main"):
        page = (
            f"<body><nav><a href=x>Home</a></nav><ul><li><a href=y>Other</a></li></ul><{tag}>{paragraphs}"
            f"<h2><a href='#x'>Heading</a></h2><table>{table}</table><ul>{listed}</ul>{paragraphs}"
            f"<aside>Around</aside></{tag}><article><h3><a href=z>A card</a></h3></article></body>"
        )
        shown = main_text(page).split("\n")
        assert shown[10:71] == ["Heading", *cells, *items] and len(shown) == 81


def test_names_alone_rule_out_no_page_and_no_article():
    text = [f"Paragraph {k}, with some words in it. And more of them." for k in range(6)]
    inner = "".join(f"<p>{t}</p>" for t in text)
    around = "<div class=sidebar><p>Popular, posts. Read.</p></div><nav><a href=x>Home</a></nav>"
    for page in (
        f"<body class='no-sidebar comments-open'>{around}{inner}</body>",
        f"<html class='js cookie-consent'><body>{around}<article>{inner}</article></body></html>",
        f"<body>{around}<article class='legal'>{inner}</article></body>",
        f"<body>{around}<main id='search' role='form'>{inner}</main></body>",
        f"<body>{around}<div class='content with-sidebar'>{inner}{around}</div></body>",
        f"<body class='login'><div class='widget'><div id='share'>{inner}</div></div>{around}</body>",
        f"<body>{around}<div class='page-header-fixed'><article class='notice'>{inner}</article></div></body>",
    ):
        assert main_text(page).split("\n") == text
    comments = "<section class=comments>" + "<p>A comment, as long as others. Yes.</p>" * 40 + "</section>"
    assert main_text(f"<article>{inner}{comments}</article>").split("\n") == text
    assert main_text(f"<body><article>{inner}</article>{comments}</body>").split("\n") == text


PARAGRAPHS = [f"Paragraph {k} of a text, with some words in it. And a few more of them, to be read." for k in range(15)]
INNER = "".join(f"<p>{t}</p>" for t in PARAGRAPHS)
COMMENT = "<div class=comment><b>Ann</b><p>I have read this, and liked it. Thank you very much for it, and more of it, please.</p></div>"


@pytest.mark.parametrize("n", [5, 40, 80, 200, 500])
def test_reader_comments_go_however_many(n):
    for around in ("<div class='comments'>{}</div>", "<section id=respond>{}</section>", "<ol class='comment-list'>{}</ol>"):
        comments = around.format(COMMENT * n)
        for page in (
            f"<body><article>{INNER}{comments}</article></body>",
            f"<body><article>{INNER}</article>{comments}</body>",
            f"<body><div class=post>{INNER}</div>{comments}</body>",
            f"<body><div id=main><div class=post>{INNER}</div>{comments}</div></body>",
        ):
            assert main_text(page).split("\n") == PARAGRAPHS
    nested = "".join("<article class=comment><p>So do I, as it happens. Yes.</p></article>" for _ in range(n))
    assert main_text(f"<body><article>{INNER}{nested}</article></body>").split("\n") == PARAGRAPHS


def test_names_that_tell_of_a_part_rule_nothing_out():
    for name in ("no-sidebar", "content with-sidebar", "has-comments", "comments-open", "sidebar-layout"):
        assert main_text(f"<body><div class='{name}'>{INNER}</div></body>").split("\n") == PARAGRAPHS


def test_lists_and_tables_of_a_plain_page():
    """As in an article, so on a page of divs; menus and lists of links stay out."""
    items = [f"item {k}" for k in range(12)]
    cells = [f"c{k}" for k in range(40)]
    listed = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
    table = "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in cells[k : k + 4]) + "</tr>" for k in range(0, 40, 4)) + "</table>"
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Link {k}</a></li>" for k in range(12)) + "</ul>"
    whole = f"{INNER}{listed}{table}"
    for page in (
        f"<body>{menu}<div class='post'>{whole}</div><footer>Tail</footer></body>",
        f"<body><div>{menu}</div><div id=page><div class='post'>{whole}<div>{menu}</div></div></div></body>",
        f"<body>{menu}{whole}</body>",
    ):
        assert main_text(page).split("\n") == PARAGRAPHS + items + cells
    assert main_text(f"<body><article>{whole}</article></body>").split("\n") == PARAGRAPHS + items + cells


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000, "<b " * 100_000, "<p><table><td>" + "<div>y" * 50_000, "<div class=legal>z " * 50_000,
    "<a href=\"x>" * 50_001, "<li>a" * 100_000, "<ul><li>" * 50_000 + "x",
], ids=["divs", "open tags", "scopes", "names", "quotes", "items", "lists"])
def test_time_and_memory_follow_the_length_of_a_page(page):
    def seconds(text):
        start = time.process_time()
        main_text(text)
        return time.process_time() - start

    main_text(page[: len(page) // 8])
    assert seconds(page) < 0.5 + 16 * seconds(page[: len(page) // 8])
    tracemalloc.start()
    main_text(page)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def slowly(page):
    """The content of a page of plain elements, path by path as texts."""
    def name(number):
        step = page.paths[number]
        return (name(step.parent) if step.parent else ()) + (f"{number}:{step.tag}",) if number else ()

    rows = [(name(b.path), b) for b in page.blocks]
    shown = [r for r in rows if r[1].weight > 0]
    if not shown:
        return []

    def of(path):
        return [b for p, b in rows if p == path]

    def ratios(path):
        same = of(path)
        marks = sum(c in ".,;:!?…。，、！？；：¿¡" for b in same for c in b.text)
        return sum(len(b.text) for b in same) / len(same), marks / len(same)

    def smoothed(k, which):
        values = [ratios(p)[which] for p, _ in shown]
        left, right = values[max(0, k - 1)], values[min(len(values) - 1, k + 1)]
        return 0.25 * left + 0.5 * values[k] + 0.25 * right

    value = {}
    for k, (path, block) in enumerate(shown):
        same = of(path)
        unlinked = 1 - sum(b.linked for b in same) / sum(len(b.text) for b in same)
        fused = math.sqrt(smoothed(k, 0) * (1 + smoothed(k, 1))) * unlinked**2 * block.weight
        value.setdefault(path, []).append(fused)
    score = {p: sum(v) / len(of(p)) for p, v in value.items()}
    bound = 0.1 * sum(score[p] * len(b.text) for p, b in shown) / sum(len(b.text) for _, b in shown)
    kept = {p for p, s in score.items() if s > 0 and s >= bound}
    total = sum(len(b.text) for p, b in rows if p in kept)
    above = {p[:k] for p in score for k in range(len(p) + 1)}
    own = ("p", "li", "ul", "table", "td", "tr", "h2")
    wide = [
        a for a in above
        if a and page.elements[int(a[-1].split(":")[0])] == 1 and a[-1].split(":")[1] not in own
        and sum(len(b.text) for p, b in rows if p in kept and p[: len(a)] == a) >= 0.8 * total > 0
    ]
    top = max(wide, key=len, default=())
    whole = set()
    for path in score:
        inside = path[: len(top)] == top and (path == top or len(path) > len(top))
        if top and top[-1].split(":")[1] == "div":
            handed = inside
        else:
            handed = inside and len(path) > len(top) and path[len(top)].split(":")[1] in ("ul", "table")
        if handed:
            whole.add(path)

    def linked(path, block):
        same = [b for p, b in rows if (b.list == block.list if block.list else p == path and not b.list)]
        return sum(b.linked for b in same) * 2 > sum(len(b.text) for b in same)

    return [b.text for p, b in rows if b.weight > 0 and (p in kept or (p in whole and not linked(p, b)))]


PIECES = st.recursive(
    st.sampled_from(["<p>Some words, of a text. More.</p>", "<p>x</p>", "<li>one</li>", "<p><a href=x>link</a></p>", "text, plain. ", "<h2><a href=y>Head</a></h2>", "<td>cell</td>"]),
    lambda inner: st.tuples(st.sampled_from(["div", "div class=a", "ul", "table", "div class=sidebar"]), st.lists(inner, max_size=5)).map(
        lambda t: f"<{t[0]}>{''.join(t[1])}</{t[0].split()[0]}>"
    ),
    max_leaves=30,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=8).map(lambda p: f"<body>{''.join(p)}</body>"))
def test_against_a_slow_version(html):
    found = [b.text for b in content(read_page(html))]
    assert found == slowly(read_page(html))
