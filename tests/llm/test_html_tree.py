import pytest

from tidemark.llm import html_tree

BODY = "A long paragraph, with commas, that says what the page is about, and says it at some length."
CASES = {
    "": "", "<": "<", "<p": "", "plain  text": "plain text", "<body>a < b and c > d</body>": "a < b and c > d",
    "<body><p>One, two.<p>Three &lt;x&gt; &amp &am": "One, two.\nThree <x> & &am",
    f"<nav><a href=x>m</a></nav><article><h1>T</h1><p>{BODY}</p></article><footer>f</footer>": f"T\n{BODY}",
    f"<article><p>{BODY}</p></article><div id=comments><p>{BODY} Nice!</p></div>": BODY,
    f"<article><p>{BODY}</p><section class='comment-list'><p>{BODY} Me too.</p></section></article>": BODY,
    f"<div class=cookie-notice>ok</div><main><p>{BODY}</p><form><label>mail</label></form></main>": BODY,
    f"<aside>{BODY}</aside><div class=post><p>{BODY}</p><ul class=share><li><a>x</a></li></ul></div>": BODY,
    f"<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>{BODY}</p></article>": f"Head\n{BODY}",
    f"<article><p>x<script>var a='<p>no</p>';</script>y</p><!-- c --><style>p{{}}</style><p>{BODY}</p></article>":
        f"xy\n{BODY}",
    f"<div class=content><p>{BODY}</p></div><div><a href=1>one</a> <a href=2>two</a></div>": BODY,
    f"<article><section><p>A short.</p></section><section><p>{BODY}</p></section></article>": f"A short.\n{BODY}",
    "<article><p><b>a<br><p>b\n\t c&nbsp;d</article>": "a\nb c d",
    f"<div hidden><p>{BODY} no</p></div><div><p>{BODY}</p></div>": BODY,
}


@pytest.mark.parametrize("html", CASES)
def test_main_text(html):
    assert html_tree.main_text(html) == CASES[html]


@pytest.mark.parametrize("wrapper", [
    "<div class='content has-sidebar'>", "<div id='page' class='no-sidebar'>", "<div class='post-content social'>",
    "<main class='layout sidebar-left'>", "<div class='has-sidebar'>", "<div class='hentry comments-enabled'>",
    "<span class='share-wrap'>", "<article class='widget'>"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "{}"])
def test_wrappers_keep_the_article(wrapper, inner):
    tag = wrapper[1:].split()[0]
    text = f"<h1>T</h1><p>{BODY}</p><p>{BODY} Two.</p>"
    page = (f"<body><nav><a href=1>m</a></nav>{wrapper}{inner.format(text)}<div class=sidebar><p>Side.</p></div></{tag}>"
            "<div class=cookie>ok</div></body>")
    assert html_tree.main_text(page) == f"T\n{BODY}\n{BODY} Two."


@pytest.mark.parametrize("beside", [
    f"<div id=comments>{f'<p>{BODY} Me too.</p>' * 5}</div>", f"<div class=related>{f'<p>{BODY} More.</p>' * 2}</div>",
    "<div class=related><article><p>Teaser, short.</p></article></div>", "<p>x<span class=ad>buy</span></p>"])
def test_names_still_tell_what_is_beside(beside):
    want = BODY + ("\nx" if "span" in beside else "")
    assert html_tree.main_text(f"<main><p>{BODY}</p>{beside}</main>" if "span" in beside else
                               f"<main><p>{BODY}</p></main>{beside}") == want


def test_short_siblings_and_lists_stay():
    parts = ["<section><h2>One</h2><p>Short.</p></section>", f"<section><p>{BODY}</p><p>{BODY} Two.</p></section>",
             "<ul><li>First</li><li>Second</li></ul>", "<p>A line.</p>", "<div><p>The end.</p></div>",
             "<ol><li>With <a href=1>a link</a> in a longer line of text.</li></ol>"]
    menu = "<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul>"
    want = ["One", "Short.", BODY, f"{BODY} Two.", "First", "Second", "A line.", "The end.",
            "With a link in a longer line of text."]
    for page in ("".join(parts), f"<div>{menu}{''.join(parts)}</div>"):
        assert html_tree.main_text(f"<body>{menu}{page}<div class=comments><p>No.</p></div></body>") == "\n".join(want)


def test_references_inside_the_article_stay():
    links = "<ul><li><a href=1>Reference one</a></li><li><a href=2>Reference two</a></li></ul>"
    for tag in ("article", "main", "div"):
        page = f"<body>{links}<{tag}><p>{BODY}</p><p>{BODY} Two.</p>{links}</{tag}></body>"
        assert html_tree.main_text(page) == f"{BODY}\n{BODY} Two.\nReference one\nReference two"


def test_deep_and_long_pages():
    assert html_tree.main_text("<div>" * 5000 + f"<p>{BODY}") == BODY
    assert html_tree.main_text("<b>" * 5000 + "x") == "x"
    page = "<article>" + "".join(f"<p>{BODY} {i}</p>" for i in range(3000)) + "</article>"
    assert html_tree.main_text(page).count("\n") == 2999


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{BODY}</p></article>"), (1, "u", f"<article><p>{BODY}</p></article>"), (None, None, None)]
    df = spark.createDataFrame([r + ("!",) for r in rows], "page_id long, url string, html string, text string")
    got = html_tree.extract(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, BODY, len(BODY)), (1, BODY, len(BODY))]
    assert html_tree.extract(df.limit(0)).count() == 0


def test_nested_columns_stay():
    rows = "".join(f"<div class=row><div class=col><p>{BODY} {i}.</p></div></div>" for i in ("One", "Two", "Three"))
    assert html_tree.main_text(f"<body>{rows}</body>") == "\n".join(f"{BODY} {i}." for i in ("One", "Two", "Three"))
    deep = "".join(f"<div><div><div><p>{BODY} {i}.</p><p>{BODY}</p></div></div></div>" for i in range(3))
    assert html_tree.main_text(f"<body><ul><li><a href=1>a</a></li><li><a href=2>b</a></li></ul>{deep}</body>") == "\n".join(
        f"{BODY} {i}.\n{BODY}" for i in range(3))


@pytest.mark.parametrize("name", ["notice-board", "skip-list", "search-history", "hidden-figures"])
def test_names_that_only_hint_do_not_delete(name):
    page = f"<article><p>{BODY}</p><div class='{name}'><p>{BODY} More.</p><p>{BODY} Last.</p></div></article>"
    assert html_tree.main_text(page) == f"{BODY}\n{BODY} More.\n{BODY} Last."


@pytest.mark.parametrize("name", ["ad", "cookie-notice", "sidebar", "share-buttons", "comment-list", "ad-box", "teasers"])
def test_plain_names_do(name):
    page = f"<article><p>{BODY}</p><p>{BODY} Two.</p><div class='{name}'><p>Buy, now.</p></div></article>"
    assert html_tree.main_text(page) == f"{BODY}\n{BODY} Two."


def test_headline_beside_the_article_and_teasers_after_a_post():
    page = f"<body><div><h1>Headline</h1></div><article><p>{BODY}</p></article></body>"
    assert html_tree.main_text(page) == f"Headline\n{BODY}"
    teasers = f"<div class=teasers><p>{BODY} A.</p><p>{BODY} B.</p></div>"
    assert html_tree.main_text(f"<body><div class=post><p>{BODY}</p><p>{BODY} C.</p></div>{teasers}</body>") == f"{BODY}\n{BODY} C."


@pytest.mark.parametrize("unit", ["<a b ", "<span class=ad>", "<a \">\" ", "<a '", "</ ", "<!-- ", "<p><button><b>", "<b><div></div>",
                                  "<li><b>", "<!", "<", "&amp;", "<div class=ad>", "<table><tr><td>", "<a href=x>y"])
def test_hostile_pages_take_linear_time(unit):
    import time

    def took(n):
        start = time.process_time()
        html_tree.main_text(unit * n)
        return time.process_time() - start

    n = 8000
    took(n)
    assert took(8 * n) < 24 * max(took(n), 0.004)


def test_unclosed_quotes_end_at_the_next_bracket():
    assert html_tree.main_text(f"<p title=\"x>{BODY}</p>") == BODY
    assert html_tree.main_text(f"<p title='a>b'>{BODY}</p>") == BODY
