from kpi_shift.llm.html_text import extract_text, main_text
from tests.llm.helpers import clashing

LONG = "Here is a paragraph of some length that any reader would take for the text of a page. "


def test_article_without_furniture():
    page = f"""<html><head><title>T</title><style>p{{x:1}}</style></head><body class="has-sidebar"><header><p>{LONG}</p></header>
    <nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">{LONG}</div><aside>{LONG}</aside>
    <article><h1>Head &amp; line</h1><p>One   <b>two</b>,<br>three &eacute;&#233;</p><script>var a = "<p>no</p>";</script>
    <div class="ad">{LONG}</div><form><input><label>Name</label></form><p>Four<p>Five <a href=x>link</a></p><ul><li>a<li>b</ul>
    <div id="comments"><p>{LONG}</p></div></article><footer>{LONG}</footer></body></html>"""
    assert main_text(page) == "Head & line\nOne two, three éé\nFour\nFive link\na\nb"


def test_body_without_marks_finds_the_dense_part():
    links = "".join(f'<li><a href="/{i}">Some link number {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><p>{LONG * 3}</p><p>{LONG * 2}</p><p>Short.</p></div></div><div>(c)</div></body>"
    assert main_text(page) == "\n".join([(LONG * 3).strip(), (LONG * 2).strip(), "Short."])


def test_awkward_pages():
    assert [main_text(h) for h in (None, "", "   ", "<p></p>", "<script>x</script>", "<!-- a")] == [""] * 6
    assert main_text("plain &lt;text&gt; only") == "plain <text> only"
    assert main_text("<p>a<p>b</div></p>c") == "a\nb\nc"
    assert main_text("<div>" * 5000 + "deep") == "deep"
    assert main_text("<P CLASS='x' data-y=\"a>b\">t u</P>") == "t u"
    assert main_text("<article><p>" + "word " * 50_000 + "</p></article>") == ("word " * 50_000).strip()


def test_an_article_that_is_a_teaser_is_not_the_page():
    teaser = "<div><article><h3>Other</h3><p>A teaser.</p></article></div>"
    text = "\n".join([(LONG * 3).strip(), (LONG * 2).strip()])
    paragraphs = f"<p>{LONG * 3}</p><p>{LONG * 2}</p>"
    assert main_text(f"<body><main>{paragraphs}</main>{teaser}</body>") == text
    assert main_text(f"<body><div>{paragraphs}</div>{teaser}</body>").startswith(text)
    assert main_text(f"<body><div>{teaser}</div><article>{paragraphs}</article></body>").startswith(text)


def test_a_name_cuts_no_text_of_the_page():
    text = "\n".join([(LONG * 3).strip(), (LONG * 2).strip()])
    paragraphs = f"<p>{LONG * 3}</p><p>{LONG * 2}</p>"
    for name in ("with-sidebar", "content-header-fixed"):
        assert main_text(f"<body><div id='page' class='{name}'><h2>Head</h2>{paragraphs}</div></body>") == f"Head\n{text}"
        # the wrapper has the article, but less than half of the characters
        assert main_text(f"<body><div class='{name}'><article>{paragraphs}</article></div><div class='comments'>{paragraphs * 2}</div></body>") == text
    links = "".join(f"<li><a href=/{i}>Another page of the site</a></li>" for i in range(5))
    inside = f"<section id='discussion'><p>{LONG}</p></section><div class='menu'><p>Soup, then fish.</p></div><div class='related'><ul>{links}</ul></div>"
    assert main_text(f"<article>{paragraphs}{inside}</article>") == f"{text}\n{LONG.strip()}\nSoup, then fish."


def test_rows(spark):
    rows = [(1, "u", "<p>x y</p>"), (1, "u", "<p>x y</p>"), (2, None, None), (None, "v", "")]
    pages = clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "u", "x y", 3), (1, "u", "x y", 3), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert extract_text(pages.limit(0)).count() == 0
