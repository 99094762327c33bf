import numpy as np
import pytest

from riskframe.llm import html_content
from riskframe.llm.html_content import main_text

from helpers import prose

P = [prose(i, 40) for i in range(6)]


@pytest.mark.parametrize("html, text", [
    ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p></p><br>", ""),
    ("<article><p>a &amp; b&nbsp;c\n d</p><p>x<b>y</b>z</article>", "a & b c d xyz"),
    ("<article>one<br>two<ul><li>three<li>four</ul></article>", "one two three four"),
    ("<nav>menu</nav><p>text</p><footer>foot</footer>", "text"),
    ("<article>kept<script>var a='<p>no</p>'</script><style>p{}</style> on</article>", "kept on"),
    ("<div class='ad'>buy<article>open advert</article>", "open advert"),
    ("<div class='no-sidebar'><article>wrapped</article></div>", "wrapped"),
    ("<article><header><h1>Head</h1></header><p>body</p></article>", "Head body"),
    ("<header>site</header><main><p>body</p></main>", "body"),
    ("<article>real<section class='comments'><article>reader</article></section></article>",
     "real"),
    ("<p class='notice'>cookies<p>paragraph after", "paragraph after"),
    ("<article><p>a<form><p>field</p></form>b</article>", "a b"),
    ("<article>un<b>closed <p>tags", "unclosed tags"),
])
def test_small_pages(html, text):
    assert main_text(html) == text


def test_page_with_all_kinds_of_boilerplate():
    html = f"""<!DOCTYPE html><html><head><title>{P[5]}</title></head><body>
    <header><a href=/>site</a></header><nav><ul><li><a>one</a></li></ul></nav>
    <div class="cookie-notice">{P[4]}</div><aside class="sidebar">{P[3]}</aside>
    <article class="post"><h1>Title</h1><p>{P[0]}</p><p>Sh.</p><p>{P[1]}</p>
    <div class="advert">{P[2]}</div></article>
    <div id="comments"><p>{P[3]}</p></div><form><label>{P[4]}</label></form>
    <footer>&copy; site</footer></body></html>"""
    assert main_text(html) == f"Title {P[0]} Sh. {P[1]}"


def test_without_marks_the_cluster_of_long_lines_is_taken():
    menu = "".join(f"<div><a>m{i}</a><a>n{i}</a></div>" for i in range(12))
    html = f"<body>{menu}<div>{P[0]}</div><div>short</div><div>{P[1]}</div>{menu}</body>"
    text = main_text(html)
    assert text.index(P[0]) < text.index("short") < text.index(P[1])
    assert "m5" not in text


def test_every_article_and_both_ends_stay():
    short = "A real second article, whole."
    html = f"<body><article><p>{P[0] * 9}</p></article><article><p>{short}</p></article></body>"
    assert main_text(html) == f"{P[0] * 9} {short}"
    html = f"<body><h1>Headline</h1><p>{P[1] * 30}</p><p>Short end.</p></body>"
    assert main_text(html) == f"Headline {P[1] * 30} Short end."


def test_a_word_on_a_wrapper_of_most_of_the_page_says_nothing():
    page = "<body><div class='layout-sidebar'><h1>Head</h1><p>{}</p></div><div class='ad'>buy</div>"
    assert main_text(page.format(P[0])) == f"Head {P[0]}"
    # An article, however short, is the page's text: then words count again.
    assert main_text(f"<article>tiny</article><div class='sidebar'>{P[0]}</div>") == "tiny"


def test_the_ratio_decides_where_no_mark_does(monkeypatch):
    menu = "".join(f"<div><a>m{i}</a><a>n{i}</a></div>" for i in range(12))
    html = f"<body>{menu}<div>{P[0]}</div><div>{P[1]}</div>{menu}</body>"
    with_ratio = main_text(html)
    monkeypatch.setattr(html_content, "smoothed", lambda r, sigma=1.0: np.ones(len(r)))
    assert f"{P[0]} {P[1]}" in with_ratio and "m5" not in with_ratio
    assert "m5" in main_text(html)


def test_smoothing_keeps_a_constant():
    assert np.allclose(html_content.smoothed(np.full(9, 3.0)), 3.0)


def test_extract_odd_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x</p>"), (2, "u", ""), (2, "u", ""),
            (3, "u", "<article>" + "word " * 50_000 + "</article>"), (4, "u", "<<>>&#x;<p")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {(r.page_id, r.text[:9]) for r in html_content.extract(df, ["page_id", "url"]).collect()}
    assert {(1, ""), (None, "x"), (2, ""), (3, "word word")} <= got
    assert html_content.extract(df.limit(0), ["page_id"]).collect() == []
    with pytest.raises(ValueError):
        html_content.extract(df.withColumnRenamed("url", "text"), ["page_id", "text"])
