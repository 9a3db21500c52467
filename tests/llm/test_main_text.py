import html
import re
import time

import pytest

from rillmark.llm import main_text


def article(page):
    """For these pages: the blocks between the article's tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))
    return "\n\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: (r["url"], article(r["html"])) for r in pages.collect()}
    got = {r["page_id"]: r for r in main_text.extract(pages).collect()}
    assert got.keys() == want.keys()
    for i, (url, text) in want.items():
        assert (got[i]["url"], got[i]["text"], got[i]["n_chars"]) == (url, text, len(text))


PROSE = "This sentence, like many others, has commas, words and a length that tells it from menus."
PAGES = {
    f"<body><div class='sidebar'><p>{PROSE}</p></div><div id=main><h2>Top</h2><p>{PROSE}</p><p>Short.</p></div></body>": f"Top\n\n{PROSE}\n\nShort.",
    f"<div><ul><li><a href=/>{PROSE}</a></ul></div><div><p>{PROSE}<p>a &lt;b&gt; &amp;\n\t c<br>d</div>": f"{PROSE}\n\na <b> & c d",
    f"<article><header><h1>Head</h1></header><p>{PROSE}</p><section class='comments'><p>{PROSE}</p></section></article>": f"Head\n\n{PROSE}",
    f"<body><div class=cookie-notice>{PROSE}</div><article><p>One<aside>{PROSE}</aside><form><p>{PROSE}</p></form>": "One",
    f"<main><table><tr><td>{PROSE}<td>Two</table><ul><li>x<li>y</ul></main>": f"{PROSE}\n\nTwo\n\nx\n\ny",
    f"<article><p>{PROSE}</p><script>if (a < b) {{ '</p>' }}</script><style>p {{}}</style><p>1 < 2 &copy; &#x41;</p></article><!-- <p>no</p> --><footer>{PROSE}": f"{PROSE}\n\n1 < 2 © A",
    "<html><body></body></html>": "",
    "": "",
    "plain words only": "plain words only",
    f"<p>{PROSE}</p><p>cut off <a hre": f"{PROSE}\n\ncut off",
}


@pytest.mark.parametrize("page", PAGES)
def test_page(page):
    assert main_text.main_text(page) == PAGES[page]


def test_null_deep_and_long():
    assert main_text.main_text(None) == ""
    deep = "<div>" * 20_000 + f"<p>{PROSE}</p>"
    assert main_text.main_text(deep) == PROSE
    long = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert main_text.main_text(long).count(PROSE) == 20_000


def test_repeated_rows_and_clashing_names(spark):
    frame = spark.createDataFrame([(1, None, "<p>a</p>", "x"), (1, None, "<p>a</p>", "x"), (None, "u", None, None)], "page_id long, url string, html string, text string")
    assert sorted(str(tuple(r)) for r in main_text.extract(frame).collect()) == ["(1, None, 'a', 1)"] * 2 + ["(None, 'u', '', 0)"]
    assert main_text.extract(frame.limit(0)).count() == 0


LONG = " ".join([PROSE] * 6)
WHOLE = {
    f"<article><section>{f'<p>{LONG}</p>' * 10}</section><section><p>{PROSE}</p></section></article>": [LONG] * 10 + [PROSE],
    f"<article><div>{f'<p>{LONG}</p>' * 4}</div><h3>More</h3><ul><li>x<li>y</ul><p>End.</p></article>": [LONG] * 4 + ["More", "x", "y", "End."],
    f"<main><h1>Head</h1><article><p>{LONG}</p></article><p>After.</p><ul><li><a href=/>Another page</a></ul></main>": ["Head", LONG, "After."],
    f"<body><div><div><p>{LONG}</p></div><h3>More</h3>loose <b>words</b><dl><dt>a<dd>b</dl><table><tr><td>c</table><p>End.</p><div><a href=/>Home</a></div><a href=/>One</a> | <a href=/>Two</a></div></body>": [LONG, "More", "loose words", "a", "b", "c", "End."],
}


@pytest.mark.parametrize("page", WHOLE)
def test_nothing_of_the_article_is_dropped(page):
    assert main_text.main_text(page) == "\n\n".join(WHOLE[page])


FORMS = {
    f"<body><FORM id=aspnetForm><input value=x><div class=menu>{PROSE}</div><div><label>Name</label><p>{LONG}</p><p>End.</p><select><option>a</select><button>Go</button></div></form></body>": f"{LONG}\n\nEnd.",
    f"<form><article><p>{PROSE}</p></article></form><aside><p>{LONG}</p></aside><div>End.</div>": PROSE,
    f"<body><div><p>{LONG}</p></div><form><p>Ask us.</p></form></body>": LONG,
    f"<body><p>Short.</p><form class=newsletter><p>{LONG}</p></form></body>": "Short.",
    f"<article><p>One</p><form><p>{LONG}</p></form></article>": "One",
}


@pytest.mark.parametrize("page", FORMS)
def test_forms_around_the_body(page):
    assert main_text.main_text(page) == FORMS[page]


def test_many_and_deep_forms():
    assert main_text.main_text("<form>" * 20_000 + f"<p>{PROSE}</p>") == PROSE


BROKEN = {
    "tags without an end": "<a b " * 200_000,
    "quotes without an end": "<a b=' " * 100_000 + "<a b=\" " * 100_000,
    "an end far away": "<a b=\"" + "<p c='" * 200_000 + ">",
    "quotes that hide each end": "<a b='>\" c=\">' d" * 60_000,
    "ends of paragraphs": "<div>" * 100_000 + "</p>" * 100_000,
    "ends of inline elements": "<b><div>" + "<span>" * 100_000 + "</b>" * 100_000,
    "items of no list": "<div>" * 100_000 + "<dd></dd>" * 100_000,
    "headers": "<header>" * 100_000,
    "comments": "<!--" * 250_000,
    "brackets": "<" * 1_000_000,
    "ends of nothing": "</" * 500_000,
    "references": "&amp" * 250_000,
    "scripts": "<script>" * 125_000,
    "forms": "<form><p>a</p>" * 70_000,
}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_pages_of_a_megabyte(kind):
    began = time.process_time()
    page = f"<article><p>{PROSE}</p></article>"
    assert PROSE in main_text.main_text(page + BROKEN[kind])
    main_text.main_text(BROKEN[kind] + page)
    assert time.process_time() - began < 10


TAGS = {
    "<p title=it's>One</p><p>It's two</p>": "One\n\nIt's two",
    "<p class='a>b' id=x/>One</p>": "One",
    "<p a=1 a=2 = ==b>One<br/>two<hr/>three": "One two\n\nthree",
    "<p>a < b and c</p>": "a < b and c",
    "<!-->One<!doctype x><?xml a?>": "One",
    "<p>One</ p>two</p>": "One</ p>two",
    "<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>d<td>e<tr><td>f</table>": "a\n\nb\n\nc\n\nd\n\ne\n\nf",
    "<div><span>a</div>b<b>c</span>d</b>": "a\n\nbcd",
}


@pytest.mark.parametrize("page", TAGS)
def test_tags(page):
    assert "\n\n".join(main_text.blocks(main_text.parse(page))) == TAGS[page]


def test_equal_scores_go_to_the_first_container():
    assert main_text.main_text("".join(f"<div><div><p>{PROSE} {n}</p></div></div>" for n in "ab")) == f"{PROSE} a"
