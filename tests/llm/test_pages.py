from html.parser import HTMLParser

import numpy as np
import pytest

from ledgerline.llm import pages as p


class Article(HTMLParser):
    """Text of the article element of the tables' pages, by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def plain(html):
    parser = Article()
    parser.feed(html or "")
    parser.close()
    return "\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = p.op13_main_text(spark, sf).collect()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in got) == sorted(
        (r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages
    )
    assert all(r.n_chars for r in got)


LONG = "A sentence that is long enough to be told from the words of a menu, so that its window rises. "

CASES = {
    "article with everything around it": (
        "<html><head><title>T</title><style>p{}</style></head><body class='with-sidebar'><header><h1>Site</h1></header>"
        "<nav><a href=1>One</a></nav><div class=page-menu><a>x</a></div><form><p>Search</p></form>"
        "<div class='wrap newsletter-page'><article class='post comments-open'><header><h1>The title</h1></header><p>First&nbsp;&amp; <b>bold</b>"
        "\n\t text.<p>Second<script>if (a<b) '</p>'</script> one.<div class='ad'>Buy!</div><aside>Side</aside>"
        "<form>Vote</form><ul><li>one<li>two</ul><footer>By X</footer></article></div>"
        "<section id='comments'><h2>Comments</h2><article class='comment'><p>Nice!</p></article></section>"
        "<div class='cookie-notice'>We use cookies.</div><footer>(c)</footer></body></html>",
        "The title\nFirst & bold text.\nSecond one.\none\ntwo",
    ),
    "no landmark": (
        f"<body><div><a href=x>Home</a> <a href=y>News</a></div><div><a>More</a></div><hr><div></div><h2>Head</h2><div>{LONG}</div>"
        f"<div>{LONG}<br>after a break</div><p>short end.</p><div class=footer>(c)</div><div><a href=z>Terms</a></div></body>",
        f"Head\n{LONG.strip()}\n{LONG}after a break\nshort end.",
    ),
    "form around the page": (f"<form id=aspnet><div class=menu>m</div><main><p>{LONG}</p><p>b</p></main></form>", f"{LONG.strip()}\nb"),
    "article rather than main": (f"<main><h2>Latest</h2><article><p>{LONG}</p></article><ul><li>Other</ul></main>", LONG.strip()),
    "teasers": (f"<article><p>{LONG * 3}</p></article><article><p>tease</p></article>", (LONG * 3).strip()),
    "broken markup": (
        "<article><p class=\"x>y\" title='>'>1 &lt; 2 &copy; &#8364;&unknown; a < b <3</p><!-- c > --><p hidden>no</p><p style='display: none'>no"
        "<p>end<!-- open <p>never", "1 < 2 © €&unknown; a < b <3\nend",
    ),
    "open script": ("<p>before</p><script>var x = '<p>no</p>'", "before"),
    "plain text": ("just\n  words\tand nothing &gt; else", "just words and nothing > else"),
    "capitals": ("<BODY><NAV>n</NAV><ARTICLE><P>Ä ö</P><SCRIPT>x</SCRIPT ><P>z</ARTICLE>", "Ä ö\nz"),
    "a name around all text": ("<body><div class='has-sidebar no-ads'><p>short</p></div></body>", "short"),
    "dialogue": (f"<div><p>{LONG}</p>" + "<p>He said: no, never.</p>" * 9 + "</div><div></div>", LONG.strip() + "\nHe said: no, never." * 9),
    "nothing": ("<nav>n</nav><!doctype html><?php x ?>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_page(name):
    page, want = CASES[name]
    assert p.main_text(page) == want


def test_window_sums():
    lengths = np.array([5, 0, 0, 90, 40, 0, 10, 0, 0, 0, 200, 0, 0, 3])
    assert p.between_surge_and_dive(lengths) == [(3, 6), (10, 10)]
    assert p.between_surge_and_dive(np.zeros(0, np.int64)) == []
    assert p.between_surge_and_dive(np.array([200])) == [(0, 0)]


def test_defined_cases(spark, tmp_path):
    long = "<article>" + "<p>word after word</p>" * 100_000
    rows = [(1, "u", "<p>x</p>", "k"), (1, "u", "<p>x</p>", "k"), (2, None, None, None), (None, "v", "", "k"), (3, "w", long, "k")]
    rows += [(4, "q", "<a href='" + "x" * 200_000 + "\">" * 3, "k")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in p.op13_main_text(spark, str(tmp_path)).collect()}
    assert p.op13_main_text(spark, str(tmp_path)).count() == 6
    assert got[1, "u"] == ("x", 1) and got[2, None] == ("", 0) and got[None, "v"] == ("", 0)
    assert got[3, "w"] == ("\n".join(["word after word"] * 100_000), 1_600_000 - 1)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = p.op13_main_text(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == ["page_id", "url", "text", "n_chars"]
