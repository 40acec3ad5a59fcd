from html.parser import HTMLParser
from random import Random

import pytest

from ratinglens.llm import html_blocks, html_extraction
from ratinglens.llm.decision_tree import Leaf, answer, fit_tree

SMALL = "/root/testdata/sf0.01"


class Article(HTMLParser):
    """The text of the article element by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.found, self.text = False, [], ""

    def cut(self):
        text, self.text = " ".join(self.text.split()), ""
        self.found += [text] if text and self.inside else []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        if tag in ("p", "h1", "article"):
            self.cut()
            self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
            self.inside &= tag != "article"

    def handle_data(self, data):
        self.text += data


def test_the_test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for row in html_extraction.main_text(pages).select("row.html", "main_text").collect():
        parser = Article()
        parser.feed(row.html)
        parser.close()
        parser.cut()
        assert row.main_text == "\n".join(parser.found)


def extract(spark, *pages):
    rows = [(i, "u", page, 1, "t") for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, texts int, words string")
    return [r.main_text for r in sorted(html_extraction.main_text(df.repartition(3)).collect(), key=lambda r: r.row.page_id)]


LONG = "The river rose again on Monday night, and by the morning the lower streets of the old town stood under a foot of brown water."
OTHER = "Shopkeepers carried what they could to the upper floors while the fire service pumped out the cellars of the school and the town hall."
THIRD = "Nobody was hurt, the mayor said, but the bridge stays closed until engineers have looked at its middle pillar."

LAYOUTS = {
    "news": f"""<html><body><header class="site-header"><a href=/>The Daily</a><nav><a>Home</a><a>Sport</a></nav></header>
        <div class="breaking-banner">Subscribe now and save half!</div>
        <main><article><header><h1>Water in town</h1><p class="byline">By A. Writer</p></header><p>{LONG}</p>
        <div class="ad-slot">Buy a boat today, you may need one.</div><p>{OTHER}</p><p>{THIRD}</p></article>
        <aside class="related"><h3>Read next</h3><p>Another flood ten years ago left the same streets under water for a week.</p></aside>
        <section id="comments"><h2>2 comments</h2><p>I told them about that bridge for years and nobody has ever listened to me about it.</p></section></main>
        <footer>All rights reserved. Contact us at the usual address.</footer></body></html>""",
    "named": f"""<body class="has-sidebar"><div id="top-nav"><ul><li><a>A</a><li><a>B</a></ul></div>
        <div id="cookie-consent">We use cookies to make this site better for everybody who reads it every day.<button>Fine</button></div>
        <div id="content"><h1>Water in town</h1><p>{LONG}<p>{OTHER}<p>{THIRD}</div>
        <div id="sidebar"><p>Our weather page has forecasts for all towns in the valley and beyond it.</p></div>
        <form action=/s><label>Search</label><input><p>Leave your address to get our letter every week.</p></form></body>""",
    "bare": f"""<div><a>Home</a> | <a>News</a> | <a>Contact</a></div><h1>Water in town</h1><div>{LONG}</div><div>{OTHER}</div><div>{THIRD}</div>
        <ul><li><a>More news</a></li><li><a>Older news</a></li><li><a>Imprint</a></li></ul>""",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_that_the_tree_has_not_seen(spark, layout):
    text, = extract(spark, LAYOUTS[layout])
    assert text == "\n".join(["Water in town", LONG, OTHER, THIRD])


def test_odd_pages(spark):
    found = extract(
        spark, None, "", "   \n", "<article><p>a &amp;amp; b&nbsp;\t c &lt;i&gt; &#233;&hellip;<br>d</p></article>", "<nav><a>x</a></nav>",
        f"<article><p>1 < 2 <!-- not <p> this --> and <b>bo</b>ld</p><script>if (a < b) '</p>'</script><p title='a>b' class=x>{LONG}</article>",
        f"<article><p>{LONG}</p><!-- never closed <p>gone</p></article>", f"<article><p>{LONG}<script>never closed</article>",
        f"<ARTICLE><P>{LONG}</ARTICLE><FOOTER>x</FOOTER>", f"</div></p><article><p>{LONG}</p></div></article><div>", f"<article><p>{LONG}</p")
    assert found == ["", "", "", "a &amp; b c <i> é… d", "", f"1 < 2 and bold\n{LONG}", LONG, LONG, LONG, LONG, LONG]
    assert extract(spark) == []


def test_long_page_and_repeats(spark):
    page = "<article>" + "".join(f"<p>paragraph {i} of a very long page, which goes on.</p>" for i in range(60_000)) + "</article>"
    found = extract(spark, page, page, LAYOUTS["bare"])
    assert found[0] == found[1] and found[0].count("\n") == 59_999 and found[0].endswith("paragraph 59999 of a very long page, which goes on.")


@pytest.mark.parametrize("piece", ['<a "', "<a b='", "<!--", "<", "<script>", "<div>", "</div>", "<p ", '<div class="', "<x y=\"'", "&", "= "])
def test_broken_markup_takes_linear_time(piece):
    html_blocks.text_blocks(piece * 100_000)
    html_blocks.text_blocks("<div>" * 50_000 + "</p>" * 50_000 + piece)


def test_random_markup_never_fails_and_loses_no_words():
    random = Random(2)
    parts = ["<p>", "</p>", "<div class=x>", "</div>", "<b>", "</b>", "<li>", "<a href='>'>", "</a>", "<br>", "<h2>", "</h2>", "<td>", "&lt;"]
    for _ in range(300):
        made, words = [], 0
        for _ in range(random.randint(0, 40)):
            if random.random() < 0.5:
                made.append(f" w{words} ")
                words += 1
            else:
                made.append(random.choice(parts))
        blocks = html_blocks.text_blocks("".join(made))
        text = " ".join(b[0] for b in blocks)
        assert [w for w in text.replace("<", " ").split() if w.startswith("w")] == [f"w{i}" for i in range(words)]
        assert all(0 <= linked <= n == len(t.split()) for t, n, linked, _ in blocks)


def test_tree():
    x, y = html_extraction.labelled_table()
    tree = html_extraction.trained_tree()
    assert sum(answer(tree, row) != label for row, label in zip(x, y, strict=True)) <= 0.02 * len(y)
    assert fit_tree(x[:1], y[:1]) == Leaf(bool(y[0])) and isinstance(fit_tree(x * 0, y), Leaf)
