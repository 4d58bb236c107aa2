import html
import re

import pytest

from ledgerlens.llm import html_text
from ledgerlens.llm.html_text import main_text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("just text, no tags", "just text, no tags"),
        ("<div class='advert'>buy now, today!</div>", ""),
        (
            "<body><header>Site</header><nav><a href=x>A</a></nav><main><article class='has-sidebar'><h1>T</h1>"
            "<p>One &lt;b&gt; &amp; two&nbsp;three,\n and more.<script>var p = '</p>';</script></p><p>short</p>"
            "<form><p>mail?</p></form><aside>side</aside></article><section id=comments><article><p>"
            "A reader wrote a long comment, longer than the article itself is, indeed.</p></article></section></main>"
            "<footer>&copy;</footer></body>",
            "T\n\nOne <b> & two three, and more.\n\nshort",
        ),
        (
            "<body><div class=nav-menu><a href=/>Home</a></div><div id=content><h1>Title</h1><div><p>First para, with text."
            "<p>Second para; long enough to count.<ul><li>one<li>two</ul></div></div>"
            "<div class=cookie-notice>We use cookies, of course.</div></body>",
            "Title\n\nFirst para, with text.\n\nSecond para; long enough to count.\n\none\n\ntwo",
        ),
        ("<p>x <span class=ad>buy</span> y <button>Go</button>z.<p style='display:none'>no, no.", "x y z."),
        ("<!-- <p>no</p> --><p>a<!-- c -->b &#233;&eacute; &am", "ab éé &am"),
        ("<p>" + "word, " * 50000, ("word, " * 50000).strip()),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_all_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {row["page_id"]: row["html"] for row in pages.collect()}
    for row in html_text.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", sources[row["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


def test_nulls_and_repeats(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, None, None, "t"), (None, "u", "<p>a", "t"), (2, "u", "<p>a", None), (2, "u", "<p>a", None)]
    found = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in found) == [("1", "", 0), ("2", "a", 1), ("2", "a", 1), ("None", "a", 1)]
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []


def test_long_punctuated_paths_are_content():
    blocks = [("/ul/li", "Home")] * 8 + [("/div/p", "A sentence, with commas. And more of it." * 3)] * 3
    assert html_text.content_paths(blocks) == {"/div/p"}
    assert html_text.content_paths([]) == set()


SENTENCE = "A sentence of the article, with a comma. "


@pytest.mark.parametrize(
    "page",
    [
        "<div id=content><section><p>{short}</p></section><section><p>{long}</p></section></div>",
        "<div><p>{short}</p></div><div><p>{long}</p></div>",
        "<div id=content><p>{short}</p><blockquote>{long}</blockquote></div>",
        "<div id=content><p>{short}</p><ul><li>{long}</li></ul></div>",
        "<div id=content><p>{short}</p><table><tr><td>{long}</td></tr></table></div>",
    ],
)
def test_parts_beside_the_longest_stay(page):
    short, long = (SENTENCE * 3).strip(), (SENTENCE * 8).strip()
    assert main_text(f"<body>{page.format(short=short, long=long)}</body>") == f"{short}\n\n{long}"
