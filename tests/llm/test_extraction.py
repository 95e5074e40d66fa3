"""Page texts of many shapes, time on hostile pages, and training that the layout does not change."""

import time

import pytest

from fleetpulse.llm import extraction

LONG = "The river bends twice before it meets the old mill, and nobody knows why it was built there. " * 2
MORE = "In winter the wheel stands still, and the miller repairs what the summer has worn out. " * 2
L, M = LONG.strip(), MORE.strip()
AROUND = "<nav><a href=/>Home</a> <a href=/b>News</a></nav>{}<footer>Imprint and contact</footer>"

PAGES = {
    "an apostrophe in an unquoted value": (f"<article><p title=don't>{L}</p><p>It's {M}</p></article>", f"{L} It's {M}"),
    "a quote as an attribute": (f'<article><p " x>{L}</p><p>{M}</p></article>', f"{L} {M}"),
    "a bracket in a quoted value": (f'<article><p title="a > b">{L}</p></article>', L),
    "single quotes": (f"<article><p title='say \"x\" > y'>{L}</p></article>", L),
    "a slash at the end of a value": (f"<body><div id=content data-u=http://x/><p>{L}</p></div></body>", L),
    "class names in an article": (
        f"<article><p>{L}</p><section class='related-work'><p>{M}</p></section><div class=social-history><p>{L}</p></div>"
        f"<div class='related-posts'><p>{M}</p></div><div class='share-buttons'>Tell others</div></article>", f"{L} {M} {L}"),
    "lists and tables of a marked block": (
        AROUND.format(f"<div class='post-body'><h2>Water</h2><p>{L}</p><ul><li>One</li><li>Two</li></ul><p>{M}</p></div>"),
        f"Water {L} One Two {M}"),
    "a table in an article": (f"<article><p>{L}</p><table><tr><td>a</td><td>b</td></tr></table></article>", f"{L} a b"),
    "main": (AROUND.format(f"<main><h1>Mill</h1><p>{L}</p></main>"), f"Mill {L}"),
    "paragraphs without any mark": (AROUND.format(f"<div><p>{L}</p><p>{M}</p></div>"), f"{L} {M}"),
    "unclosed paragraphs": (AROUND.format(f"<div id=content><p>{L}<p>{M}</div>"), f"{L} {M}"),
    "references": ("<article><p>caf&eacute; &lt;b&gt; &#x41;&amp;B, said " + L + "</p></article>", f"café <b> A&B, said {L}"),
    "comments of readers": (f"<article><p>{L}</p></article><div class='comments'><p>{M}</p><p>{M}</p></div>", L),
    "a comment that never ends": (f"<article><p>{L}</p></article><!-- <p>{M}</p>", L),
    "scripts and styles": (f"<article><script>var a = '<p>x</p>'</script><style>p {{}}</style><p>{L}</p></article>", L),
    "less-than signs": (f"<article><p>a < b and 1 <2, {L}</p></article>", f"a < b and 1 <2, {L}"),
    "an end inside a tag": (f"<article><p>{L}</p></article><div class='x", L),
    "unmatched ends": (f"</div></b><article></i><p>{L}</b></p></span></article>", L),
    "nothing": ("", ""),
}


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return extraction.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_shapes(model, name):
    page, text = PAGES[name]
    assert extraction.main_text(page, *model) == text


@pytest.mark.parametrize("page", [
    '<a "' * 250_000, "<div>" * 100_000 + "</b>" * 100_000, "<p><body>" + "<h1>" * 100_000, "<a b='" * 150_000,
    "<!--" * 250_000, "<" * 1_000_000, "<p><span>" * 60_000 + "</i>" * 100_000, "<ul>" + "<li><b>" * 60_000,
], ids=range(8))
def test_time_grows_with_the_page(page):
    def seconds(html):
        start = time.process_time()
        extraction.main_text(html, *extraction.prior())
        return time.process_time() - start
    assert seconds(page) < 20 and seconds(page) < 3.5 * seconds(page[:len(page) // 2]) + 0.5


def test_the_model_does_not_depend_on_the_layout(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    first = extraction.train(pages)
    for other in (pages.repartition(7), pages.unionByName(pages).orderBy("html")):
        again = extraction.train(other)
        assert (first[0] == again[0]).all() and (first[1] == again[1]).all()
