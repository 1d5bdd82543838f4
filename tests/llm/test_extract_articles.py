"""Text that an article has in common with the other pages of its host."""

from __future__ import annotations

from ledgerloom.llm import extract
from ledgerloom.llm.html_blocks import read
from ledgerloom.sources.scratch import Scratch

PAGE = """<html><head><title>Site</title></head><body><nav>Menu</nav><article><h2>Summary</h2>
<p>Text of page {i}.</p><ul><li>Sources</li></ul></article><footer>End</footer></body></html>"""


def test_constants_in_an_article_stay(spark):
    rows = [(i, f"https://host.example/{i}", PAGE.format(i=i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in extract.extract(df, Scratch(spark)).collect():
        assert r.text == f"Summary Text of page {r.page_id}. Sources"


TWO = """<html><head><title>Site</title></head><body><div class=bar>Visit {i}</div><article class=story>{story}</article>
<article class=teaser><h3>Our books</h3><p>Now in all shops.</p></article><footer>End</footer></body></html>"""


def texts(spark, html):
    rows = [(i, f"https://host.example/{i}", html(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in extract.extract(df, Scratch(spark)).orderBy("page_id").collect()]


def test_the_template_chooses_among_marked_articles(spark):
    """One that is the same on all pages of the host is of the template, whatever its tag."""
    story = "<h2>Summary</h2><p>Text {i}.</p><ul><li>Sources</li></ul>"
    found = texts(spark, lambda i: TWO.format(i=i, story=story.format(i=i)))
    assert found == [f"Summary Text {i}. Sources" for i in range(6)]


def test_copies_of_an_article_keep_it(spark):
    """Only the frame differs: no article has a slot, and none is lost."""
    found = texts(spark, lambda i: TWO.format(i=i, story="<p>The same text.</p>"))
    assert found == ["The same text. Our books Now in all shops."] * 6


FRAME = "<html><head><title>Site</title></head><body>{}</body></html>"


def test_classes_are_ordered(spark):
    """What stands now here, now there among the template's tags is none of them; the others are."""
    fixed = ["<div class=name>Our site</div>", "<div class=lead>Lead {i}</div>", "<div class=foot>Contact</div>"]

    def html(i):
        parts = ["<div class=moved>By Jo</div>", *fixed] if i % 3 else [*fixed, "<div class=moved>By Jo</div>"]
        return FRAME.format("".join(parts)).replace("{i}", str(i))

    assert texts(spark, html) == [f"By Jo Lead {i}" if i % 3 else f"Lead {i} By Jo" for i in range(6)]


def test_classes_are_nested_in_a_root(spark):
    """A class that lies in no large one, or in a tag that is out of order, is not of the template."""
    alone = "<section>Same words</section><p>Text {i}</p>"
    layout = "<div class=name>Our site</div><div class=lead>Lead {i}</div>"

    def html(i):
        return alone.replace("{i}", str(i)) if i > 3 else FRAME.format(layout.replace("{i}", str(i)))

    assert texts(spark, html) == [f"Lead {i}" for i in range(4)] + [f"Same words Text {i}" for i in (4, 5)]

    def turned(i):
        parts = ["<div class=x><ul class=u><li>Within</li></ul></div>", "<div class=name>Our site</div>", "<div class=foot>End</div>"]
        return FRAME.format("".join(parts if i else parts[1:] + parts[:1]) + f"<p>Text {i}</p>")

    assert texts(spark, turned) == [f"Within Text {i}" for i in range(6)]


def test_orders_of_a_page():
    page = read("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl><dl><dd>e</dd><dt>f</dt></dl>")
    dl, dt, dd = page.tags[:3]
    assert page.parents == [0, dl, dl, dl, dl, 0, dl, dl]
    found = list(extract.orders(page, {dl: 1, dt: 2, dd: 2}))
    assert found.count((dl, 2, (dt, dd))) == 2 and found.count((dl, 2, (dd, dt))) == 1


def test_the_fewest_are_out_of_order():
    import itertools

    assert extract.out_of_order([5, 1, 2, 3, 4], [1, 2, 3, 4, 5]) == [5]
    for order in itertools.permutations(range(5)):
        out = set(extract.out_of_order(order, range(5)))
        left = [m for m in order if m not in out]
        assert left == sorted(left)
        longest = max(
            n for n in range(6) if any(list(c) == sorted(c) for c in itertools.combinations(order, n))
        )
        assert len(left) == longest


def test_nesting_follows_the_containers():
    # a root of three tags; one in it, one in a tag that is out of order, one beside all
    paths, parents, classes = [1, 2, 3, 4, 5, 6, 7], [0, 1, 1, 3, 0, 2, 6], [9, 9, 9, 8, 7, 6, 6]
    assert extract.nested(paths, parents, classes, []) == {1, 2, 3, 4, 6, 7}
    assert extract.nested(paths, parents, classes, [6]) == {1, 2, 3, 4}
    assert extract.nested(paths, parents, classes, [3]) == set()  # two are left of the root
