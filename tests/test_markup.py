from html.parser import HTMLParser

import pyarrow.parquet as pq

from marginalia.sources import readers as R

PAGES = [
    """<p class='a' id="x"><!-- <b> --><script>if(a<b){}</script><i class=z hidden>t</i></p>""",
    """<!DOCTYPE html><a href=/x/y?q=1&r=2 title="a > b <c>" DATA-N='<!-- no -->'>x</a><br/><img src=q.png alt=''/>""",
    """<STYLE>p{content:"</p><q>"}</STYLE><b>x</b><textarea><u></textarea><title><em>no</em></title><svg viewBox="0 0 1 1"><path d='M0 0'/></svg>""",
    """<p
  class = "multi line"
  data-x
  = y>1 < 2 and 3 > 2 <3 <u <s>""",
    """text <!-- never closed <b><i>""",
    """<script>never closed <b>""",
    """<p class="one" class="two">""",
    "",
]


class Elements(HTMLParser):
    """The standard library's parser, as a list of (tag, attributes), the first of a repeated one."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.found = []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        kept = {}
        for k, v in attrs:
            kept.setdefault(k, v or "")
        self.found.append((tag, kept))
        # Newer versions of the parser do so on their own.
        if tag in ("textarea", "title", "xmp", "iframe", "noembed", "noframes"):
            self.set_cdata_mode(tag)

    def unescape(self, s):
        return s


def scanned(spark, pages, **more):
    got = {}
    rows = R.scan_markup(spark.createDataFrame(list(enumerate(pages)), "k long, h string"), "k", "h", **more).collect()
    for r in sorted(rows, key=lambda r: (r.k, r.ordinal)):
        got.setdefault(r.k, []).append((r.tag, r.attrs))
    return got


def test_example_and_edges(spark):
    got = scanned(spark, [*PAGES, None])
    assert got[0] == [("p", {"class": "a", "id": "x"}), ("script", {}), ("i", {"class": "z", "hidden": ""})]
    assert got[1] == [("a", {"href": "/x/y?q=1&r=2", "title": "a > b <c>", "data-n": "<!-- no -->"}), ("br", {}), ("img", {"src": "q.png", "alt": ""})]
    assert got[2] == [("style", {}), ("b", {}), ("textarea", {}), ("title", {}), ("svg", {"viewbox": "0 0 1 1"}), ("path", {"d": "M0 0"})]
    assert got[3] == [("p", {"class": "multi line", "data-x": "y"}), ("s", {})]
    assert 4 not in got and 7 not in got and 8 not in got and got[5] == [("script", {})] and got[6] == [("p", {"class": "one"})]
    assert scanned(spark, PAGES, tags=["i", "b"]) == {0: [("i", {"class": "z", "hidden": ""})], 2: [("b", {})]}


def test_long_pages(spark):
    many = "<div " + " ".join(f"a{k}=v{k}" for k in range(5000)) + ">"
    got = scanned(spark, [many, "<" * 200_000, "<p b=" * 50_000 + "</" * 50_000, "<script>" + "x<y " * 300_000, '<a b="' + "c" * 500_000])
    assert len(got[0][0][1]) == 5000 and got[3] == [("script", {})] and set(got) == {0, 3}


def test_given_pages_equal_the_standard_parser(spark):
    pages = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if p and "&" in p]
    pages = [p.replace("&amp;", "+").replace("&", "+") for p in pages]  # the standard parser decodes entities
    got = scanned(spark, pages)
    for k, page in enumerate(pages):
        assert got[k] == Elements(page).found
