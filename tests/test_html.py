"""Start tags against the standard library's parser, on all pages and on odd snippets."""

import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from kaigi.functions import html as tags
from kaigi.sources import readers

SF = "/root/testdata/sf0.01"
ODD = [
    "<a href=x.pdf>x</a>", "<a HREF = 'x&amp;y.pdf' >x", '<A href="a b.pdf"class=z>', "<a href=it's.pdf id=2>", "<a href>", "<a href=>", "<a href=''>", "<a\nhref\n=\n\"x.pdf\"\n>", "<!-- <a href='no.pdf'> --><a href=yes.pdf>",
    "<!-- > <a href=no.pdf> -- ><a href=yes.pdf>", "<script>var a = '<a href=no.pdf>';</script><a href=yes.pdf>", "<STYLE>a<b <a href=no.pdf></style ><a href=yes.pdf>", "<script src=x.js></script><script/><a href=q.pdf>", "<p title='<a href=no.pdf>'><a href=yes.pdf>",
    "<a href=one.pdf href=two.pdf>", "<abbr href=x.pdf><a/href=y.pdf><a/>", "<a href='x.pdf", "<a href='x.pdf><b>", "a < b <a href=x.pdf>", "<a data-href=no.pdf title=>", "<a href=x/y/z.pdf/>", "<a href = x.pdf / title>", "<br/><a href=&#120;&#x2e;pdf&#0;&#128;&#xD800;&#99999999999;>",
    "<a href='?a=1&copy=2&lt=3&amp;b&notit;&nbsp;&unknown;&hearts;&'>", "<a href=&eacute.pdf>", "<!DOCTYPE html><?php <a href=no.pdf> ?><a href=yes.pdf>", "</a href=no.pdf><a href=\"é日.pdf\">", "", "no tags at all", "<", "<a", "<a ", "<1a href=x>", "<a\x00href=x.pdf>", "<a =x href=y.pdf>", "<a 'x' href=y.pdf>",
]


class Seen(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, attrs))


def seen(page):
    parser = Seen()
    parser.feed(page)
    parser.close()
    return parser.found


def ours(rows):
    return [(t.tag, [(a.name, a.value) for a in t.attributes]) for t in rows]


def test_odd_snippets(spark):
    found = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, html string").select("i", tags.start_tags(F.col("html")).alias("t")).orderBy("i").collect()
    assert [(ODD[r.i], ours(r.t)) for r in found] == [(x, seen(x)) for x in ODD]


def test_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").where("html is not null")
    found = pages.select("html", tags.start_tags(F.col("html")).alias("t")).collect()
    assert len(found) > 200 and all(ours(r.t) == seen(r.html) for r in found)


def test_references(spark):
    texts = ["&" + n for n in html.entities.html5][::7] + ["&#%d;" % n for n in (*range(0, 300), 0xFDD0, 0xFFFF, 0x1F600, 0x10FFFF, 0x110000)] + ["&#x1f600", "&#X41g", "&amp;lt;", "&&amp", "a&b", "&ampersand", "&#;", "&#x;", "& x"]
    found = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").select("i", tags.unescape(F.col("t")).alias("u")).orderBy("i").collect()
    assert [(texts[r.i], r.u) for r in found] == [(t, html.unescape(t)) for t in texts]


def test_long_pages_take_linear_time(spark):
    big = ["<a " + "x " * 100_000 + ">", "<a href='" + "x" * 300_000, "<" * 300_000, "<!--" * 50_000, "<a " + "/" * 200_000, "<script>" * 30_000, "&" * 300_000, "<a href=" + "&amp;" * 20_000 + ">", " " * 300_000, "<a" + " " * 300_000, "<a href" + " =" * 100_000]
    found = spark.createDataFrame([(x,) for x in big], "html string").select(F.size(tags.start_tags(F.col("html"))).alias("n")).collect()
    assert len(found) == len(big)


@pytest.mark.parametrize("suffix", [".pdf", ""])
def test_links(spark, suffix):
    pages = spark.createDataFrame([(1, "http://h/a/b.html", "<a href=x.pdf><A HREF='../y.pdf'>"), (2, "http://h/", "<a href='/z.pdf?x'><a href=''><a href=q&amp;r.pdf><img src=i.pdf>"), (3, "http://h/", None)], "page_id int, url string, html string")
    found = {(r.page_id, r.href, r.target) for r in readers.links(pages, suffix).collect()}
    every = {(1, "x.pdf", "http://h/a/x.pdf"), (1, "../y.pdf", "http://h/y.pdf"), (2, "/z.pdf?x", "http://h/z.pdf?x"), (2, "q&r.pdf", "http://h/q&r.pdf")}
    assert found == {x for x in every if x[1].endswith(suffix)}
