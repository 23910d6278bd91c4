"""Link resolution: cases worked out by hand from RFC 3986, section 5.4, and
awkward page URLs; anchors in every quoting."""

from quarry.operators import search as S
from pyspark.sql import functions as F

BASE = "http://a/b/c/d;p?q"
CASES = [("g:h", "g:h"), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"),
         ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q"), ("g#s", "http://a/b/c/g"), (";x", "http://a/b/c/;x"),
         ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"), ("./", "http://a/b/c/"), ("..", "http://a/b/"), ("../", "http://a/b/"),
         ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../g", "http://a/g"), ("../../../g", "http://a/g"), ("/./g", "http://a/g"),
         ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."), ("..g", "http://a/b/c/..g"), ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"),
         ("g/./h", "http://a/b/c/g/h"), ("g/../h", "http://a/b/c/h"), ("g;x=1/../y", "http://a/b/c/y"), ("g?y/../x", "http://a/b/c/g?y/../x"),
         ("mailto:x@y", "mailto:x@y"), (" g ", "http://a/b/c/g"), ("http://o.com", "http://o.com"), ("//o.com/x", "http://o.com/x")]
OTHER = [("http://h", "x.html", "http://h/x.html"), ("http://h?q", "x", "http://h/x"), ("http://h/a/b.html", "?q=1", "http://h/a/b.html?q=1"),
         ("http://h/a/b.html", "../c.html", "http://h/c.html"), ("http://h/a/b.html#f", "", "http://h/a/b.html")]


def test_resolve(spark):
    rows = [(BASE, r, w) for r, w in CASES] + OTHER
    got = spark.createDataFrame(rows, "base string, ref string, want string").withColumn("got", S.resolve_url(F.col("base"), F.col("ref")))
    assert [(r["ref"], r["got"]) for r in got.collect()] == [(r, w) for _, r, w in rows]


def test_anchors_in_every_quoting(spark):
    html = """<a href="/d">one</a> <A class=x href='/s'>two</A> <a href=/u>three</a><a href = "/sp" >four</a> <a name="n">no</a> <a href="">self</a>"""
    link, words = S.page_links(spark.createDataFrame([("http://h/p", html)], "url string, html string"))
    assert sorted(r["toid"] for r in link.collect()) == ["http://h/d", "http://h/s", "http://h/sp", "http://h/u"]
    assert sorted(r["word"] for r in words.collect()) == ["four", "one", "three", "two"]


def test_match_rows_beyond_any_integer(spark):
    texts = [(1, "a1 b1 c1 d1 e1 f1 " * 4000), (2, "a1 b1 c1 d1 e1 f1 " * 8000)]
    wl = S.word_locations(spark.createDataFrame(texts, "id int, text string"), "id", F.col("text"), only=["a1", "b1", "c1", "d1", "e1", "f1"])
    s = S.match_summary(wl, ["a1", "b1", "c1", "d1", "e1", "f1"])
    got = {r["urlid"]: r["score"] for r in S.frequency_score(s).collect()}
    assert got[2] == 1.0 and abs(got[1] - 2 ** -6) < 1e-9
