"""Text functions against the standard library."""

import html
import quopri
import random

from pyspark.sql import functions as F

from quarry.functions import text as T

CASES = ["&amp;&lt;&gt;&quot;&apos;&nbsp;", "&notit; &notin; &not &nota", "&#65;&#x41;&#X41; &#128; &#x9F; &#0; &#xD800; &#x110000; &#99999999999999999999;", "&#13;&#1;&#11;&#127;&#xFDD0;&#xFFFE;&#9;",
         "&copy &copycat; &COPY; &Copy;", "&&amp;amp; & &; &# &#; &#x; &#xg;", "a&b=c&lt=d", "&CounterClockwiseContourIntegral; &NotEqualTilde; &fjlig;", "", None, "plain", "&AMP &ampx &ltx",
         "&#38;lt;", "&Aacute&aacute;", "\U0001F600 &#x1F600; &#128512;"]


def test_unescape_equals_the_standard_library(spark):
    rnd = random.Random(4)
    bits = ["&", "#", "x", "4", "amp", "lt", ";", " ", "not", "in", "1", "é", "copy", "A"]
    texts = CASES + ["".join(rnd.choice(bits) for _ in range(12)) for _ in range(400)] + ["".join(f"&{n}" for n in list(html.entities.html5)[::7])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", "t", T.html_unescape("t").alias("got")).collect():
        assert r["got"] == html.unescape(r["t"] or ""), r["t"]


def test_quoted_printable(spark):
    texts = ["café = olé \U0001F600", "x" * 200, "line\nother\nend", "", "a=b==c"]
    rows = [(t, quopri.encodestring(t.encode()).decode()) for t in texts]
    for r in spark.createDataFrame(rows, "want string, q string").select("want", T.quoted_printable("q").alias("got")).collect():
        assert r["got"] == r["want"]


def test_mail_body(spark):
    rows = [("<p>a =E2=82=AC &amp; b</p><br>c=\r\nd",), (None,)]
    got = [r["b"] for r in spark.createDataFrame(rows, "m string").select(T.mail_body("m").alias("b")).collect()]
    assert got[0].split() == ["a", "€", "&", "b", "cd"] and got[1] == ""


def test_mail_epoch(spark):
    rows = [("Mon, 1 Dec 2025 10:00:00 -0500", 1764601200000), ("1 Dec 2025 10:00 +0000 (UTC)", 1764583200000), ("nonsense", None)]
    for r in spark.createDataFrame(rows, "d string, want long").select("want", T.mail_epoch_ms("d").alias("got")).collect():
        assert r["got"] == r["want"]


def test_letters_only_of_odd_input(spark):
    got = spark.createDataFrame([("<p>Ab c</p>d",)], "t string").select(T.letter_words(F.col("t")).alias("w")).first()["w"]
    assert got == ["ab", "cd"]
