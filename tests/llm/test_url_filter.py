from quarry.llm import bloom
from quarry.llm import url_filter as U
from quarry.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, rule string"


def test_rules_and_list(spark):
    urls = {1: ("http://a.com/x", "com/", "allow"), 2: ("http://EXAMPLE.com/en/x", "example.com/en/", "block"),
            3: ("https://www.example.com/en/x?q#f", "www.example.com/en/", "allow"), 4: ("http://m.example.com/en/", "example.com/en/", "block"),
            5: ("http://x.net/fr/1", "net/fr/", "block"), 6: ("http://xnet/fr/1", None, "allow"), 7: ("http://a.com", None, "allow"),
            8: ("http://bad.org/p/?utm_source=x", None, "block"), 9: ("https://www.bad.org:443/p?a=1", None, "allow"),
            10: (None, None, "allow"), 11: ("no scheme bad.org/p", None, "allow"), 12: ("", None, "allow"),
            13: ("http://bad.org/q?b=2&gclid=7&c=3#z", None, "block"), 14: ("http://notexample.com/en/", "com/", "allow"),
            15: ("x://http://bad.org/p", None, "allow")}
    pages = spark.createDataFrame([(k, v[0], "clash", "clash") for k, v in urls.items()] + [(8, urls[8][0], "clash", "clash")], PAGES)
    listed = spark.createDataFrame([("https://www.bad.org/p",), ("http://bad.org/q?b=2&c=3",), (None,), ("junk",)], "url string")
    got = U.judge(pages, URL_RULES, listed).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r["rule"], r["verdict"]) == urls[r["page_id"]][1:], r
    by = {r["page_id"]: r for r in got}
    assert (by[2]["host"], by[2]["path"]) == ("example.com", "/en/x")
    assert (by[10]["host"], by[10]["path"]) == ("", "") and by[3]["path"] == "/en/x"


def test_empty_tables(spark):
    none = spark.createDataFrame([], PAGES)
    some = spark.createDataFrame([(1, "http://a.org/x", "", "")], PAGES)
    assert U.judge(none, URL_RULES, some.select("url")).count() == 0
    assert U.judge(some, URL_RULES, none.select("url")).first()["verdict"] == "allow"


def test_bloom_has_no_false_negative_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS k")
    f = bloom.build(keys, "k", 5000)
    assert bloom.probe(keys, "k", f, "hit").where("hit").count() == 5000
    others = spark.range(20000).selectExpr("concat('other', id) AS k")
    assert bloom.probe(others, "k", f, "hit").where("hit").count() < 400


def test_full_filter_still_gives_exact_verdicts(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 1)
    listed = spark.range(3000).selectExpr("concat('http://bad', id, '.org/') AS url")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('http://bad', id, '.org/') AS url")
    got = U.judge(pages, [], listed)
    assert got.where("verdict = 'block'").count() == 3000 and got.where("page_id >= 3000 AND listed").count() == 0


def test_filter_of_many_keys_keeps_its_share_of_false_positives(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 5)
    keys = spark.range(4000).selectExpr("concat('k', id) AS k")
    rows = spark.range(10000).selectExpr("IF(id < 4000, concat('k', id), concat('other', id)) AS key", "id").unionByName(
        spark.createDataFrame([(None, -1)], "key string, id long"))
    got = bloom.flagged(rows, "key", keys, "k", 4000, "hit").collect()
    assert sorted(r["id"] for r in got) == list(range(-1, 10000))
    assert all(r["hit"] for r in got if 0 <= r["id"] < 4000) and not any(r["hit"] for r in got if r["id"] < 0)
    assert sum(r["hit"] for r in got if r["id"] >= 4000) < 150
