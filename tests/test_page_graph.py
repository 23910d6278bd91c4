"""The graph of pages as the ranking queries read it."""

from quarry.plans import q_search


def test_pages_are_searched_for_links_once(spark, tmp_path):
    """Every reading of the links searched the html again before."""
    rows = [(1, "http://a.org/x", '<a href="http://b.org/y">one two</a>'), (2, "http://b.org/y", '<a href="http://a.org/x">back</a>'), (3, "http://c.org/", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    link, _, urls = q_search._page_graph(spark, str(tmp_path))
    assert "regexp_extract_all" not in urls._jdf.queryExecution().executedPlan().toString()
    assert {(r["fromid"], r["toid"]) for r in link.collect()} == {("http://a.org/x", "http://b.org/y"), ("http://b.org/y", "http://a.org/x")}
    assert urls.count() == 3
