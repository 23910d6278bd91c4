"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "score"]
    assert df.count() >= 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def test_a_few_queries_run_on_smallest_scale(spark):
    qs = E.queries()
    for name in ["a3_year_month_counts", "rk3_pagerank", "x12_summaries", "b8_fisher_classify"]:
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0
