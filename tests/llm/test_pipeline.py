"""The pipeline and the registered queries on the smallest data folder."""

import corpus_pipeline as C
from quarry.llm.queries import oracle_sql, queries
from quarry.llm import decontaminate, kneser_ney, line_dedup, simhash
from quarry.llm.common import table

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = list(queries())
    assert [n for n in names if n != "pipeline"] == sorted((n for n in names if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0]))
    assert len(names) == 14 and set(oracle_sql()) <= set(names)


def test_stages_do_what_their_operators_find(spark):
    docs = table(spark, SF, "documents").cache()
    n = docs.count()
    kept = C.quality(spark, docs, SF).cache()
    judged = kneser_ney.classify(docs, table(spark, SF, "labels"))
    assert kept.columns == list(C.COLUMNS) and kept.count() == judged.where("kept").count() <= n
    cut = C.lines(spark, kept, SF).cache()
    removed = line_dedup.remove(kept, C.MIN_SITES)
    assert cut.count() == removed.where("n_removed = 0 OR text RLIKE '[^ \\t\\n]'").count()
    one = C.near_duplicates(spark, cut, SF).cache()
    assert one.count() == simhash.components(cut).select("component_id").distinct().count()
    clean = C.contamination(spark, one, SF).cache()
    leaks = {r["doc_id"] for r in decontaminate.matches(one, table(spark, SF, "benchmark")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect()} - leaks
    packed = C.sequences(spark, clean, SF)
    assert packed.select("doc_id").distinct().count() == clean.count()


def test_run_and_awkward_documents(spark, docs_of, awkward, tmp_path):
    for t in ("labels", "benchmark"):
        table(spark, SF, t).write.parquet(f"{tmp_path}/{t}.parquet")
    docs_of(awkward, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    out = C.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} >= {4, 5, 7, 8}
    empty = tmp_path / "empty"
    for t in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").where("false").write.parquet(f"{empty}/{t}.parquet")
    assert C.run(spark, str(empty)).count() == 0
