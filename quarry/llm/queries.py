"""One thin query per operator over the tables of a data folder.

Each applies its operator with production parameters to the whole table;
``oracle_sql`` holds DuckDB SQL where SQL can state the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    chat,
    decontaminate,
    divergence,
    html_extract,
    kneser_ney,
    license_scan,
    line_dedup,
    packing,
    quality_rules,
    resample,
    simhash,
    url_filter,
    warc,
)
from quarry.llm.common import scratch_path, table

WINDOW = 2048
END_ID = 1
MIN_SITES = 10

# Fixed values of the contract.
URL_RULES = [url_filter.Rule.of(*x) for x in (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]

# Parts of host names whose pages make up the URL list of the query.
LISTED_HOSTS = "(adult|bets|casino|pills|spam|track)"


def tokenizer_path() -> str:
    """The public tokenizer of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item of any length, a row per pair;
    equal items are one."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_words=1, expand=False).drop("k1", "k2")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the rule table for every document."""
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.array_join("failed", ",").alias("failed"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed boilerplate lines, and what is left."""
    out = line_dedup.remove(table(spark, sf_dir, "documents"), MIN_SITES)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"), F.md5(F.col("text")).alias("text_md5"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page. Listed are the URLs of
    pages on hosts of ``LISTED_HOSTS``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.judge(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "listed", "verdict")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash.components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), WINDOW, END_ID)
    return packing.pack(cut, WINDOW).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    out = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "lang", "n_units", "perplexity", "threshold", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, as a row of a table
    of mixed sources; read back from its canonical, formatted form."""
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    sources = chat.as_sources(chat.conversations(rows))
    return chat.digests(chat.read_back(chat.formatted(chat.canonical(sources, ["conv_id"]))))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark's words."""
    out = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources and terms of sources by divergence, per language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_quality_rules, op3_line_dedup, op4_url_filter, op5_simhash, op6_packing,
                            op7_warc, op8_quality_classifier, op9_license_scan, op10_html_extract, op11_chat_format,
                            op12_resample, op13_source_divergence, pipeline)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def _op2_sql() -> str:
    every = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws}))
    measure = {"mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / n_words", "alpha_ratio": "n_alpha / n_words",
               "stop_ratio": "n_stop / n_words", "dup_line_ratio": "n_dup_lines / n_lines", "ellipsis_line_ratio": "n_ellipsis / n_lines",
               "bullet_line_ratio": "n_bullet / n_lines", "repeat_ratio": "n_repeat_words / n_words", "n_words": "n_words"}
    tests = []
    for r in quality_rules.RULES:
        m = f"coalesce({measure[r.measure]}, 0)"
        bad = " OR ".join([f"{m} < {r.low}"] * (r.low is not None) + [f"{m} > {r.high}"] * (r.high is not None))
        tests.append(f"CASE WHEN {bad} THEN '{r.name}' END")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (
  SELECT k, unnest(range(1, len(ws) - 1)) AS i, unnest(list_zip(ws[1:len(ws) - 2], ws[2:len(ws) - 1], ws[3:len(ws)])) AS g
  FROM w WHERE len(ws) >= 3),
r AS (
  SELECT k, count(DISTINCT p) AS n
  FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1)
  GROUP BY k),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(x) IN ({every}))) AS n_stop,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis,
         len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*•‣]'))) AS n_bullet
  FROM w LEFT JOIN r USING (k)),
v AS (
  SELECT *, list_filter([{", ".join(tests)}], lambda x: x IS NOT NULL) AS failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(failed) = 0 AS kept,
       coalesce(array_to_string(failed, ','), '') AS failed
FROM v"""


def _op3_sql() -> str:
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (
  SELECT k, doc_id, source, unnest(range(0, len(ls))) AS i, unnest(ls) AS line,
         unnest(list_transform(ls, lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))) AS key FROM d),
b AS (
  SELECT key, min(struct_pack(a := doc_id IS NULL, b := doc_id, c := i)) AS first
  FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= {MIN_SITES}),
f AS (
  SELECT l.*, b.key IS NOT NULL AND NOT (l.doc_id IS NOT DISTINCT FROM b.first.b AND l.i = b.first.c) AS cut
  FROM l LEFT JOIN b USING (key)),
x AS (
  SELECT k, count(*) FILTER (cut) AS n_removed, count(*) AS n_lines,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '') AS left_over FROM f GROUP BY k)
SELECT d.doc_id, coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_removed, 0) AS n_removed,
       length(x.left_over) AS n_chars_left, md5(x.left_over) AS text_md5
FROM d LEFT JOIN x USING (k)"""


def _op4_sql() -> str:
    cases = sorted(URL_RULES, key=lambda r: (-len(r.prefix), -len(r.host)))
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in cases]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r.prefix}'" for c, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{r.verdict}'" for c, r in fits) + " END"
    return rf"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
                     lambda x: NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref)=') AND x <> '') AS q
  FROM pages),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
           regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canon,
         {rule} AS rule, {verdict} AS by_rule
  FROM p),
b AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '{LISTED_HOSTS}') AND canon IS NOT NULL)
SELECT page_id, host, path, rule, b.canon IS NOT NULL AS listed,
       coalesce(by_rule, CASE WHEN b.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN b USING (canon)"""


def _op11_sql() -> str:
    def escaped(x: str) -> str:
        for opener, rests in chat.TEMPLATE.controls:
            x = rf"regexp_replace({x}, '({opener})(\\*)({rests})', '\1\\\2\3', 'g')"
        return x

    t = chat.TEMPLATE
    marks = len(t.start) + len(t.middle) + len(t.end)
    return rf"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x) AS turns,
         coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '') AS loss,
         string_agg(r, ',' ORDER BY turn NULLS FIRST, r, x) AS roles,
         sum({marks} + length({escaped("r")}) + length({escaped("x")}))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       CASE WHEN roles = 'user,assistant' THEN 'prompt-response' WHEN roles = 'system,user,assistant' THEN 'system-question'
            WHEN n_turns > 1 AND regexp_full_match(roles, 'system(,(user|assistant|system))*') THEN 'conversations' ELSE 'messages' END AS layout
FROM g"""


def _op13_sql() -> str:
    share = lambda n, total, v: f"1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + {v})"
    gap = lambda p, q: f"((({p}) - ({q})) * (({p}) - ({q}))) // ({q})"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT k) >= {divergence.MIN_DOCS}),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(any_value(total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN size USING (lang)
       LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
  GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, {share("coalesce(n, 0)", "total", "v")} AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lang, term, {share("sum(n)", "any_value(a)", "any_value(v)")} AS q
      FROM c JOIN (SELECT lang, any_value(v) AS v, sum(total) AS a FROM g GROUP BY lang) USING (lang) GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum({gap("a.p", "b.p")}) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, {gap("p", "q")} FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _op2_sql(), "op3_line_dedup": _op3_sql(), "op4_url_filter": _op4_sql(),
            "op11_chat_format": _op11_sql(), "op13_source_divergence": _op13_sql()}
