"""Search index and ranking (inventory RK1-RK14, J1, J2, W1, W2, F8, F36).

The index is a long table ``wordlocation(urlid, word, location)``; links are
``link(linkid, fromid, toid)`` and ``linkwords(linkid, word)``.  Ids are the
natural keys (url strings or document ids) rather than counters, so indexing
needs no sequential id service.

Scoring never materialises the per-url combinations of query-word
positions (the reference's match rows, J1): the frequency score is the
product of per-word counts (a sum of logarithms), the location score the sum of per-word minimum
positions, and the distance score a dynamic programme over consecutive
query words evaluated with window functions.  ``match_rows`` still builds the
literal combination table for callers that want it on small inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.session import cut_lineage

VSMALL = 0.00001
# href in double quotes, single quotes or none, with or without space around "="
ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""


# ---- index (RK1, RK2) ------------------------------------------------------------

def word_locations(docs: DataFrame, key: str, text: Column, only: list[str] | None = None) -> DataFrame:
    """RK1: (urlid, word, location); ignored words are dropped but still
    advance the location (W1).  With ``only``, the rows of these words alone:
    they are picked inside the text's array, so no other word leaves it."""
    stop = F.array(*[F.lit(w) for w in T.INDEX_STOP_WORDS])
    if only is not None:
        places = F.transform(T.words(text), lambda w, i: F.struct(w.alias("word"), i.alias("location")))
        t = docs.select(F.col(key).alias("urlid"), F.explode(F.filter(places, lambda p: p["word"].isin(only))).alias("p"))
        t = t.select("urlid", "p.location", "p.word")
    else:
        t = docs.select(F.col(key).alias("urlid"), F.posexplode(T.words(text)).alias("location", "word"))
    return t.where(~F.array_contains(stop, F.col("word"))).select("urlid", "word", "location")


def _url_parts(u: Column) -> dict[str, Column]:
    """Scheme, authority, path and query of a URI reference (RFC 3986, appendix
    B); scheme, authority and query are null where they are not given."""
    parts = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
    given = {"scheme": r"(?s)^[a-zA-Z][a-zA-Z0-9+.-]*:", "authority": r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//",
             "query": r"(?s)^[^#?]*\?"}
    out = {}
    for i, name in enumerate(("scheme", "authority", "path", "query"), 1):
        part = F.regexp_extract(u, parts, i)
        out[name] = F.when(u.rlike(given[name]), part) if name in given else part
    return out


def _remove_dots(path: Column) -> Column:
    """``.`` and ``..`` segments resolved (RFC 3986, 5.2.4)."""
    segments = F.split(path, "/")
    none = F.array().cast("array<string>")

    def step(kept, s):
        # the empty segment before the first slash stays
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(
            F.when(F.get(kept, F.lit(0)) == "", kept).otherwise(none))
        return F.when(s == ".", kept).when(s == "..", up).otherwise(F.concat(kept, F.array(s)))

    kept = F.aggregate(segments, none, step)
    last = F.element_at(segments, -1)
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def resolve_url(base: Column, href: Column) -> Column:
    """a link joined with its page's URL by the rules of RFC 3986, 5.2,
    without the fragment."""
    b, r = _url_parts(base), _url_parts(F.trim(href))
    directory = F.regexp_extract(b["path"], r"(?s)^(.*/)", 1)
    merged = F.when(b["authority"].isNotNull() & (b["path"] == ""), F.concat(F.lit("/"), r["path"])).otherwise(
        F.concat(directory, r["path"]))
    dotted = F.when(r["path"].startswith("/"), r["path"]).otherwise(merged)
    own = r["scheme"].isNotNull() | r["authority"].isNotNull()
    empty = r["path"] == ""
    path = F.when(own, F.when(r["path"].startswith("/"), _remove_dots(r["path"])).otherwise(r["path"])).when(
        empty, b["path"]).otherwise(_remove_dots(dotted))
    query = F.when(own | ~empty | r["query"].isNotNull(), r["query"]).otherwise(b["query"])
    scheme = F.when(r["scheme"].isNotNull(), r["scheme"]).otherwise(b["scheme"])
    authority = F.when(own, r["authority"]).otherwise(b["authority"])
    blank = F.lit("")
    return F.concat(F.coalesce(F.concat(scheme, F.lit(":")), blank), F.coalesce(F.concat(F.lit("//"), authority), blank),
                    path, F.coalesce(F.concat(F.lit("?"), query), blank))


def page_links(pages: DataFrame, key: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """RK2: links of stored pages and the words of their anchor text.

    Returns ``link(linkid, fromid, toid)`` without self-links (duplicates
    kept) and ``linkwords(linkid, word)`` without ignored words.  Links whose
    resolved URL holds a quote are skipped."""
    groups = [F.regexp_extract_all(html, F.lit(ANCHOR), i).alias(f"g{i}") for i in (1, 2, 3, 4)]
    a = pages.select(F.col(key).alias("fromid"), *groups)
    a = a.select("fromid", F.posexplode(F.arrays_zip("g1", "g2", "g3", "g4")).alias("seq", "g"))
    href = F.concat(*[F.coalesce(F.col(f"g.g{i}"), F.lit("")) for i in (1, 2, 3)])
    a = a.select("fromid", "seq", href.alias("href"), F.col("g.g4").alias("anchor"))
    a = a.select("fromid", "seq", resolve_url(F.col("fromid"), F.col("href")).alias("toid"), "anchor")
    a = a.where(~F.col("toid").contains("'") & (F.col("toid") != F.col("fromid")))
    a = a.withColumn("linkid", F.concat_ws("#", F.col("fromid"), F.col("seq").cast("string")))
    link = a.select("linkid", "fromid", "toid")
    stop = F.array(*[F.lit(w) for w in T.INDEX_STOP_WORDS])
    lw = (a.select("linkid", F.explode(T.words(T.visible_text(F.col("anchor")))).alias("word"))
          .where(~F.array_contains(stop, F.col("word"))))
    return link, lw


def url_list(link: DataFrame, pages_ids: DataFrame | None = None) -> DataFrame:
    """Every url seen: link ends plus indexed pages."""
    u = link.select(F.col("fromid").alias("urlid")).union(link.select("toid"))
    if pages_ids is not None:
        u = u.union(pages_ids.select("urlid"))
    return u.distinct()


# ---- match rows (J1, RK4) -----------------------------------------------------------

def query_words(q: str) -> list[str]:
    """Query words split on spaces and lower-cased (Q7 fix)."""
    return [w.lower() for w in q.split(" ") if w]


def query_positions(wl: DataFrame, words: list[str]) -> tuple[DataFrame, int]:
    """(urlid, qi, location) of the query words present in the index, for
    urls that hold every present word.  Unknown words are dropped (Q7); the
    second value is the number of words kept."""
    spark = wl.sparkSession
    empty = spark.createDataFrame([], "urlid " + wl.schema["urlid"].dataType.simpleString() + ", qi int, location int")
    if not words:
        return empty, 0
    hits = cut_lineage(wl.where(F.col("word").isin(words)).select("urlid", "word", "location"))
    present = {r.word for r in hits.select("word").distinct().collect()}
    kept = [w for w in words if w in present]
    if not kept:
        return empty, 0
    # a word asked for twice stands for two query positions
    at = F.filter(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for i, w in enumerate(kept)]),
                  lambda x: x["w"] == F.col("word"))
    qp = hits.select("urlid", F.explode(at).alias("q"), "location").select("urlid", F.col("q.i").alias("qi"), "location")
    full = (qp.groupBy("urlid").agg(F.countDistinct("qi").alias("_k"))
            .where(F.col("_k") == len(kept)).select("urlid"))
    return qp.join(full, "urlid", "left_semi"), len(kept)


def match_rows(wl: DataFrame, words: list[str]) -> DataFrame:
    """One row per combination of query-word positions in a url
    (urlid, loc0, loc1, ...).  Its size is the product of the per-word counts,
    so scoring uses ``match_summary`` instead."""
    qp, k = query_positions(wl, words)
    parts = [qp.where(F.col("qi") == i).select("urlid", F.col("location").alias(f"loc{i}")) for i in range(k)]
    return reduce(lambda a, b: a.join(b, "urlid"), parts)


def match_summary(wl: DataFrame, words: list[str]) -> DataFrame:
    """RK4 / RK6-RK8 raw values per url: the logarithm of the number of match
    rows (the number itself outgrows every type on long texts), best position
    sum and best word distance, without building the rows."""
    qp, k = query_positions(wl, words)
    per = qp.groupBy("urlid", "qi").agg(F.count(F.lit(1)).alias("c"), F.min("location").alias("m"))
    s = per.groupBy("urlid").agg(F.sum(F.log("c")).alias("log_rows"), F.sum("m").alias("loc_sum"))
    if k <= 1:
        out = s.withColumn("min_dist", F.lit(None).cast("long"))
    else:
        out = s.join(min_distance(qp, k), "urlid")
    return cut_lineage(out)   # a row per matching url, read by several score normalisations


def min_distance(qp: DataFrame, k: int) -> DataFrame:
    """W2 / RK8: per url, the smallest sum of |l_i - l_(i-1)| over all
    choices of one position per query word.

    dp_0(p) = 0; dp_i(q) = min_p dp_(i-1)(p) + |q - p|, evaluated by two
    running minima over the url's positions in order (p <= q and p >= q), so
    each step is linear in the url's positions."""
    dp = qp.where(F.col("qi") == 0).select("urlid", F.col("location").alias("pos"), F.lit(0).cast("long").alias("dp"))
    for i in range(1, k):
        cur = qp.where(F.col("qi") == i).select("urlid", F.col("location").alias("pos"))
        u = (dp.select("urlid", "pos", "dp", F.lit(0).alias("kind"))
             .unionByName(cur.select("urlid", "pos", F.lit(None).cast("long").alias("dp"), F.lit(1).alias("kind"))))
        w = Window.partitionBy("urlid").orderBy("pos")
        left = F.min(F.when(F.col("kind") == 0, F.col("dp") - F.col("pos"))).over(
            w.rangeBetween(Window.unboundedPreceding, 0))
        right = F.min(F.when(F.col("kind") == 0, F.col("dp") + F.col("pos"))).over(
            w.rangeBetween(0, Window.unboundedFollowing))
        dp = (u.withColumn("l", left + F.col("pos")).withColumn("r", right - F.col("pos"))
              .where(F.col("kind") == 1)
              .select("urlid", "pos", F.least(F.col("l"), F.col("r")).alias("dp")))
    return dp.groupBy("urlid").agg(F.min("dp").alias("min_dist"))


# ---- scores (RK5-RK12) ----------------------------------------------------------

def _scalar(df: DataFrame, agg: Column):
    """One aggregate value fetched to the driver (a single number)."""
    return df.agg(agg.alias("_v")).first()["_v"]


def normalize(df: DataFrame, col: str, small_is_better: bool = False) -> DataFrame:
    """RK5: max-normalise, or min / max(1e-5, x) when small is better.

    The extreme is one aggregate value computed first."""
    if small_is_better:
        lo = _scalar(df, F.min(col))
        val = F.lit(float(lo or 0)) / F.greatest(F.lit(VSMALL), F.col(col).cast("double"))
    else:
        hi = _scalar(df, F.max(col))
        val = F.col(col).cast("double") / F.lit(float(hi) if hi else VSMALL)
    return df.select("urlid", val.alias("score"))


def frequency_score(summary: DataFrame) -> DataFrame:
    """RK6: number of match rows, max-normalised, from its logarithm."""
    hi = _scalar(summary, F.max("log_rows"))
    return summary.select("urlid", F.exp(F.col("log_rows") - F.lit(float(hi or 0.0))).alias("score"))


def location_score(summary: DataFrame) -> DataFrame:
    """RK7: best position sum, small is better (Q32 kept)."""
    return normalize(summary, "loc_sum", small_is_better=True)


def distance_score(summary: DataFrame, k: int) -> DataFrame:
    """RK8: best word distance, small is better; 1.0 for one-word queries."""
    if k <= 1:
        return summary.select("urlid", F.lit(1.0).alias("score"))
    return normalize(summary, "min_dist", small_is_better=True)


def inbound_link_score(candidates: DataFrame, link: DataFrame) -> DataFrame:
    """RK9: links pointing at each candidate url (duplicates counted)."""
    c = link.groupBy(F.col("toid").alias("urlid")).agg(F.count(F.lit(1)).alias("n"))
    j = candidates.select("urlid").join(c, "urlid", "left").select("urlid", F.coalesce("n", F.lit(0)).alias("n"))
    return normalize(j, "n")


def pagerank(link: DataFrame, urls: DataFrame, rounds: int = 20, damping: float = 0.85,
             checkpoint_every: int = 5) -> DataFrame:
    """RK3: 0.15 + 0.85 * sum over distinct linkers of pr(linker) / out-links
    (out-links counted with duplicates), starting at 1.0.

    Each round uses the previous round's values (Q21).  The weighted edges are
    dealt out by their source once and kept so; a round is one join on that
    dealing and one aggregation by target, to which every node adds a zero, so
    that nodes without linkers need no join of their own.  Ranks never leave
    the executors; every few rounds, and at the end, they are written."""
    outdeg = link.groupBy(F.col("fromid").alias("src")).agg(F.count(F.lit(1)).alias("c"))
    w = (link.select(F.col("fromid").alias("src"), F.col("toid").alias("dst")).distinct()
         .join(outdeg, "src").select("src", "dst", (F.lit(1.0) / F.col("c")).alias("w")))
    edges = cut_lineage(w).repartition("src").persist()
    nodes = cut_lineage(urls.select(F.col("urlid").alias("id")))
    pr = nodes.select("id", F.lit(1.0).alias("score"))
    for i in range(rounds):
        given = edges.join(pr, edges["src"] == pr["id"]).select(F.col("dst").alias("id"), (F.col("score") * F.col("w")).alias("s"))
        own = nodes.select("id", F.lit(0.0).alias("s"))
        pr = (given.union(own).groupBy("id").agg(F.sum("s").alias("s"))
              .select("id", (F.lit(1.0 - damping) + F.lit(damping) * F.col("s")).alias("score")))
        if (i + 1) % checkpoint_every == 0 or i + 1 == rounds:
            pr = cut_lineage(pr)
    edges.unpersist()
    return pr.withColumnRenamed("id", "urlid")


def linktext_score(candidates: DataFrame, link: DataFrame, linkwords: DataFrame, pr: DataFrame,
                   words: list[str]) -> DataFrame:
    """RK10: for each query word, the PageRank of linkers whose link text
    holds it, summed per target; max-normalised (null when the max is 0)."""
    lw = linkwords.where(F.col("word").isin(words)).select("linkid", "word").distinct()
    hits = lw.join(link, "linkid").join(pr.withColumnRenamed("urlid", "fromid"), "fromid")
    s = hits.groupBy(F.col("toid").alias("urlid")).agg(F.sum("score").alias("s"))
    j = candidates.select("urlid").join(s, "urlid", "left").select("urlid", F.coalesce("s", F.lit(0.0)).alias("s"))
    hi = _scalar(j, F.max("s"))
    den = F.lit(float(hi)) if hi else F.lit(None).cast("double")
    return j.select("urlid", (F.col("s") / den).alias("score"))


def pagerank_score(candidates: DataFrame, pr: DataFrame) -> DataFrame:
    """RK11: PageRank of each candidate divided by the largest one."""
    j = candidates.select("urlid").join(pr, "urlid", "left").select("urlid", F.col("score").alias("p"))
    hi = _scalar(j, F.max("p"))
    return j.select("urlid", (F.col("p") / F.lit(hi)).alias("score"))


def weighted_total(weights: list[tuple[float, DataFrame]], n: int | None = 10) -> DataFrame:
    """RK12 + K3: sum of weight * score per url; the best ``n`` by (score,
    urlid) descending."""
    parts = [df.select("urlid", (F.lit(float(wt)) * F.col("score")).alias("s")) for wt, df in weights]
    total = reduce(lambda a, b: a.unionByName(b), parts).groupBy("urlid").agg(F.sum("s").alias("score"))
    out = total.orderBy(F.desc("score"), F.desc("urlid"))
    return out.limit(n) if n else out


# ---- click network (RK13, RK14) ---------------------------------------------------

def hidden_key(words: list) -> str:
    """Create key of a hidden node: sorted word ids joined by '_'."""
    return "_".join(sorted(str(w) for w in words))


def click_network(words: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RK13 start: one hidden node per word set of a query with at most three
    words; weights 1 / words from each word and 0.1 to each candidate url.
    ``words(query_id, word)``, ``urls(query_id, urlid)``; the edge tables are
    (fromid, toid, strength)."""
    keys = (words.distinct().groupBy("query_id").agg(F.array_sort(F.collect_list("word")).alias("ws"))
            .where(F.size("ws") <= 3).select("query_id", "ws", F.array_join("ws", "_").alias("hid")))
    wh = keys.select("hid", "ws").distinct().select(F.explode("ws").alias("fromid"), F.col("hid").alias("toid"),
                                                    (F.lit(1.0) / F.size("ws")).alias("strength"))
    hu = (keys.join(urls, "query_id").select(F.col("hid").alias("fromid"), F.col("urlid").alias("toid")).distinct()
          .withColumn("strength", F.lit(0.1)))
    return wh, hu


NO_WORD = -0.2          # strength of a missing word -> hidden edge; a missing hidden -> url edge has 0


def _activations(wordhidden: DataFrame, hiddenurl: DataFrame, words: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query_id, hid, ah) of the hidden nodes linked to a query's words or
    candidate urls, and (query_id, urlid, ao)."""
    wh = wordhidden.select(F.col("fromid").alias("word"), F.col("toid").alias("hid"), F.col("strength").alias("s"))
    hu = hiddenurl.select(F.col("fromid").alias("hid"), F.col("toid").alias("urlid"), F.col("strength").alias("s"))
    hid = (words.join(wh, "word").select("query_id", "hid")
           .union(urls.join(hu, "urlid").select("query_id", "hid")).distinct())
    nq = words.groupBy("query_id").agg(F.countDistinct("word").alias("nw"))
    have = (words.join(wh, "word").groupBy("query_id", "hid")
            .agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("m")))
    ah = (hid.join(nq, "query_id").join(have, ["query_id", "hid"], "left")
          .select("query_id", "hid", F.tanh(F.coalesce("s", F.lit(0.0)) +
                                            F.lit(NO_WORD) * (F.col("nw") - F.coalesce("m", F.lit(0)))).alias("ah")))
    out = (ah.join(hu, "hid").join(urls, ["query_id", "urlid"])
           .groupBy("query_id", "urlid").agg(F.sum(F.col("ah") * F.col("s")).alias("z")))
    ao = (urls.join(out, ["query_id", "urlid"], "left")
          .select("query_id", "urlid", F.tanh(F.coalesce("z", F.lit(0.0))).alias("ao")))
    return ah, ao


def train_clicks(wordhidden: DataFrame, hiddenurl: DataFrame, words: DataFrame, urls: DataFrame, clicks: DataFrame,
                 rate: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """RK13: one gradient step over a batch of clicks (query_id, urlid): the
    changes that the queries ask for are summed per edge (Q22), edges that a
    query lacked become explicit."""
    ah, ao = (cut_lineage(x) for x in _activations(wordhidden, hiddenurl, words, urls))
    wanted = clicks.select("query_id", "urlid").distinct().withColumn("t", F.lit(1.0))
    od = cut_lineage(ao.join(wanted, ["query_id", "urlid"], "left").select(
        "query_id", "urlid", ((F.lit(1.0) - F.col("ao") * F.col("ao")) * (F.coalesce("t", F.lit(0.0)) - F.col("ao"))).alias("od")))
    old_hu = hiddenurl.select(F.col("fromid").alias("hid"), F.col("toid").alias("urlid"), F.col("strength").alias("s"))
    pair = ah.join(od, "query_id").join(old_hu, ["hid", "urlid"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    pair = cut_lineage(pair)
    hd = (pair.groupBy("query_id", "hid").agg(F.sum(F.col("od") * F.col("s")).alias("e"), F.first("ah").alias("ah"))
          .select("query_id", "hid", ((F.lit(1.0) - F.col("ah") * F.col("ah")) * F.col("e")).alias("hd")))
    hu = pair.groupBy("hid", "urlid").agg((F.first("s") + F.lit(rate) * F.sum(F.col("od") * F.col("ah"))).alias("new"))
    change = words.distinct().join(hd, "query_id").groupBy("word", "hid").agg(F.sum("hd").alias("d"))
    old_wh = wordhidden.select(F.col("fromid").alias("word"), F.col("toid").alias("hid"), F.col("strength").alias("s"))
    wh = old_wh.join(change, ["word", "hid"], "full_outer").select(
        F.col("word").alias("fromid"), F.col("hid").alias("toid"),
        (F.coalesce("s", F.lit(NO_WORD)) + F.lit(rate) * F.coalesce("d", F.lit(0.0))).alias("strength"))
    left = old_hu.join(hu, ["hid", "urlid"], "full_outer").select(
        F.col("hid").alias("fromid"), F.col("urlid").alias("toid"), F.coalesce("new", "s").alias("strength"))
    return wh, left


def nn_scores(wordhidden: DataFrame, hiddenurl: DataFrame, words: DataFrame, urls: DataFrame) -> DataFrame:
    """RK14: output of the click network for every (query, url) pair.

    ``words(query_id, word)``, ``urls(query_id, urlid)``; edges are
    ``(fromid, toid, strength)``.  Hidden nodes are those linked to a query
    word or a candidate url; a missing word->hidden weight counts -0.2 and a
    missing hidden->url weight 0.  Output (query_id, urlid, score) with
    score = tanh(sum_j tanh(sum_i w_ij) * w_jk)."""
    return _activations(wordhidden, hiddenurl, words, urls)[1].withColumnRenamed("ao", "score")
