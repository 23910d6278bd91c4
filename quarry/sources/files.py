"""File sources and sinks (inventory IO1-IO13, IO18-IO22).

Readers return DataFrames with explicit schemas; writers use Spark's writers
(one file set per table, written by the executors, never collected).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.relational import global_rank
from quarry.session import cut_lineage


def read_labelled_matrix(spark: SparkSession, path: str, long: bool = True) -> DataFrame:
    """IO2: tab file, header = column names, first column = row name, the
    rest numbers.  Long form (row, col, value) by default, else (row, vec)."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    cols = df.columns[1:]
    if long:
        # numbered inside, so that a header may hold any character
        wide = df.toDF("row", *[str(i) for i in range(len(cols))])
        tall = wide.unpivot("row", [str(i) for i in range(len(cols))], "at", "value")
        header = F.array(*[F.lit(c) for c in cols])
        return tall.select("row", F.get(header, F.col("at").cast("int")).alias("col"), F.col("value").cast("double").alias("value"))
    wide = df.toDF("row", *[str(i) for i in range(len(cols))])
    return wide.select("row", F.array(*[F.col(str(i)).cast("double") for i in range(len(cols))]).alias("vec"))


def write_count_matrix(counts: DataFrame, row: str, col: str, value: str, columns: list[str], path: str,
                       first_header: str = "Blog") -> None:
    """IO3 / IO4: dense tab matrix of the chosen columns, 0 where missing."""
    wide = counts.groupBy(row).pivot(col, columns).agg(F.sum(value)).na.fill(0)
    wide.withColumnRenamed(row, first_header).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


TILE = 1000


def write_ownership_matrix(owned: DataFrame, item: str, user: str, path: str, tile: int = TILE, first_header: str = "Item") -> None:
    """IO4: the dense 0/1 tab matrix of items by all users of ``owned``, as
    tiles of at most ``tile`` items and ``tile`` users: a folder per tile with a
    tab file whose header names its users. Rows and columns are in order of
    their names, so tiles set side by side are the whole matrix, but no row or
    task grows with the users. Tabs and line ends in names become spaces."""
    clean = lambda c: F.regexp_replace(F.col(c).cast("string"), "[\t\r\n]", " ")
    pairs = cut_lineage(owned.select(clean(item).alias("i"), clean(user).alias("u")).where("i IS NOT NULL AND u IS NOT NULL").distinct())
    numbered = lambda c: global_rank(pairs.select(c).distinct(), [c]).withColumn("rank", F.col("rank") - 1)
    items = numbered("i").select("i", F.expr(f"rank div {tile}").alias("row_tile"), (F.col("rank") % tile).alias("place"))
    users = numbered("u").select("u", F.expr(f"rank div {tile}").alias("col_tile"), (F.col("rank") % tile).cast("int").alias("at"))
    heads = users.groupBy("col_tile").agg(F.array_sort(F.collect_list(F.struct("at", "u"))).alias("us"))
    heads = heads.select("col_tile", F.col("us.u").alias("us"))
    cells = (pairs.join(users, "u").groupBy("i", "col_tile").agg(F.collect_list("at").alias("owns")))
    # every item stands in every column tile, owned there or not
    n_tiles = heads.count()
    frame = items.withColumn("col_tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1)).cast("array<bigint>"))) if n_tiles else items.withColumn("col_tile", F.lit(0)).limit(0)
    width = heads.select("col_tile", F.size("us").alias("width"))
    owns = F.coalesce("owns", F.array().cast("array<int>"))
    bits = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda k: F.array_contains(owns, k).cast("int").cast("string"))
    lines = (frame.join(width, "col_tile").join(cells, ["i", "col_tile"], "left")
             .select("row_tile", "col_tile", "place", F.concat_ws("\t", F.col("i"), bits).alias("value")))
    tops = (items.select("row_tile").distinct().withColumn("col_tile", F.explode(F.sequence(F.lit(0), F.lit(max(n_tiles, 1) - 1)).cast("array<bigint>")))
            .join(heads, "col_tile").select("row_tile", "col_tile", F.lit(-1).cast("long").alias("place"), F.concat_ws("\t", F.lit(first_header), "us").alias("value")))
    (tops.unionByName(lines).repartition("row_tile", "col_tile").sortWithinPartitions("row_tile", "col_tile", "place")
     .select("row_tile", "col_tile", "value").write.mode("overwrite").partitionBy("row_tile", "col_tile").text(path))


def read_ownership_matrix(spark: SparkSession, path: str) -> DataFrame:
    """The cells (row, col, value) of a matrix that ``write_ownership_matrix``
    wrote; the first line of each tile names its columns."""
    lines = spark.read.text(path)
    if "row_tile" not in lines.columns:  # a matrix without cells has no tile
        return spark.createDataFrame([], "row string, col string, value int")
    lines = (lines.select("*", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")))
    tile = Window.partitionBy("row_tile", "col_tile").orderBy("block", "seq")  # a tile has a bounded number of lines
    lines = lines.select("value", F.first("value").over(tile).alias("top"), F.row_number().over(tile).alias("n")).where("n > 1")
    cell, name = F.split("value", "\t"), F.split("top", "\t")
    rows = lines.select(cell.alias("cell"), F.col("top")).select(F.get("cell", F.lit(0)).alias("row"), "cell", name.alias("name"))
    tail = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    return (rows.select("row", F.explode(F.arrays_zip(tail("name").alias("col"), tail("cell").alias("value"))).alias("c"))
            .select("row", F.col("c.col").alias("col"), F.col("c.value").cast("int").alias("value")))


def read_ratings(spark: SparkSession, items: str, data: str) -> DataFrame:
    """IO1: (user_id, item, rating, ts): a ``|`` item file (number and title
    are its first two fields) joined with a tab file of user, item, rating and
    time.  Items of one title stay apart in the rows (Q1)."""
    titles = (spark.read.schema("item_no string, item string").option("sep", "|").option("enforceSchema", True)
              .option("mode", "PERMISSIVE").csv(items))
    ratings = spark.read.schema("user_id string, item_no string, rating double, ts long").option("sep", "\t").csv(data)
    return ratings.join(titles, "item_no").select("user_id", "item", "rating", "ts")


def mails_to_mbox(spark: SparkSession, folder: str) -> DataFrame:
    """IO13: (path, value): the messages of every folder named inbox below
    ``folder`` as mbox records: a separator line of sender and date, then the
    message.  ``value`` is ready for a text writer."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    m = files.where(F.col("path").rlike("/inbox/[^/]*$")).select("path", F.decode("content", "UTF-8").alias("m"))
    m = m.withColumn("m", F.regexp_replace("m", "\r\n", "\n"))
    sender = F.regexp_extract("m", r"(?m)^From:\s*(?:[^<\n]*<)?([^>\s]+)", 1)
    date = T.mail_date(F.regexp_extract("m", r"(?m)^Date:\s*(.*)$", 1))
    line = F.concat(F.lit("From "), sender, F.lit(" "), F.date_format(date, "EEE MMM dd HH:mm:ss yyyy"), F.lit("\n"))
    return m.select("path", F.concat(line, F.col("m"), F.lit("\n")).alias("value")).where("value IS NOT NULL")


def read_labelled_csv(spark: SparkSession, path: str, n_features: int, all_numeric: bool = True) -> DataFrame:
    """IO5: comma rows, last column an int label; (data array, match)."""
    cols = [f"c{i}" for i in range(n_features)]
    ftype = "double" if all_numeric else "string"
    schema = ", ".join(f"{c} {ftype}" for c in cols) + ", match int"
    df = spark.read.schema(schema).csv(path)
    return df.select(F.array(*cols).alias("data"), "match")


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """IO6: UTF-16, tab separated, header row; no record is skipped (Q2)."""
    return (spark.read.option("encoding", "UTF-16").option("multiLine", True)
            .option("sep", "\t").option("header", True).csv(path))


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    """IO7: origin,dest,depart,arrive,price rows; the leg number is the
    position within its (origin, dest) route in file order, the files of a
    folder by name."""
    df = spark.read.schema("origin string, dest string, depart string, arrive string, price int").csv(path)
    place = ["_file", "_block", "_seq"]
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_seq"))
    w = Window.partitionBy("origin", "dest").orderBy(*place)
    return df.withColumn("leg", F.row_number().over(w) - 1).drop(*place)


def read_json_documents(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """IO8: one JSON array (or object) per file."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema is not None else r).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """IO9: JSON lines, written by the executors."""
    df.write.mode("overwrite").json(path)


def save_documents(df: DataFrame, path: str) -> None:
    """IO10 save: append to a parquet document table."""
    df.write.mode("append").parquet(path)


def load_documents(spark: SparkSession, path: str, criteria=None, projection: list[str] | None = None) -> DataFrame:
    """IO10 load: filter and projection reach the parquet scan."""
    df = spark.read.parquet(path)
    if criteria is not None:
        df = df.where(criteria)
    return df.select(*projection) if projection else df


HEADER_NAMES = ["From", "To", "Cc", "Bcc", "Subject", "Date", "Content-Type"]


def read_mbox(spark: SparkSession, path: str) -> DataFrame:
    """IO11 / IO12: one row per message of an mbox file.

    A message starts at a line ``From <sender> <weekday> <month> <day> <time>
    <year>``; any other line that begins with ``From`` is text.  Records are cut at ``\\nFrom `` and those that start no
    message are joined to the message before them, within their file.  A file is
    read in byte ranges; its messages are numbered range by range, so no task
    holds more than a range, and a table of one row per range says which message
    an earlier range leaves open.  Header
    fields come from the header block (up to the first blank line); a field
    given several times keeps all its values, joined by a comma.  To/Cc/Bcc
    become arrays (F21); the date is parsed with its offset into UTC (Q3 fix).
    A multipart body keeps its first text part."""
    raw = (spark.read.option("lineSep", "\nFrom ").text(path)
           .select(F.col("value").alias("m"), F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")))
    dated = r"^(?:From )?\S+ +(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) +[A-Z][a-z]{2} +\d{1,2} +\d{1,2}:\d\d(?::\d\d)? .*\d{4}\s*(?:\n|$)"
    starts = F.when(F.col("m").rlike(dated), 1).otherwise(0)
    # (block, n): the n-th message that starts in a byte range; what stands before
    # the first start of a range belongs to the last start of an earlier range
    within = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = raw.groupBy("file", "block").agg(F.sum(starts).alias("n"))
    left = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(earlier)
    ranges = ranges.select("file", F.col("block").alias("at"), left.alias("open"))
    raw = raw.withColumn("n", F.sum(starts).over(within)).join(
        ranges.withColumnRenamed("file", "of"), (F.col("file") == F.col("of")) & (F.col("block") == F.col("at")))
    raw = raw.withColumn("key", F.when(F.col("n") > 0, F.struct("block", "n")).otherwise(F.col("open")))
    piece = F.struct("block", "seq", "m")
    msg = raw.where("key IS NOT NULL").groupBy("file", "key").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["m"]), "\nFrom ")
    msg = msg.select(F.regexp_replace(F.regexp_replace(text, r"^From ", ""), "\r\n", "\n").alias("m"))
    msg = msg.select(F.regexp_extract("m", r"(?s)^.*?\n(.*?)(?:\n\n|$)", 1).alias("head"),
                     F.regexp_extract("m", r"(?s)^.*?\n\n(.*)$", 1).alias("body"))
    cols = []
    for h in HEADER_NAMES:
        val = F.array_join(F.regexp_extract_all("head", F.lit(rf"(?mi)^{h}:[ \t]*(.*(?:\n[ \t]+.*)*)"), 1), ",")
        cols.append(F.when(val != "", val).alias(h.replace("-", "_")))
    out = msg.select(*cols, "body")
    for h in ("To", "Cc", "Bcc"):
        out = out.withColumn(h, F.when(F.col(h).isNotNull(), T.recipients(F.col(h))))
    mark = F.concat(F.lit("--"), F.regexp_extract("Content_Type", r'(?i)boundary="?([^";\s]+)', 1))
    part = F.get(F.filter(F.split(F.col("body"), F.concat(F.lit("\\Q"), mark, F.lit("\\E"))),
                          lambda x: x.rlike(r"(?is)^\s*content-type:\s*text/")), F.lit(0))
    first = F.regexp_extract(part, r"(?s)^\s*.*?\n\n(.*)$", 1)
    body = F.when(F.col("Content_Type").rlike("(?i)multipart/") & part.isNotNull(), first).otherwise(F.col("body"))
    return out.withColumns({"body": body, "Date": T.mail_date(F.col("Date"))})


def save_table(df: DataFrame, path: str) -> None:
    """IO18 / IO22: model or graph state as parquet."""
    df.write.mode("overwrite").parquet(path)


def hierarchy_json(groups: DataFrame, label: str, member: str, width: int = 30, chunk: int = 1000) -> DataFrame:
    """IO20: JSON objects {name, children: [{name}]}, the label cut to
    ``width`` characters, groups with equal labels merged.  A group of more
    than ``chunk`` members is several objects of its name (``part`` 0, 1, ...),
    so that a row stays bounded."""
    g = groups.select(F.substring(label, 1, width).alias("name"), F.col(member).alias("child")).distinct()
    place = F.row_number().over(Window.partitionBy("name").orderBy("child")) - 1
    g = g.withColumn("part", F.floor(place / chunk).cast("int"))
    agg = g.groupBy("name", "part").agg(F.array_sort(F.collect_list(F.struct(F.col("child").alias("name")))).alias("children"))
    return agg.select("name", "part", F.to_json(F.struct("name", "children")).alias("json"))
