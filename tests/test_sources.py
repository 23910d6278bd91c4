"""File sources and sinks on small files written by the test."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.sources import files as IO

MBOX = """From santa@northpole.example Mon Dec  1 10:00:00 2025
From: Santa <santa@northpole.example>
To: elf1@northpole.example,
\telf2@northpole.example
Subject: Toys
Date: Mon, 1 Dec 2025 10:00:00 -0500

Please build more toys.
From: this line is part of the body
From rudolph@northpole.example Tue Dec  2 11:00:00 2025
From: Rudolph <rudolph@northpole.example>
To: santa@northpole.example
Subject: Re: Toys
Date: Tue, 2 Dec 2025 11:00:00 +0000

On it.
"""


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="quarry-test-")


def test_mbox(spark, tmp):
    p = os.path.join(tmp, "box.mbox")
    open(p, "w").write(MBOX)
    rows = IO.read_mbox(spark, p).orderBy("Date").collect()
    assert len(rows) == 2
    assert rows[0]["To"] == ["elf1@northpole.example", "elf2@northpole.example"]
    assert rows[0]["Subject"] == "Toys"
    assert "part of the body" in rows[0]["body"]
    assert rows[0]["Date"].hour == 15          # -0500 offset honoured, stored in UTC
    assert rows[1]["From"].startswith("Rudolph")


def test_labelled_matrix_and_writer(spark, tmp):
    p = os.path.join(tmp, "m.tsv")
    open(p, "w").write("Blog\tw1\tw2\nb1\t1\t0\nb2\t3\t4\n")
    long = {(r["row"], r["col"]): r["value"] for r in IO.read_labelled_matrix(spark, p).collect()}
    assert long[("b2", "w2")] == 4.0 and len(long) == 4
    counts = spark.createDataFrame([("b1", "x", 2), ("b2", "y", 1)], "doc string, word string, n long")
    out = os.path.join(tmp, "out")
    IO.write_count_matrix(counts, "doc", "word", "n", ["x", "y"], out)
    back = spark.read.option("sep", "\t").option("header", True).csv(out).orderBy("Blog").collect()
    assert [r["x"] for r in back] == ["2", "0"]


def test_contacts_utf16(spark, tmp):
    p = os.path.join(tmp, "c.csv")
    with open(p, "w", encoding="utf-16") as f:
        f.write("First Name\tCurrent Position\nAna\tSr. Engineer\nBo\tCEO / Founder\n")
    rows = IO.read_contacts(spark, p).collect()
    assert len(rows) == 2 and rows[1]["Current Position"] == "CEO / Founder"


def test_schedule_leg_order(spark, tmp):
    p = os.path.join(tmp, "s.txt")
    open(p, "w").write("LGA,OMA,6:19,8:13,239\nLGA,OMA,8:04,10:59,136\nMIA,OMA,6:25,9:30,335\n")
    rows = {(r["origin"], r["leg"]): r["price"] for r in IO.read_schedule(spark, p).collect()}
    assert rows[("LGA", 0)] == 239 and rows[("LGA", 1)] == 136 and rows[("MIA", 0)] == 335


def test_document_store_pushdown(spark, tmp):
    p = os.path.join(tmp, "docs")
    IO.save_documents(spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "id int, t string, rc int"), p)
    IO.save_documents(spark.createDataFrame([(3, "c", 9)], "id int, t string, rc int"), p)
    df = IO.load_documents(spark, p, F.col("rc") > 3, ["id"])
    assert sorted(r.id for r in df.collect()) == [1, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(rc,3)" in plan


def test_mbox_with_crlf_repeated_headers_and_parts(spark, tmp):
    """A body line that begins with From is text, also in a CRLF file."""
    text = ("From a@x Mon Dec  1 10:00:00 2025\nFrom: A <a@x>\nTo: b@x\nTo: c@x\nSubject: One\n\nbody\n\nFrom here on it is text\nFrom there too\n\n"
            "From b@x Tue Dec  2 10:00:00 2025\nFrom: B <b@x>\nSubject: Two\nContent-Type: multipart/alternative; boundary=\"xyz\"\n\n"
            "--xyz\nContent-Type: text/plain\n\nplain part\n--xyz\nContent-Type: text/html\n\n<p>html part</p>\n--xyz--\n")
    for name, data in (("lf", text), ("crlf", text.replace("\n", "\r\n"))):
        path = os.path.join(tmp, name)
        with open(path, "w", newline="") as f:
            f.write(data)
        rows = sorted(IO.read_mbox(spark, path).collect(), key=lambda r: r["Subject"])
        assert [r["Subject"] for r in rows] == ["One", "Two"]
        assert rows[0]["To"] == ["b@x", "c@x"]
        assert "From here on it is text\nFrom there too" in rows[0]["body"]
        assert rows[1]["body"].strip() == "plain part"


def test_headers_with_quotes_and_repeated_attributes(spark, tmp_path):
    from quarry.sources import files, xml

    path = tmp_path / "m.tsv"
    path.write_text("Blog\tdon't\ta`b\tx.y\nfirst\t1\t2\t\nsecond\t3\t4\t5\n")
    got = sorted((r["row"], r["col"], r["value"]) for r in files.read_labelled_matrix(spark, str(path)).collect())
    assert got == [("first", "a`b", 2.0), ("first", "don't", 1.0), ("first", "x.y", None),
                   ("second", "a`b", 4.0), ("second", "don't", 3.0), ("second", "x.y", 5.0)]
    text = ("<i><Attribute><id>1</id><value>2</value></Attribute><Attribute><id>1</id><value>9</value></Attribute>"
            "<Attribute><id>3</id><value>4.5</value></Attribute></i>")
    rows = spark.createDataFrame([(1, text), (2, "<i><Attribute><id>1</id><value>2</value></Attribute></i>")], "k long, xml string")
    assert [(r["k"], r["vec"]) for r in xml.attribute_vectors(rows, "k", "xml", ["3", "1"]).collect()] == [(1, [4.5, 2.0])]


def test_ownership_matrix_in_tiles(spark, tmp):
    owned = [(f"item{i}", 100 + u) for i in range(7) for u in range(11) if (i * u) % 3 == 1] + [("don't\tstop", 105), ("item1", 101)]
    df = spark.createDataFrame([*owned, (None, 3), ("lost", None)], "item string, user long")
    for tile in (3, 1000):
        path = os.path.join(tmp, f"own{tile}")
        IO.write_ownership_matrix(df, "item", "user", path, tile=tile)
        back = IO.read_ownership_matrix(spark, path).collect()
        pairs = {(i.replace("\t", " "), str(u)) for i, u in owned}
        rows, cols = {i for i, _ in pairs}, {u for _, u in pairs}
        assert len(back) == len(rows) * len(cols)
        assert {(r["row"], r["col"]): r["value"] for r in back} == {(i, u): int((i, u) in pairs) for i in rows for u in cols}
        files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
        assert len(files) == -(-len(rows) // tile) * -(-len(cols) // tile)
        for f in files:
            lines = open(f).read().splitlines()
            assert lines[0].startswith("Item\t") and len(lines) <= tile + 1 and lines[1:] == sorted(lines[1:])
    path = os.path.join(tmp, "none")
    IO.write_ownership_matrix(df.limit(0), "item", "user", path)
    assert IO.read_ownership_matrix(spark, path).collect() == []


def test_schedule_over_several_files(spark, tmp):
    folder = os.path.join(tmp, "legs")
    os.mkdir(folder)
    # the larger file is read first unless the order is the files'
    open(os.path.join(folder, "a.txt"), "w").write("LGA,OMA,6:19,8:13,1\n")
    open(os.path.join(folder, "b.txt"), "w").write("".join(f"LGA,OMA,6:19,8:13,{i}\n" for i in range(2, 400)))
    rows = {r["leg"]: r["price"] for r in IO.read_schedule(spark, folder).collect()}
    assert rows == {i: i + 1 for i in range(399)}


def test_mbox_in_byte_ranges(spark, tmp):
    """A message may span many ranges, and a range may start no message."""
    body = ["".join(f"From here line {k} of {i}\n" for k in range(i * 7 % 60)) for i in range(40)]
    text = "".join(f"From a@x Mon Dec  1 10:{i:02d}:00 2025\nFrom: A <a@x>\nSubject: S{i}\n\nstart {i}\n{body[i]}\n" for i in range(40))
    for name in ("one", "two"):
        open(os.path.join(tmp, name), "w").write(text.replace("Subject: S", f"Subject: {name}-"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("300", "5000", "10000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            m = IO.read_mbox(spark, tmp)
            got = {r["Subject"]: r["body"].strip() for r in m.collect()}
            assert got == {f"{name}-{i}": f"start {i}\n{body[i]}".strip() for name in ("one", "two") for i in range(40)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
