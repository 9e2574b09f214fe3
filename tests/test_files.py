"""Line numbers of text files, and rows kept by a filter of listed values."""

from __future__ import annotations

import json
import os
import random
import re
import subprocess
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import members
from millrace.sources import checked, merged, text


@contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SMALL_PIECES = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def folder(tmp_path):
    """Files with all line ends, empty ones, one without an end and a long one."""
    draw = random.Random(2)
    texts = {
        "a.txt": "".join(f"a{i} {'x' * draw.randint(0, 90)}\n" for i in range(400)),
        "b.txt": "",
        "c.txt": "c0\r\nc1\rc2\n\nc4",
        "d.txt": "d0 " + "y" * 5_000 + "\nd1\n",
        "e/f.txt": "\n\n",
        "g.txt": "g0",
    }
    wanted = []
    for name, content in texts.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content.encode())
        lines = content.replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n").split("\n")
        wanted += [(name, i, line) for i, line in enumerate(lines) if content]
    return tmp_path, [(n, name, i, line) for n, (name, i, line) in enumerate(wanted)]


def found(frame, folder):
    rows = frame.collect()
    return [
        (r.number, os.path.relpath(re.sub("^file:/+", "/", r.file), folder), r.line_no, r.value)
        for r in rows
    ]


@pytest.mark.parametrize("pieces", [{}, SMALL_PIECES])
def test_lines_are_numbered_through_all_pieces(spark, folder, pieces):
    path, wanted = folder
    with settings(spark, **pieces):
        lines = text.numbered_lines(spark, [f"{path}/*.txt", f"{path}/e/*.txt"])
        if pieces:
            assert lines.select(F.spark_partition_id()).distinct().count() > 20
        assert sorted(found(lines, path)) == wanted


@pytest.mark.parametrize("n", [1, 399, 400, 405, 10_000])
def test_first_lines_in_the_order_of_the_files(spark, folder, n):
    path, wanted = folder
    with settings(spark, **SMALL_PIECES):
        lines = text.first_lines_of_files(spark, [f"{path}/*.txt", f"{path}/e/*.txt"], n)
        assert found(lines, path) == wanted[:n]
        if n < 400:
            assert [os.path.basename(f) for f in lines.inputFiles()] == ["a.txt"]


def test_no_line_is_shuffled(spark, folder):
    path, _ = folder
    lines = text.numbered_lines(spark, f"{path}/*.txt").select("number", "value")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2
    above = plan.split("FileScan text")[0]
    assert "Exchange" not in above.split("BroadcastHashJoin")[0]


def test_files_that_change_between_the_passes_are_noticed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("three\n")
    lines = text._in_splits(text.read_lines(spark, f"{tmp_path}/*.txt"))
    starts = text._split_starts(lines.drop("value")).collect()
    assert sorted((r["lines"], r["ahead"], r["file_ahead"]) for r in starts) == [(1, 2, 2), (2, 0, 0)]
    numbered = text.numbered_lines(spark, f"{tmp_path}/*.txt")
    numbered.collect()
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "4", "spark.sql.files.openCostInBytes": "0"}):
        shifted = text._numbered(lines.withColumn("place", F.col("place") + 5), text._split_starts(lines))
        with pytest.raises(Exception, match="files changed between the passes"):
            shifted.collect()


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    assert text.numbered_lines(spark, f"{tmp_path}/*.txt").count() == 0
    assert text.first_lines_of_files(spark, f"{tmp_path}/*.txt").count() == 0


LISTS = {
    "numbers": ("long", [1, 2, 2, 3, 10**12], [1, 1, 2, 4, 5, None, None, 10**12]),
    "null listed": ("long", [None, 7], [None, None, 7, 8, 8]),
    "texts": ("string", ["", "a", "é"], ["", "a", "A", "é", None, "zz", "zz"]),
    "empty list": ("long", [], [1, None, 2, 2]),
    "no rows": ("long", [1], []),
}


@pytest.mark.parametrize("name", LISTS)
@pytest.mark.parametrize("most_words", [members.MOST_WORDS, 0])
def test_filtered_anti_join(spark, name, most_words):
    kind, listed, values = LISTS[name]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"v {kind}, i int")
    table = spark.createDataFrame([(v,) for v in listed], f"v {kind}")
    kept = members.without_many_listed(df, "v", table, most_words)
    assert sorted(r.i for r in kept.collect()) == [i for i, v in enumerate(values) if v not in listed]
    assert kept.columns == ["v", "i"]


def test_the_filter_lets_few_others_through(spark):
    listed = spark.range(50_000).select((F.col("id") * 3).alias("v"))
    words = 1 << 14
    known = members.value_filter(listed, words).scalar()
    rows = spark.range(300_000)
    passed = rows.filter(members.may_be_listed(F.col("id"), known, words))
    on_list = passed.filter("id % 3 = 0 and id < 150000").count()
    assert on_list == 50_000 and passed.count() - on_list < 0.02 * 250_000
    kept = members.without_many_listed(rows, "id", listed)
    assert kept.count() == 250_000


SHUFFLES = """
import sys
from pyspark.sql import SparkSession, functions as F
from millrace.operators import members
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
urgent = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").filter("o_orderpriority = '1-URGENT'")
kept = getattr(members, sys.argv[2])(lines, "l_orderkey", urgent.select("o_orderkey"))
kept.write.format("noop").mode("overwrite").save()
spark.stop()
"""


def shuffled_bytes(folder, operator):
    log = folder / operator
    log.mkdir()
    root = str(Path(__file__).resolve().parents[1])
    subprocess.run(
        [sys.executable, "-c", SHUFFLES, str(log), operator], cwd=root, check=True, capture_output=True
    )
    total = 0
    for path in log.rglob("*"):
        for line in path.read_text().splitlines() if path.is_file() else ():
            if '"SparkListenerTaskEnd"' in line:
                metrics = json.loads(line).get("Task Metrics") or {}
                total += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return total


def test_fewer_bytes_are_shuffled(tmp_path):
    """By Spark's event log, all columns of the lines, a fifth of the orders listed."""
    whole = shuffled_bytes(tmp_path, "without_listed")
    filtered = shuffled_bytes(tmp_path, "without_many_listed")
    print(f"shuffled {whole} bytes before, {filtered} after")
    assert 0 < filtered < 0.35 * whole


ROWS = 'x,y,z\n1,2.5,a\n2,oops,b\n3\n4,5,c,d\n,,\n"5",6,"q,r"\n7,,"s"\n'
WANTED = {
    (1, 2.5, "a", None, None),
    (2, None, "b", "value", "2,oops,b"),
    (3, None, None, "fields", "3"),
    (4, 5.0, "c", "fields", "4,5,c,d"),
    (None, None, None, None, None),
    (5, 6.0, "q,r", None, None),
    (7, None, "s", None, None),
}


def test_rows_that_do_not_parse(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(ROWS)
    (tmp_path / "in" / "b.csv").write_text("x,y,z\n")
    (tmp_path / "in" / "c.csv").write_text("x,y,z\nbad,1,u\n8,1,u\n")
    rows = checked.read_checked(spark, str(tmp_path / "in"), "x int, y double, z string")
    found = {(r.x, r.y, r.z, r.problem, r.bad_line) for r in rows.collect()}
    assert found == WANTED | {(None, 1.0, "u", "value", "bad,1,u"), (8, 1.0, "u", None, None)}
    counts = {os.path.basename(r.file): tuple(r)[1:] for r in checked.problem_counts(rows).collect()}
    assert counts == {"a.csv": (7, 4, 2, 1), "c.csv": (2, 1, 0, 1)}
    # Fewer columns asked for, the same verdicts.
    assert rows.select("z", "problem").filter("problem = 'value'").count() == 2
    assert rows.select("problem").filter("problem is null").count() == 5
    good = checked.put_aside(rows, str(tmp_path / "bad"))
    assert good.columns == ["x", "y", "z"] and good.count() == 5
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted((r.problem, r.bad_line) for r in bad.collect()) == [
        ("fields", "3"),
        ("fields", "4,5,c,d"),
        ("value", "2,oops,b"),
        ("value", "bad,1,u"),
    ]
    with pytest.raises(ValueError):
        checked.read_checked(spark, str(tmp_path / "in"), "x int, problem string")


def test_rows_of_a_stream_that_do_not_parse(spark, tmp_path):
    for i in range(4):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.csv").write_text(ROWS)
    stream = checked.checked_stream(
        spark, str(tmp_path / "in"), "x int, y double, z string", files_per_batch=1
    )
    places = [str(tmp_path / name) for name in ("good", "bad", "state")]
    for _ in range(2):
        # The second start finds nothing new.
        checked.start_checked(stream, *places).awaitTermination()
    good, bad = (spark.read.parquet(place) for place in places[:2])
    assert good.count() == 16 and bad.count() == 12
    assert good.select("batch").distinct().count() == 4
    assert {r.bad_line for r in bad.collect()} == {line for *_, line in WANTED if line}


def test_files_whose_headers_differ(spark, tmp_path):
    texts = {
        "a.csv": "id,name,price\n1,x,2\n2,y,3\n",
        "b.csv": "price,id,more,when\n2.5,3,k,2020-01-01\n",
        "c.csv": "id,name,price\n30000000000,,\n",
        "d.csv": "",
        "e.csv": "name,when\n\"a,b\",2020-01-02 10:00:00\n",
        "f.csv": "price,id,more,when\n",
    }
    for name, content in texts.items():
        (tmp_path / name).write_text(content)
    path = f"{tmp_path}/*.csv"
    known = merged.layouts(spark, path)
    assert {names: [os.path.basename(f) for f in files] for names, files in known.files.items()} == {
        ("id", "name", "price"): ["a.csv", "c.csv"],
        ("name", "when"): ["e.csv"],
        ("price", "id", "more", "when"): ["b.csv", "f.csv"],
    }
    assert known.schema.simpleString() == "struct<id:bigint,name:string,price:double,when:timestamp,more:string>"
    assert set(known.widened) == {"id", "price", "when"}
    rows = merged.read_merged(spark, path)
    key = lambda row: repr(row)
    found = sorted(((r.id, r.name, r.price, r.more, str(r.when)) for r in rows.collect()), key=key)
    assert found == sorted(
        [
            (1, "x", 2.0, None, "None"),
            (2, "y", 3.0, None, "None"),
            (3, None, 2.5, "k", "2020-01-01 00:00:00"),
            (30000000000, None, None, None, "None"),
            (None, "a,b", None, None, "2020-01-02 10:00:00"),
        ],
        key=key,
    )
    pinned = merged.read_merged(spark, path, "price double, id string, absent int")
    assert pinned.columns == ["price", "id", "absent"] and pinned.count() == 5
    assert {r.id for r in pinned.collect()} == {"1", "2", "3", "30000000000", None}


@pytest.mark.parametrize("text_, named", [("a,a\n1,2\n", "a"), ("a,\n1,2\n", "''"), ("A,b\n1,2\n", "case")])
def test_headers_that_no_merge_can_mend(spark, tmp_path, text_, named):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text(text_)
    with pytest.raises(ValueError, match=named):
        merged.read_merged(spark, f"{tmp_path}/*.csv")


@pytest.mark.parametrize("kinds, wanted", [
    (["int", "bigint"], "bigint"), (["int", "double"], "double"), (["date", "timestamp"], "timestamp"),
    (["boolean", "int"], "string"), (["string", "int"], "string"), (["date", "int"], "string"),
])
def test_wider_types(kinds, wanted):
    a, b = (merged.StructType.fromDDL(f"c {kind}").fields[0].dataType for kind in kinds)
    assert merged.wider(a, b).simpleString() == merged.wider(b, a).simpleString() == wanted
