from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.numeric import array_total, label_flag, squares, to_int
from millrace.operators import cleaning, extremes, members, numbers, totals
from millrace.session import build_session, fresh_path, shared_folder
from millrace.sources import csv, tables


def weather(spark):
    rows = [("2020-01-01", -5.0, 1.0), ("2020-07-01", 10.0, 30.5), ("2019-03-01", None, 4.0)]
    rows += [("2018-03-01", 0.0, None), (None, -9.0, 9.0)]
    return spark.createDataFrame(rows, "date string, low double, high double").withColumn(
        "date", F.to_date("date")
    )


def test_extremes(spark):
    df = weather(spark)
    assert tuple(extremes.global_extremes(df, "low", "high").first()) == (-9.0, 30.5)
    by_year = extremes.extremes_by(df.withColumn("year", F.year("date")), "year", "low", "high")
    assert [tuple(r) for r in by_year.collect()] == [
        (2020, -5.0, 30.5),
        (2019, None, 4.0),
        (2018, 0.0, None),
        (None, -9.0, 9.0),
    ]
    text = "SELECT min(low) AS lowest, max(high) AS highest FROM {weather}"
    assert tuple(tables.query(spark, text, weather=df).first()) == (-9.0, 30.5)
    tables.name_relation(df, "weather_days")
    assert spark.sql("SELECT count(*) FROM weather_days").first()[0] == 5


def test_describe_matches_describe(spark):
    df = weather(spark)
    typed = {r["column"]: r for r in extremes.describe_long(df, ["low", "high"]).collect()}
    shown = {r["summary"]: r for r in df.describe("low", "high").collect()}
    for name in ("low", "high"):
        assert typed[name]["n"] == int(shown["count"][name])
        for ours, theirs in (
            ("mean", "mean"),
            ("stddev", "stddev"),
            ("lowest", "min"),
            ("highest", "max"),
        ):
            assert typed[name][ours] == pytest.approx(float(shown[theirs][name]))


def test_describe_text(spark):
    rows = [("b", None), ("", None), (None, None), ("Z", None), ("\u00e9", None)]
    df = spark.createDataFrame(rows, "word string, nothing string")
    found = [tuple(r) for r in extremes.describe_text(df, ["word", "nothing"]).collect()]
    assert found == [("word", 4, "", "\u00e9"), ("nothing", 0, None, None)]
    empty = extremes.describe_text(df.limit(0), ["word"]).collect()
    assert [tuple(r) for r in empty] == [("word", 0, None, None)]


def test_whole_numbers_keep_their_limits(spark):
    df = spark.createDataFrame([(2**53 + 1, 1), (-(2**53) - 1, 2)], "n bigint, m int")
    rows = {r["column"]: r for r in extremes.describe_long(df, ["n", "m"]).collect()}
    assert (rows["n"]["lowest"], rows["n"]["highest"]) == (-(2**53) - 1, 2**53 + 1)


def test_top_groups_settle_ties_by_key(spark):
    rows = [(f"d{i:02}", 1, 5.0) for i in range(12)] + [("d11", 2, 2.5)]
    df = spark.createDataFrame(rows, "day string, quantity int, price double")
    for parts in (1, 7):
        best = totals.top_groups(df.repartition(parts), "day", "quantity * price", 3).collect()
        assert [tuple(r) for r in best] == [("d11", 10.0), ("d00", 5.0), ("d01", 5.0)]


def test_year_of_maximum_and_one_year(spark):
    sales = tables.inline(
        spark, [(2001, 70), (2002, 930), (2003, 8), (2001, 30), (2004, 640)], "year int, euros int"
    )
    total = totals.total_by(sales, "year", "euros", "total_euros")
    assert total.schema["total_euros"].dataType.simpleString() == "bigint"
    assert tuple(totals.first_match(total, "year = 2001").first()) == (2001, 100)
    assert tuple(totals.leaders(total, "total_euros", "year", 1).first()) == (2002, 930)
    assert totals.first_match(total, "year = 1900").count() == 0


def test_narrowing_gives_null_instead_of_wrapping(spark):
    df = spark.createDataFrame([(5,), (2**31,)], "n bigint")
    assert [r[0] for r in df.select(to_int(F.col("n"))).collect()] == [5, None]


def test_inline_forms(spark):
    assert tables.inline(spark, [(1, 2.0, "x")], ["c1", "c2", "c3"]).columns == ["c1", "c2", "c3"]
    assert [r[0] for r in tables.inline(spark, [2, 3], "int").collect()] == [2, 3]


DIRTY = """a,b,LABEL
0.1, 4.5 , Ok
,5.0, Ok
0.2,x, Fatal
0.3,6.0,
0.1, 4.5 , Ok
0.4,7.0, Fatal
0.5
"""


def test_dirty_csv(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text(DIRTY)
    rows = csv.read_csv(spark, str(path), "a double, b double, LABEL string")
    assert rows.filter("LABEL = ' Ok'").count() == 3
    bare = cleaning.clean_numeric(rows.drop("LABEL"), ["a", "b"])
    assert sorted(map(tuple, bare.collect())) == [(0.1, 4.5), (0.3, 6.0), (0.4, 7.0)]
    labelled = cleaning.clean_numeric(rows, ["a", "b"])
    assert labelled.count() == 2
    as_text = csv.read_csv(spark, str(path), "a string, b string, LABEL string").drop("LABEL")
    assert sorted(cleaning.clean_numeric(as_text, ["a", "b"]).collect()) == sorted(bare.collect())


def test_quoted_fields_may_hold_the_separator(spark, tmp_path):
    (tmp_path / "q.csv").write_text('NAME,N\n"Gifts, Ltd",3\nplain,4\n')
    rows = csv.read_csv(spark, str(tmp_path / "q.csv"), "NAME string, N int").collect()
    assert [tuple(r) for r in rows] == [("Gifts, Ltd", 3), ("plain", 4)]


def test_csv_glob_separator_and_inference(spark, tmp_path):
    (tmp_path / "one.csv").write_text("day;low\n2020-01-01;-5\n2020-01-02;1.5\n")
    (tmp_path / "two.csv").write_text("day;low\n2021-01-01;2\n")
    glob = f"{tmp_path}/*.csv"
    schema = csv.infer_schema(spark, glob, sep=";")
    assert [f.dataType.simpleString() for f in schema] == ["date", "double"]
    pinned = csv.read_csv(spark, glob, schema, sep=";")
    assert pinned.count() == 3
    assert sorted(pinned.collect()) == sorted(csv.read_csv(spark, glob, sep=";").collect())


def test_label_flag(spark):
    df = spark.createDataFrame([(" Ok",), (" Fatal",), (None,), ("",)], "LABEL string")
    assert [r[0] for r in df.select(label_flag(F.col("label"), "Ok")).collect()] == [0, 1, 1, 1]


def test_keyed_split_is_whole_and_stable(spark):
    df = spark.range(20_000).withColumn("v", F.col("id") % 7)
    left, right = cleaning.keyed_split(df, ["id"], 0.7, seed=3)
    assert left.union(right).distinct().count() == 20_000
    assert 13_700 < left.count() < 14_300
    again, _ = cleaning.keyed_split(df.repartition(5), ["id"], 0.7, seed=3)
    assert left.exceptAll(again).count() == 0
    other, _ = cleaning.keyed_split(df, ["id"], 0.7, seed=4)
    assert left.exceptAll(other).count() > 0


def test_random_split_is_whole(spark):
    parts = cleaning.random_split(spark.range(1000), [0.7, 0.3], seed=1)
    assert sum(p.count() for p in parts) == 1000


def test_removed_values_leave_other_copies(spark):
    rows = [("p",), ("p",), ("Lamp",), ("Lamp",), (None,), (None,)]
    df = spark.createDataFrame(rows, "line string")
    kept = members.without_values(df, "line", ["Lamp"])
    assert Counter(r[0] for r in kept.collect()) == {"p": 2, None: 2}
    assert members.without_values(df, "line", ["Lamp", None]).count() == 2
    listed = spark.createDataFrame([("Lamp",), ("Lamp",), ("q",)], "v string")
    kept = members.without_listed(df, "line", listed)
    assert Counter(r[0] for r in kept.collect()) == {"p": 2, None: 2}
    listed = spark.createDataFrame([("Lamp",), (None,)], "v string")
    assert members.without_listed(df, "line", listed).count() == 2


def grouped(spark, extra=()):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).alias("m"))
    rows = [("cold", 1), ("cold", 1), (None, 2), ("none", None), *extra]
    return hot.union(spark.createDataFrame(rows, "k string, m bigint"))


def test_group_members_hold_everything(spark):
    found = members.group_members(grouped(spark), "k", "m").collect()
    assert Counter({(r["k"], r["m"]): r["copies"] for r in found}) == Counter(
        {("hot", i): 3 for i in range(1000)} | {("cold", 1): 2, (None, 2): 1, ("none", None): 1}
    )
    assert len(found) == 1003


def test_one_row_more_changes_no_other_row(spark):
    for count in (members.group_members, lambda *a: members.member_lists(*a, buckets=7)):
        before = {str(r) for r in count(grouped(spark), "k", "m").collect()}
        after = {str(r) for r in count(grouped(spark, [("hot", 5000)]), "k", "m").collect()}
        assert len(before - after) <= 1 and len(after - before) == 1


def test_member_lists_hold_the_same(spark):
    lists = members.member_lists(grouped(spark), "k", "m", buckets=10).collect()
    found = {(r["k"], e["member"]): e["copies"] for r in lists for e in r["members"]}
    rows = members.group_members(grouped(spark), "k", "m").collect()
    assert found == {(r["k"], r["m"]): r["copies"] for r in rows}
    assert len([r for r in lists if r["k"] == "hot"]) == 10
    with pytest.raises(ValueError):
        members.member_lists(grouped(spark), "k", "m", buckets=0)


def factors_of(n):
    found, p = [], 2
    while n > 1:
        while n % p == 0:
            found.append(p)
            n //= p
        p += 1
    return found


def test_prime_factors(spark):
    values = [None, -6, 0, 1, *range(2, 400), 46337 * 46327, 2**31 - 1, 2**30, 3 * 46337]
    df = spark.createDataFrame([(v,) for v in values + values[:50]], "n int")
    found = {r["n"]: r["factors"] for r in numbers.with_factors(df, "n").collect()}
    assert found[None] is None
    assert found[2**31 - 1] == [2**31 - 1]
    assert found[46337 * 46327] == [46327, 46337]
    for n in set(values) - {None, 2**31 - 1, 46337 * 46327}:
        assert found[n] == factors_of(n), n


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_prime_factors_of_large_numbers(spark, ansi):
    wanted = {
        2**31: [2] * 31,
        2**31 + 11: [2**31 + 11],
        2**32 + 6: [2, 83, 1277, 20261],
        1048583 * 1048589: [1048583, 1048589],
        1048583**2: [1048583, 1048583],
        2**61 - 1: [2**61 - 1],
        2**63 - 1: [7, 7, 73, 127, 337, 92737, 649657],
        4294967291 * 2147483647: [2147483647, 4294967291],
        -(2**40): [],
        None: None,
    }
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.createDataFrame([(v,) for v in wanted], "n bigint")
        found = {r["n"]: r["factors"] for r in numbers.with_factors(df, "n").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert found == wanted


def test_factor_histogram(spark):
    values = [12, 12, 7, 1, 0, 60]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    wanted = Counter(p for v in values if v > 1 for p in factors_of(v))
    assert dict(numbers.factor_histogram(df, "n").collect()) == wanted


def test_squares(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "v array<int>")
    row = df.select(squares(F.col("v")), array_total(squares(F.col("v")))).first()
    assert row[0] == [1, 4, 9, 16, 25]
    assert row[1] == 55.0
    rows = spark.createDataFrame([(i,) for i in range(1, 6)], "n int")
    assert numbers.square_sum(rows, "n", []).first()[0] == 55


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert build_session("again") is not None


class Unset:
    """The two parts of a session that the folder choice looks at."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder
        self.conf = {}
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_master_may_use_a_temporary_folder():
    local = Unset("local[2]")
    assert shared_folder(local) == local.folder and "millrace-" in local.folder
    assert shared_folder(Unset("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        shared_folder(Unset("yarn"))
    named = Unset("yarn")
    named.conf = {"spark.checkpoint.dir": "hdfs:///named/"}
    assert shared_folder(named) == "hdfs:///named" and named.folder == "hdfs:///named/"
