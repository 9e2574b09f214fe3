"""Smallest and largest values, by the DataFrame API and by SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cleaning import clean_numeric
from millrace.operators.extremes import (
    describe_long,
    describe_text,
    extremes_by,
    global_extremes,
)
from millrace.session import fresh_path
from millrace.sources import checked
from millrace.sources.csv import infer_schema, read_csv, write_csv
from millrace.sources.merged import read_merged
from millrace.sources.tables import name_relation, query, table
from millrace.sources.text import write_lines


def orders_with_year(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))


def overall(spark: SparkSession, folder: str) -> DataFrame:
    return global_extremes(table(spark, folder, "orders"), "o_totalprice", "o_totalprice")


def overall_sql(spark: SparkSession, folder: str) -> DataFrame:
    text = "SELECT min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM {orders}"
    return query(spark, text, orders=table(spark, folder, "orders"))


def by_year(spark: SparkSession, folder: str) -> DataFrame:
    return extremes_by(orders_with_year(spark, folder), "year", "o_totalprice", "o_totalprice")


def by_year_sql(spark: SparkSession, folder: str) -> DataFrame:
    name_relation(orders_with_year(spark, folder), "orders_with_year")
    return spark.sql("""
        SELECT year, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
        FROM orders_with_year
        GROUP BY year
        ORDER BY year DESC
    """)


def by_year_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The same from ';'-separated shards whose types are inferred once."""
    path = fresh_path(spark, "orders-csv")
    orders = table(spark, folder, "orders")
    shards = orders.select("o_totalprice", F.to_date("o_orderdate").alias("day"))
    write_csv(shards, path, sep=";")
    glob = f"{path}/*.csv"
    rows = read_csv(spark, glob, infer_schema(spark, glob, sep=";"), sep=";")
    return extremes_by(
        rows.withColumn("year", F.year("day")), "year", "o_totalprice", "o_totalprice"
    )


def dirty_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Padded and broken numbers read from CSV under a declared schema, then cleaned."""
    path = fresh_path(spark, "events-csv")
    events = table(spark, folder, "events")
    padded = F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    write_csv(
        events.select(
            F.when(F.col("event_type") == "error", "broken").otherwise(padded).alias("a"),
            F.when(F.col("event_type") != "view", F.col("user_id")).alias("b"),
            F.concat(F.lit(" "), "event_type").alias("LABEL"),
        ),
        path,
    )
    rows = read_csv(spark, path, "a double, b double, LABEL string").drop("LABEL")
    return clean_numeric(rows, ["a", "b"])


EXPORT = "value double, user_id bigint, kind string"


def _loose_export(spark: SparkSession, folder: str) -> str:
    """Events as CSV lines: some with a text for a number, some cut short, some too long."""
    path = fresh_path(spark, "loose-csv")
    fields = [F.col(c).cast("string") for c in ("value", "user_id", "event_type")]
    whole = F.concat_ws(",", *fields)
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws(",", F.lit("broken"), *fields[1:]))
        .when(F.col("event_type") == "view", F.concat_ws(",", *fields[:2]))
        .when(F.col("event_type") == "click", F.concat_ws(",", whole, F.lit("more")))
        .otherwise(whole)
    )
    write_lines(table(spark, folder, "events").select(line.alias("line")), "line", path)
    return path


def _by_problem(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.sum(c).alias(c) for c in ("rows", "good", "fields", "value")])


def checked_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of an export, and those that do not parse by what is wrong with them."""
    rows = checked.read_checked(spark, _loose_export(spark, folder), EXPORT, header=False)
    return _by_problem(checked.problem_counts(rows))


def checked_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream, which writes good and bad rows to two tables."""
    rows = checked.checked_stream(spark, _loose_export(spark, folder), EXPORT, header=False, files_per_batch=4)
    good_path, bad_path, state = (fresh_path(spark, f"checked-{name}") for name in ("good", "bad", "state"))
    checked.start_checked(rows, good_path, bad_path, state).awaitTermination()
    good = spark.read.parquet(good_path).select(F.lit(None).cast("string").alias("problem"))
    both = good.unionByName(spark.read.parquet(bad_path).select("problem"))
    return _by_problem(checked.problem_counts(both.withColumn("file", F.lit(""))))


def merged_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Customers from files with two headers: columns in another order, one more, other types."""
    path = fresh_path(spark, "merged-csv")
    customers = table(spark, folder, "customer")
    names = ["c_custkey", "c_name", "c_acctbal"]
    write_csv(customers.filter("c_custkey % 2 = 0").select(*names), f"{path}/even")
    whole = F.floor("c_acctbal").alias("c_acctbal")
    odd = customers.filter("c_custkey % 2 = 1")
    write_csv(odd.select(whole, "c_nationkey", "c_custkey", "c_name"), f"{path}/odd")
    rows = read_merged(spark, f"{path}/*/*.csv")
    return rows.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        "c_acctbal",
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
    )


def statistics(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return describe_long(table(spark, folder, "orders"), columns).select(
        "column",
        "n",
        F.round("mean", 2).alias("mean"),
        F.round("stddev", 2).alias("stddev"),
        "lowest",
        "highest",
    )


def text_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return describe_text(table(spark, folder, "documents"), ["text", "lang", "source"])


OVERALL = "SELECT min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders"

BY_YEAR = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       min(o_totalprice) AS lowest, max(o_totalprice) AS highest
FROM orders GROUP BY 1 ORDER BY 1 DESC
"""

DIRTY = """
SELECT DISTINCT value AS a, CAST(user_id AS DOUBLE) AS b
FROM events WHERE event_type NOT IN ('error', 'view')
"""


CHECKED = """
SELECT count(*) AS rows, count(*) FILTER (WHERE event_type NOT IN ('error', 'view', 'click')) AS good,
       count(*) FILTER (WHERE event_type IN ('view', 'click')) AS fields,
       count(*) FILTER (WHERE event_type = 'error') AS value
FROM events
"""

MERGED = """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
       CAST(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE floor(c_acctbal) END AS DOUBLE) AS c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS BIGINT) END AS c_nationkey
FROM customer
"""


def _statistics_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 2) AS mean,
            round(stddev_samp({c}), 2) AS stddev, CAST(min({c}) AS DOUBLE) AS lowest,
            CAST(max({c}) AS DOUBLE) AS highest FROM orders"""
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ]
    return " UNION ALL ".join(parts)


def _text_statistics_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS lowest, max({c}) AS highest
            FROM documents"""
        for c in ("text", "lang", "source")
    ]
    return " UNION ALL ".join(parts)


QUERIES = {
    "global_extremes": (overall, OVERALL),
    "global_extremes_sql": (overall_sql, OVERALL),
    "year_extremes": (by_year, BY_YEAR),
    "year_extremes_sql": (by_year_sql, BY_YEAR),
    "year_extremes_csv": (by_year_csv, BY_YEAR),
    "dirty_csv": (dirty_csv, DIRTY),
    "checked_csv": (checked_csv, CHECKED),
    "checked_csv_stream": (checked_csv_stream, CHECKED),
    "merged_csv": (merged_csv, MERGED),
    "describe_orders": (statistics, _statistics_sql()),
    "describe_documents": (text_statistics, _text_statistics_sql()),
}
