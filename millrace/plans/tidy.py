"""Cleaning, label flags, splits, projections and removed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numeric import label_flag
from millrace.operators.cleaning import clean_numeric, random_split, split_side
from millrace.operators.corpus import lines_of
from millrace.operators.members import (
    group_members,
    member_lists,
    without_listed,
    without_many_listed,
    without_values,
)
from millrace.sources.tables import table


def _event_text(spark: SparkSession, folder: str) -> DataFrame:
    """Event numbers as the text a loose export would hold."""
    padded = F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") == "error", "broken").otherwise(padded).alias("a"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("b"),
        F.get_json_object("props", "$.k").alias("c"),
    )


def clean_two(spark: SparkSession, folder: str) -> DataFrame:
    return clean_numeric(_event_text(spark, folder).drop("c"), ["a", "b"])


def clean_three(spark: SparkSession, folder: str) -> DataFrame:
    return clean_numeric(_event_text(spark, folder), ["a", "b", "c"])


def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    flag = label_flag(F.col("o_orderpriority"), "HIGH").alias("flag")
    rows = table(spark, folder, "orders").select(flag, "o_totalprice")
    return rows.groupBy("flag").agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    )


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of the two sides of a 70/30 split by order key."""
    side = split_side(["o_orderkey"], 0.7).alias("training")
    orders = table(spark, folder, "orders")
    return orders.select(side, "o_totalprice").groupBy("training").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


def random_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Spark's own 70/30 split: all orders once, none in both parts, the share about met.

    Which orders go where depends on the partitioning. The share has room for
    five deviations of the binomial count.
    """
    orders = table(spark, folder, "orders").select("o_orderkey")
    training, test = random_split(orders, [0.7, 0.3], seed=1)
    sides = training.withColumn("training", F.lit(1)).unionByName(
        test.withColumn("training", F.lit(0))
    )
    by_key = sides.groupBy("o_orderkey").agg(
        F.count("*").alias("rows"), F.sum("training").alias("training")
    )
    n, share = F.sum("rows"), F.sum("training") / F.sum("rows")
    return by_key.agg(
        n.alias("n"),
        F.count_if((F.col("training") > 0) & (F.col("training") < F.col("rows"))).alias("in_both"),
        (F.abs(share - 0.7) < 5 * F.sqrt(0.21 / n)).alias("share_holds"),
    )


def customer_card(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").drop("c_acctbal")
    return customers.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"
    )


def drop_values(spark: SparkSession, folder: str) -> DataFrame:
    kept = without_values(
        table(spark, folder, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]
    )
    return kept.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def drop_listed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Document lines that are no line of the benchmark texts."""
    document_lines = lines_of(table(spark, folder, "documents"), "text", ["lang"])
    listed = lines_of(table(spark, folder, "benchmark"), "text", [])
    kept = without_listed(document_lines, "line", listed)
    return kept.groupBy("lang").agg(F.count("*").alias("lines"))


def lines_off_list(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of orders that are not urgent, the list being one of order keys."""
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    kept = without_many_listed(lines, "l_orderkey", urgent.select("o_orderkey"))
    return kept.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("quantity")
    )


def supplier_members(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers behind each return flag, with their line counts."""
    return group_members(table(spark, folder, "lineitem"), "l_returnflag", "l_suppkey")


def supplier_lists(spark: SparkSession, folder: str) -> DataFrame:
    """What the lists of suppliers behind each return flag hold together."""
    lines = table(spark, folder, "lineitem")
    lists = member_lists(lines, "l_returnflag", "l_suppkey", buckets=64)
    copies = F.aggregate(
        F.col("members.copies"), F.lit(0).cast("bigint"), lambda total, n: total + n
    )
    return lists.groupBy("l_returnflag").agg(
        F.sum(F.size("members")).alias("suppliers"),
        F.sum(copies).alias("lines"),
        F.min(F.col("members")[0]["member"]).alias("first_supplier"),
        F.max(F.element_at("members", -1)["member"]).alias("last_supplier"),
    )


EVENT_TEXT = """
SELECT CASE WHEN event_type = 'error' THEN 'broken'
            ELSE ' ' || CAST(value AS VARCHAR) || ' ' END AS a,
       CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS b,
       json_extract_string(props, '$.k') AS c
FROM events
"""


def _clean_sql(*columns: str) -> str:
    casts = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"SELECT DISTINCT * FROM (SELECT {casts} FROM ({EVENT_TEXT})) WHERE {present}"


LABEL = """
SELECT CASE WHEN contains(o_orderpriority, 'HIGH') THEN 0 ELSE 1 END AS flag,
       count(*) AS n, round(avg(o_totalprice), 4) AS mean_price
FROM orders GROUP BY 1
"""

SPLIT = """
SELECT md5('0|' || CAST(o_orderkey AS VARCHAR)) < 'b3333333' AS training,
       count(*) AS n, round(sum(o_totalprice), 2) AS price
FROM orders GROUP BY 1
"""

CARD = "SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer"

DROP = """
SELECT c_mktsegment, count(*) AS n FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1
"""

LINES = r"""
CASE WHEN text = '' THEN []
     ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r') END
"""

DROP_LINES = f"""
SELECT lang, count(*) AS lines
FROM (SELECT lang, unnest({LINES}) AS line FROM documents)
WHERE line NOT IN (SELECT line FROM (SELECT unnest({LINES}) AS line FROM benchmark))
GROUP BY 1
"""

OFF_LIST = """
SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY 1
"""

MEMBERS = "SELECT l_returnflag, l_suppkey, count(*) AS copies FROM lineitem GROUP BY ALL"

# About 70 % of any orders fall into the first part; the shares are checked, not fixed.
RANDOM_SPLIT = """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS in_both, true AS share_holds FROM orders
"""

MEMBER_LISTS = """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(*) AS lines,
       min(l_suppkey) AS first_supplier, max(l_suppkey) AS last_supplier
FROM lineitem GROUP BY l_returnflag
"""

QUERIES = {
    "clean_numeric_2d": (clean_two, _clean_sql("a", "b")),
    "clean_numeric_3d": (clean_three, _clean_sql("a", "b", "c")),
    "label_encode": (label_encode, LABEL),
    "split_counts": (split_counts, SPLIT),
    "random_split_counts": (random_split_counts, RANDOM_SPLIT),
    "customer_card": (customer_card, CARD),
    "drop_values": (drop_values, DROP),
    "drop_listed_lines": (drop_listed_lines, DROP_LINES),
    "lines_off_list": (lines_off_list, OFF_LIST),
    "group_members": (supplier_members, MEMBERS),
    "member_lists": (supplier_lists, MEMBER_LISTS),
}
