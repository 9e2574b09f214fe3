"""Best days and years, in batch and from a stream of files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.numeric import to_int
from millrace.operators.totals import first_match, leaders, top_groups, total_by
from millrace.session import fresh_path, remove_path
from millrace.sources.csv import write_csv
from millrace.sources.tables import table
from millrace.streaming.files import csv_stream, parquet_stream, run_to_parquet, run_to_table
from millrace.streaming.keyed import keyed_table, start_keyed
from millrace.streaming.totals import running_leaders, running_totals

# The stream reports take the tables as so many files at least, a few a batch.
ARRIVALS = 4
FILES_PER_BATCH = 2
AMOUNT = "l_quantity * l_extendedprice"


def _day(column: str) -> F.Column:
    return F.to_date(column).cast("string").alias("day")


def _to_cents(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.round("total", 2))


def best_days(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        _day("l_shipdate"), "l_quantity", "l_extendedprice"
    )
    return _to_cents(top_groups(rows, "day", AMOUNT))


def best_days_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream of CSV shards, with the schema of the batch frame."""
    path = fresh_path(spark, "sales-csv")
    rows = table(spark, folder, "lineitem").select(
        _day("l_shipdate"), "l_quantity", "l_extendedprice"
    )
    write_csv(rows.repartition(ARRIVALS), path, rows_per_file=1_000_000)
    stream = csv_stream(spark, f"{path}/*.csv", rows.schema, files_per_batch=FILES_PER_BATCH)
    best = running_leaders(stream, "day", AMOUNT)
    found = run_to_table(best, f"best_days_{uuid.uuid4().hex}", limit=10)
    remove_path(spark, path)
    return _to_cents(found)


@contextmanager
def arriving_events(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The events as files that arrive a few at a time; deleted at the end."""
    path = fresh_path(spark, "events-arriving")
    events = table(spark, folder, "events").select(_day("ts"), "value")
    try:
        events.repartition(ARRIVALS).write.parquet(path)
        yield parquet_stream(spark, path, events.schema, files_per_batch=FILES_PER_BATCH)
    finally:
        remove_path(spark, path)


def best_days_stream(spark: SparkSession, folder: str) -> DataFrame:
    with arriving_events(spark, folder) as events:
        best = running_leaders(events, "day", "value")
        return _to_cents(run_to_table(best, f"best_event_days_{uuid.uuid4().hex}", limit=10))


def daily_totals_stream(spark: SparkSession, folder: str) -> DataFrame:
    with arriving_events(spark, folder) as events:
        totals = running_totals(events, "day", "value")
        return _to_cents(run_to_parquet(totals, fresh_path(spark, "daily-totals")))


def daily_totals_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by day in a keyed table: half of the files arrive, the stream stops and goes on."""
    arriving, path, state = (fresh_path(spark, f"kept-{name}") for name in ("in", "totals", "state"))
    events = table(spark, folder, "events").select(_day("ts"), "value")
    halves = [events.filter("pmod(xxhash64(day, value), 2) = 0"), events.filter("pmod(xxhash64(day, value), 2) = 1")]
    schema = StructType.fromDDL("day string, total double")
    for half in halves:
        half.repartition(ARRIVALS).write.mode("append").parquet(arriving)
        stream = parquet_stream(spark, arriving, events.schema, files_per_batch=1)
        totals = total_by(stream, "day", "value")
        start_keyed(totals, path, state, ["day"], merge_every=3).awaitTermination()
    remove_path(spark, arriving)
    remove_path(spark, state)
    return _to_cents(keyed_table(spark, path, schema, ["day"]))


def units_per_year(spark: SparkSession, folder: str) -> DataFrame:
    """Whole units sold per year: a sum of ints, kept as bigint."""
    rows = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("int").alias("units")
    )
    return total_by(rows, "year", "units", "total_units")


def units_per_year_int(spark: SparkSession, folder: str) -> DataFrame:
    """The same narrowed to int, null where a sum no longer fits."""
    total = F.col("total_units")
    return units_per_year(spark, folder).withColumn("total_units", to_int(total))


def best_year(spark: SparkSession, folder: str) -> DataFrame:
    return leaders(units_per_year(spark, folder), "total_units", "year", 1)


def one_year(spark: SparkSession, folder: str) -> DataFrame:
    return first_match(units_per_year(spark, folder), "year = 1998")


def _best(table_name: str, day: str, amount: str, limit: str) -> str:
    return f"""
SELECT CAST(CAST({day} AS DATE) AS VARCHAR) AS day, round(sum({amount}), 2) AS total
FROM {table_name} GROUP BY 1 ORDER BY sum({amount}) DESC, 1 {limit}
"""


UNITS = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_units
FROM lineitem GROUP BY 1
"""

QUERIES = {
    "best_days": (best_days, _best("lineitem", "l_shipdate", AMOUNT, "LIMIT 10")),
    "best_days_csv_stream": (
        best_days_csv_stream,
        _best("lineitem", "l_shipdate", AMOUNT, "LIMIT 10"),
    ),
    "best_days_stream": (best_days_stream, _best("events", "ts", "value", "LIMIT 10")),
    "daily_totals_stream": (daily_totals_stream, _best("events", "ts", "value", "")),
    "daily_totals_kept": (daily_totals_kept, _best("events", "ts", "value", "")),
    "year_totals": (units_per_year, UNITS),
    "year_totals_int": (
        units_per_year_int,
        f"SELECT year, TRY_CAST(total_units AS INTEGER) AS total_units FROM ({UNITS})",
    ),
    "best_year": (best_year, UNITS + "ORDER BY total_units DESC, year LIMIT 1"),
    "one_year": (one_year, f"SELECT * FROM ({UNITS}) WHERE year = 1998"),
}
