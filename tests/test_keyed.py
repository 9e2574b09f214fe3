"""The keyed table of a stream: restarts, repeated batches, merging."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.totals import total_by
from millrace.streaming import keyed
from millrace.streaming.files import parquet_stream

SCHEMA = "day string, value bigint"


def arrive(spark, folder, number):
    """One more file: a hot day, one of few days, a null day and a day of its own."""
    rows = [("hot", 1)] * 20 + [(f"d{number % 3}", number), (None, 1), (f"own{number}", 5)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def wanted(count):
    totals = {"hot": 20 * count, None: count}
    for number in range(count):
        totals[f"own{number}"] = 5
        totals[f"d{number % 3}"] = totals.get(f"d{number % 3}", 0) + number
    return totals


def rows_of(spark, path, schema):
    found = keyed.keyed_table(spark, path, schema, ["day"]).collect()
    assert len({r.day for r in found}) == len(found)
    return {r.day: r.total for r in found}


@pytest.fixture
def places(tmp_path):
    return tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")


def totals(spark, folder):
    stream = parquet_stream(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, 1)
    return total_by(stream, "day", "value")


def test_restarts_and_merging(spark, places):
    folder, path, state = places
    number = 0
    for _ in range(3):
        for _ in range(3):
            arrive(spark, folder, number)
            number += 1
        result = totals(spark, folder)
        keyed.start_keyed(result, path, state, ["day"], merge_every=2).awaitTermination()
        assert rows_of(spark, path, result.schema) == wanted(number)
    names = sorted(p.name for p in Path(path).iterdir())
    # Nine batches: the last base and the one batch after it.
    assert names == ["base=7", "batch=8"]


def test_a_batch_that_fails_is_run_again(spark, places, monkeypatch):
    folder, path, state = places
    for number in range(4):
        arrive(spark, folder, number)
    result, write, failures = totals(spark, folder), keyed.write_changes, []

    def breaking(batch, number, *rest):
        if number == 2 and not failures:
            # Half a batch: its rows lie there, the stream does not know of it.
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
            failures.append(number)
            raise RuntimeError("lost")
        write(batch, number, *rest)

    monkeypatch.setattr(keyed, "write_changes", breaking)
    with pytest.raises(Exception, match="lost"):
        keyed.start_keyed(result, path, state, ["day"], merge_every=3).awaitTermination()
    keyed.start_keyed(totals(spark, folder), path, state, ["day"], merge_every=3).awaitTermination()
    assert rows_of(spark, path, result.schema) == wanted(4)


def test_a_batch_run_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    batches = [[("a", 1), (None, 1)], [("a", 2), ("b", 7)], [("b", 8)], [("a", 9)]]
    kind = "day string, total bigint"
    schema = spark.createDataFrame([], kind).schema
    state = {}
    for number, rows in enumerate(batches):
        state.update(rows)
        for _ in range(2):
            keyed.write_changes(spark.createDataFrame(rows, kind), number, path, ["day"], 2)
            assert rows_of(spark, path, schema) == state


def test_a_merge_cut_short_is_repeated(spark, tmp_path):
    path = str(tmp_path / "table")
    kind = "day string, total bigint"
    schema = spark.createDataFrame([], kind).schema
    for number in range(3):
        keyed.write_changes(spark.createDataFrame([("a", number)], kind), number, path, ["day"], 100)
    # A base without its mark of completion is no base.
    keyed.keyed_table(spark, path, schema, ["day"]).withColumn("total", F.lit(-1).cast("bigint")).write.parquet(f"{path}/base=2")
    (Path(path) / "base=2" / "_SUCCESS").unlink()
    assert rows_of(spark, path, schema) == {"a": 2}
    keyed.merge(spark, path, schema, ["day"], 2)
    assert rows_of(spark, path, schema) == {"a": 2}
    assert [p.name for p in Path(path).iterdir()] == ["base=2"]
    # Nothing deleted yet: the base rules over what it holds.
    spark.createDataFrame([("a", 1)], kind).write.parquet(f"{path}/batch=1")
    assert rows_of(spark, path, schema) == {"a": 2}


def test_no_batches(spark, tmp_path):
    schema = spark.createDataFrame([], "day string, total bigint").schema
    assert keyed.keyed_table(spark, str(tmp_path / "none"), schema, ["day"]).count() == 0
