"""Row keys, stored tables and chunks of text."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import common
from millrace.session import shared_folder
from odd_corpus import odd, odd_rows  # noqa: F401


@pytest.mark.parametrize(
    "frame",
    [
        lambda df: df,
        lambda df: df.filter("doc_id is not null").select("doc_id", "text"),
        lambda df: df.union(df),
        lambda df: df.repartition(5),
        lambda df: df.withColumn("twice", F.explode(F.array(F.lit(1), F.lit(2)))),
        lambda df: df.crossJoin(df.limit(2).select(F.col("doc_id").alias("other"))),
    ],
)
def test_every_row_has_a_key_of_its_own(odd, frame):  # noqa: F811
    rows = frame(odd)
    keyed, keys = common.with_row_keys(rows, "keys")
    assert keyed.columns == [*rows.columns, *keys]
    assert keyed.select(*keys).distinct().count() == rows.count()


def test_scans_are_not_stored_again(odd, spark):  # noqa: F811
    keyed, _ = common.with_row_keys(odd, "never-stored")
    assert not any("never-stored" in name for name in keyed.inputFiles())


def test_names_do_not_clash(odd):  # noqa: F811
    # The fixture has a column of that name.
    assert common.fresh_names(odd, "row_file", "ROW_FILE", "new") == ["_row_file", "_ROW_FILE", "new"]


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_chunks_hold_all_rows_in_order(limit):
    texts = ["abc", None, "", "d" * 50, "e", "f"] * 5
    batch = pa.RecordBatch.from_pydict({"i": list(range(30)), "text": pa.array(texts)})
    seen = []
    for part, found in common.text_chunks(iter([batch, batch.slice(0, 0)]), limit=limit):
        assert part.num_rows == len(found)
        seen += zip(part.column("i").to_pylist(), found)
    assert seen == [(i, text or "") for i, text in enumerate(texts)]


def test_scratch_takes_its_tables_away(spark):
    kept = common.stored(spark.range(3), "kept")
    with common.scratch(spark):
        inner = common.stored(spark.range(5), "inner")
        assert inner.count() == 5
    assert kept.count() == 3
    assert not list(Path(shared_folder(spark).removeprefix("file:")).glob("inner-*"))
