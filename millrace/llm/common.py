"""Pieces that several operators share: stored tables and Arrow batches."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.session import fresh_path, remove_path

CHUNK_BYTES = 8_000_000
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end what ``stored`` wrote inside; read its results before."""
    paths: list[str] = []
    outer = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(outer)
        for path in paths:
            remove_path(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage: what follows reads the files, and a lost executor costs a
    reread instead of the work before. The files stay unless ``scratch`` is around.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    paths = _written.get()
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_workers_import(df: DataFrame) -> None:
    """Python workers on this machine find the package wherever the driver was started.

    On a cluster the package is installed or sent with ``--py-files``, as any other.
    """
    settings = df.sparkSession.sparkContext.environment
    paths = [path for path in settings.get("PYTHONPATH", "").split(os.pathsep) if path]
    if PACKAGE_ROOT not in paths:
        settings["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def map_arrow(df: DataFrame, work: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with functions of this package."""
    let_workers_import(df)
    return df.mapInArrow(work, schema)


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of batches with about ``limit`` bytes of text (one row at least).

    A null text counts as empty.
    """
    for batch in batches:
        column = pc.fill_null(batch.column(text), "")
        sizes = pc.binary_length(column).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start), column.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start), column.slice(start)


def text_chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The same with the texts as strings."""
    for batch, column in text_slices(batches, text, limit):
        yield batch, column.to_pylist()


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it if the frame has it already."""
    taken = {name.lower() for name in df.columns}
    fresh = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        fresh.append(name)
    return fresh


def with_row_keys(docs: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """The rows with two more columns that name each row for good, and their names.

    They are the file and the place in it. A plain scan of Parquet files has them
    already; other frames are stored first. Equal rows get different keys, and a
    retried task gets the same ones.
    """
    names = fresh_names(docs, "row_file", "row_number")
    scan = as_scan(docs, label)
    row = scan.metadataColumn("_metadata")
    keys = [row["file_path"].alias(names[0]), row["row_index"].alias(names[1])]
    return scan.select("*", *keys), names


def as_scan(docs: DataFrame, label: str) -> DataFrame:
    """The rows as a scan of Parquet files, which gives a retried task the same ones again."""
    return docs if _is_scan(docs) else stored(docs, label)


def _is_scan(df: DataFrame) -> bool:
    """Whether the frame is a scan of Parquet files, with columns or rows left out at most.

    Anything else may give a row of a file more than once.
    """
    plan = df._jdf.queryExecution().analyzed().toString()
    nodes = [re.sub(r"^[\s:+-]+", "", line) for line in plan.strip().splitlines()]
    simple = all(re.match("Project |Filter |SubqueryAlias |Relation ", node) for node in nodes)
    return simple and bool(re.search(r"\] parquet$", nodes[-1]))
