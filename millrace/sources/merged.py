"""CSV files under one glob whose headers differ.

The headers are read file by file and files with equal ones are read together.
Columns are matched by name wherever they stand, types are widened to what holds
all files, and a column that a file lacks is null there. The schema found is then
pinned: give it to later reads, which need no inference.
"""

from __future__ import annotations

import csv
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from millrace.sources.text import read_lines

# Different headers that are read as one table; each is a scan of its own.
MOST_HEADERS = 100
_WIDER = [
    (IntegerType, LongType),
    (IntegerType, DoubleType),
    (LongType, DoubleType),
    (DateType, TimestampType),
]


@dataclass(frozen=True)
class Layouts:
    """The headers found with their files, one schema for all, and types that differed."""

    files: dict[tuple[str, ...], list[str]]
    schema: StructType
    widened: dict[str, tuple[str, ...]]


def headers(spark: SparkSession, path: str | list[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Files without a line have none and are left out.

    As much as a listing of the files reaches the driver. A header with a name that
    is empty or stands twice cannot be matched: such files are named in the error.
    """
    known = F.col("_metadata")
    first = (
        read_lines(spark, path)
        .select(
            known["file_path"].alias("file"),
            known["file_block_start"].alias("start"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
        .filter(F.col("start") == 0)
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in grouped.orderBy("header").collect():
        line = row["header"].removeprefix("﻿")
        names = tuple(name.strip() for name in next(csv.reader([line], delimiter=sep), []))
        twice = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
        if twice or not all(names):
            raise ValueError(f"names {twice or ['']} cannot be matched in {row['files'][:3]}")
        found.setdefault(names, []).extend(row["files"])
    if len(found) > MOST_HEADERS:
        raise ValueError(f"{len(found)} different headers; read them as tables of their own")
    spellings: dict[str, set[str]] = {}
    for names in found:
        for name in names:
            spellings.setdefault(name.lower(), set()).add(name)
    unclear = [sorted(held) for held in spellings.values() if len(held) > 1]
    if unclear:
        raise ValueError(f"names that differ in case only: {unclear}")
    return found


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds values of both; text holds all."""
    if a == b:
        return a
    for narrow, wide in _WIDER:
        if {type(a), type(b)} == {narrow, wide}:
            return wide()
    return StringType()


def _is_empty(name: str, rows: DataFrame) -> bool:
    return rows.filter(F.col(name).isNotNull()).head(1) == []


def layouts(spark: SparkSession, path: str | list[str], sep: str = ",") -> Layouts:
    """Headers, and the schema that holds all files: one inferring read for each header.

    Columns come in the order in which they are first met, headers in text order.
    A column without any value has no say in its type.
    """
    files = headers(spark, path, sep)
    types: dict[str, dict[str, DataType]] = {}
    for names, held in files.items():
        rows = spark.read.option("sep", sep).option("header", True).option("inferSchema", True).csv(held)
        for name, kind in zip(names, [f.dataType for f in rows.schema.fields]):
            seen = types.setdefault(name, {})
            column = rows.columns[names.index(name)]
            if not (isinstance(kind, StringType) and _is_empty(f"`{column}`", rows)):
                seen[kind.simpleString()] = kind
    fields, widened = [], {}
    for name, seen in types.items():
        kinds = list(seen.values()) or [StringType()]
        kind = kinds[0]
        for other in kinds[1:]:
            kind = wider(kind, other)
        # Widening two at a time must not depend on their order.
        if any(isinstance(k, (BooleanType, DateType, TimestampType)) for k in kinds) and any(
            isinstance(k, (IntegerType, LongType, DoubleType)) for k in kinds
        ):
            kind = StringType()
        fields.append(StructField(name, kind))
        if len(seen) > 1:
            widened[name] = tuple(sorted(seen))
    return Layouts(files, StructType(fields), widened)


def read_merged(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """All rows of the files under one schema, columns matched by name.

    With ``schema`` nothing is inferred: columns that it does not name are left out
    and those that a file lacks are null. Without it the one of ``layouts`` holds.
    """
    if schema is None:
        known = layouts(spark, path, sep)
        files, schema = known.files, known.schema
    else:
        files = headers(spark, path, sep)
        schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kinds = {field.name: field.dataType for field in schema.fields}
    whole = spark.createDataFrame([], schema)
    for names, held in files.items():
        own = StructType([StructField(name, kinds.get(name, StringType())) for name in names])
        rows = spark.read.schema(own).option("sep", sep).option("header", True).csv(held)
        columns = [
            F.col(f"`{name}`") if name in names else F.lit(None).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
        whole = whole.unionByName(rows.select(*columns))
    return whole
