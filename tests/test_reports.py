"""Every report against its SQL on the small tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from millrace.plans.catalog import equivalent_sql, reports

ROWS_ONLY = {
    "cluster_means_2d": 5,
    "cluster_means_3d": 5,
    "cluster_means_3d_refit": 5,
    "labelled_means": 2,
    "elbow": 9,
}


def in_name_order(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(equivalent_sql()))
def test_report_equals_sql(spark, duck, name):
    frame = queries()[name](spark, SMALL)
    found = [tuple(row) for row in frame.collect()]
    relation = duck.sql(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert found, "an empty result proves nothing"
    wanted = in_name_order(relation.fetchall(), relation.columns)
    assert in_name_order(found, frame.columns) == wanted


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_report_without_sql_has_its_rows(spark, name):
    assert queries()[name](spark, SMALL).count() == ROWS_ONLY[name]


def test_every_report_is_covered():
    assert set(reports()) == set(equivalent_sql()) | set(ROWS_ONLY)
    assert set(queries()) >= set(reports()) and set(oracle_sql()) >= set(equivalent_sql())


def test_entry(spark):
    assert entry(spark).count() == 10
