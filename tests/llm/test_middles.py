"""Fill-in-the-middle against a plain version, piece by piece and whole."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pytest

from millrace.llm import middles
from millrace.llm.queries import QUERIES
from odd_corpus import nothing, odd, odd_rows, prose  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain(doc_id, text, shares=middles.Shares()):
    """The row of a document, and its output."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"{shares.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    lo, hi = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 100 - shares.plain:
        return (doc_id, n, "plain", None, None), text
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < shares.spm:
        return (doc_id, n, "spm", lo, hi - lo), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (doc_id, n, "psm", lo, hi - lo), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def wanted(rows, **how):
    found = []
    for doc_id, text in rows:
        head, output = plain(doc_id, text, **how)
        found.append((*head, sha(output), sha(text)))
    return sorted(found, key=repr)


def strange_texts():
    draw = random.Random(4)
    signs = ["<", ">", "P", "S", "M", "<P", "S>", "<<", "é", "😀", "é", "\n", "\x00", "a b "]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(300)]
    return [(i, text) for i, text in enumerate(texts)] + [(7, "same"), (7, "same"), (7, "other"), (None, "x y")]


@pytest.mark.parametrize("chunk", [1, 2, 7, 2048])
def test_strange_texts(spark, chunk):
    rows = strange_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = middles.digests(docs, chunk=chunk).collect()
    assert sorted(map(tuple, found), key=repr) == wanted(rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_odd_corpus(odd, odd_rows, nothing):  # noqa: F811
    found = middles.digests(odd)
    assert sorted(map(tuple, found.collect()), key=repr) == wanted([r[:2] for r in odd_rows])
    assert middles.digests(nothing).count() == 0 and middles.transformed(nothing).count() == 0


def test_outputs_and_their_texts(odd, odd_rows):  # noqa: F811
    shares = middles.Shares(plain=30, spm=60, seed="other")
    found = middles.transformed(odd, shares=shares, chunk=100).collect()
    expected = [(*head, out) for head, out in (plain(*row[:2], shares=shares) for row in odd_rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    texts = sorted(row[1] or "" for row in odd_rows)
    assert sorted(middles.restored(r.output, r.form) for r in found) == texts


def test_one_shuffle_for_both_orders(spark, odd):  # noqa: F811
    plan = middles.digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(document") == 1 and plan.count("Exchange ") == 1
    assert plan.count("Sort [document") == 2


def test_a_hot_id_is_as_many_documents(spark):
    """Rows are told apart by their place, so one id may stand on any number of them."""
    rows = [(5, prose(random.Random(i), 30)) for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = middles.digests(docs, chunk=20).collect()
    assert sorted(map(tuple, found), key=repr) == wanted(rows)


def test_the_sql_gives_the_same(spark):
    query, sql = QUERIES["op11_middles"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    frame = query(spark, SMALL)
    relation = connection.sql(sql)
    assert frame.columns == relation.columns
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(relation.fetchall(), key=repr)
