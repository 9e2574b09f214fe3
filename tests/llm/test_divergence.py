"""Divergence of sources against a plain version with a row for every term."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from millrace.llm import divergence as d
from millrace.llm.queries import QUERIES
from odd_corpus import nothing, odd, odd_rows  # noqa: F401

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(d.CAPITALS, d.CAPITALS.lower())


def plain(rows, least_docs=10, top=10):
    """(lang, source, text) rows to the rows of the report."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: [t for t, n in found.items() if n >= least_docs] for lang, found in docs.items()}

    def shares(count, terms):
        total = sum(count[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10**9 * (count[t] + 2) // total for t in terms}

    def gap(p, q):
        return (p - q) ** 2 // (p + q)

    ps = {g: shares(count, kept[g[0]]) for g, count in counts.items()}
    result = []
    for (lang, source), p in ps.items():
        whole = Counter()
        for other in counts:
            if other[0] == lang:
                whole.update(counts[other])
        q = shares(whole, kept[lang])
        pairs = [
            (sum(gap(p[t], ps[other][t]) for t in kept[lang]), other[1])
            for other in counts
            if other[0] == lang and other[1] != source
        ]
        terms = [
            (gap(p[t], q[t]), t) for t in kept[lang] if counts[lang, source][t] and p[t] > q[t]
        ]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            result += [(lang, source, part, item, v, i) for i, (v, item) in enumerate(found[:most], 1)]
    return sorted(result)


def report(spark, rows, parts=4, **how):
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(parts)
    found = d.divergence(docs, **how)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, found.collect()))


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["the", "The", "a", "Ä", "é", "straße", "x-y", "co2", "zum", "日本"] + [f"w{chr(97 + i)}" for i in range(90)]
    rows = []
    for _ in range(n):
        lang = draw.choice(["en", "de", None, ""])
        source = draw.choice(["s1", "s1", "s1", "s2", "é", "Z", "a", None, ""])
        weights = [1 / (1 + (i * (len(source or "") + 1)) % 97) for i in range(len(words))]
        rows.append((lang, source, " ".join(draw.choices(words, weights, k=draw.randint(0, 60)))))
    return rows


@pytest.mark.parametrize("seed, least_docs, top", [(1, 10, 10), (2, 3, 2), (3, 1, 100), (4, 1000, 10)])
def test_against_a_row_for_every_term(spark, seed, least_docs, top):
    rows = corpus(seed, 300)
    assert report(spark, rows, least_docs=least_docs, top=top) == plain(rows, least_docs, top)


def test_many_counts_in_a_word_and_groups_without_terms(spark):
    rows = [("en", "a", " ".join(f"t{chr(97 + i)}" * 1 + " " for i in range(26) for _ in range(i * 7)))] * 3
    rows += [("en", "b", "ta tb tz tz")] * 2 + [("en", "empty", ""), ("en", "null", None), ("xx", "alone", "q")]
    rows += [("yy", "one", "12 34"), ("yy", "two", None)]
    assert report(spark, rows, least_docs=2) == plain(rows, 2)


def test_odd_corpus(spark, odd, odd_rows, nothing):  # noqa: F811
    found = sorted(map(tuple, d.divergence(odd, least_docs=2).collect()))
    assert found == plain([(r[2], r[3], r[1]) for r in odd_rows], 2)
    assert d.divergence(nothing).count() == 0


def test_large_counts_stay_exact(spark):
    """Ten billion occurrences: the products are beyond 64 bits."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(10**13 + 7, 3 * 10**13 + 1, 5)], "n long, total long, v long")
    p = frame.select(d.share(F.col("n"), F.col("total"), F.col("v"))).first()[0]
    assert p == 1 + 10**9 * (10**13 + 9) // (3 * 10**13 + 11)


def test_the_sql_gives_the_same(spark):
    query, sql = QUERIES["op13_divergence"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    found = sorted(map(tuple, query(spark, SMALL).collect()))
    assert found and found == sorted(connection.sql(sql).fetchall())


def test_no_python_in_the_plan(spark):
    found = d.divergence(spark.read.parquet(f"{SMALL}/documents.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
