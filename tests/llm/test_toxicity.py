"""Toxicity: the index against brute force, the score by held-out accuracy."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_the_exact_neighbours(seed):
    random_ = random.Random(seed)
    vectors = []
    for _ in range(500):
        terms = random_.sample(range(30), random_.randint(0, 6))
        raw = {t: random_.choice([1.0, 2.0, 3.5]) for t in terms}
        length = sum(w * w for w in raw.values()) ** 0.5
        vectors.append({t: w / length for t, w in raw.items()})
    labels = np.array([random_.randint(0, 1) for _ in vectors])
    index = toxicity.BlockMaxIndex(vectors, labels, list(range(500)), 15)
    cosine = lambda a, b: sum(w * b.get(t, 0.0) for t, w in a.items())
    for i in range(0, 500, 25):
        skip = index.place[i]
        found, cosines = index.nearest(vectors[i], skip)
        all_ = sorted((cosine(vectors[i], v) for j, v in enumerate(vectors) if j != i), reverse=True)
        wanted = [c for c in all_ if c > 0][:15]
        assert np.allclose(cosines, wanted)
        for place, c in zip(found, cosines):
            assert cosine(vectors[i], vectors[index.ids[place]]) == pytest.approx(c)


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op6_toxicity"][0](spark, MEDIUM).collect()


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in scored) == sorted(docs)
    for row in scored:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    held = [(labels[r.doc_id], r) for r in scored if r.held_out and r.doc_id in labels]
    flagged = [label for label, r in held if r.predicted]
    assert sum(flagged) >= 0.85 * len(flagged)
    assert sum(flagged) >= 0.75 * sum(label for label, _ in held)


def test_scores_ignore_held_out_labels(spark, scored):
    """Turning every held-out label over changes nothing."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    turned = labels.withColumn(
        "toxic",
        toxicity.F.when(toxicity.held_out("doc_id"), 1 - labels.toxic).otherwise(labels.toxic),
    )
    found = toxicity.toxicity(docs, turned).collect()
    assert {r.doc_id: r.score for r in found} == {r.doc_id: r.score for r in scored}


LABELS = "doc_id bigint, toxic int, quality int, score string"


def corpus(spark):
    random_ = random.Random(2)
    plain = "river stone cloud tree bread light window garden paper music".split()
    rows, labels = [], []
    for i in range(600):
        words = random_.choices(plain, k=30)
        toxic = i % 5 == 0
        if toxic:
            words[3:5] = random_.sample(["grobnik", "grobniks", "snarlop"], 2)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic), 1, "z"))
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "grobnik " * 20_000, "x"), (None, "tree", "x")]
    rows += [rows[0], rows[0]]
    labels += [(None, 1, 1, "z"), (3, None, 1, "z"), (1, 0, 1, "z"), (77_777, 1, 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    return docs, spark.createDataFrame(labels, LABELS), rows


def test_odd_rows(spark):
    docs, labels, rows = corpus(spark)
    found = toxicity.toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    scores = {r.doc_id: r.score for r in found}
    assert scores[1000] == scores[1001] < 0.3
    assert scores[1002] > 0.7
    assert all((r.score >= 0.7) == (r.doc_id % 5 == 0) for r in found if r.doc_id in range(600))
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    clean = Counter(r for r in rows if scores[r[0]] < 0.7)
    assert Counter(map(tuple, kept.collect())) == clean


def test_nothing_to_learn_or_to_score(spark):
    docs, labels, rows = corpus(spark)
    for known in (labels.limit(0), labels.filter("toxic = 0")):
        found = toxicity.toxicity(docs, known).collect()
        assert len(found) == len(rows) and all(r.predicted == 0 for r in found)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_examples_are_bounded(spark):
    _, labels, _ = corpus(spark)
    drawn = toxicity.training_rows(labels, "toxic", 40).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in drawn} == {0: 20, 1: 20}


def test_words_of_copies_are_no_evidence(spark):
    docs, labels, _ = corpus(spark)
    toxic = "river grobnik stone snarlop cloud mirkwood tree bread light window"
    copies = [(2000 + i, toxic, "x") for i in range(60)]
    near = [(2100 + i, f"{toxic} garden paper music {i}", "x") for i in range(60)]
    clean = [(2200, "river stone mirkwood cloud tree", "x"), (2201, "mirkwood light bread", "x")]
    more = spark.createDataFrame(copies + near + clean, docs.schema)
    known = spark.createDataFrame([(r[0], 1, 1, "z") for r in copies + near], LABELS)
    found = toxicity.toxicity(docs.union(more), labels.union(known)).collect()
    scores = {r.doc_id: r.score for r in found}
    assert scores[2200] < 0.3 and scores[2201] < 0.3
    assert min(scores[r[0]] for r in copies + near) > 0.7


def test_examples_as_close_as_the_last_share_its_place():
    """20 clean and 80 toxic examples with one vector vote the share of the toxic."""
    for labels in ([0] * 20 + [1] * 80, [1] * 80 + [0] * 20):
        vectors = [{0: 1.0}] * 100
        index = toxicity.BlockMaxIndex(vectors, np.array(labels), list(range(100)), 15)
        scorer = toxicity.Scorer(index, np.ones(1), (1.0, 1.0))
        assert scorer.vote({0: 1.0})[0] == pytest.approx(0.8)
        assert len(index.nearest({0: 1.0})[0]) == 15


@pytest.mark.parametrize("seed", range(3))
def test_votes_against_all_examples(seed):
    random_ = random.Random(seed)
    unit = lambda raw: {t: w / sum(x * x for x in raw.values()) ** 0.5 for t, w in raw.items()}
    vectors = [unit({t: 1.0 for t in random_.sample(range(6), 3)}) for _ in range(300)]
    labels = np.array([random_.randint(0, 1) for _ in vectors])
    index = toxicity.BlockMaxIndex(vectors, labels, list(range(300)), 15)
    scorer = toxicity.Scorer(index, np.ones(6), (1.0, 2.0))
    for vector in vectors[:20]:
        cosines = [round(sum(w * v.get(t, 0.0) for t, w in vector.items()), 12) for v in vectors]
        last = sorted(cosines, reverse=True)[14]
        closer, tied = sum(c > last for c in cosines), sum(c == last for c in cosines)
        votes = [0.0, 0.0]
        for cosine, label in zip(cosines, labels):
            part = 1.0 if cosine > last else (15 - closer) / tied if cosine == last else 0.0
            votes[label] += part * cosine**2 * (1.0, 2.0)[label]
        assert scorer.vote(vector)[0] == pytest.approx(votes[1] / sum(votes))


def test_words_of_both_classes_are_no_terms(spark):
    """Neutral words in the same surroundings in both classes, more often in the toxic."""
    random_ = random.Random(3)
    neutral = [f"{a}{b}ness" for a in ("stel", "morn", "quip", "brav", "dusk") for b in ("a", "o")]
    rows = []
    for i in range(400):
        words = [w for n in random_.sample(neutral, 4) for w in ("the", n, "of")]
        # The toxic word varies its surroundings, the neutral ones have one each.
        rows.append((i, i % 2, " ".join([*words, *(["by", f"x{i}y", "grobnik"] if i % 2 else [])])))
    train = spark.createDataFrame(rows, "doc_id bigint, label int, text string")
    chosen = toxicity.vocabulary(train, 25.0, 3.0)
    assert not [term for term in chosen if term[:4] in ("stel", "morn", "quip", "brav", "dusk")]
