"""Toxicity by the nearest labelled examples, by exact TF-IDF cosine.

A bounded sample of labelled documents is the examples; the terms that tell its
classes apart are the vocabulary (words and word beginnings, so that inflected
and compound forms meet). Term weights use document frequencies over all
documents. The examples lie in an inverted index by blocks of neighbours in
vector space, which keeps for each term and block the largest weight; blocks are
visited from the highest possible cosine down, until no block can reach the
k-th best, so the k nearest are exact. Their votes are weighted by closeness and
turned into probabilities by a curve fitted on the examples, each without itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, stored, text_chunks, with_row_keys

WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7)
STORE_WORDS = 300_000
BLOCK = 64
ROWS_A_TASK = 50_000


def held_out(doc_id: str) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


class Terms:
    """Counts of the vocabulary's terms in texts; words are looked up once a worker."""

    def __init__(self, vocabulary: list[str]):
        self.number = {term: i for i, term in enumerate(vocabulary)}
        self.known: dict[str, tuple[int, ...]] = {}

    def counts(self, text: str) -> dict[int, int]:
        if len(self.known) > STORE_WORDS:
            self.known.clear()
        known, words = self.known, WORDS.findall(text.lower())
        for word in set(words).difference(known):
            known[word] = tuple(self.number[t] for t in terms_of(word) if t in self.number)
        found: Counter = Counter()
        for numbers in filter(None, map(known.__getitem__, words)):
            found.update(numbers)
        return found


class BlockMaxIndex:
    """Unit vectors of the examples by term, and the largest weight of each block."""

    def __init__(self, vectors: list[dict[int, float]], labels: np.ndarray, ids: list, k: int):
        # Similar examples next to each other make blocks that can be passed over.
        order = sorted(
            range(len(vectors)),
            key=lambda i: sorted(((-w, t) for t, w in vectors[i].items()))[:3],
        )
        self.k, self.size = k, len(vectors)
        self.place = {old: new for new, old in enumerate(order)}
        self.labels, self.ids = labels[order], [ids[i] for i in order]
        self.blocks = -(-self.size // BLOCK)
        rows: dict[int, list[tuple[int, float]]] = {}
        for new, old in enumerate(order):
            for term, weight in vectors[old].items():
                rows.setdefault(term, []).append((new, weight))
        self.postings, self.tops = {}, {}
        for term, entries in rows.items():
            examples = np.array([e for e, _ in entries])
            weights = np.array([w for _, w in entries])
            starts = np.searchsorted(examples, np.arange(self.blocks + 1) * BLOCK)
            top = np.zeros(self.blocks)
            np.maximum.at(top, examples // BLOCK, weights)
            self.postings[term], self.tops[term] = (examples, weights, starts), top

    def nearest(self, vector: dict[int, float], skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples with a cosine above 0, the closest first, ties in index order."""
        best, cosines, _ = self.with_ties(vector, skip)
        return best[: self.k], cosines[: self.k]

    def with_ties(
        self, vector: dict[int, float], skip: int = -1
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k nearest and all as close as the k-th, their cosines and their parts.

        An example closer than the k-th counts whole; those as close as the k-th
        share what is left of k evenly, so no order among them decides.
        """
        terms = [(t, w) for t, w in vector.items() if t in self.postings]
        bound = np.zeros(self.blocks)
        for term, weight in terms:
            bound += weight * self.tops[term]
        best, cosines, worst = np.empty(0, int), np.empty(0), 0.0
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or (len(best) >= self.k and bound[block] < worst - 2e-12):
                break
            scores = np.zeros(BLOCK)
            for term, weight in terms:
                examples, weights, starts = self.postings[term]
                part = slice(starts[block], starts[block + 1])
                scores[examples[part] - block * BLOCK] += weight * weights[part]
            if skip // BLOCK == block:
                scores[skip % BLOCK] = 0
            found = np.flatnonzero(scores)
            best = np.concatenate([best, found + block * BLOCK])
            cosines = np.concatenate([cosines, scores[found]])
            near = np.round(cosines, 12)
            top = np.lexsort((best, -near))
            if len(top) >= self.k:
                worst = near[top[self.k - 1]]
                top = top[near[top] >= worst]
            best, cosines = best[top], cosines[top]
        parts = np.ones(len(best))
        if len(best) > self.k:
            tied = np.round(cosines, 12) <= worst
            parts[tied] = (self.k - np.count_nonzero(~tied)) / np.count_nonzero(tied)
        return best, cosines, parts


class Scorer:
    """Probabilities from votes: the index, the weights and the fitted curve."""

    def __init__(self, index: BlockMaxIndex, idf: np.ndarray, rates: tuple[float, float]):
        self.index, self.idf, self.rates = index, idf, rates
        self.curve, self.without = (0.0, 0.0), 0.0

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {t: (1 + math.log(n)) * self.idf[t] for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / length for t, w in weights.items()}

    def vote(self, vector: dict[int, float], skip: int = -1) -> tuple[float | None, np.ndarray]:
        best, cosines, parts = self.index.with_ties(vector, skip)
        if not len(best):
            return None, best
        labels = self.index.labels[best]
        weights = parts * cosines**2 * np.where(labels == 1, self.rates[1], self.rates[0])
        return float(weights @ labels / weights.sum()), best

    def fit(self, vectors: list[dict[int, float]], labels: np.ndarray) -> None:
        """The curve from votes to probabilities, each example voted on by the others."""
        importance = np.where(labels == 1, self.rates[1], self.rates[0])
        votes = [self.vote(v, self.index.place[i])[0] if v else None for i, v in enumerate(vectors)]
        voted = np.array([v is not None for v in votes], dtype=bool)
        rest = importance * ~voted
        self.without = float((rest @ labels + 0.1) / (rest.sum() + 1))
        x = np.array([v if v is not None else 0.0 for v in votes])[voted]
        y, w = labels[voted].astype(float), importance[voted]
        design = np.column_stack([x - 0.5, np.ones(len(x))])
        a = np.array([4.0, 0.0])
        # Newton steps on the logistic loss; a small ridge keeps the slope finite.
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
            gradient = design.T @ (w * (p - y)) + 0.05 * (a - [4.0, 0.0])
            hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            a -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        self.curve = float(max(a[0], 0.0)), float(a[1])

    def score(self, counts: dict[int, int]) -> tuple[float, list]:
        vote, best = self.vote(self.vector(counts)) if counts else (None, [])
        if vote is None:
            return self.without, []
        z = self.curve[0] * (vote - 0.5) + self.curve[1]
        return 1 / (1 + math.exp(-z)), [self.index.ids[i] for i in best[:3]]


def training_rows(labels: DataFrame, target: str, examples: int) -> DataFrame:
    """(example_id, label): at most half of ``examples`` of each class, drawn by a digest."""
    known = labels.filter(
        F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out("doc_id")
    )
    known = known.groupBy(F.col("doc_id").alias("example_id")).agg(F.max(target).alias("label"))
    drawn = [
        known.filter(F.col("label") == label).orderBy(F.xxhash64("example_id")).limit(examples // 2)
        for label in (0, 1)
    ]
    return drawn[0].unionByName(drawn[1])


def vocabulary(train: DataFrame, least: float, times: float) -> list[str]:
    """All terms whose presence tells the classes apart.

    Their chi-square is at least ``least``, and they are ``times`` as frequent in
    one class as in the other: words of a language or a subject that one class
    merely has more of are left out. What counts is the number of different
    surroundings a term stands in within each class, one for each text, so that the
    words of copies and of passages that many texts share are not taken for
    evidence, and words that both classes use in the same surroundings are none.
    """

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            types = pa.string(), pa.string(), pa.int32()
            terms, places, labels = [], [], []
            for text, label in zip(texts, batch.column("label").to_pylist()):
                words = WORDS.findall(text.lower())
                found: dict[str, str] = {}
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    new = [term for term in terms_of(word) if term not in found]
                    found.update(dict.fromkeys(new, f"{before} {word} {after}"))
                terms += found
                places += found.values()
                labels += [label] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((terms, places, labels), types)],
                names=["term", "place", "label"],
            )

    totals = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"))
    n, toxic = map(float, totals.first())
    if not 0 < toxic < n:
        return []
    both, seen = F.col("both").cast("double"), F.col("seen")
    off = both * n - seen * toxic
    chi = off * off * n / (seen * (n - seen) * toxic * (n - toxic))
    telling = (
        map_arrow(
            train.select("text", "label"), presence, "term string, place string, label int"
        )
        .select("term", F.xxhash64("place").alias("place"), "label")
        .distinct()
        .groupBy("term")
        .agg(F.count("*").cast("double").alias("seen"), F.sum("label").alias("both"))
        .filter((F.col("seen") >= 4) & (F.col("seen") < n))
        .withColumn("chi", chi)
        .withColumn("odds", (both + 0.5) / toxic / ((seen - both + 0.5) / (n - toxic)))
        .filter((F.col("chi") >= least) & ~F.col("odds").between(1 / times, times))
    )
    return sorted(row["term"] for row in telling.select("term").collect())


def with_counts(docs: DataFrame, keep: list[str], terms: list[str]) -> DataFrame:
    """The kept columns with the vocabulary's terms in each text and how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Terms(terms)
        for batch, texts in text_chunks(batches, "counted_text"):
            found = [counter.counts(text) for text in texts]
            columns = [batch.column(name) for name in keep]
            columns.append(pa.array([list(c) for c in found], pa.list_(pa.int32())))
            columns.append(pa.array([list(c.values()) for c in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "terms", "times"])

    narrow = docs.select(*keep, F.col("text").alias("counted_text"))
    empty = F.array().cast("array<int>")
    schema = narrow.select(*keep, empty.alias("terms"), empty.alias("times")).schema
    return map_arrow(narrow, count, schema)


def document_frequencies(counted: DataFrame, size: int) -> dict[int, int]:
    """In how many of all documents each of the ``size`` terms occurs.

    Added up within each task, which gives a row for each term at most.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen])], names=["term", "documents"]
        )

    parts = map_arrow(counted.select("terms"), add, "term int, documents bigint")
    rows = parts.groupBy("term").agg(F.sum("documents").alias("documents")).collect()
    return {row["term"]: row["documents"] for row in rows}


def scored(
    docs: DataFrame,
    labels: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    target: str = "toxic",
    examples: int = 6000,
    chi_square: float = 25.0,
    odds: float = 3.0,
    neighbours: int = 15,
) -> DataFrame:
    """The kept columns with ``score`` and ``evidence``, the nearest examples' ids.

    ``examples`` bounds the fitted model: that many labelled documents at most,
    half of each class, and of their terms all that tell the classes apart. Texts
    without a known term (null and empty ones too) get the rate of such examples. Label
    rows that repeat an id count as toxic if any says so; null ids or labels
    teach nothing. Without labels of both classes every score is that of an
    unknown text. An empty table gives no rows.
    """
    drawn = training_rows(labels, target, examples)
    rows = docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("example_id"))
    # Copies of a text are one example, toxic if any of them is.
    text = F.coalesce("text", F.lit(""))
    distinct = rows.groupBy(F.xxhash64(text).alias("digest"), F.length(text).alias("length"))
    train = distinct.agg(
        F.min("doc_id").alias("doc_id"),
        F.max("label").cast("int").alias("label"),
        F.any_value(text).alias("text"),
    )
    train = stored(train.select("doc_id", "label", "text"), "toxic-train")
    chosen = vocabulary(train, chi_square, odds)
    counted = stored(with_counts(docs, [*keep], chosen), "toxic-counts")

    seen, total = document_frequencies(counted, len(chosen)), counted.count()
    idf = np.full(len(chosen), math.log(1 + total) + 1)
    for term, documents in seen.items():
        idf[term] = math.log((1 + total) / (1 + documents)) + 1
    known = labels.filter(F.col(target).isin(0, 1) & ~held_out("doc_id"))
    class_rows = dict(known.groupBy(target).count().collect())
    taken = dict(train.groupBy("label").count().collect())
    rates = tuple(class_rows.get(c, 0) / max(1, taken.get(c, 0)) for c in (0, 1))

    held = (
        with_counts(train, ["doc_id", "label"], chosen)
        .orderBy("terms", "times", "doc_id")
        .collect()
    )
    answers = np.array([row["label"] for row in held], dtype=int)
    scorer = Scorer(None, idf, rates)
    vectors = [scorer.vector(dict(zip(row["terms"], row["times"]))) for row in held]
    scorer.index = BlockMaxIndex(vectors, answers, [row["doc_id"] for row in held], neighbours)
    scorer.fit(vectors, answers)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_scores: dict = {}
        for batch in batches:
            lists = zip(batch.column("terms").to_pylist(), batch.column("times").to_pylist())
            scores, evidence = [], []
            for numbers, times in lists:
                key = tuple(sorted(zip(numbers, times)))
                if key not in known_scores:
                    if len(known_scores) > 50_000:
                        known_scores.clear()
                    known_scores[key] = scorer.score(dict(key))
                scores.append(known_scores[key][0])
                evidence.append(known_scores[key][1])
            columns = [batch.column(name) for name in keep]
            columns += [pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "evidence"])

    ids = F.array().cast("array<bigint>").alias("evidence")
    schema = counted.select(*keep, F.lit(0.0).alias("score"), ids).schema
    # Counts are few bytes and long work, so tasks are dealt by rows, not by bytes.
    tasks = max(4 * docs.sparkSession.sparkContext.defaultParallelism, total // ROWS_A_TASK + 1)
    return map_arrow(counted.repartition(tasks), score, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **how) -> DataFrame:
    """doc_id, held_out, score, predicted (score at least ``threshold``) and evidence."""
    return scored(docs, labels, **how).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **how) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns only."""
    keyed, keys = with_row_keys(docs, "toxicity-docs")
    rejected = scored(keyed, labels, tuple(keys), **how).filter(F.col("score") >= threshold)
    return keyed.join(rejected.select(*keys), keys, "left_anti").select(*docs.columns)
