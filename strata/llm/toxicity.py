"""Toxicity by the nearest labelled examples.

Labelled documents are vectors of TF-IDF weights over words and beginnings of
words, each also as a term of its own where it occurs twice or four times (in
place of a factor for frequency, which a vector of length one would lose). Kept
are the terms that occur significantly more often under label 1, by a
chi-square test that Spark makes on the examples; a term's document frequency
is counted over all documents. For each text the ``K`` examples of largest
cosine are found exactly: the index is inverted, its examples lie in blocks,
and each term keeps its largest weight in each block. A text's terms give every
block an upper bound; blocks are read from the largest bound down, until no
bound can reach the K-th best.

The neighbours vote with their squared cosines against a small weight of the
prior, and a logistic curve, fitted on the examples' own votes without
themselves, weighted to the shares of the labels, makes a probability of the
vote and of how much a text's terms weigh. Each result carries its nearest
examples as evidence.

Defined cases: null and empty texts, and texts without an indexed term, have no
neighbour and get the score of no evidence; training ignores null labels and
ids; without examples of both labels every score is the share of label 1; ties
go to the block read first, then to the smaller example id; repeated rows are scored each; null ids stay
null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, first_by_hash, fold, map_rows, to_batch

#: Examples the index is fitted on, of label 1 and of label 0.
TOXIC, CLEAN = 2500, 7500
TERMS, CHI_SQUARE = 2000, 40.0
#: Bytes of the beginnings of words.
BEGINNINGS = range(4, 10)
LEVELS = ((1, b""), (2, b"+"), (4, b"++"))
K, BLOCK = 15, 32
#: Cosines that differ by less are equal.
TIE = 1e-9
#: Weight of the prior among the votes, in squared cosines.
PRIOR_VOTES = 0.05
LEAST = 0.7
SCORES = "doc_id long, held_out boolean, score double, predicted int, evidence array<long>"

_BLANKS = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or b == 95 else 32 for b in range(256)
)  # of lower-cased UTF-8: letters, digits, the underscore and all beyond ASCII stay


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANKS).split()


def terms_of(text: str | None, gate: set[bytes] | None = None) -> set[bytes]:
    """Terms of a text; with ``gate``, only of words that begin like one."""
    found = words(text)
    if gate is not None:
        found = [w for w in found if w[:4] in gate]
    counts = Counter(found)
    begun: Counter = Counter()
    for word, n in counts.items():
        for k in BEGINNINGS:
            if k >= len(word):
                break
            begun[word[:k] + b"~"] += n
    return {t + mark for c in (counts, begun) for t, n in c.items() for least, mark in LEVELS if n >= least}


class Index:
    """Block-max inverted index of labelled examples."""

    def __init__(self, terms: list[bytes], idf: np.ndarray, ids: list[int], labels: np.ndarray, texts: list[set]):
        self.place = {t: i for i, t in enumerate(terms)}
        self.idf = idf
        self.gate = {t[:4].rstrip(b"~+") for t in terms}
        vectors = [self.vector(c) for c in texts]
        # Like beside like, so that a block's largest weights are few terms'.
        order = sorted(
            (i for i, v in enumerate(vectors) if len(v[0])), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), ids[i])
        )
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.blocks = -(-len(order) // BLOCK)
        self.most = np.zeros((len(terms), self.blocks))
        # Postings by block: the place of each term in it (-1: none), and for
        # each such term the weights of the block's examples.
        self.slots = np.full((self.blocks, len(terms)), -1, np.int16)
        self.postings: list[np.ndarray] = []
        for block in range(self.blocks):
            members = order[block * BLOCK : (block + 1) * BLOCK]
            used = np.unique(np.concatenate([vectors[i][0] for i in members]))
            self.slots[block, used] = np.arange(len(used))
            weights = np.zeros((len(used), BLOCK))
            for at, i in enumerate(members):
                weights[self.slots[block, vectors[i][0]], at] = vectors[i][1]
            self.most[used, block] = weights.max(axis=1)
            self.postings.append(weights)
        self.curve = np.array([1.0, 1.0, 0.0])
        self.prior = 0.0

    def vector(self, terms: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of length one."""
        at = np.array(sorted(self.place[t] for t in terms if t in self.place), np.int64)
        weights = self.idf[at]
        norm = math.sqrt(float(weights @ weights))
        return (at, weights / norm) if norm else (at[:0], weights[:0])

    def evidence(self, terms: np.ndarray) -> float:
        """How much the terms of a text weigh together, up to about one."""
        return math.tanh(float(self.idf[terms].sum()) / 20)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K, without: int | None = None):
        """(cosines, places) of the k nearest examples that share a term,
        largest first; ties by block as read, then by id."""
        if not len(terms) or not self.blocks:
            return np.zeros(0), np.zeros(0, np.int64)
        bounds = weights @ self.most[terms]
        best: list[tuple[float, int, int]] = []
        for block in np.argsort(-bounds, kind="stable").tolist():
            if bounds[block] <= 0 or len(best) == k and bounds[block] <= TIE - best[-1][0]:
                break
            slots = self.slots[block, terms]
            there = slots >= 0
            cosines = weights[there] @ self.postings[block][slots[there]]
            found = cosines.nonzero()[0].tolist()
            best += [(-float(cosines[at]), int(self.ids[block * BLOCK + at]), block * BLOCK + at) for at in found]
            if without is not None:
                best = [b for b in best if b[2] != without]
            best = sorted(best)[:k]
        return np.array([-b[0] for b in best]), np.array([b[2] for b in best], np.int64)

    def vote(self, cosines: np.ndarray, places: np.ndarray) -> float:
        weights = cosines**2
        share = (weights @ self.labels[places] + PRIOR_VOTES * self.prior) / (weights.sum() + PRIOR_VOTES)
        return math.log((share + 1e-2) / (1 - share + 1e-2))

    def calibrate(self, toxic: int, clean: int, texts: list[set], labels: np.ndarray, ids: list[int]) -> None:
        """``toxic`` and ``clean``: labelled documents in all, beyond the examples."""
        self.prior = toxic / (toxic + clean)
        place = {i: at for at, i in enumerate(self.ids.tolist())}
        rows = []
        for terms, i in zip(texts, ids, strict=True):
            vector = self.vector(terms)
            rows.append((self.vote(*self.nearest(*vector, without=place.get(i))), self.evidence(vector[0]), 1.0))
        x = np.array(rows)
        weight = np.where(labels == 1, toxic / max(1, labels.sum()), clean / max(1, (labels == 0).sum()))
        weight = weight / weight.sum()
        curve, held = np.array([1.0, 1.0, 0.0]), np.array([1.0, 1.0, 0.0])
        for _ in range(60):  # Newton steps, held near the identity by a small penalty
            p = 0.5 * (1 + np.tanh(0.5 * (x @ curve)))
            slope = x.T @ (weight * (p - labels)) + 1e-4 * (curve - held)
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
            curve = curve - np.clip(np.linalg.solve(bend, slope), -1, 1)
        self.curve = curve

    def score(self, text: str | None) -> tuple[float, list[int]]:
        terms, weights = self.vector(terms_of(text, self.gate))
        cosines, places = self.nearest(terms, weights)
        x = float(np.array([self.vote(cosines, places), self.evidence(terms), 1.0]) @ self.curve)
        return 0.5 * (1 + math.tanh(0.5 * x)), self.ids[places].tolist()


def significant(examples: DataFrame) -> list[bytes]:
    """Terms whose presence goes with label 1, by chi-square over the examples
    (toxic, terms); at most TERMS come to the driver."""
    totals = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("yes")).first()
    n, yes = float(totals.n), float(totals.yes)
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    over = a * (n - yes - c) - (yes - a) * c
    square = n * over * over / F.greatest(F.lit(1.0), yes * (n - yes) * (a + c) * (n - a - c))
    counted = (
        examples.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("c"))
        .where("a >= 3")
    )
    kept = counted.where((over > 0) & (square >= CHI_SQUARE)).orderBy(square.desc(), "term").limit(TERMS)
    return sorted(bytes(r.term) for r in kept.select("term").collect())


def frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[int, np.ndarray]:
    """Documents in all, and how many of them hold each term."""
    place = {t: i for i, t in enumerate(terms)}
    gate = {t[:4].rstrip(b"~+") for t in terms}
    schema = arrow_schema(docs.sparkSession, "term int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            counts[-1] += batch.num_rows
            for text in batch.column(0):
                for term in terms_of(text.as_py(), gate) & place.keys():
                    counts[place[term]] += 1
        yield to_batch({"term": np.arange(len(counts), dtype=np.int32), "n": counts}, schema)

    summed = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(terms) + 1, np.int64)
    for row in summed.collect():  # a row for each indexed term
        out[row.term] = row.n
    return int(out[-1]), out[:-1]


def fit(docs: DataFrame, labels: DataFrame, *, held_out: int = 1, folds: int = 3) -> Index | float:
    """The index, or the share of label 1 where there is nothing to learn."""
    known = labels.where((fold("doc_id", folds) != held_out) & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return float(bool(totals.get(1)))
    first = lambda label, n: first_by_hash(known.where(F.col("toxic") == label), n, "doc_id", total=totals[label])
    chosen = first(1, TOXIC).union(first(0, CLEAN))
    # TOXIC + CLEAN ids at most: a size known beforehand.
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.dropDuplicates(["doc_id"])
    some = map_rows(
        texts.select("doc_id", "toxic", "text"),
        lambda batch: {"toxic": batch.column(1), "terms": [sorted(terms_of(t.as_py())) for t in batch.column(2)]},
        "toxic int, terms array<binary>",
    )
    terms = significant(some)
    gate, wanted = {t[:4].rstrip(b"~+") for t in terms}, set(terms)
    vectors = map_rows(
        texts.select("doc_id", "toxic", "text"),
        lambda batch: {
            "doc_id": batch.column(0),
            "toxic": batch.column(1),
            "terms": [sorted(terms_of(t.as_py(), gate) & wanted) for t in batch.column(2)],
        },
        "doc_id long, toxic int, terms array<binary>",
    )
    seen = {r.doc_id: (r.toxic, {bytes(t) for t in r.terms}) for r in vectors.collect()}
    ids = sorted(seen)
    y = np.array([seen[i][0] for i in ids], np.float64)
    if not 0 < y.sum() < len(y):
        return totals[1] / (totals[0] + totals[1])
    counts = [seen[i][1] for i in ids]
    n, df = frequencies(docs, terms)
    index = Index(terms, np.log((1 + n) / (1 + df)), ids, y, counts)
    index.calibrate(totals[1], totals[0], counts, y, ids)
    return index


def score(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, held_out: int = 1, folds: int = 3
) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every text."""
    model = fit(docs, labels, held_out=held_out, folds=folds)

    def run(batch: pa.RecordBatch) -> dict:
        if isinstance(model, float):
            got = [(model, [])] * batch.num_rows
        else:
            got = [model.score(text.as_py()) for text in batch.column(1)]
        return {
            "doc_id": batch.column(0),
            "held_out": batch.column(2),
            "score": [s for s, _ in got],
            "predicted": [int(s >= LEAST) for s, _ in got],
            "evidence": [e for _, e in got],
        }

    rows = docs.select(F.col("doc_id").cast("long"), "text", (fold("doc_id", folds) == held_out).alias("held_out"))
    return map_rows(rows, run, SCORES)
