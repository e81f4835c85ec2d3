"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles. Documents with equal sets
are one class. Of every class 128 minima are taken; bands of five of them make
buckets, and the low four bits of all are packed into eight longs, so that two
signatures compare by bit counts. Agreement by chance is corrected for.

Links are confirmed on full sets, in three steps that never bring a bucket, a
class or a component together:

1. every class meets the smallest one of each of its buckets (a star, not all
   pairs); what hangs together so is a family, and no two classes of different
   families share a bucket;
2. a family is dealt into blocks by set size and hash, of at most
   ``BLOCK_SHINGLES`` shingles on average; block pairs whose sizes can meet the
   threshold go to a task each, so a hot family is split over many tasks;
3. in a pair of blocks, signatures whose estimate is near enough are confirmed
   on the sets; pairs that are already connected need no check. Links found
   are unioned over all tasks.

Defined cases: null, empty and wordless texts have no shingle and link with
nothing, as do null ids; a text with fewer words than a shingle is one shingle;
rows that repeat an id are one document in links and as many rows in results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, components, map_rows, materialize, to_batch

WORDS = 5
PERCENT = 85
#: Minima of a signature; bands of ROWS of them, the rest only in the estimate.
MINIMA, BITS, BANDS, ROWS = 128, 4, 25, 5
#: Estimates this far below the threshold are still confirmed on the sets: over
#: five standard errors at 0.85 (0.037, chance agreement included), so a pair at
#: the threshold is left out with a probability under 1e-6, bands included.
MARGIN = 0.2
#: Shingles of a block on average (8 bytes each).
BLOCK_SHINGLES = 65_536
CACHE_WORDS = 200_000

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_ODD = np.random.default_rng(6).integers(1, 2**63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(7).integers(0, 2**63, MINIMA, np.uint64)
_LANES = np.uint64(0x1111111111111111)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts; keeps word hashes."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # ASCII only, both
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(words) < self.words:
            return self.join([hashes[i : i + 1] for i in range(len(words))])
        return np.unique(self.join([hashes[i : len(words) - self.words + 1 + i] for i in range(self.words)]))

    def join(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(columns[0]), len(columns), np.uint64)
        for column in columns:
            out = mix(out * _MIX[0] + column)
        return out


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 4096):  # a bounded table for long texts
        part = shingles[at : at + 4096, None] * _ODD + _ADD
        np.minimum(out, part.min(axis=0), out=out)
    return mix(out)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, sixteen to a long."""
    low = (least & np.uint64(2**BITS - 1)).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of a packed signature with others, corrected for the share
    of lanes that agree by chance."""
    differs = one ^ many
    differs |= differs >> np.uint64(2)
    differs |= differs >> np.uint64(1)
    agree = 1 - np.bitwise_count(differs & _LANES).sum(axis=1) / MINIMA
    chance = 0.5**BITS
    return (agree - chance) / (1 - chance)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    schema = "doc_id long, n_shingles long, low long, high long, sig binary, bands array<long>"

    def run(batch: pa.RecordBatch) -> dict:
        shingler = Shingler(words)
        out = {name: [] for name in ("n_shingles", "low", "high", "sig", "bands")}
        for text in batch.column(1):
            shingles = shingler(text.as_py())
            digest = xxhash.xxh3_128_digest(shingles.tobytes())
            low, high = np.frombuffer(digest, np.int64).tolist()
            least = minima(shingles)
            bands = np.arange(BANDS, dtype=np.uint64)
            for column in least[: BANDS * ROWS].reshape(BANDS, ROWS).T:
                bands = mix(bands * _MIX[0] + column)
            out["n_shingles"].append(len(shingles))
            out["low"].append(low)
            out["high"].append(high)
            out["sig"].append(packed(least).tobytes())
            out["bands"].append(bands.view(np.int64) if len(shingles) else [])
        return out | {"doc_id": batch.column(0)}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def _size_class(n: str, percent: int) -> Column:
    """Sets of classes that differ by more than one cannot reach the threshold."""
    return F.floor(F.log(F.col(n).cast("double")) / (math.log(100 / percent) + 1e-9)).cast("int")


def _blocks(families: DataFrame, percent: int) -> DataFrame:
    """(rep, n_shingles, family, i, j): the block pairs that a class goes to;
    ``i`` and ``j`` are ``size class << 32 | block``."""
    sized = families.withColumn("size", _size_class("n_shingles", percent))
    weights = sized.groupBy("family", "size").agg(F.sum("n_shingles").alias("w"))
    whole = weights.groupBy("family").agg(
        F.sum("w").alias("all"),
        F.map_from_entries(
            F.collect_list(F.struct("size", F.ceil(F.col("w") / BLOCK_SHINGLES).cast("int").alias("n")))
        ).alias("blocks"),  # one entry per size class: tens
    )
    dealt = sized.join(whole, "family")
    count = lambda size: F.coalesce(F.try_element_at("blocks", size), F.lit(0))
    block = F.shiftleft(F.col("size").cast("long"), 32) + F.pmod(F.xxhash64("rep"), count(F.col("size")))
    others = lambda step: F.transform(
        F.sequence(F.lit(1), count(F.col("size") + step)),
        lambda k: F.shiftleft((F.col("size") + step).cast("long"), 32) + k - 1,
    )
    some = lambda step: F.when(count(F.col("size") + step) > 0, others(step)).otherwise(
        F.array().cast("array<bigint>")
    )
    split = dealt.where(F.col("all") > BLOCK_SHINGLES).withColumn("own", block)
    split = split.withColumn("other", F.explode(F.concat(some(-1), some(0), some(1)))).select(
        "rep", "n_shingles", "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"
    )
    small = dealt.where(F.col("all") <= BLOCK_SHINGLES).select(
        "rep", "n_shingles", "family", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"),
        F.lit(0).cast("long").alias("own"),
    )
    return small.unionByName(split)


def _confirm(ids: np.ndarray, own: np.ndarray, sets: list[np.ndarray], sigs: np.ndarray, percent: int) -> list:
    """Links that connect the classes of a block pair; only pairs across the
    two blocks, if there are two."""
    n = len(ids)
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, sigs, ids, own = [sets[i] for i in order], sigs[order], ids[order], own[order]
    sizes = np.array([len(s) for s in sets])
    root = np.arange(n)
    two = bool((own != own[0]).any())
    links = []
    for i in range(n - 1):
        end = np.searchsorted(sizes, 100 * sizes[i] / percent, side="right")
        if end <= i + 1:
            continue
        near = estimates(sigs[i], sigs[i + 1 : end])
        close = np.flatnonzero((near >= percent / 100 - MARGIN) & (root[i + 1 : end] != root[i])) + i + 1
        if two:
            close = close[own[close] != own[i]]
        for j in close[np.argsort(-near[close - i - 1], kind="stable")]:
            if root[i] == root[j]:
                continue
            a, b = sets[i], sets[j]
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            shared = int((b[at] == a).sum())
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                root[root == root[j]] = root[i]
                links.append((ids[i], ids[j]))
    return links


def links(docs: DataFrame, blocks: DataFrame, sigs: DataFrame, *, words: int = WORDS, percent: int = PERCENT):
    """Confirmed links (a, b) between the classes of ``blocks``."""
    sets_of = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(
        sigs.select(F.col("doc_id").alias("rep"), "sig"), "rep"
    )
    members = map_rows(
        sets_of,
        lambda batch: _sets(batch, words),
        "rep long, sig binary, shingles binary",
    )
    dealt = blocks.select("rep", "family", "i", "j", "own").join(members, "rep")
    key = ["family", "i", "j"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)
    schema = arrow_schema(docs.sparkSession, "a long, b long")

    def found(rows: list) -> pa.RecordBatch:
        ids, own = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
        sigs = np.frombuffer(b"".join(r[2] for r in rows), np.uint64).reshape(len(rows), -1)
        pairs = _confirm(ids, own, [np.frombuffer(r[3], np.uint64) for r in rows], sigs, percent)
        return to_batch({"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            values = zip(*(batch.column(k).to_pylist() for k in range(3, 7)), strict=True)
            for group, row in zip(keys, values, strict=True):
                if group != last and rows:
                    yield found(rows)
                    rows = []
                last = group
                rows.append(row)
        if rows:
            yield found(rows)

    return dealt.select(*key, "rep", "own", "sig", "shingles").mapInArrow(run, "a long, b long")


def _sets(batch: pa.RecordBatch, words: int) -> dict:
    shingler = Shingler(words)
    return {
        "rep": batch.column(0),
        "shingles": [shingler(text.as_py()).tobytes() for text in batch.column(1)],
        "sig": batch.column(2),
    }


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    found = materialize(spark, signatures(docs, words), "minhash-signatures")
    classes = (
        found.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("low", "high", "n_shingles")
        .agg(F.min("doc_id").alias("rep"))
    )
    classes = materialize(spark, classes, "minhash-classes")
    reps = found.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = materialize(spark, reps.select(F.col("doc_id").alias("rep"), "bands"), "minhash-reps")
    banded = reps.select("rep", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    )
    buckets = materialize(spark, buckets.select("band", "least"), "minhash-buckets")
    stars = banded.join(buckets, "band").where("rep != least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    families = (
        components(spark, stars, "minhash-families")
        .select(F.col("v").alias("rep"), F.col("component").alias("family"))
        .join(classes, "rep")
        .select("rep", "n_shingles", "family")
    )
    families = materialize(spark, families, "minhash-families")
    wanted = found.join(families.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    pairs = links(docs, _blocks(families, percent), wanted, words=words, percent=percent)
    linked = components(spark, pairs, "minhash-links")
    named = classes.join(linked.withColumnRenamed("v", "rep"), "rep", "left").select(
        "low", "high", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        found.select("doc_id", "low", "high", "n_shingles")
        .join(named, ["low", "high", "n_shingles"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
