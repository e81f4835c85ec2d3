"""Importance resampling of documents towards the word use of a target text.

Features are all runs of 1 to ``max_words`` consecutive words, hashed by CRC-32
into buckets. A document's weight is the mean log ratio of its buckets' shares
in the target to their shares in the corpus; documents are drawn without
replacement by adding Gumbel noise to the weight and keeping the highest.

Prefix CRCs: a text is reduced to its words with one space after each, scanned
once, and the running CRC of every position kept. The CRC of any run of words
comes from the two running values at its ends: the earlier one is shifted by
the run's length (a product in GF(2), from tables of shifted bytes) and
cancelled out. No feature is ever cut out as a string.

Counts and weights are of whole texts and whole tables. What reaches the driver
is one row for each bucket, and one for each whole score that occurs (fewer than
200,000: weights lie within +-54,000 and the noise within -3,200 to 23,000). The
ranks of the drawn come from a range-partitioned sort written to the scratch
folder, so no task ranks them all.

Rows: a null or empty text has no feature and weight 0. A null id is scored as
an empty id, ranks last among equal scores and is a document of its own, as is
every repeated row; rows with equal score and id are ranked in any order. Texts
are taken in steps of about ``STEP`` bytes; one longer text is a step by itself
(some 40 bytes of memory for a byte of it). Columns besides id and text are not
read. An empty table gives no rows; without a target text all its counts are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, materialize, numbered, text_bytes, to_batch

BUCKETS = 10000
MAX_WORDS = 2
STEP = 4 << 20
LANES = 2048
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
ONES = np.uint32(0xFFFFFFFF)
SHORT = 64


def _byte_table() -> np.ndarray:
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(POLYNOMIAL), state >> 1)
    return state


TABLE = _byte_table()


def _zero_byte(state: np.ndarray) -> np.ndarray:
    return TABLE[state & 255] ^ (state >> 8)


def _apply(shift: np.ndarray, state: np.ndarray) -> np.ndarray:
    """``state`` through a linear map given by its values on the four bytes."""
    return shift[0][state & 255] ^ shift[1][(state >> 8) & 255] ^ shift[2][(state >> 16) & 255] ^ shift[3][state >> 24]


def _short_shifts() -> np.ndarray:
    """The maps of 0 to ``SHORT`` zero bytes, [length, byte of the state, value]."""
    bytes_ = np.arange(256, dtype=np.uint32)
    maps = [np.stack([bytes_ << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHORT):
        maps.append(_zero_byte(maps[-1]))
    return np.stack(maps)


SHIFTS = _short_shifts()


def shifted(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after ``length`` more zero bytes."""
    at = (length % SHORT).astype(np.intp) * 1024
    flat = SHIFTS.reshape(-1)
    out = (
        flat[at + (state & 255)]
        ^ flat[at + 256 + ((state >> 8) & 255)]
        ^ flat[at + 512 + ((state >> 16) & 255)]
        ^ flat[at + 768 + (state >> 24)]
    )
    rest, power = length // SHORT, SHIFTS[SHORT]
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _apply(power, out[odd])
        rest, power = rest >> 1, _apply(power, power)
    return out


def running(data: np.ndarray) -> np.ndarray:
    """CRC states (start 0, no final complement) before each byte and after the
    last. The bytes are scanned in lanes side by side; then every lane gets the
    state the lanes before it end on."""
    lanes = max(1, min(LANES, len(data) // 64))
    width = -(-len(data) // lanes) if len(data) else 0
    grid = np.zeros(lanes * width, np.uint8)
    grid[: len(data)] = data
    grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
    out = np.zeros((width + 1, lanes), np.uint32)
    for i in range(width):
        out[i + 1] = TABLE[(out[i] ^ grid[i]) & 255] ^ (out[i] >> 8)
    ends, step = out[width].copy(), 1
    while step < lanes:
        ends[step:] ^= shifted(ends[:-step], np.full(lanes - step, step * width, np.int64))
        step *= 2
    before = np.concatenate([np.zeros(1, np.uint32), ends[:-1]])
    for i in range(width):
        out[i] ^= before
        before = _zero_byte(before)
    states = np.ascontiguousarray(out[:width].T).reshape(-1)
    return np.append(states[: len(data)], states[len(data)] if len(data) < lanes * width else ends[-1])


def _classes() -> np.ndarray:
    """Bytes as word bytes (A-Z in lower case) or 32: digits, letters and all
    of the bytes of characters from U+0080 on make words."""
    table = np.full(256, 32, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


CLASSES = _classes()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(normalised bytes, start of each word, end of each word, first word of
    each text and the number of words)."""
    mapped = CLASSES[np.insert(data, offsets[1:], 32)]
    inside = mapped != 32
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    texts = offsets + np.arange(len(offsets))
    normal = mapped[keep]
    ends = np.flatnonzero(normal == 32)
    starts = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1] + 1])
    # a text ends on a space that is kept only behind a word, so its words are those closed before it
    closed = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep & ~inside)])
    return normal, starts, ends, closed[texts]


def features(data: np.ndarray, offsets: np.ndarray, max_words: int, buckets: int):
    """Per run length: (bucket of every run, first run of each text and the number of runs)."""
    normal, starts, ends, first = words(data, offsets)
    states = running(normal)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    for n in range(1, max_words + 1):
        whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
        start, end = starts[whole], ends[whole + n - 1]
        crc = states[end] ^ shifted(states[start] ^ ONES, end - start) ^ ONES
        runs = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.maximum(counts - n + 1, 0))])
        yield (crc % np.uint32(buckets)).astype(np.int64), runs, counts


def steps(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``STEP`` bytes."""
    data, offsets = text_bytes(column)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def bucket_counts(docs: DataFrame, *, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; a task sends one row for each bucket it met."""
    arrow = arrow_schema(docs.sparkSession, "bucket long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in steps(batch.column(0)):
                for bucket, _, _ in features(data, offsets, max_words, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield to_batch({"bucket": met, "n": total[met]}, arrow)

    counts = docs.select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of each bucket's smoothed share in the target
    over that in the corpus, floored."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, *, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_features long, weight long"
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n_words, n, total = (np.zeros(rows, np.int64) for _ in range(3))
            for row, data, offsets in steps(batch.column(1)):
                here = slice(row, row + len(offsets) - 1)
                for bucket, runs, counts in features(data, offsets, max_words, len(gain)):
                    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(gain[bucket])])
                    total[here] += sums[runs[1:]] - sums[runs[:-1]]
                    n[here] += np.diff(runs)
                    n_words[here] = counts
            yield to_batch(
                {"doc_id": batch.column(0), "n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)}, arrow
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def noise(seed: str):
    """Gumbel noise in thousandths, floored; from a hash of the id."""
    key = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(spark: SparkSession, scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` (written, deterministic rows) with the ``rank`` of those drawn."""
    known = scored.where(F.col("n_words") >= min_words).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = percent * sum(r.n for r in known) // 100
    reached, lowest = 0, None
    for row in sorted(known, key=lambda r: -r.score):
        if reached >= wanted:
            break
        reached, lowest = reached + row.n, row.score
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    candidate = (F.col("n_words") >= min_words) & (F.col("score") >= lowest)
    ranked = numbered(spark, scored.where(candidate), [F.desc("score"), F.asc_nulls_last("doc_id")], "resample-ranked")
    ranked = ranked.select(*scored.columns, F.when(F.col("place") <= wanted, F.col("place")).alias("rank"))
    rest = scored.where(~candidate).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = 25,
    min_words: int = 20,
    seed: str = "7:",
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every document with (n_features, weight, score) and, for the ``percent``
    of those of at least ``min_words`` words that are drawn, a rank from 1."""
    gain = gains(
        bucket_counts(docs, max_words=max_words, buckets=buckets),
        bucket_counts(target, max_words=max_words, buckets=buckets),
    )
    scored = weights(docs, gain, max_words=max_words)
    scored = scored.withColumn("score", F.col("weight") + noise(seed))
    scored = materialize(spark, scored, "resample-scores")
    return draw(spark, scored, percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The documents drawn, with all their columns. Rows that share an id are
    kept if one of them was drawn."""
    ids = ranked.where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")
