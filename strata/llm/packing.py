"""Best-fit packing of token sequences by large-item matching.

Documents are tokenised, ended by one separator id, and cut where they are
longer than a sequence. Pieces above a third of the capacity go at most two to
a sequence, matched greedily (the longest with the longest that still fits);
smaller pieces then fill the smallest gap that holds them, longest first.

A packing depends only on how many pieces there are of each length, so the
plan is made from that histogram (at most ``capacity`` rows, whatever the
input) as runs: pieces ``rank .. rank + count`` of one length go to sequences
``first .. first + count`` at one offset. Ranks come from counts by task, so
no piece meets another in a sort, a window or a hot group.

A piece carries its ids, little-endian 32-bit each: ``placed`` gives the pieces
with their place, ``sequences`` puts those of a sequence together, and
``write_sequences`` writes that. ``pack`` only has digests of the same rows.

Defined cases: a null or empty text is one piece that holds the separator;
repeated rows are packed once each; null ids are kept as null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, map_rows, materialize, to_batch

CAPACITY = 2048
#: Words whose ids a worker keeps, twice: when a table of them is full, a new
#: one takes over from it what still occurs.
CACHE_WORDS = 300_000
#: Characters of the texts whose new words are encoded in one call.
GROUP_CHARS = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, seen long"
PLACED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
SEQUENCES = (
    "sequence_id long, n_ids int, ids binary, pieces array<struct<offset: int, length: int, doc_id: long, start: long>>"
)

# Latin-1 texts of printable characters: there the tokenizer's normalisation
# is lower-casing, and its classes of letters and digits are these.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-ÿ]*")
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+")


class WordTokenizer:
    """Ids of whole texts by a word-level BPE file, as little-endian 32-bit.

    BPE never crosses words, so a text's ids are its words' ids; words repeat,
    so each worker keeps theirs. Texts outside the plain alphabet, or with the
    string of a special token, go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}  # words, and what stands between white space
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
                out += self.grouped(group)
                out.append(self.whole(text))
                group, size = [], 0
                continue
            group.append(text.lower().split())
            size += len(text)
            if size > GROUP_CHARS:
                out += self.grouped(group)
                group, size = [], 0
        return out + self.grouped(group)

    def grouped(self, texts: list[list[str]]) -> list[bytes]:
        chunks = [c for text in texts for c in text]
        got = list(map(self.known.get, chunks))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if missing:
            self.learn({chunks[i] for i in missing})
            known = self.known
            for i in missing:
                got[i] = known[chunks[i]]
        ends = np.cumsum([len(text) for text in texts]).tolist()
        return [b"".join(got[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) + len(chunks) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        parts = {c: [c] if c.isalpha() else _WORDS.findall(c) for c in chunks}
        new = []
        for word in {w for words in parts.values() for w in words if w not in known}:
            if word in older:
                known[word] = older[word]
            else:
                new.append(word)
        if new:
            self.encode(new)
        for chunk, words in parts.items():
            if len(words) > 1:
                known[chunk] = b"".join([known[w] for w in words])

    def encode(self, words: list[str]) -> None:
        """Words of one call, told apart by the ids that end a word."""
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words):
            raw, known, cuts = ids.tobytes(), self.known, (4 * cuts).tolist()
            for word, a, b in zip(words, [0, *cuts[:-1]], cuts, strict=True):
                known[word] = raw[a:b]
        else:
            self.known.update((w, self.whole(w)) for w in words)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's own; loading the file takes longer than a batch."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, separator: int = 0) -> DataFrame:
    """One row per piece; ``part`` and ``seen`` number the pieces of one length
    that one task makes."""
    schema = arrow_schema(docs.sparkSession, PIECES)
    end = np.asarray([separator], "<u4").tobytes()

    def run(batches):
        encode, seen, part = tokenizer(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            texts = encode([text or "" for text in batch.column(1).to_pylist()])
            for doc, ids in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids += end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    rows.append((doc, piece, start, length, ids[4 * start : 4 * (start + length)], part, seen[length]))
                    seen[length] += 1
            if rows:
                yield to_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, rank, count, first sequence, offset) that pack ``counts``
    pieces of each length. The number of runs depends on ``capacity`` alone."""
    left = {n: int(c) for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    rank = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
    sizes: list[int] = []  # gaps in order
    bins = 0

    def place(length: int, count: int, first: int, offset: int) -> None:
        runs.append((length, rank[length], count, first, offset))
        rank[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        at = bisect_left(large, capacity - longest + 1) - 1
        if at < 0:  # nothing large fits beside it
            n = left[longest]
            place(longest, n, bins, 0)
            leave(capacity - longest, bins, n)
        elif large[at] == longest:
            n = left[longest] // 2
            if n:
                place(longest, n, bins, 0)
                place(longest, n, bins, longest)
                leave(capacity - 2 * longest, bins, n)
            elif at > 0:  # the last one pairs with the next shorter
                n = 1
                place(longest, 1, bins, 0)
                place(large[at - 1], 1, bins, longest)
                leave(capacity - longest - large[at - 1], bins, 1)
            else:
                n = 1
                place(longest, 1, bins, 0)
                leave(capacity - longest, bins, 1)
        else:
            n = min(left[longest], left[large[at]])
            place(longest, n, bins, 0)
            place(large[at], n, bins, longest)
            leave(capacity - longest - large[at], bins, n)
        bins += n
        large = [x for x in large if left[x]]
    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                n = -(-left[length] // (capacity // length))
                leave(capacity, bins, n)
                bins += n
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            n = min(count, left[length])
            place(length, n, first, capacity - gap)
            if n < count:
                gaps[gap].append((first + n, count - n))
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            leave(gap - length, first, n)
    return np.asarray(sorted(runs), np.int64).reshape(-1, 5)


def placed(
    spark: SparkSession, docs: DataFrame, path: str, *, capacity: int = CAPACITY, separator: int = 0
) -> DataFrame:
    """Pack ``docs`` (doc_id, text): one row per piece with its ids, its
    sequence and the offset there."""
    made = materialize(spark, pieces(docs, path, capacity=capacity, separator=separator), "pack-pieces")
    by_task = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    # At most `capacity` rows, however long the input is.
    histogram = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_sequences(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most `capacity` rows a task, so these are hashed; pieces are not sorted.
    ranked = made.join(starts.hint("shuffle_hash"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("seen")).alias("rank")
    )
    lengths, firsts = np.unique(runs[:, 0], return_index=True)
    ends = np.append(firsts[1:], len(runs))[: len(firsts)]
    base = np.zeros(capacity + 1, np.int64)  # of a length's ranks among all
    total = np.zeros(capacity + 1, np.int64)
    for n, a, b in zip(lengths, firsts, ends, strict=True):
        total[n] = runs[a:b, 2].sum()
    base[1:] = np.cumsum(total)[:-1]
    keys = base[runs[:, 0]] + runs[:, 1]

    def assign(batch: pa.RecordBatch) -> dict:
        out = {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids")}
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(keys, base[length] + rank, side="right") - 1
        return out | {"sequence_id": runs[at, 3] + rank - runs[at, 1], "offset": runs[at, 4]}

    return map_rows(ranked, assign, PLACED)


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of each sequence in order, and which document's pieces they are;
    ``pieces`` as ``placed`` gives them. A group is one sequence, so it has at
    most its capacity of ids."""
    schema = arrow_schema(pieces.sparkSession, SEQUENCES)

    def whole(sequence: int, group: list[tuple]) -> tuple:
        ids = b"".join([row[-1] for row in group])
        return sequence, len(ids) // 4, ids, [row[:-1] for row in group]

    def run(batches):
        last, group = None, []
        for batch in batches:
            rows = []
            for sequence, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if sequence != last and group:
                    rows.append(whole(last, group))
                    group = []
                last = sequence
                group.append(tuple(row))
            if rows:
                yield to_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)
        if group:
            yield to_batch(dict(zip(schema.names, zip(whole(last, group), strict=True), strict=True)), schema)

    dealt = pieces.select("sequence_id", F.col("offset").cast("int"), F.col("length").cast("int"), "doc_id", "start", "ids")
    return dealt.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(run, SEQUENCES)


def write_sequences(pieces: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """``sequences`` as parquet: a row has all that a training step reads."""
    sequences(pieces).write.mode(mode).parquet(path)


def pack(
    spark: SparkSession, docs: DataFrame, path: str, *, capacity: int = CAPACITY, separator: int = 0
) -> DataFrame:
    """``placed`` with a digest of each piece's ids in their stead."""
    rows = placed(spark, docs, path, capacity=capacity, separator=separator)
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
