"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased, runs of bytes that are neither letters nor digits become
one blank, and an item of m bytes occurs in a document if some part of the
document is within ``floor(RATE * m)`` edits of it. With an error budget of k,
one of any k + 1 pieces of the item must occur unchanged: the first eight bytes
of all pieces are looked up at every position of a batch of texts at once, the
rest of a piece is compared, and the stretch around it is verified with Myers'
bit-parallel distance, a column of the edit matrix in one big integer.

Where the budget makes pieces shorter than eight bytes (``REWORDED``), single
hits say too little. Then an item has k + ``HITS`` pieces, of which at least
``HITS`` occur unchanged, shifted against each other by at most k; and what is
around them must hold as many of the item's strings of three, four and five
bytes as k edits leave, before it is verified. These bounds lose no match.

The benchmark is read in blocks of bounded size, and each block is one pass
over the documents without a shuffle; neither side is ever collected whole.

Defined cases: null and empty texts match nothing; an item of fewer than
``SHORT`` bytes after normalisation has no edits: of eight bytes and ``SHORT_WORDS`` words or more
it is found wherever it stands between word boundaries, and a shorter one, which
says too little inside a text, in the documents that equal it; a very long text is searched in parts that overlap by
an item and its edits; of several places the least distance counts; repeated
items count once; a repeated document gets
its rows again; null ids stay null; empty tables give no rows; other columns
are ignored (``clean`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_rows, materialize, text_bytes

RATE = 0.08
#: The share of edits that the query and the pipeline look for: one inserted
#: word of seven letters in an item of 54 bytes, three in one of 160.
REWORDED = 0.15
HITS, GRAMS = 3, (5, 4, 3)  # strings of five reject most, so they come first
SHORT, SHORT_WORDS = 24, 3
#: Bytes of benchmark text in a block, and so in a task's tables.
BLOCK_BYTES = 4_000_000
#: Texts that are normalised and searched at once: rows, and bytes of their text
#: (a longer one is searched in parts of as many that overlap by an item).
STEP_ROWS, STEP_BYTES = 256, 1 << 20
#: Piece hits in memory at once.
STEP_HITS = 1 << 20
MATCHES = "doc_id long, item_id long, distance int, budget int, item_bytes int"

_FILTER_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.full(256, 32, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def normalized(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """Normalised bytes of all texts and the offsets of each."""
    raw, offsets = text_bytes(pc.utf8_lower(column))
    data = _FOLD[raw]
    blank = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    kept = [np.count_nonzero(keep[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
    return data[keep].tobytes(), np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])


def myers(pattern_masks: dict[int, int], m: int, text: bytes) -> int:
    """Least edit distance between the pattern and any part of ``text``."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for byte in text:
        eq = pattern_masks.get(byte, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            best = min(best, score)
        up = up << 1 & full  # a match may begin anywhere, so no 1 comes in
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return best


def _words(data: bytes, width: int) -> np.ndarray:
    """The ``width`` bytes from each position on, as a number."""
    out, raw = np.empty(len(data), np.uint64), data + bytes(8)
    for shift in range(min(8, len(data))):
        out[shift::8] = np.frombuffer(raw, np.uint64, len(out[shift::8]), shift)
    return out & np.uint64(2 ** (8 * width) - 1)


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    """Two bytes for the first ``width`` of each eight."""
    return ((words & np.uint64(2 ** (8 * width) - 1)) * _SPREAD >> np.uint64(48)).astype(np.uint16)


class _Width:
    """Pieces of one length (eight bytes: that or longer), by their first bytes."""

    def __init__(self, width: int, first: np.ndarray, piece: np.ndarray):
        self.mask = np.uint64(2 ** (8 * width) - 1)
        by = np.argsort(first, kind="stable")
        self.piece = piece[by]
        self.keys, self.first_of, self.count = np.unique(first[by], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys * _SPREAD >> np.uint64(64 - _FILTER_BITS)] = True

    def found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, first of the pieces there, how many)."""
        keys = words & self.mask
        at = np.flatnonzero(self.filter[keys * _SPREAD >> np.uint64(64 - _FILTER_BITS)])
        key = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        there = self.keys[key] == keys[at]
        return at[there], self.first_of[key[there]], self.count[key[there]]


class ShortPieces:
    """Pieces of which an item needs ``HITS`` (first bytes, item, start, piece)."""

    def __init__(self, pieces: list[tuple[int, int, int, bytes]], texts: list[bytes], budgets: list[int]):
        sizes = np.array([min(8, len(p[3])) for p in pieces])
        first = np.array([p[0] for p in pieces], np.uint64)
        self.item = np.array([p[1] for p in pieces])
        self.start = np.array([p[2] for p in pieces])
        self.widths = [_Width(int(w), first[sizes == w], np.flatnonzero(sizes == w)) for w in np.unique(sizes)]
        self.sizes, self.budgets = np.array([len(t) for t in texts]), np.array(budgets)
        self.reach = int((self.sizes + 2 * self.budgets).max())
        self.least = [(self.sizes - g + 1 - g * self.budgets).tolist() for g in GRAMS]
        self.grams = [[_grams(_words(t, 8), g)[: max(0, len(t) - g + 1)] for t in texts] for g in GRAMS]
        self.table = np.zeros(1 << 16, bool)

    def stretches(self, data: bytes, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, from, to) of what may hold an item. A stretch may come
        twice where hits are taken in several steps."""
        words = _words(data, 8)
        for at, piece in self._hits(words):
            yield from self._enough(words, offsets, at, piece)

    def _hits(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, piece) of all hits, about ``STEP_HITS`` at once; the hits of
        any stretch as long as an item and its edits are in one step."""
        found = [w.found(words) for w in self.widths]
        which = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        at, first, n = (np.concatenate([f[i] for f in found]) for i in range(3))
        by = np.argsort(at, kind="stable")
        which, at, first, n = which[by], at[by], first[by], n[by]
        until = np.concatenate([[0], np.cumsum(n)])
        a = 0
        while a < len(at):
            b = int(np.searchsorted(until, until[a] + STEP_HITS, "right")) - 1
            b = max(b, int(np.searchsorted(at, at[a] + 2 * self.reach, "right")))
            m, kind = n[a:b], which[a:b]
            rank = np.repeat(first[a:b] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            kind, piece = np.repeat(kind, m), np.empty(len(rank), np.int64)
            for k, width in enumerate(self.widths):
                piece[kind == k] = width.piece[rank[kind == k]]
            yield np.repeat(at[a:b], m), piece
            a = len(at) if b >= len(at) else int(np.searchsorted(at, at[b] - self.reach))

    def _enough(self, words: np.ndarray, offsets: np.ndarray, at: np.ndarray, piece: np.ndarray):
        row, item = np.searchsorted(offsets, at, side="right") - 1, self.item[piece]
        begin = at - self.start[piece]
        pair = row * len(self.sizes) + item
        most = int(self.sizes.max())
        pair, begin = np.divmod(np.sort(pair * (len(words) + most) + begin + most), len(words) + most)
        begin -= most
        last = HITS - 1
        some = np.flatnonzero(
            (pair[last:] == pair[:-last]) & (begin[last:] - begin[:-last] <= self.budgets[pair[last:] % len(self.sizes)])
        )
        if not len(some):
            return
        pair, low, high = pair[some], begin[some], begin[some + last]
        opens = np.concatenate([[True], (pair[1:] != pair[:-1]) | (low[1:] > high[:-1])])
        first, final = np.flatnonzero(opens), np.append(np.flatnonzero(opens)[1:] - 1, len(pair) - 1)
        row, item = np.divmod(pair[first], len(self.sizes))
        low = np.maximum(offsets[row], low[first] - self.budgets[item])
        high = np.minimum(offsets[row + 1], high[final] + self.sizes[item] + self.budgets[item])
        every, table = _grams(words, GRAMS[0]), self.table
        for r, i, a, b in zip(row.tolist(), item.tolist(), low.tolist(), high.tolist(), strict=True):
            for k, g in enumerate(GRAMS):
                here = every[a:b] if k == 0 else _grams(words[a:b], g)
                table[here] = True
                enough = np.count_nonzero(table[self.grams[k][i]]) >= self.least[k][i]
                table[here] = False
                if not enough:
                    break
            else:
                yield r, i, a, b


class PieceIndex:
    """Pieces of a block of items, found by their first eight bytes."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.ids, self.texts, self.budgets, self.whole = [], [], [], {}
        self.exact: set[int] = set()
        pieces, short = [], []
        for item_id, text in items:
            data, _ = normalized(pa.array([text]))
            data = data.strip()
            if not data:
                continue
            at, budget = len(self.ids), int(rate * len(data))
            self.ids.append(item_id)
            self.texts.append(data)
            self.budgets.append(budget)
            if len(data) < SHORT:
                self.whole.setdefault(data, []).append(at)
                if len(data) >= 8 and data.count(b" ") >= SHORT_WORDS - 1:
                    self.exact.add(at)
                    pieces.append((int.from_bytes(data[:8], "little"), at, 0, data))
                continue
            n, into = budget + 1, pieces
            if len(data) // n < 8:
                n, into = budget + HITS, short
            cuts = [len(data) * i // n for i in range(n + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                into.append((int.from_bytes(data[a : min(b, a + 8)], "little"), at, a, data[a:b]))
        pieces.sort()
        self.pieces = pieces
        self.keys = np.array([p[0] for p in pieces], np.uint64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys * _SPREAD >> np.uint64(64 - _FILTER_BITS)] = True
        self.masks: dict[int, dict[int, int]] = {}
        self.short = ShortPieces(short, self.texts, self.budgets) if short else None

    def mask(self, item: int) -> dict[int, int]:
        if item not in self.masks:
            masks: dict[int, int] = {}
            for i, byte in enumerate(self.texts[item]):
                masks[byte] = masks.get(byte, 0) | 1 << i
            self.masks[item] = masks
        return self.masks[item]

    def candidates(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(position, item, start in the item) of every piece found."""
        if not self.pieces:
            return
        for shift in range(8):
            words = np.frombuffer(data, np.uint64, max(0, (len(data) - shift) // 8), shift) if len(data) > shift else ()
            if not len(words):
                continue
            some = np.flatnonzero(self.filter[words * _SPREAD >> np.uint64(64 - _FILTER_BITS)])
            first = np.searchsorted(self.keys, words[some])
            end = np.searchsorted(self.keys, words[some], side="right")
            for at, a, b in zip(
                (8 * some + shift)[end > first].tolist(), first[end > first].tolist(), end[end > first].tolist(),
                strict=True,
            ):
                for _, item, start, piece in self.pieces[a:b]:
                    if data.startswith(piece, at):
                        yield at, item, start

    def search(self, column: pa.Array, step: int = STEP_ROWS) -> dict[tuple[int, int], int]:
        """(row, item) -> least distance, for all that are within the budget."""
        best, at = {}, 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        while at < len(column):
            so_far = sizes[at - 1] if at else 0
            end = max(at + 1, min(at + step, int(np.searchsorted(sizes, so_far + STEP_BYTES, "right"))))
            found = self.search_some(column.slice(at, end - at))
            best.update({(at + row, item): distance for (row, item), distance in found.items()})
            at = end
        return best

    def parts(self, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(start, offsets from there) of what is searched for short pieces at
        once: all rows, or parts of a row by itself that is longer than a step."""
        whole = int(offsets[-1])
        if whole <= 2 * STEP_BYTES or len(offsets) > 2:
            yield 0, offsets
            return
        size = max(STEP_BYTES, 4 * self.short.reach)
        for a in range(0, whole, size):
            yield a, np.array([0, min(whole - a, size + self.short.reach)])

    def search_some(self, column: pa.Array) -> dict[tuple[int, int], int]:
        data, offsets = normalized(column)
        best: dict[tuple[int, int], int] = {}
        if self.whole:
            for row in np.flatnonzero(np.diff(offsets) < SHORT + 2):
                for item in self.whole.get(data[offsets[row] : offsets[row + 1]].strip(), ()):
                    best[int(row), item] = 0
        found = sorted(self.candidates(data))
        rows = np.searchsorted(offsets, [f[0] for f in found], side="right") - 1
        tried = set()
        for (at, item, start), row in zip(found, rows.tolist(), strict=True):
            m, budget = len(self.texts[item]), self.budgets[item]
            if best.get((row, item)) == 0:
                continue
            low, high = int(offsets[row]), int(offsets[row + 1])
            begin = at - start
            if item in self.exact:
                before, after = data[max(low, begin - 1) : begin], data[begin + m : min(high, begin + m + 1)]
                if begin + m <= high and before in (b"", b" ") and after in (b"", b" "):
                    best[row, item] = 0
                continue
            if begin >= low and begin + m <= high and data.startswith(self.texts[item], begin):
                best[row, item] = 0
                continue
            if (row, item, begin) in tried:
                continue
            tried.add((row, item, begin))
            part = data[max(low, begin - budget) : min(high, begin + m + budget)]
            if len(part) < m - budget:
                continue
            distance = myers(self.mask(item), m, part)
            if distance <= min(budget, best.get((row, item), budget)):
                best[row, item] = distance
        if self.short:
            for a, places in self.parts(offsets):
                for row, item, low, high in self.short.stretches(data[a : a + int(places[-1])], places):
                    m, budget = len(self.texts[item]), self.budgets[item]
                    if best.get((row, item)) == 0:
                        continue
                    part = data[a + low : a + high]
                    distance = 0 if self.texts[item] in part else myers(self.mask(item), m, part)
                    if distance <= min(budget, best.get((row, item), budget)):
                        best[row, item] = distance
        return best


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    items, size = [], 0
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    for row in rows.toLocalIterator():
        items.append((row.item_id, row.text))
        size += len(row.text)
        if size >= block_bytes:
            yield items
            items, size = [], 0
    if items:
        yield items


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document and item that occurs in it, with the distance."""
    out = spark.createDataFrame([], MATCHES)
    for items in item_blocks(benchmark, block_bytes):
        index = PieceIndex(items, rate)

        def run(batch: pa.RecordBatch, index: PieceIndex = index) -> dict:
            found = sorted(index.search(batch.column(1)).items())
            rows, at = [k[0] for k, _ in found], [k[1] for k, _ in found]
            return {
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                "item_id": [index.ids[i] for i in at],
                "distance": [d for _, d in found],
                "budget": [index.budgets[i] for i in at],
                "item_bytes": [len(index.texts[i]) for i in at],
            }

        block = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, MATCHES)
        out = out.union(materialize(spark, block, "contaminated"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no item occurs."""
    at = docs.columns.index("text")
    for items in item_blocks(benchmark, block_bytes):
        index = PieceIndex(items, rate)

        def run(batches: Iterator[pa.RecordBatch], index: PieceIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, _ in index.search(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
