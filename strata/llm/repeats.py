"""Repeated passages across documents, removed by sharded suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Places where such strings start are called windows.

No machine can sort the suffixes of everything, so windows are dealt by
content: each belongs to the least hash of the 20-byte strings inside it (its
key), and consecutive windows of one key make a run. Equal windows have equal
keys, wherever they stand, so each key is a shard of its own.

1. Every batch of documents sends, for each key in it, one entry: the run's
   hash and its least document, or that the batch holds several runs under it.
   So a passage that a third of all documents share costs an entry a batch.
2. From the entries of a key follows what each document must know: a run that
   stands with the same bytes in a smaller document is covered whole; where
   runs of one key differ, their bytes are needed; all other runs are unique.
3. Texts meet these answers, dealt by document, and give the bytes that are
   needed, dealt by key. Shards of several keys are sorted by induced sorting;
   permuted common prefixes of at least ``LENGTH`` make groups of equal
   windows, and windows whose group has a smaller document are covered.
4. Texts meet all covered stretches, dealt by document, and give what is kept
   and where the rest was: ``deduplicated``. ``cleaned`` has the documents with
   the texts that are left, ``removed`` counts and digests of the same rows.

A key whose runs exceed ``HOT_BYTES`` would be too much for one task. Its
windows are counted out one by one instead: grouped by a 128-bit hash in Spark,
which combines before it shuffles, and joined back.

Defined cases: null texts are empty; documents without an id neither remove nor
lose anything; rows that repeat an id do not remove from each other (their id
is not smaller) and lose the same; texts shorter than ``LENGTH`` stay; an empty
table gives an empty result; other columns are ignored. A text of any length
is read whole and is in memory in one piece; rows without an id are dealt by
their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, group_rows, map_rows, materialize, text_bytes, to_batch
from strata.llm.suffixes import permuted_prefixes, suffix_array

LENGTH = 50
INNER = 20
#: Text bytes of a group of entries or of documents, of a shard, of a hot key.
GROUP_BYTES, SHARD_BYTES, HOT_BYTES = 16_000_000, 1_500_000, 4_000_000
#: Text bytes whose runs are computed at once.
STEP_BYTES = 1_000_000

KEPT = "doc_id long, kept binary, spans array<struct<start: int, size: int>>"
_ENTRIES = "kind int, part long, base long, wide boolean, keys binary, runs binary, mixed binary, docs binary"
_BUNDLE = "part long, ids binary, known binary, sizes binary, texts binary, others binary"
_NEEDED = "key long, doc_id long, text_hash long, start int, content binary"

_M1, _M2, _M3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_POWER = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M3
    return x ^ (x >> np.uint64(32))


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers, kept up to the length of a step."""
    known = _TABLES.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, STEP_BYTES), base)
        known[:1] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= 2 * STEP_BYTES:
            _TABLES[int(base)] = known
    return known[:n]


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of all documents in ``data``: key, hash of the run's bytes,
    document, first window (in ``data``) and number of windows."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    words = np.empty(n - 7, np.uint64)
    raw = data.tobytes()
    for shift in range(8):
        part = np.frombuffer(raw, np.uint64, (n - shift) // 8, shift)
        words[shift::8] = part[: len(words[shift::8])]
    places = n - INNER + 1
    inner = (words[:places] * _M1) ^ (words[8 : places + 8] * _M2 + _M1)
    inner = _mixed(_mixed(inner) + words[INNER - 8 : places + INNER - 8] * _M2)
    inside = LENGTH - INNER + 1
    least, width = inner, 1
    while 2 * width <= inside:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if inside > width:
        rest = inside - width
        least = np.minimum(least[:-rest], least[rest:])
    windows = len(least)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    whole = np.arange(windows) + LENGTH <= offsets[doc + 1]
    fresh = np.ones(windows, bool)
    fresh[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(fresh & whole)
    breaks = np.append(np.flatnonzero(fresh | ~whole), windows)
    count = breaks[np.searchsorted(breaks, starts, side="right")] - starts
    # Of the bytes of a run: the hashes in it, weighted by their place.
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(inner * _powers(_POWER, len(inner)), dtype=np.uint64)])
    ends = starts + count + LENGTH - INNER
    content = (total[ends] - total[starts]) * _powers(_INVERSE, len(inner))[starts]
    return least[starts], _mixed(content + count.astype(np.uint64) * _M1), doc[starts], starts, count


def _steps(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of a batch in steps of about STEP_BYTES."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP_BYTES, side="right")) - 1)
        yield a, b
        a = b


def _narrow(docs: np.ndarray) -> tuple[int, bool, np.ndarray]:
    """Documents as the distance from the least, in 32 bits if that holds it."""
    base = int(docs.min()) if len(docs) else 0
    away = docs.astype(np.int64) - base
    wide = bool(len(away)) and int(away.max()) >= 2**32
    return base, wide, away if wide else away.astype(np.uint32)


def _docs(base: int, wide: bool, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64 if wide else np.uint32).astype(np.int64) + base


def part_of(doc_id: np.ndarray, parts: int) -> np.ndarray:
    mixed = _mixed(np.asarray(doc_id, np.int64).view(np.uint64) * _M1)
    return (mixed % np.uint64(parts)).astype(np.int64)


def entries(docs: DataFrame, parts: int) -> DataFrame:
    """What batches send. Kind 0, dealt by key: 32 bits of each key, the run's
    hash, its least document, and ``mixed``: 0 one run, 1 several of one
    document, 2 several documents that know. Kind 1, dealt by document: what
    the batch already knows, as ``_known`` makes it."""
    schema = arrow_schema(docs.sparkSession, _ENTRIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            got = []
            for a, b in _steps(offsets):
                key, content, doc, _, _ = runs_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                got.append((key, content, ids[a + doc]))
            key, content, doc = (np.concatenate(x) for x in zip(*got, strict=True))
            if len(key):
                yield from sent(key, content, doc)

    def sent(key: np.ndarray, content: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        by = np.lexsort((doc, content, key))
        key, content, doc = key[by], content[by], doc[by]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_run = new_key | np.concatenate([[True], content[1:] != content[:-1]])
        at_key, at_run = np.flatnonzero(new_key), np.flatnonzero(new_run)
        of_key, of_run = np.cumsum(new_key) - 1, np.cumsum(new_run) - 1
        several = np.add.reduceat(new_run.astype(np.int64), at_key) > 1
        low, high = np.minimum.reduceat(doc, at_key), np.maximum.reduceat(doc, at_key)
        mixed = np.where(several, np.where(low < high, 2, 1), 0).astype(np.uint8)
        same = doc > doc[at_run][of_run]
        needed = (mixed[of_key] == 2) & new_run
        part = (key % np.uint64(parts)).astype(np.int64)
        columns = [part[at_key], (key[at_key] >> np.uint64(32)).astype(np.uint32), content[at_key], mixed, low]
        by = np.argsort(columns[0], kind="stable")
        columns = [c[by] for c in columns]
        cuts = np.flatnonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1], [True]]))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            base, wide, away = _narrow(columns[4][a:b])
            rows.append((0, int(columns[0][a]), base, wide, *(x.tobytes() for x in (columns[1][a:b], columns[2][a:b], columns[3][a:b], away))))
        told = _known(doc, same, needed, content, _short(key, parts), parts)
        rows += [(1, p, 0, True, keys, runs, b"", docs) for p, docs, runs, keys in told]
        yield to_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return docs.mapInArrow(run, _ENTRIES)


def _short(key: np.ndarray, parts: int) -> np.ndarray:
    """What entries keep of a key: its part and 32 bits."""
    return (key >> np.uint64(32) << np.uint64(32)) | (key % np.uint64(parts))


def _known(doc, same, needed, content, short, parts: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """(part, documents, run hashes, keys): one element each for a run that is
    covered whole (its hash, key 0) or needed (hash 0, its key)."""
    some = np.flatnonzero(same | needed)
    if not len(some):
        return []
    doc, same = doc[some], same[some]
    runs = np.where(same, content[some], np.uint64(0))
    keys = np.where(same, np.uint64(0), short[some])
    part = part_of(doc, parts)
    by = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(part[by]) != 0, [True]]))
    return [
        (int(part[by[a]]), *(x[by[a:b]].tobytes() for x in (doc, runs, keys)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def answers(sent: DataFrame, parts: int) -> DataFrame:
    """(part, docs, same, keys) of every entry that matters, dealt by document."""

    def run(key: tuple, rows: pa.Table) -> dict:
        kind, part = key
        lists = {name: rows[name].to_pylist() for name in ("base", "wide", "keys", "runs", "mixed", "docs")}
        if kind == 1:
            told = [(part, d, r, k) for d, r, k in zip(lists["docs"], lists["runs"], lists["keys"], strict=True)]
        else:
            short = np.frombuffer(b"".join(lists["keys"]), np.uint32)
            content = np.frombuffer(b"".join(lists["runs"]), np.uint64)
            mixed = np.frombuffer(b"".join(lists["mixed"]), np.uint8)
            doc = np.concatenate([_docs(*x) for x in zip(lists["base"], lists["wide"], lists["docs"], strict=True)])
            by = np.lexsort((doc, content, short))
            short, content, mixed, doc = short[by], content[by], mixed[by], doc[by]
            new = np.concatenate([[True], short[1:] != short[:-1]])
            at, of = np.flatnonzero(new), np.cumsum(new) - 1
            low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
            several = np.maximum.reduceat(mixed, at) > 0
            differs = np.concatenate([[False], (content[1:] != content[:-1]) & ~new[1:]])
            several |= np.logical_or.reduceat(differs, at)
            shared = ((low < high) | (np.maximum.reduceat(mixed, at) == 2))[of]
            needed = shared & several[of] & (mixed < 2)
            same = shared & ~several[of] & (doc > low[of])
            full = short.astype(np.uint64) << np.uint64(32) | np.uint64(part)
            told = _known(doc, same, needed, content, full, parts)
        names = ("part", "docs", "same", "keys")
        return dict(zip(names, zip(*told, strict=True), strict=True)) if told else {n: [] for n in names}

    return group_rows(
        sent.repartition("kind", "part").sortWithinPartitions("kind", "part"),
        ["kind", "part"],
        run,
        "part long, docs binary, same binary, keys binary",
    )


def _texts(docs: DataFrame, parts: int) -> DataFrame:
    """Texts dealt by document, those of a part and a batch compressed
    together: (part, ids, known, sizes, texts, others). A third column of
    ``docs`` goes along as ``others``."""
    schema = arrow_schema(docs.sparkSession, _BUNDLE)

    def beside(batch: pa.RecordBatch, some: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes | None:
        if batch.num_columns < 3:
            return None
        taken, sink = batch.select([2]).take(pa.array(some)), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, taken.schema) as out:
            out.write_batch(taken)
        return packer.compress(sink.getvalue())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid())
            ids = batch.column(0).fill_null(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            part = part_of(ids, parts)
            lost = np.flatnonzero(~known)
            if len(lost):  # they meet nothing, so any place will do, as long as it is not one for all
                hashes = [_text_hash(data[offsets[i] : offsets[i + 1]].tobytes()) ^ int(i) for i in lost]
                part[lost] = part_of(np.array(hashes, np.int64), parts)
            by = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(part[by]) != 0, [True]]))
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = by[a:b]
                raw = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in some)
                sizes = (offsets[some + 1] - offsets[some]).tobytes()
                rows.append((int(part[some[0]]), ids[some].tobytes(), known[some].tobytes(), sizes, packer.compress(raw), beside(batch, some, packer)))
            if rows:
                yield to_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return docs.mapInArrow(run, _BUNDLE)


def _bundles(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array | None]]:
    """(ids, known, bytes, offsets, others) of each bundle of texts among ``rows``."""
    reader = zstandard.ZstdDecompressor()
    names = ("ids", "known", "sizes", "texts", "others")
    for ids, known, sizes, texts, others in zip(*(rows[c].to_pylist() for c in names), strict=True):
        if ids is not None:
            offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
            data = np.frombuffer(reader.decompress(texts), np.uint8)
            beside = others and pa.ipc.open_stream(reader.decompress(others)).read_next_batch().column(0)
            yield np.frombuffer(ids, np.int64), np.frombuffer(known, bool), data, offsets, beside


def _text_hash(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - 2**63


class _Told:
    """Pairs of a document and a number, to look many up at once."""

    def __init__(self, docs: np.ndarray, values: np.ndarray):
        self.docs, self.values = np.unique(docs), np.unique(values)
        self.codes = np.unique(
            np.searchsorted(self.values, values) * len(self.docs) + np.searchsorted(self.docs, docs)
        )

    def holds(self, docs: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(docs), bool)
        d = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        v = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        code = v * len(self.docs) + d
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return (self.docs[d] == docs) & (self.values[v] == values) & (self.codes[at] == code)


def needed_and_covered(docs: DataFrame, told: DataFrame, parts: int) -> DataFrame:
    """Runs whose bytes are needed (``content``), and stretches that are covered
    whole (``content`` null, ``key`` their length)."""
    both = _texts(docs, parts).unionByName(told, allowMissingColumns=True)

    def run(key: tuple, rows: pa.Table) -> dict:
        doc, same, keys = (
            np.frombuffer(b"".join(x for x in rows[c].to_pylist() if x is not None), t)
            for c, t in (("docs", np.int64), ("same", np.uint64), ("keys", np.uint64))
        )
        whole_runs, wanted_keys = _Told(doc[keys == 0], same[keys == 0]), _Told(doc[keys != 0], keys[keys != 0])
        out: dict = {name: [] for name in ("key", "doc_id", "text_hash", "start", "content")}

        def add(key, ids, row, hashes, start, content) -> None:
            out["key"].append(key)
            out["doc_id"].append(ids[row])
            out["text_hash"].append(hashes[row])
            out["start"].append(start)
            out["content"] += content

        for ids, known, data, offsets, _ in _bundles(rows):
            for a, b in _steps(offsets):
                part, where = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                key, content, row, start, count = runs_of(part, where)
                mine = ids[a:b]
                whole = whole_runs.holds(mine[row], content) & known[a:b][row]
                wanted = ~whole & wanted_keys.holds(mine[row], _short(key, parts)) & known[a:b][row]
                raw = part.tobytes()
                hashes = np.zeros(b - a, np.int64)
                for i in np.unique(row[whole | wanted]):
                    hashes[i] = _text_hash(raw[where[i] : where[i + 1]])
                # Whole runs that touch or overlap are one stretch.
                r, first, last = row[whole], start[whole], start[whole] + count[whole] + LENGTH - 1
                if len(r):
                    opens = np.concatenate([[True], (r[1:] != r[:-1]) | (first[1:] > last[:-1])])
                    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(r) - 1)
                    r, first, last = r[opens], first[opens], last[closes]
                    add(last - first, mine, r, hashes, first - where[r], [None] * len(r))
                at = np.flatnonzero(wanted)
                if len(at):
                    ends = start[at] + count[at] + LENGTH - 1
                    texts = [raw[x:y] for x, y in zip(start[at].tolist(), ends.tolist(), strict=True)]
                    add(key[at].view(np.int64), mine, row[at], hashes, start[at] - where[row[at]], texts)
        return {k: v if k == "content" else np.concatenate([np.zeros(0, np.int64), *v]) for k, v in out.items()}

    return group_rows(both.repartition("part").sortWithinPartitions("part"), ["part"], run, _NEEDED)


def covered_windows(contents: list[bytes], docs: np.ndarray) -> list[tuple[int, int, int]]:
    """(content, first, last) of windows that also start in a content of a
    smaller document, by the suffix array of all contents."""
    sizes = np.array([len(c) for c in contents])
    text = np.ones(int(sizes.sum()) + len(contents), np.int32)  # 1 ends a content
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    text[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int32) + 2
    owner = np.repeat(np.arange(len(contents), dtype=np.int32), sizes + 1)
    order = suffix_array(text)
    shared = permuted_prefixes(text, order)
    window = (starts + sizes)[owner] - np.arange(len(text)) >= LENGTH
    fresh = ~((shared >= LENGTH) & window)[order]
    fresh[0] = True
    group = np.flatnonzero(fresh)
    least = np.minimum.reduceat(docs[owner[order]], group)
    covered = np.zeros(len(text), bool)
    covered[order] = least[np.cumsum(fresh) - 1] < docs[owner[order]]
    covered &= window
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    first, last = edges[::2], edges[1::2] - 1
    of = owner[first]
    return list(zip(of.tolist(), (first - starts[of]).tolist(), (last - starts[of]).tolist(), strict=True))


_STRETCH = "doc_id long, text_hash long, start int, size int"


def sorted_shards(needed: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Covered stretches of the needed runs; several keys make a shard. Runs
    with the same bytes are sorted once, for the least document; in larger ones
    they are covered whole."""
    schema = arrow_schema(needed.sparkSession, _STRETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[bytes, int, list]] = []  # bytes, least document, its (text_hash, start)
        group: list[tuple] = []
        size, last = 0, None
        out: dict = {name: [] for name in schema.names}

        def add(doc: int, text_hash: int, start: int, length: int) -> None:
            for name, value in zip(out, (doc, text_hash, start, length), strict=True):
                out[name].append(value)

        def close_group() -> int:
            least: dict[bytes, int] = {}
            for doc, _, _, content in group:
                least[content] = min(doc, least.get(content, doc))
            places: dict[bytes, list] = {content: [] for content in least}
            for doc, text_hash, start, content in group:
                if doc > least[content]:
                    add(doc, text_hash, start, len(content))
                else:
                    places[content].append((text_hash, start))
            if len(least) < 2:  # alone, a run meets no other
                return 0
            shard.extend((content, least[content], places[content]) for content in least)
            return sum(map(len, least))

        def solve() -> pa.RecordBatch:
            docs = np.array([doc for _, doc, _ in shard], np.int64)
            for at, first, end in covered_windows([content for content, _, _ in shard], docs) if shard else ():
                for text_hash, start in shard[at][2]:
                    add(shard[at][1], text_hash, start + first, end - first + LENGTH)
            done = to_batch(out, schema)
            shard.clear()
            for values in out.values():
                values.clear()
            return done

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    size += close_group()
                    group, last = [], key
                    if size >= shard_bytes or len(out["doc_id"]) >= 100_000:
                        yield solve()
                        size = 0
                group.append(tuple(row))
        close_group()
        yield solve()

    ordered = needed.repartition("key").sortWithinPartitions("key")
    return ordered.select("key", "doc_id", "text_hash", "start", "content").mapInArrow(run, _STRETCH)


def counted_windows(hot: DataFrame) -> DataFrame:
    """Covered windows of the runs of hot keys, each window on its own."""

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict = {name: [] for name in ("low", "high", "doc_id", "text_hash", "start")}
        for doc, text_hash, start, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for at in range(len(content) - LENGTH + 1):
                low, high = np.frombuffer(xxhash.xxh3_128_digest(content[at : at + LENGTH]), np.int64).tolist()
                for name, value in zip(out, (low, high, doc, text_hash, start + at), strict=True):
                    out[name].append(value)
        return out

    windows = map_rows(
        hot.select("doc_id", "text_hash", "start", "content"),
        cut,
        "low long, high long, doc_id long, text_hash long, start int",
    )
    least = windows.groupBy("low", "high").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return (
        windows.join(least.where("least < most"), ["low", "high"])
        .where("least < doc_id")
        .select("doc_id", "text_hash", "start", F.lit(LENGTH).alias("size"))
    )


def _kept(raw: bytes, starts: list[int], sizes: list[int]) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes that are left, and (start, size) of what is not; stretches by
    their start, those that touch or overlap are one span."""
    spans: list[list[int]] = []
    for start, size in zip(starts, sizes, strict=True):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], start + size)
        else:
            spans.append([start, start + size])
    edges = [0, *(x for span in spans for x in span), len(raw)]
    left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return left, [(a, b - a) for a, b in spans]


def without(docs: DataFrame, stretches: DataFrame, parts: int) -> DataFrame:
    """What is left of each text, and the spans that are not; texts and
    stretches meet by document. A third column of ``docs`` is kept, and then
    what is left is also returned as a string."""

    def dealt(batch: pa.RecordBatch) -> dict:
        names = ("doc_id", "text_hash", "start", "size")
        return {"part": part_of(batch.column(0).to_numpy(), parts)} | dict(zip(names, batch.columns, strict=True))

    found = map_rows(stretches.select("doc_id", "text_hash", "start", "size"), dealt, f"part long, {_STRETCH}")
    both = _texts(docs, parts).unionByName(found, allowMissingColumns=True)
    more = len(docs.columns) > 2
    schema = KEPT + (f", text string, {docs.select('beside').schema.toDDL()}" if more else "")

    def run(key: tuple, rows: pa.Table) -> dict:
        found = rows.filter(rows["doc_id"].is_valid())
        doc, text_hash, start, size = (found[c].to_numpy() for c in ("doc_id", "text_hash", "start", "size"))
        by = np.lexsort((start, text_hash, doc))
        doc, text_hash, start, size = doc[by], text_hash[by], start[by], size[by]
        out: dict = {name: [] for name in ("doc_id", "kept", "spans", "text")}
        rest: list[pa.Array] = []
        for ids, known, data, offsets, others in _bundles(rows):
            low, high = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
            for i in range(len(ids)):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                a, b = (int(low[i]), int(high[i])) if known[i] else (0, 0)
                if a < b:
                    a, b = a + np.searchsorted(text_hash[a:b], [_text_hash(raw), _text_hash(raw) + 1])
                left, spans = _kept(raw, start[a:b].tolist(), size[a:b].tolist())
                text = left.decode("utf-8", "ignore") if more else None
                for name, value in zip(out, (int(ids[i]) if known[i] else None, left, spans, text), strict=True):
                    out[name].append(value)
            rest += [others] if more else []
        return out | {"beside": pa.concat_arrays(rest) if rest else []}

    return group_rows(both.repartition("part").sortWithinPartitions("part"), ["part"], run, schema)


def deduplicated(
    spark: SparkSession,
    docs: DataFrame,
    *,
    beside: Column | None = None,
    group_bytes: int = GROUP_BYTES,
    shard_bytes: int = SHARD_BYTES,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(doc_id, kept, spans) of every row: the bytes of the text that are left,
    and start and size of each stretch of bytes that was removed. With a column
    ``beside``, also that and the text that is left, as a string."""
    others = [] if beside is None else [beside.alias("beside")]
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *others)
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first().n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / group_bytes))
    told = answers(entries(texts, parts), parts)
    found = materialize(spark, needed_and_covered(texts, told, parts), "repeats-runs")
    needed = found.where("content IS NOT NULL")
    whole = found.where("content IS NULL").select("doc_id", "text_hash", "start", F.col("key").cast("int").alias("size"))
    heavy = needed.groupBy("key").agg(F.sum(F.octet_length("content").cast("long")).alias("n")).where(F.col("n") > hot_bytes)
    heavy = materialize(spark, heavy.select("key"), "repeats-hot")
    stretches = whole
    if heavy.isEmpty():
        stretches = stretches.unionByName(sorted_shards(needed, shard_bytes))
    else:
        stretches = stretches.unionByName(sorted_shards(needed.join(heavy, "key", "left_anti"), shard_bytes))
        stretches = stretches.unionByName(counted_windows(needed.join(heavy, "key", "left_semi")))
    return without(docs, materialize(spark, stretches, "repeats-stretches"), parts)


def cleaned(spark: SparkSession, docs: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``docs`` with what is left of each text, and ``spans``: start
    and size of what was removed from its UTF-8 bytes. Spans can begin or end
    inside a character; the rest of such a one goes too. Null texts stay null.
    Where the documents have a column ``spans``, the new one has underscores more."""
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
    taken, spans = {c.lower() for c in docs.columns}, "spans"
    while spans in taken:
        spans += "_"
    others = F.struct(*[F.col(quoted[c]) for c in docs.columns if c != "text"])
    row = F.struct(F.col("text").isNull().alias("none"), others.alias("row"))
    done = deduplicated(spark, docs, beside=row, **bounds)
    text = F.when(~F.col("beside.none"), F.col("text")).alias("text")
    kept = [text if c == "text" else F.col("beside.row").getField(c).alias(c) for c in docs.columns]
    return done.select(*kept, F.col("spans").alias(spans))


def removed(spark: SparkSession, docs: DataFrame, **bounds: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    done = deduplicated(spark, docs, **bounds)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["size"])
    return done.select(
        "doc_id",
        (F.octet_length("kept") + gone).alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
