"""Prefix CRCs and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import resample
from strata.llm.common import numbered, text_bytes

RND = random.Random(5)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = ["the", "Zoo", "é1", "naïve", "x", "日本", "k" * 70, "re", "sat", "10"]
ROWS = [(None, "a null id"), (None, "a null id"), (0, None), (1, ""), (2, " -,.\n"), (3, "one"), (4, "y" * 9000)]
ROWS += [(i, RND.choice([" ", "--", ", "]).join(RND.choices(VOCABULARY, k=RND.randint(1, 60)))) for i in range(10, 90)]
ROWS += [(90, ROWS[20][1]), (91, ROWS[20][1]), (20, ROWS[21][1]), (20, ROWS[21][1]), (95, "the zoo sat " * 30_000)]
TARGET = [(1, "the zoo sat the zoo"), (2, None), (3, "naïve 10 x"), (4, "")]


def _features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [" ".join(p) for p in zip(words, words[1:], strict=False)]


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 1000, 140_001])
def test_every_substring_has_its_crc(n):
    data = np.frombuffer(RND.randbytes(n), np.uint8)
    states = resample.running(data)
    assert len(states) == n + 1
    ends = [sorted((RND.randint(0, n), RND.randint(0, n))) for _ in range(40)] + [[0, n], [n, n]]
    start, end = np.array(ends).T
    crc = states[end] ^ resample.shifted(states[start] ^ resample.ONES, end - start) ^ resample.ONES
    assert crc.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in ends]


@pytest.mark.parametrize("step", [1, 100, resample.STEP])
def test_features_of_any_step(monkeypatch, step):
    monkeypatch.setattr(resample, "STEP", step)
    texts = [t for _, t in ROWS]
    got = Counter()
    for _, data, offsets in resample.steps(pa.array(texts)[3:]):
        for bucket, runs, _ in resample.features(data, offsets, 2, 10000):
            got.update(bucket.tolist())
            assert runs[-1] == len(bucket)
    want = Counter(zlib.crc32(f.encode()) % 10000 for t in texts[3:] for f in _features(t)[1])
    assert got == want and text_bytes(pa.array(texts))[1][-1] == sum(len((t or "").encode()) for t in texts)


def _brute(rows, target, percent, least):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in _features(t)[1])

    s, t = counts(x for _, x in rows), counts(x for _, x in target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in set(s) | set(t)
    }
    out = []
    for doc, text in rows:
        words, found = _features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words), len(found), weight, score])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return Counter((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out)


@pytest.mark.parametrize(("percent", "least"), [(25, 20), (100, 0), (0, 20), (50, 1)])
def test_draw_is_that_of_plain_python(spark, percent, least):
    # columns whose names the operator uses inside
    docs = spark.createDataFrame([(i, t, 1, 2, 3.0) for i, t in ROWS], "doc_id long, text string, rank int, weight int, score double")
    bench = spark.createDataFrame(TARGET, "item_id long, text string")
    got = resample.resample(spark, docs.repartition(4), bench, percent=percent, min_words=least)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    rows = got.collect()
    assert Counter(tuple(r) for r in rows) == _brute(ROWS, TARGET, percent, least)
    ranks = sorted(r["rank"] for r in rows if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1))
    ids = {r.doc_id for r in rows if r["rank"] is not None}
    kept = resample.drawn(docs, got).collect()
    assert Counter(r.doc_id for r in kept) == Counter(i for i, _ in ROWS if i in ids)


def test_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    none = docs.limit(0)
    assert resample.resample(spark, none, docs).count() == 0
    assert Counter(map(tuple, resample.resample(spark, docs, none).collect())) == _brute(ROWS, [], 25, 20)


def test_places_of_equal_rows(spark):
    rows = spark.createDataFrame([(i % 3, "v") for i in range(300)], "k long, v string").repartition(5)
    got = numbered(spark, rows, ["k"], "t-numbered").collect()
    assert sorted(r.place for r in got) == list(range(1, 301))
    assert all(r.k == (r.place - 1) // 100 for r in got)
