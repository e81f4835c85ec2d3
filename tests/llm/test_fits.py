"""Fits, thresholds and bounds of the models and of the pieces."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, langid, pii, quality
from strata.llm.common import first_by_hash


def _jobs(spark, run):
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- 4 -----------------------------------------------------------------------


def test_jobs_of_the_language_sample_do_not_grow_with_languages(spark, monkeypatch):
    monkeypatch.setattr(langid.Network, "train", lambda self, texts, labels: self)
    few, many = (
        spark.createDataFrame([(i, f"text {i} of words", f"l{i % n:02d}") for i in range(600)], "doc_id long, text string, lang string")
        for n in (3, 60)
    )
    one, jobs = _jobs(spark, lambda: langid.fit(few))
    other, more = _jobs(spark, lambda: langid.fit(many))
    assert len(one.langs) == 3 and len(other.langs) == 60 and more == jobs <= 8


def test_the_sample_is_the_first_by_hash_of_each_language(spark):
    rows = [(i, f"part {i % 50}", "hot" if i % 3 else f"l{i % 7}") for i in range(900)] + [(None, "part", "hot"), (5, "part 5", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, part string, lang string").repartition(5)
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    got = langid.first_of_each(spark, docs, 20, counts).collect()
    for lang, total in counts.items():
        some = docs.where(F.col("lang") == lang).select("doc_id", "part")
        want = first_by_hash(some, 20, "doc_id", "part", total=total).collect()
        assert sorted((str(r.doc_id), r.part) for r in want) == sorted((str(r.doc_id), r.part) for r in got if r.lang == lang)


def test_scores_of_documents_are_those_of_the_layers():
    rng = np.random.default_rng(3)
    network = langid.Network.fresh(["a", "b", "c"], 5)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (1, 127, 128, 129, 0, 700, 5)]
    offsets = np.cumsum([0, *(len(t) for t in texts)])
    got = network.documents(np.concatenate(texts), offsets)
    for text, mean in zip(texts, got, strict=True):
        total = np.zeros(3)
        for at in range(0, len(text), langid.WINDOW):
            codes = text[at : at + langid.WINDOW, None]
            states = [network.layer(way, codes, np.ones(codes.shape, np.float32), False)[0] for way in ("ahead", "back")]
            total += network.probabilities(tuple(states)).sum(axis=1)
        assert np.abs(mean - total / max(1, len(text))).max() < 1e-4


# --- 10 ----------------------------------------------------------------------


def test_the_prior_counts_all_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED", 50)
    monkeypatch.setattr(quality, "POSITIVES", 60)
    rnd = random.Random(1)
    say = lambda good: " ".join("".join(rnd.choices("abcdef", k=5)) for _ in range(40)).capitalize() + ("." if good else "#| 9" * 60)
    rows = [(i, say(i % 4 == 0)) for i in range(800)] + [(None, "x y"), (-(2**63), "least long")] + [(4, say(True))] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 800, 4)], "doc_id long, quality int")
    seen, real = [], quality.estimate_prior
    monkeypatch.setattr(quality, "estimate_prior", lambda p, below: seen.append(below) or real(p, below))
    model = quality.fit(docs, labels)
    assert seen[0].sum() == len(rows) and 0.3 < model.prior < 0.65  # 200 of 800, and 300 copies of one


def test_features_come_once_for_an_id(spark):
    docs = spark.createDataFrame([(7, "same id")] * 500 + [(7, "another"), (8, "b")], "doc_id long, text string").repartition(3)
    x = quality.map_features(docs)
    assert len(x) == 2 and np.allclose(x[0], list(quality.features(pa.array(["another"])))[0])


def test_histograms_give_the_prior_of_the_scores():
    rng = np.random.default_rng(5)
    positive, other = rng.normal(2, 1, 3000), np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 7000)])
    cuts = quality.prior_cuts(positive)
    below = quality.counted(other, cuts)
    assert below.sum() == len(other) and (below[1:].sum() == (other >= cuts[0]).sum())
    assert abs(quality.estimate_prior(positive, below) - 0.3) < 0.05


# --- 7 -----------------------------------------------------------------------


def _phones(spark, unconfirmed, extra=()):
    rnd = random.Random(2)
    number = lambda: f"({rnd.randint(200, 989)}) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"
    rows = [(i, f"please call +1 {number()} today") for i in range(300)]
    rows += [(1000 + i, f"please call {number()} today") for i in range(unconfirmed)]
    rows += [(5000 + i, text) for i, text in enumerate(extra)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("unconfirmed", [0, 60, 300, 1500])
def test_unconfirmed_data_does_not_switch_a_kind_off(spark, unconfirmed):
    decoys = ["order 2024-12-25 10 30 45", "isbn 978 316 148 4100", "a 12 34 56 b", "on 25.12.2024 10 30 11", "at 10.20.30.40 now"]
    decoys += [f"order no. 555 {100 + i} {1000 + i}" for i in range(20)]
    found = {r.doc_id: r.spans for r in pii.find(spark, _phones(spark, unconfirmed, decoys)).collect()}
    hits = sum("phone:" in found[1000 + i] for i in range(unconfirmed))
    assert hits >= 0.9 * unconfirmed
    assert not any("phone:" in found[5000 + i] for i in range(len(decoys)))


def test_national_groupings_are_proposed(spark):
    texts = ["06 12 34 56 78", "020 7946 0958", "(0)30 1234 5678", "030/1234567 89", "00 49 30 123456", "555.123.4567", "91 234 56 78 90"]
    docs = _phones(spark, 0, [f"please call {t} today" for t in texts])
    found = {r.doc_id: r.spans for r in pii.find(spark, docs).where("doc_id >= 5000").collect()}
    missed = [t for i, t in enumerate(texts) if "phone:" not in found[5000 + i]]
    assert missed == []


def test_a_long_run_of_digit_groups_is_read_in_line(spark):
    docs = _phones(spark, 0, ["12 " * 40_000, "1" * 60_000, "(12" * 20_000, None, ""])
    assert pii.find(spark, docs).count() == 305


def test_redaction_keeps_columns_of_any_name(spark):
    docs = _phones(spark, 5).select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in ("base_spans", "proposals", "spans", "Spans_", "a.b")])
    trees = pii.fit_trees(pii.spans_found(docs.select("doc_id", "text")))
    want = {r.doc_id: tuple(r)[2:] for r in docs.collect()}
    for out in (pii.redact(docs, trees), pii.redacted(spark, docs)):
        assert out.schema == docs.schema
        rows = out.collect()
        assert {r.doc_id: tuple(r)[2:] for r in rows} == want and len(rows) == 305
        assert all(r.text == "please call [PHONE] today" for r in rows)


# --- 1 -----------------------------------------------------------------------


@pytest.mark.parametrize("rate", [decontaminate.REWORDED, 0.08])
def test_steps_of_any_size_find_the_same(monkeypatch, rate):
    rnd = random.Random(3)
    say = lambda n: " ".join("".join(rnd.choices("abcde", k=rnd.randint(2, 6))) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate((9, 16, 25, 40))]
    texts = [None, "", say(3)]
    for _ in range(30):
        words = rnd.choice(items)[1].split()
        words[rnd.randrange(len(words))] = "zz"
        texts.append(" ".join([say(rnd.randint(0, 200)), *words, say(rnd.randint(0, 200))]))
    texts.append(" ".join(texts[5:25]) * 3)
    index = decontaminate.PieceIndex(items, rate)
    want = index.search(pa.array(texts))
    assert len({row for row, _ in want}) > 25
    for size, hits in ((1 << 20, 50), (700, 1 << 20), (400, 9)):
        monkeypatch.setattr(decontaminate, "STEP_BYTES", size)
        monkeypatch.setattr(decontaminate, "STEP_HITS", hits)
        assert decontaminate.PieceIndex(items, rate).search(pa.array(texts)) == want


# --- 5 -----------------------------------------------------------------------


def test_rows_without_an_id_are_many_parts(spark):
    from strata.llm import repeats

    rows = spark.createDataFrame([(None, f"text number {i} of many" * 3) for i in range(400)], "doc_id long, text string")
    parts = repeats._texts(rows.repartition(2), 16).groupBy("part").count().collect()
    assert len(parts) == 16
    same = spark.createDataFrame([(None, "the same text, over and over " * 3)] * 400, "doc_id long, text string")
    assert len(repeats._texts(same.coalesce(1), 16).select("part").distinct().collect()) > 8
    assert repeats.removed(spark, same).agg(F.sum("n_removed")).first()[0] == 0


def test_cleaned_keeps_columns_of_any_name(spark):
    from strata.llm import repeats

    passage = "a passage of more than fifty bytes that two documents have in common"
    rows = [(1, passage, "a", 1, 2.5), (2, "x " + passage + " y", "b", 2, None), (3, None, None, 3, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, _none int, `a.b` double")
    got = repeats.cleaned(spark, docs)
    assert got.columns == [*docs.columns, "spans_"]
    out = {r.doc_id: r for r in got.collect()}
    assert {i: tuple(r)[2:5] for i, r in out.items()} == {r[0]: r[2:] for r in rows}
    assert out[2].text == "x  y" and [tuple(s) for s in out[2].spans_] == [(2, len(passage))] and out[3].text is None


@pytest.mark.parametrize("induced", [0, 64, 1 << 17])
def test_suffixes_are_in_order_wherever_the_recursion_ends(monkeypatch, induced):
    from strata.llm import suffixes

    monkeypatch.setattr(suffixes, "INDUCED", induced)
    rng = np.random.default_rng(0)
    for n, letters in ((0, 2), (1, 3), (2, 2), (10, 2), (300, 2), (3000, 3), (3000, 200)):
        text = rng.integers(1, letters + 1, n).astype(np.int32)
        text[n // 3 : n // 3 * 2] = text[: n // 3 * 2 - n // 3]  # a long repeat
        raw = text.astype(">u2").tobytes()
        assert suffixes.suffix_array(text).tolist() == sorted(range(n), key=lambda i: raw[2 * i :])


def test_short_items_are_found_between_word_boundaries():
    items = [(1, "Who wrote it?"), (2, "yes"), (3, "a b c"), (4, "over and out")]
    texts = ["so who wrote -- it, then", "who wrote item", "awho wrote it", "yes", "oh yes", "a b c", "over and out", "Over and out!", None]
    texts += ["x over and", "out"]  # not across documents
    got = decontaminate.PieceIndex(items, 0.15).search(pa.array(texts))
    assert got == {(0, 0): 0, (3, 1): 0, (5, 2): 0, (6, 3): 0, (7, 3): 0}
