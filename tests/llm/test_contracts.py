"""Operators against brute-force versions, on awkward rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import cover_tree, decontaminate, langid, minhash, packing, pii, quality, queries, repeats, toxicity, warc
from strata.llm.common import components, crc_fold
from strata.llm.queries import vocabulary

RND = random.Random(11)


def word():
    return "".join(RND.choice("abcdeé") for _ in range(RND.randint(1, 7)))


PASSAGES = [" ".join(word() for _ in range(RND.randint(12, 60))) for _ in range(10)]
AWKWARD = [(None, PASSAGES[0]), (0, None), (1, ""), (2, " \n"), (3, "x" * 49), (4, "x" * 400), (5, "ab" * 150), (6, "a b")]
TEXTS = AWKWARD + [
    (i, " ".join(RND.choice(PASSAGES) if RND.random() < 0.5 else word() for _ in range(RND.randint(1, 14))))
    for i in range(10, 80)
]
TEXTS += [TEXTS[20], (500, TEXTS[20][1]), (501, TEXTS[21][1] + " end"), (-3, PASSAGES[1])]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "x", i, 7) for i, t in TEXTS]
    # columns whose names the operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, sig string, rep long, part long").repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def _union(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(5, 5), (60, 61), (61, 3), (60, 61)]
    got = {r.v: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    want = _union({v for e in edges for v in e}, edges)
    want.pop(5)  # alone
    assert got == want


# --- 1: decontamination ---------------------------------------------------


def _distance(pattern: bytes, text: bytes) -> int:
    column, best = list(range(len(pattern) + 1)), len(pattern)
    for byte in text:
        before, column[0] = column[:], 0
        for i, p in enumerate(pattern, 1):
            column[i] = min(before[i] + 1, column[i - 1] + 1, before[i - 1] + (p != byte))
        best = min(best, column[-1])
    return best


def test_pieces_find_every_item_within_the_budget(spark):
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 8, 9, 20, 40))]
    items += [(9, None), (10, ""), (11, "?!"), (0, items[0][1])]
    rows = list(AWKWARD)
    for i in range(100, 160):
        parts = [word() for _ in range(10)]
        text = RND.choice(items[:5])[1]
        for _ in range(RND.randint(0, 6)):
            at = RND.randrange(len(text))
            text = text[:at] + RND.choice(["", "q", "ZZ"]) + text[at + RND.randint(0, 2) :]
        rows.append((i, " ".join(parts) + " -- " + text.upper() + "! " + " ".join(parts)))
    rows += [(200, items[0][1].upper() + " ..."), (201, "b" + items[0][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plain = lambda t: decontaminate.normalized(pa.array([t or ""]))[0].strip()
    want = {}
    for doc, text in rows:
        for item, pattern in items[:5]:
            p, t = plain(pattern), plain(text)
            budget = int(0.08 * len(p))
            there = p == t or (p.count(b" ") >= 2 and b" " + p + b" " in b" " + t + b" ")
            d = (0 if there else 99) if len(p) < decontaminate.SHORT else _distance(p, t)
            if d <= budget:
                want[doc, item] = (d, budget)
    assert any(d for d, _ in want.values()) and (200, 0) in want
    for block in (10**6, 60):  # one block of items, and many
        got = decontaminate.contaminated(spark, docs, bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id): (r.distance, r.budget) for r in got} == want and len(got) == len(want)
    kept = decontaminate.clean(docs, bench, block_bytes=60)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in rows if d not in {k[0] for k in want})
    assert decontaminate.contaminated(spark, docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(spark, docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("rate", [decontaminate.REWORDED, 0.2])
def test_short_pieces_find_reworded_items(rate):
    rnd = random.Random(8)
    say = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate((6, 9, 16, 16, 40))]
    texts = [None, "", items[0][1]]
    for _ in range(60):
        words = rnd.choice(items)[1].split()
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randint(0, 1)] = [say(1)]
        texts.append(" ".join([say(5), *words, say(5)]))
    want = {}
    for row, text in enumerate(texts):
        for at, (_, item) in enumerate(items):
            d = _distance(item.encode(), (text or "").encode())
            if d <= int(rate * len(item)):
                want[row, at] = d
    assert len({d for d in want.values()}) > 5
    for step in (256, 7):
        assert decontaminate.PieceIndex(items, rate).search(pa.array(texts), step) == want


def test_an_inserted_word_does_not_hide_a_short_item(spark, tmp_path):
    item = "which of the planets has the longest day and how many hours does it last in all"
    text = "so: " + item.replace("longest", "longest measured") + "? who knows"
    docs = spark.createDataFrame([(1, text), (2, "the planets have days of many hours")], "doc_id long, text string")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op1_pigeonhole_decontamination(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got] == [(1, 0, 9)]


# --- 2: cover trees ---------------------------------------------------------


def test_dual_traversal_finds_the_exact_links(spark):
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        for centre in rng.normal(size=(12, 16)):
            rows += [(label, centre + rng.normal(size=16) * RND.choice([0.05, 0.2, 0.35])) for _ in range(18)]
    rows += [(1, rows[0][1]), (1, rows[0][1] * 3)]
    rows = [(i, [float(x) for x in v], label) for i, (label, v) in enumerate(rows)]
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [float("nan")] * 16, 1)]
    odd += [(905, rows[0][1], None), (None, rows[0][1], 1), (906, rows[0][1][:8], 1), (rows[5][0], rows[5][1], rows[5][2])]
    table = spark.createDataFrame(
        [(*r, r[0]) for r in rows + odd], "vec_id long, embedding array<double>, label int, block long"
    )
    links = [
        (a, b)
        for a, u, k in rows
        for b, v, m in rows
        if a < b and k == m and np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.93
    ]
    counts, want = Counter(x for e in links for x in e), _union([r[0] for r in rows], links)
    for block in (2048, 20):
        got = cover_tree.near_duplicates(spark, table, block=block).collect()
        assert len(got) == len(rows) + len(odd)
        for r in got:
            if r.vec_id in want:
                assert (r.n_links, r.component_id, r.kept) == (counts[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
            else:
                assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert cover_tree.near_duplicates(spark, table.limit(0)).count() == 0


# --- 3: packing -------------------------------------------------------------


def test_word_tokenizer_equals_the_whole_one():
    encode = packing.WordTokenizer(vocabulary("word_bpe_49k.json"))
    texts = ["", "It's Déjà vu’s ½ x² don't I'LL", "<|endoftext|> a", "İ ΣΑΣ é", "'s't 're x'sy !'s", "a\x0b\x1cb　c", " ­日本"]
    texts += [t or "" for _, t in TEXTS]
    assert encode(texts) == [encode.whole(t) for t in texts] == encode(texts)


@pytest.mark.parametrize("seed", range(40))
def test_plans_hold_every_piece_once(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([5, 9, 32, 100])
    counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(1, 300)))
    places, packed = defaultdict(list), Counter()
    for length, _, n, first, offset in packing.plan_sequences(counts, capacity).tolist():
        packed[length] += n
        for i in range(n):
            places[first + i].append((offset, length))
    assert packed == counts
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(places) <= 1 + 11 / 9 * -(-sum(k * v for k, v in counts.items()) // capacity) + sum(
        v for k, v in counts.items() if 2 * k > capacity
    )


def test_pack_covers_all_tokens(spark, docs):
    path = vocabulary("word_bpe_49k.json")
    encode = packing.WordTokenizer(path)
    rows = packing.pack(spark, docs, path, capacity=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    for doc, text in TEXTS:
        ids = encode.whole(text or "") + bytes(4)
        crcs = Counter((k, 64 * k, zlib.crc32(ids[256 * k : 256 * k + 256])) for k in range(-(-len(ids) // 256)))
        times = sum(1 for d, _ in TEXTS if d == doc)
        assert Counter((r.piece, r.start, r.ids_crc32) for r in by_doc[doc]) == Counter({k: times for k in crcs})
    assert packing.pack(spark, docs.limit(0), path).count() == 0


def test_sequences_hold_the_ids_of_all_documents(spark, docs, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    encode = packing.WordTokenizer(path)
    packing.write_sequences(packing.placed(spark, docs, path, capacity=64), f"{tmp_path}/sequences")
    rows = spark.read.parquet(f"{tmp_path}/sequences").collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    got = Counter()
    for r in rows:
        assert 0 < r.n_ids <= 64 and len(r.ids) == 4 * r.n_ids
        assert [p.offset for p in r.pieces] == [sum(p.length for p in r.pieces[:k]) for k in range(len(r.pieces))]
        got.update((p.doc_id, p.start, bytes(r.ids[4 * p.offset : 4 * (p.offset + p.length)])) for p in r.pieces)
    want = Counter()
    for doc, text in TEXTS:
        ids = encode.whole(text or "") + bytes(4)
        want.update((doc, at // 4, ids[at : at + 256]) for at in range(0, len(ids), 256))
    assert got == want
    assert packing.sequences(packing.placed(spark, docs.limit(0), path)).count() == 0


# --- 5: suffix arrays -------------------------------------------------------


def _removed(rows):
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], doc)
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49 if doc is not None else 0):
            if first[raw[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        yield doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("bounds", [{}, {"hot_bytes": 300, "shard_bytes": 2000, "group_bytes": 2000}])
def test_repeats_match_brute_force(spark, docs, bounds):
    got = [tuple(r) for r in repeats.removed(spark, docs, **bounds).collect()]
    assert sorted(got, key=repr) == sorted(_removed(TEXTS), key=repr)
    assert sum(r[2] for r in got) > 1000


def test_repeats_of_an_empty_table(spark, empty):
    assert repeats.removed(spark, empty).count() == 0


def test_cleaned_has_the_texts_that_are_left(spark, docs, empty):
    first = {}
    for i, t in TEXTS:
        raw = (t or "").encode()
        for at in range(len(raw) - repeats.LENGTH + 1 if i is not None else 0):
            window = raw[at : at + repeats.LENGTH]
            first[window] = min(i, first.get(window, i))
    want = []
    for i, t in TEXTS:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - repeats.LENGTH + 1 if i is not None else 0):
            if first[raw[at : at + repeats.LENGTH]] < i:
                gone[at : at + repeats.LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int))).tolist()
        left = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        spans = tuple((a, b - a) for a, b in zip(edges[::2], edges[1::2], strict=True))
        want.append((i, None if t is None else left.decode("utf-8", "ignore"), "x", i, 7, spans, left))
    got = repeats.cleaned(spark, docs)
    assert got.columns == [*docs.columns, "spans"] and got.drop("spans").schema.simpleString() == docs.schema.simpleString()
    assert Counter((*r[:5], tuple(map(tuple, r.spans))) for r in got.collect()) == Counter(w[:6] for w in want)
    assert any(w[5] for w in want)
    kept = repeats.deduplicated(spark, docs).collect()
    assert Counter((r.doc_id, bytes(r.kept)) for r in kept) == Counter((w[0], w[6]) for w in want)
    assert repeats.cleaned(spark, empty).count() == 0


# --- 6: MinHash -------------------------------------------------------------


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    rows = list(AWKWARD) + [(-9, "A  b"), (7, "Eins zwei"), (8, "eins\tZWEI")]
    base = [word() for _ in range(300)]
    for i in range(100, 190):  # a family that straddles the threshold
        copy = list(base)
        for _ in range(RND.randint(0, 12)):
            copy[RND.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, " ".join(word() for _ in range(40))) for i in range(20)] + [rows[20], (400, rows[20][1])]
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        n = max(1, len(words) - 4) if words else 0
        sets[doc] = {tuple(words[i : i + 5]) for i in range(n)}
    ids = sorted(d for d in sets if d is not None)
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = _union(ids, links)
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, family string")
    for block in (65_536, 900):
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
        got = minhash.near_duplicates(spark, table).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want.get(r.doc_id))
            assert r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    assert len(set(want.values())) < len(want) - 10
    assert minhash.near_duplicates(spark, table.limit(0)).count() == 0


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**63, 800, np.uint64), rng.integers(0, 2**63, (2, 200), np.uint64)
    one, two = (minhash.packed(minhash.minima(np.concatenate([shared, x]))) for x in own)
    assert abs(minhash.estimates(one, two[None])[0] - 800 / 1200) < 0.15
    assert abs(minhash.estimates(one, minhash.packed(minhash.minima(own[1]))[None])[0]) < 0.25


# --- 7: PII -----------------------------------------------------------------

PATTERNS = {  # fixed values
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return True


def test_base_spans_match_the_patterns(spark):
    texts = [
        None, "", "mail a.b@c.d.e, or x@y. z@w-1.co", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0255 1.2.3.4.",
        "4337166598464399 4111 1111 1111 1111 4111-1111-1111-1112 12345678901234567890123 1-2--3 4",
        "+1 (988) 555-2485 +49 (0) 1234567890 +1 2 +12345678901234567890 +-1", "é😀 a@b.c 😀+1 (988) 555-2485",
        "1 " * 9000, "9" * 30_000, "a@b.c@d.e_f@g.h", "a%b+c@d-e.f-g", "+1 (389) 555-5010" * 3, "1.2.3.4@5.6 7.8.9.10",
    ]
    rnd = random.Random(5)
    texts += ["".join(rnd.choice("0123456789..@@ab -+()") for _ in range(80)) for _ in range(120)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a@b.c", "x"), (2, texts[2], "x"), (900, "a" * 50_000, "x")]
    found = pii.find(spark, spark.createDataFrame(rows, "doc_id long, text string, base_spans string")).collect()
    assert len(found) == len(rows)
    for r in found:
        text = dict((i, t) for i, t, _ in rows)[r.doc_id] or ""
        spans = sorted(
            (m.start(), k, m.end(), kind)
            for k, (kind, pattern) in enumerate(PATTERNS.items())
            for m in (re.finditer(pattern, text) if r.doc_id != 900 else ())
            if _valid(kind, m[0])
        )
        said = [f"{kind}:{a}:{b}" for a, _, b, kind in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        assert set(said) <= set(r.spans.split(",") if r.spans else [])


def test_trees_add_proposals_that_look_like_confirmed_ones(spark):
    rows = [(i, f"call +1 ({200 + i}) 555-{1000 + i} or write to user.{i}@mail{i}.example.com now") for i in range(60)]
    rows += [(100, "call (389) 555-5010 now; joe(at)mail.example(dot)com"), (101, "nothing 12 here"), (102, None)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    spans = {r.doc_id: r.spans for r in pii.find(spark, docs).collect()}
    assert spans[100] == "phone:5:19,email:25:52" and spans[101] == "" and spans[102] == ""
    trees = pii.fit_trees(pii.spans_found(docs))
    out = {r.doc_id: r for r in pii.redact(docs, trees).collect()}
    assert out[100].text == "call [PHONE] now; [EMAIL]" and out[102].text is None and out[101].text == rows[61][1]
    assert out[3].text == "call [PHONE] or write to [EMAIL] now" and pii.redact(docs, trees).columns == docs.columns
    plan = pii.find(spark, docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 4, 8, 10: models -------------------------------------------------------


def test_language_model_learns_and_rejects(spark, empty):
    letters = {"aa": "abcdef", "bb": "uvwxyz", "cc": "éèàçùâ"}
    rnd = random.Random(2)
    rows = []
    for i in range(240):
        lang = rnd.choice(list(letters))
        rows.append((i, " ".join("".join(rnd.choices(letters[lang], k=5)) for _ in range(rnd.randint(3, 120))), lang))
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "123 !? 4", "bb"), (None, "abc def", None), (0, *rows[0][1:])]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, score long")
    got = langid.identify(spark, docs).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif r.doc_id is not None:
            assert r.held_out == (crc_fold(r.doc_id, 5) == 0)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and r.doc_id < 900]
    assert np.mean(right) > 0.95
    kept = langid.keep_identified(docs, langid.fit(docs))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(240))
    assert kept.where("doc_id >= 900").count() == 0
    assert langid.identify(spark, empty).count() == 0
    alone = langid.identify(spark, spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string"))
    assert [(r.lang_pred, r.score) for r in alone.collect()] == [("und", 0.0)]


def test_backpropagation_through_time_matches_differences():
    network = langid.Network.fresh(["a", "b"], 3)
    network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    rng = np.random.default_rng(0)
    codes, labels = rng.integers(0, 256, (6, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    inside = np.ones((6, 4))
    inside[4:, 1] = 0

    def loss():
        states = [network.layer(way, codes, inside, False)[0].astype(float) for way in ("ahead", "back")]
        p = network.probabilities(tuple(states)).reshape(2, 6, 4)
        return -(np.log(p[labels, :, np.arange(4)]).T * inside).sum() / inside.sum()

    for key, gradient in network.gradients(codes, inside, labels).items():
        at = (1, int(codes[2, 1])) if "table" in key else (0, 0)
        network.weights[key][at] += 1e-3
        high = loss()
        network.weights[key][at] -= 2e-3
        low = loss()
        network.weights[key][at] += 1e-3
        assert abs((high - low) / 2e-3 - gradient[at]) < 1e-4


def _labelled(spark, make, name, n=400):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        one = rnd.random() < 0.5
        rows.append((i, make(rnd, one), "en"))
        labels.append((i, int(one), int(one)))
    rows += [(900, None, "en"), (901, "", "en"), (None, "some text", "en"), (5, rows[5][1], "en")]
    labels += [(None, 1, 1), (902, None, None), (5, labels[5][1], labels[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("toxic", F.lit("x"))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((r[0], r[1]) for r in labels)


def test_toxicity_votes_are_right_and_exact(spark, empty, monkeypatch):
    monkeypatch.setattr(toxicity, "CHI_SQUARE", 10.0)

    def make(rnd, one):
        text = [word() for _ in range(40)]
        return " ".join(text + (rnd.choices(["vilest", "scummy", "wretch"], k=3) if one else []))

    docs, labels, truth = _labelled(spark, make, "toxic")
    got = toxicity.score(spark, docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(crc_fold(i, 3) != 1 for r in held for i in r.evidence)
    index = toxicity.fit(docs, labels)
    matrix = np.zeros((len(index.ids), len(index.place)))
    for block, weights in enumerate(index.postings):
        some = np.flatnonzero(index.slots[block] >= 0)
        rows = matrix[block * toxicity.BLOCK : (block + 1) * toxicity.BLOCK]
        rows[:, some] = weights[index.slots[block, some]].T[: len(rows)]
    for row in docs.limit(60).collect():
        terms, weights = index.vector(toxicity.terms_of(row.text, index.gate))
        query = np.zeros(len(index.place))
        query[terms] = weights
        every = np.sort((matrix @ query)[matrix @ query > 0])[::-1][: toxicity.K]
        assert np.allclose(index.nearest(terms, weights)[0], every)
    assert toxicity.score(spark, empty, labels).count() == 0
    assert {r.score for r in toxicity.score(spark, docs, labels.limit(0)).collect()} == {0.0}


def test_quality_from_positives_and_unlabelled(spark, empty):
    def make(rnd, one):
        text = " ".join(word() for _ in range(60)).capitalize() + "."
        return text if one else text.upper().replace(" ", "!! ")

    docs, labels, truth = _labelled(spark, make, "quality")
    got = quality.score(spark, docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert 0.35 < quality.fit(docs, labels).prior < 0.7
    assert quality.score(spark, empty, labels).count() == 0
    assert {r.score for r in quality.score(spark, docs, labels.limit(0)).collect()} == {0.0}


# --- 9: WARC ----------------------------------------------------------------


@pytest.mark.parametrize("archive_bytes", [300, 8_000_000])
def test_archives_round_trip(spark, archive_bytes):
    rows = [(3, "http://a b\r\nX: y", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (None, "u", "zz")]
    rows += [(None, None, "<p>é</p>"), (7, "x", "P*M\x18\0\0\0\0\r\n\r\nWARC/1.1 " * 50), (1, "again", "<p>é</p>")]
    rows += [(i, f"http://h/{i}", "<html>" + " ".join(word() for _ in range(300)) + "</html>") for i in range(20, 60)]
    rows += [(i + 100, "copy", rows[i][2]) for i in range(10, 20)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha string")
    got = warc.archived(spark, pages, archive_bytes=archive_bytes).collect()
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    want = Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        first = least.get(html or "") if page is not None else page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[page, len(raw), digest, "response" if first == page else "revisit", None if first == page else first] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert warc.archived(spark, pages.limit(0)).count() == 0
    small = warc.archived(spark, pages, min_bytes=5).where("payload_bytes < 5")
    assert {r.record_type for r in small.collect()} == {"response"}


def test_archives_are_framed_and_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<p>{i} " + PASSAGES[i % 10]) for i in range(60)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/warc"
    warc.write(spark, pages, path)
    files = [f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part-")]
    data = files[0].read_bytes()
    assert data[:4] == warc.DICTIONARY_MAGIC and next(iter(warc.read_archive(data))).startswith(b"WARC/1.1\r\n")
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_archive(data[: len(data) // 2]))
