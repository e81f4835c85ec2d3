"""The pipeline against its stages done by hand on a small corpus."""

import random

import corpus_pipeline
from strata.llm import packing
from strata.llm.queries import vocabulary


def test_stages_keep_and_drop_what_they_should(spark, tmp_path):
    rnd = random.Random(4)
    say = lambda letters, n: " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 8))) for _ in range(n))
    rows = [(i, *(("aa", "abcdefg") if i % 2 else ("bb", "uvwxyzé"))) for i in range(80)]
    rows = [(i, say(letters, rnd.randint(30, 200)), lang) for i, lang, letters in rows]
    item = say("abcdefg", 30)
    copies = [(100, rows[3][1], "aa"), (101, rows[4][1] + " uvw", "bb")]
    leaked = [(200, rows[5][1] + ". " + item.upper() + "! " + rows[7][1][:50], "aa")]
    odd = [(300, None, "aa"), (301, "", "aa"), (302, "12 34", "bb")]
    private = [(400, say("abcdefg", 60) + " write to me.1@mail.example.com today", "aa")]
    every = [(*r, "src", len(r[1] or "")) for r in rows + copies + leaked + odd + private]
    docs = spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/sf/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/sf/benchmark.parquet")
    sf_dir = f"{tmp_path}/sf"

    before, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns, name
        seen.append({r.doc_id: r for r in after.collect()})
        after.write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
    clean = set(range(80))
    assert set(seen[0]) == clean | {100, 101, 200, 400}
    assert set(seen[1]) == clean | {200, 400}
    assert set(seen[2]) == clean | {400}
    assert seen[3][400].text.endswith("write to [EMAIL] today") and seen[3][400].n_chars == len(seen[3][400].text)
    assert all(seen[3][i].text == rows[i][1] for i in clean)

    packed = corpus_pipeline.run(spark, sf_dir).collect()
    encode = packing.WordTokenizer(vocabulary("word_bpe_49k.json"))
    lengths = {i: len(encode.whole(r.text)) // 4 + 1 for i, r in seen[3].items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths
    assert len({r.sequence_id for r in packed}) <= -(-sum(lengths.values()) // 2048) + 1


def test_last_stage_ends_on_the_ids_of_every_document(spark):
    texts = {1: "some words, and more", 2: "", 3: "word " * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    encode = packing.WordTokenizer(vocabulary("word_bpe_49k.json"))
    got = {}
    for r in corpus_pipeline.best_fit_packing(spark, docs, "").collect():
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    whole = {i: b"".join(ids for _, ids in sorted(parts)) for i, parts in got.items()}
    assert whole == {i: encode.whole(text) + bytes(4) for i, text in texts.items()}
