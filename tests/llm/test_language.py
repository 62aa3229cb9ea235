import random
import zlib

from pyspark.sql import functions as F

from tarn.llm import language


def test_query_is_right_on_rows_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in language.op8_compression_language(spark, d).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert set(got) == set(docs)
    right = []
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in docs[i].text or ""):
            assert r.lang_pred == "und" and r.rejected
        elif r.held_out and docs[i].lang:
            right.append(r.lang_pred == docs[i].lang)
    assert len(right) > 100 and sum(right) / len(right) > 0.95
    assert sum(r.rejected for r in got.values()) < 0.02 * len(got)


def test_odd_rows(spark):
    rows = [(1, "the thing of the and", "en", 1.0), (2, "der die das und nicht", "de", 2.0), (3, "words without label", None, 3.0), (4, None, "xx", 0.0), (None, "", "en", 0.0), (5, "12 34 !!", None, 0.0), (5, "der die das und nicht " * 60, None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    profiles = language.fit(df)
    assert [lang for lang, _ in profiles] == ["en", "de"]
    got = language.classify(df, profiles).collect()
    assert len(got) == 7
    assert {r.lang_pred for r in got if r.rejected} == {"und"} and sum(r.rejected for r in got) == 3
    assert [r.lang_pred for r in got if r.doc_id == 5 and not r.rejected] == ["de"]
    assert language.fit(df.limit(0)) == [] and language.classify(df.limit(0), profiles).collect() == []
    assert {r.lang_pred for r in language.classify(df, []).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    by = language.compressors([("a", b"same words here and there"), ("b", b"same words here and there")])
    assert language.answer("quite other text " * 40, by) == ("a", 0.0, True)
    assert language.answer("short", by) == ("a", 0.0, False)


ITALIAN = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita. Il governo italiano ha approvato ieri una nuova legge sulla scuola pubblica che riguarda tutti gli studenti delle superiori."
POLISH = "W czasie wakacji dzieci lubią bawić się nad jeziorem, gdzie woda jest ciepła i czysta. Rząd polski przyjął wczoraj nową ustawę o szkołach, która wejdzie w życie w przyszłym roku i dotyczy wszystkich uczniów."


def gibberish(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_gibberish_and_unlearned_languages_are_rejected_and_clean_short_texts_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    by = language.compressors(language.fit(docs.where(~language.held_out("doc_id"))))
    r = random.Random(5)
    bad = [gibberish(r, n) for n in (25, 50, 200) for _ in range(50)] + [ITALIAN, POLISH, ITALIAN * 4, POLISH * 4, ITALIAN[:120], POLISH[:120]]
    kept = [t for t in bad if not language.answer(t, by)[2]]
    assert len(kept) <= 0.02 * len(bad), kept
    clean = [x.text for x in docs.where(language.held_out("doc_id")).where("lang is not null and text rlike '[a-z]'").limit(500).collect()]
    for size in (15, 60, 200, 10**6):
        assert sum(language.answer(t[:size], by)[2] for t in clean) < 0.02 * len(clean), size


def test_a_rare_or_mistaken_label_leaves_the_other_languages_as_they_are(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null and text is not null")
    known, held = docs.where(~language.held_out("doc_id")), docs.where(language.held_out("doc_id")).limit(800).collect()
    copies = known.where("lang = 'fr'").orderBy("doc_id").limit(1).crossJoin(spark.range(20000)).select(docs.columns)
    rare = known.where("lang <> 'es'").unionByName(known.where("lang = 'es' and length(text) > 1000").orderBy("doc_id").limit(8))
    odd = known.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("un mot seul").alias("text"), F.lit("xx").alias("lang"), "source", "n_chars")
    for extra, least in ((known.unionByName(odd), 0.985), (known.unionByName(copies), 0.985), (rare.unionByName(odd), 0.96)):
        profiles = language.fit(extra)
        sizes = {lang: len(raw) for lang, raw in profiles}
        assert sizes["en"] == sizes["fr"] == sizes["de"] == language.DICTIONARY
        by = language.compressors(profiles)
        got = [(r.lang, *language.answer(r.text, by)) for r in held]
        for lang in ("en", "fr", "de", "es"):
            right = [g[1] == lang for g in got if g[0] == lang]
            assert sum(right) >= least * len(right) - 1, (lang, sum(right), len(right))
        assert sum(g[3] for g in got) <= 0.02 * len(got)


def test_every_language_with_text_can_be_answered(spark):
    rows = [(k * 10 + j, " ".join(chr(97 + (k * 7 + j + x * (k % 11 + 1)) % 26) * 3 + chr(0x4E00 + k) for x in range(60)), f"l{k}") for k in range(80) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language.fit(df)) == 80
