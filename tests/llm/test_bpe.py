import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tarn.llm import bpe

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", " ", "a", None, "It's  a test,\n\n we'll 'see' ''s 12 a1b", "café ½ 3² Ⅷ naïve — «x»", "日本語 ـعر a\x1cb a b", "<|endoftext|> x", "word " * 5000, "x" * 3000, "It's  a test,\n\n we'll 'see' ''s 12 a1b", "🙂🙃é́"]


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


def test_ids_and_bytes_match_the_other_library(spark, plain):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(rows, MULTI), MULTI).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = plain.encode_ordinary(text or "")
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, text
        assert bytes(got[i].decoded) == (text or "").encode()
        starts, seen = [], b""
        for t in ids:  # the character in which the id's first byte lies
            starts.append(sum((b & 0xC0) != 0x80 for b in seen + plain.decode_single_token_bytes(t)[:1]) - 1)
            seen += plain.decode_single_token_bytes(t)
        assert np.frombuffer(got[i].starts, "<u4").tolist() == starts


def test_long_texts_are_cut_without_effect(plain, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 50)
    text = "One two, three four's five. " * 40 + "12 34\n" * 30 + "tail of words"
    assert len(bpe.parts(text)) > 5
    assert np.frombuffer(bpe.encoder(MULTI)(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_rank_files_need_no_table_of_words(spark, plain, monkeypatch):
    """Rows are encoded by the library that holds nothing, but for runs of white space that it can't take."""
    monkeypatch.setattr(bpe.Encoder, "many", None)
    texts = [" " * 1_000_000 + "a b", "x\n" + "\n" * 900_000, "many new words " + " ".join(map(hex, range(9000)))]
    bpe.rank_encoder.cache_clear()
    made = list(bpe.of_file(MULTI).many(texts))
    assert np.frombuffer(made[2], "<u4").tolist() == plain.encode_ordinary(texts[2])
    assert b"".join(map(bpe.token_bytes(MULTI).__getitem__, np.frombuffer(made[0], "<u4").tolist())).decode() == texts[0]
    run = " " * 30_000 + "a b\n" + "\n" * 30_000  # both libraries take this one
    assert np.frombuffer(bpe.rank_encoder(MULTI)(run), "<u4").tolist() == plain.encode_ordinary(run)


def test_new_words_are_merged_alike_without_being_split_again(monkeypatch):
    """The model by itself gives the words of plain texts the ids that the whole library does."""
    import random

    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    chars = [chr(c) for c in range(0x250) if bpe._PLAIN.fullmatch(chr(c))] + list("–—‘’“”•…€") + [" "] * 60 + list("etaoin") * 9
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 60))) for _ in range(4000)] + ["", " ", "It's  we'll 'see' ÿ þÿ", "\x00\x01 a"]
    want = bpe.Encoder(path).library(texts)
    monkeypatch.setattr(bpe.Encoder, "library", None)
    assert list(bpe.Encoder(path).many(texts)) == want


def test_byte_table_is_one_to_one():
    table = bpe.byte_chars()
    assert len(table) == 256 and len(set(table.values())) == 256 and table[ord("A")] == "A" and table[ord(" ")] == "Ġ"


def test_cut_characters_become_replacements():
    assert bpe.decode_text("é".encode()[:1]) == "�"


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(rows, MULTI), MULTI).collect() == []


def test_query(spark, plain):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in bpe.op2_bpe_roundtrip(spark, d).collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = plain.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
