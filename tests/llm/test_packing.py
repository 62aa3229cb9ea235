import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tarn.llm import packing

JSON = public_tokenizers.path("byte_bpe_50k.json")


def checked(rows, capacity):
    """Gapless sequences within the capacity; returns their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_query_holds_every_token_once(spark):
    d = "/root/testdata/sf0.001"
    got = packing.op6_sum_of_squares_packing(spark, d).collect()
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    total, by = 0, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert set(by) == {r.doc_id for r in docs}
    for doc in docs:
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(by[doc.doc_id], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        at = 0
        for p in parts:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            assert p.piece == 0 or p.length == 1024
            at += p.length
        assert at == len(ids)
        total += len(ids)
    assert checked(got, 1024) <= -(-total // 1024) + 2


def test_groups_nulls_and_repeats(spark):
    rows = spark.createDataFrame([(i % 40, None if i % 7 == 0 else "some words " * (i % 90), i) for i in range(200)], "doc_id long, text string, length int")
    packed = packing.pack(packing.pieces(rows, JSON, capacity=64, keep_ids=True), 200, capacity=64, group=50)
    got = packed.collect()
    checked(got, 64)
    assert len({r.sequence_id >> 40 for r in got}) > 1
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(packing.pieces(rows.limit(0), JSON), 0).collect() == []


def test_long_documents_and_one_hot_id(spark):
    rows = spark.createDataFrame([(7 if i % 3 == 0 else i, "word " * (5000 if i == 1 else 20 + i % 50)) for i in range(300)], "doc_id long, text string")
    got = packing.pack(packing.pieces(rows, JSON, capacity=64), 300, capacity=64, group=50).collect()
    checked(got, 64)
    assert sum(r.length for r in got) == packing.pieces(rows, JSON, capacity=64).agg({"length": "sum"}).first()[0]
    assert len([r for r in got if r.doc_id == 1]) > 70
    by = {}
    for r in got:
        if r.length < 64:
            by[r.sequence_id >> 40] = by.get(r.sequence_id >> 40, 0) + 1
    assert len(by) == 6 and max(by.values()) < 90
    assert all(r.offset == 0 and r.sequence_id < 0 for r in got if r.length == 64)


def test_each_choice_makes_the_sum_of_squares_smallest():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 21, 300).tolist()
    count = [0] * 21
    for s, h in zip(items, packing.sum_of_squares(items, 20), strict=True):
        def cost(level):
            after = count[:]
            after[level] -= level > 0
            after[level + s] += 1
            return sum(x * x for x in after[1:20])
        options = [0, *(x for x in range(1, 21 - s) if count[x])]
        assert h in options and cost(h) == min(map(cost, options))
        count[h] -= h > 0
        count[h + s] += 1


def test_ids_are_those_of_the_library_with_its_added_tokens(spark):
    rng = np.random.default_rng(6)
    bits = ["<|endoftext|>", "<|endof", "text|>", " word", "word", "'s", " 12", "\n\n", "  ", "é", "日本", "\t", "|>", "<|endoftext|><|endoftext|>", " x<|endoftext|>y"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 30))) for _ in range(600)] + ["", "long words " * 90_000 + "<|endoftext|>" + " and more" * 60_000]
    tokenizer = Tokenizer.from_file(JSON)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {}
    for r in packing.pieces(rows, JSON, keep_ids=True).collect():
        got.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    for k, text in enumerate(texts):
        ids = np.frombuffer(b"".join(p for _, p in sorted(got[k])), "<u4").tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert any("<|endoftext|>" in t for t in texts)
