import numpy as np
import public_tokenizers
import tiktoken

from tarn.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute(ids, eod):
    out, start = [], 0
    for k, x in enumerate(ids):
        if x == eod:
            out.append((start, k - start))
            start = k + 1
    return out


def test_blocks_of_any_size_and_order(spark):
    rng = np.random.default_rng(3)
    for size in (2, 6, 14, 1000):
        rows, want = [], {}
        for file in range(3):
            ids = np.where(rng.random(200) < (0.02, 0.3, 0.0)[file], 7, rng.integers(8, 50, 200)).astype("<u2")
            raw = ids.tobytes()
            rows += [(file, k, raw[a : a + size]) for k, a in enumerate(range(0, len(raw), size))]
            want[file] = brute(ids.tolist(), 7)
        rows.append((9, 0, None))
        rng.shuffle(rows)
        rows = [(int(a), int(b), c) for a, b, c in rows]
        got = token_counts.scan(spark.createDataFrame(rows, "file int, block long, data binary"), eod=7).collect()
        for file in want:
            assert [(r.start, r.n_tokens) for r in sorted((r for r in got if r.file == file), key=lambda r: r.ordinal)] == want[file]
        assert len(got) == sum(map(len, want.values()))


def test_flat_files_are_read(spark, tmp_path):
    ids = np.array([1, 2, 7, 7, 3, 4, 5, 7, 6], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    got = token_counts.scan(token_counts.read_tokens(spark, str(tmp_path), block=4), eod=7).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens) for r in got) == [(0, 0, 2), (1, 3, 0), (2, 4, 3)]


def test_writer_with_nulls_and_repeats(spark):
    plain = tiktoken.Encoding("p", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    rows = [(1, "a b c", 1), (1, "a b c", 2), (None, "x", 3), (4, None, 4), (5, "word " * 300, 5)]
    blocks, order = token_counts.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, block int"), RANKS, block=64)
    got = order.join(token_counts.scan(blocks), ["file", "ordinal"]).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((a or 0, len(plain.encode_ordinary(t or ""))) for a, t, _ in rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.scan(token_counts.write_tokens(empty, RANKS)[0]).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.001"
    plain = tiktoken.Encoding("p", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: r.n_tokens for r in token_counts.op5_separator_scan(spark, d).collect()}
    want = {r.doc_id: len(plain.encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert got == want


def test_runs_of_blocks_are_stitched(spark, monkeypatch):
    """Documents that reach over many blocks and over several runs of blocks."""
    monkeypatch.setattr(token_counts, "RUN", 3)
    rng = np.random.default_rng(5)
    ids = np.where(rng.random(3000) < 0.01, 7, rng.integers(8, 50, 3000)).astype("<u2")
    raw = ids.tobytes()
    rows = [("f", k, raw[a : a + 40]) for k, a in enumerate(range(0, len(raw), 40))]
    got = token_counts.scan(spark.createDataFrame(rows, "file string, block long, data binary"), eod=7).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens) for r in got) == [(k, *x) for k, x in enumerate(brute(ids.tolist(), 7))]


def test_files_are_flat_and_unindexed(spark):
    """What the writer leaves is ids and separators and nothing else; a very long text crosses many ranges."""
    plain = tiktoken.Encoding("p", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = ["one two", "", "long words " * 20_000, "last"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks, order = token_counts.write_tokens(df, RANKS, block=1000)
    (name,) = {r.file for r in blocks.select("file").distinct().collect()}
    want = [x for t in texts for x in [*plain.encode_ordinary(t), token_counts.EOD]]
    assert np.fromfile(name.removeprefix("file://"), "<u2").tolist() == want
    got = order.join(token_counts.scan(blocks), ["file", "ordinal"]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(plain.encode_ordinary(t)) for k, t in enumerate(texts)}
    listed = token_counts.scan(token_counts.read_tokens(spark, name.rsplit("/", 1)[0], block=5000)).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens) for r in listed) == sorted((r.ordinal, r.start, r.n_tokens) for r in got)
