import hashlib
import random

import pytest

from tarn.llm import suffixes


def brute(rows):
    """(n_bytes, n_removed, n_spans, kept) of each id."""
    seen, out = set(), {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - 99):
            piece = raw[k : k + 100]
            if piece in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(piece)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, places array<int>")
    want = brute(rows)
    got = suffixes.repeats(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.spans == []
            continue
        spans = [(s.start, s.stop) for s in r.spans]
        raw = r.text.encode()
        assert (len(raw), sum(b - a for a, b in spans), len(spans), suffixes.without(raw, spans)) == want[r.doc_id], r.doc_id


def test_repeats_match_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common, long_ = text(14), text(400)
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 350), (5, "ab" * 170), (None, "x" * 200), (6, "In. " * 120), (7, "In. " * 60)]
    for k in range(10, 130):
        kind = rng.random()
        if kind < 0.3:
            rows.append((k, text(rng.randint(1, 60)) + " " + common + " " + text(rng.randint(1, 60))))
        elif kind < 0.6:
            a = rng.randrange(len(long_))
            rows.append((k, text(5) + long_[a : a + rng.randint(50, 900)] + text(9)))
        elif kind < 0.8:
            edited = list(long_)
            for _ in range(rng.randint(1, 9)):
                edited[rng.randrange(len(edited))] = "#"
            rows.append((k, "".join(edited)))
        else:
            rows.append((k, text(80)))
    rng.shuffle(rows)
    check(spark, rows)


def test_every_two_positions_meet_in_the_cover():
    cover = set(suffixes.COVER)
    for i in range(suffixes.PERIOD):
        for j in range(suffixes.PERIOD):
            assert any((i + k) % suffixes.PERIOD in cover and (j + k) % suffixes.PERIOD in cover for k in range(suffixes.PERIOD))
    assert suffixes.sampled(99).tolist() == [] and max(suffixes.sampled(5000)) <= 5000 - suffixes.WINDOW


def test_small_blocks_and_tasks(spark, monkeypatch):
    """Many blocks and shards, and entries that are dealt out a few at a time."""
    for name in ("BLOCK", "SEND", "SHARD"):
        monkeypatch.setattr(suffixes, name, 50)
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(200)
    check(spark, [(k, text(rng.randint(0, 30)) + base[rng.randrange(300) : rng.randrange(400, 900)] + text(5)) for k in range(40)])


def test_one_id_with_several_texts(spark):
    """Each row loses what repeats in its own text, and nothing that repeats in another row of its id."""
    rng = random.Random(15)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, alone = text(150), text(400)
    rows = [(1, shared + "x"), (2, alone), (2, "y" + shared), (None, shared)]
    got = suffixes.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, shared + "x"), (2, alone), (2, "y"), (0, shared)])


def test_repeated_rows_are_one_document(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(300))
    df = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, len(r.spans)) for r in suffixes.repeats(df).collect())
    assert got[:2] == [(1, 0), (1, 0)] and got[2][1] == 1
    assert suffixes.repeats(df.limit(0)).collect() == []


def test_removal_leaves_whole_characters(spark):
    text = "é" * 60 + "tail"
    rows = [(1, "a" + text, "en"), (2, "b" + text, None), (3, None, "x"), (None, text, "x")]
    got = {r.doc_id: r.text for r in suffixes.remove(spark.createDataFrame(rows, "doc_id long, text string, places string")).collect()}
    assert got[3] is None and got[None] == text and got[2] == "b" and got[1].endswith("tail")


def test_query(spark):
    d = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()])
    got = suffixes.op9_suffix_dedup(spark, d).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in want.items()}
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("places", [None, [], [64 * 3 + 1, 64 * 50]])
def test_runs(places):
    assert suffixes.runs(places, 1000) == ([(3, 150)] if places else [])


def test_ids_that_are_no_whole_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        suffixes.repeats(spark.createDataFrame([("a", "one two three")], "doc_id string, text string"))
