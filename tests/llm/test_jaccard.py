import random
import re

import pytest

from tarn.llm import jaccard, rolling


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Smallest id of each id's group; rows that repeat an id are one."""
    each = [(i, sets(t)) for i, t in rows if i is not None]
    group = {i: i for i, _ in each}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for k, (i, a) in enumerate(each):
        for j, b in each[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {i: (len(s), root(i)) for i, s in each}


def check(spark, rows):
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, cls int")
    got = jaccard.groups(df).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    return got


def test_shingles_are_those_of_the_definition():
    for text in ("", " \t", "one", "a b c d", "A b C d e", "a b c d e f a b c d e", "É é \x0b x y z w v", "w " * 30):
        assert len(rolling.shingles(text)) == len(sets(text))
    assert set(rolling.shingles("A B c d e F").tolist()) == set(rolling.shingles("a b\nc  d e f").tolist())
    assert rolling.shingles("a b").tolist() != rolling.shingles("ab").tolist()


def test_groups_match_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.choice((3, 6, 30, 80)))] for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "A b"), (4, "a B"), (None, "a b"), (5, "b a")]
    for k in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice("xyz") * 4
        rows.append((1000 - k, " ".join(words)))
    check(spark, rows)


def test_chains_longer_than_a_star(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(100 - k, " ".join(words[k * 4 : k * 4 + 60])) for k in range(30)]  # each links to the next ones only
    got = check(spark, rows)
    assert len({r.component_id for r in got}) == 1


def test_common_passages_link_nothing(spark):
    rng = random.Random(6)
    common = " ".join(f"c{k}" for k in range(40))
    check(spark, [(k, common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for k in range(60)])


def test_empty_table(spark):
    assert jaccard.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op4_jaccard_groups(spark, d).collect()}
    assert got == brute(rows)


def test_frequent_columns_and_cells(spark, monkeypatch):
    """With small limits all columns count as frequent and groups meet in cells."""
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "CELL", 8)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(120):  # one family of near copies, many of them just below the threshold
        words = list(base)
        for _ in range(rng.choice((0, 1, 2, 2, 3))):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    check(spark, rows)


def test_words_built_to_collide_are_told_apart(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    check(spark, [(1, word), (2, word.translate(str.maketrans("ab", "ba")))])


def test_product_matches_brute_force():
    rng = random.Random(9)
    import numpy as np

    sets = [np.array(sorted({rng.randrange(3000) if rng.random() < 0.5 else rng.randrange(40) for _ in range(rng.randrange(1, 200))}), np.uint64) for _ in range(90)]
    got = jaccard.overlaps(sets[:60], sets[60:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[60:]] for a in sets[:60]]


def test_ids_that_are_no_whole_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        jaccard.groups(spark.createDataFrame([("a", "one two three")], "doc_id string, text string"))


def test_counts_are_read_while_their_shuffle_is_there(spark, monkeypatch):
    """Shuffles go when a query's execution ends (see written); that of an iterator ends before its first row is read."""

    def lazily(self, *_, **__):
        raise AssertionError("rows would be read from a shuffle that has gone")

    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", lazily)
    rows = spark.createDataFrame([(k, f"some words of text {k} " * 9) for k in range(300)], "doc_id long, text string").repartition(7)
    profile, table = jaccard.profiles(rows)
    assert table.sum() == profile.agg({"n": "sum"}).first()[0] > 0
