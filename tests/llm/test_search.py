import math
import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tarn.llm import search
from tarn.llm.words import words

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Rows (item, rank, id, score) by the definition."""
    bags = [(key, Counter(terms(text))) for key, text in docs]
    bags = [(key, bag, bag.total()) for key, bag in bags if bag]
    n_docs, n_all = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item in {i for i, _ in items}:
        asked = [t for text in {t for i, t in items if i == item and t is not None} for t in terms(text)]
        scores = []
        for key, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if bag[t])
            if score:
                scores.append((-score, key is None, key, score))
        out += [(item, rank, key, score) for rank, (_, _, key, score) in enumerate(sorted(scores, key=lambda s: s[:3] if s[2] is not None else (*s[:2], 0))[:k], 1)]
    return out


def shown(rows):
    return sorted(map(repr, rows))


def test_words_of_bytes_match_the_pattern():
    rng = random.Random(1)
    for n in (0, 1, 50, 3000):
        text = "".join(rng.choice("abzAZ019 _-./:@[`{~\x00\t\n\x7féßΩ中😀 ") for _ in range(n))
        assert [w.decode() for part in words(text.encode()) for w in part] == terms(text)


def test_matches_brute_force_in_small_shards(spark):
    rng = random.Random(2)
    vocabulary = [f"t{int(rng.paretovariate(0.6)) % 80}" for _ in range(4000)]
    docs = [(k if k % 50 else None, None if k % 31 == 0 else " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 3, 30, 200))))) for k in range(400)]
    docs += [(7, "t1 T1 rare, rare;RARE t2")] * 40 + [(1000 + k, "t1 t1 rare rare rare t2") for k in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for k in range(25)] + [(3, "rare t1"), (None, "rare"), (90, "nowhere"), (91, ""), (92, None), (93, "t2 t2 t2 rare"), (93, "t2 t2 t2 rare")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("score", F.lit(1)).repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = brute(docs, items)
    for shard_rows, query_bytes in ((16, 300), (100_000, 1 << 20)):
        got = search.search(df, queries, shard_rows=shard_rows, query_bytes=query_bytes).collect()
        assert shown((r.item_id, r.rank, r.doc_id, r.score) for r in got) == shown(want)
    got = search.search(df, queries, k=3, shard_postings=100).collect()
    assert shown((r.item_id, r.rank, r.doc_id, r.score) for r in got) == shown(brute(docs, items, 3))


def test_stops_early_and_stays_exact():
    """A search that leaves postings unread gives the same as one that reads all."""
    import numpy as np

    rng = np.random.default_rng(4)
    rows, n_terms = 3000, 60
    held = [np.flatnonzero(rng.random(n_terms) < np.linspace(0.9, 0.01, n_terms)) for _ in range(rows)]
    held = [h if len(h) else np.array([0]) for h in held]
    tfs = [rng.integers(1, 6, len(h)) for h in held]
    n = np.array([int(t.sum()) for t in tfs])
    df = np.bincount(np.concatenate(held), minlength=n_terms)
    w = np.array([search.weight(rows, d) for d in df])
    shard = search.Shard(n, np.array([len(h) for h in held]), np.concatenate(held), np.concatenate(tfs), w, rows, int(n.sum()))
    completed = []
    whole = shard.complete
    shard.complete = lambda docs, times: completed.append(len(docs)) or whole(docs, times)
    for _ in range(40):
        asked = np.sort(rng.choice(n_terms, 12, replace=False))
        times = np.zeros(n_terms, np.int64)
        times[asked] = rng.integers(1, 4, 12)
        docs, scores = shard.best(asked, times, 10, np.arange(rows))
        every = whole(np.arange(rows), times)
        order = np.lexsort((np.arange(rows), -every))[:10]
        assert docs.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
    assert completed and max(completed) <= search.FEW * 10


def test_empty_tables_long_texts_and_other_ids(spark):
    docs = spark.createDataFrame([("a", "needle " + "hay " * 1_500_000), ("b", "needle"), ("c", "é" * 300_000), ("d", None)], "name string, body string")
    items = spark.createDataFrame([("q", "Needle éé")], "item_id string, text string")
    got = search.search(docs, items, id_col="name", text_col="body").collect()
    want = brute([(r.name, r.body) for r in docs.collect()], [("q", "Needle éé")])
    assert shown((r.item_id, r.rank, r.doc_id, r.score) for r in got) == shown(want) and len(got) == 2
    assert search.search(docs.limit(0), items, id_col="name", text_col="body").collect() == []
    assert search.search(docs, items.limit(0), id_col="name", text_col="body").collect() == []


def test_query_matches_sql(spark):
    got = search.op13_ranked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert shown(tuple(r) for r in got) == shown(db.execute(search.SQL["op13_ranked_search"]).fetchall())
