import random
import re

from tarn.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_statistics_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a", "é 日本 🙂 x", "one\ntwo\n\none\n two\none", "a b c d e f g h " * 5, "x " * 9, "#$ <b> | a*b", "\x0b\x0ca\x0d b", "w " * 2000]
    for _ in range(60):
        words = [rng.choice("abcdefg") for _ in range(rng.randint(0, 60))]
        texts.append(rng.choice((" ", "\n")).join(words + words[: rng.randint(0, 30)]))
    rows = [(k, t, -1) for k, t in enumerate(texts)] + [(None, "a b", 0), (3, "a", 0)]
    got = quality.statistics(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert counts(r) == brute(texts[r.doc_id]), texts[r.doc_id]
    assert quality.statistics(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rules_are_learned_and_applied_in_order(spark):
    rng = random.Random(1)
    rows = []
    for k in range(3000):
        f = {name: rng.random() for name in quality.FEATURES}
        bad = f["symbol_share"] > 0.8 or (f["word_length"] < 0.3 and f["upper_share"] > 0.6)
        rows.append((*[f[n] for n in quality.FEATURES], int(bad), k % 3))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in quality.FEATURES) + ", bad int, fold int").cache()
    rules = quality.learn(df)
    assert 2 <= len(rules) <= quality.RULES and all(1 <= len(r) <= quality.CONDITIONS for r in rules)
    out = df.withColumn("rule", quality.verdict(rules)).collect()
    assert sum((r.rule > 0) == bool(r.bad) for r in out) > 0.95 * len(out)
    assert sum(r.rule > 0 and not r.bad for r in out) < 0.02 * len(out)
    for r in out:  # the first rule that holds
        holds = [k + 1 for k, rule in enumerate(rules) if all((r[c.feature] > c.threshold) == c.above for c in rule)]
        assert r.rule == (holds[0] if holds else 0)
    assert quality.learn(df.limit(0)) == [] and quality.learn(df.where("bad = 0")) == []


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op10_quality_rules(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == len(docs)
    for doc in docs:
        r, want = got[doc.doc_id], brute(doc.text)
        assert counts(r) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and r.rule == 0)
    clean = [r for i, r in got.items() if i in labels and labels[i].quality == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) > 0.97 * len(clean)
