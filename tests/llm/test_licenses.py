import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tarn.llm import licenses
from tarn.llm.licenses import BASE, DRIFT, NOTICES, SHARE

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(found, phrase):
    return [k for k in range(len(found) - len(phrase) + 1) if found[k : k + len(phrase)] == phrase]


def base(found):
    return sorted((k, label) for phrase, label in BASE.items() for k in places(found, plain(phrase)))


def brute(texts):
    """Base rows, and all labels and the best score, trying each template at each start."""
    files = [plain(t) for t in texts]
    df = Counter(w for f in files for w in set(f))
    weight = lambda w: 1 + math.log((1 + len(files)) / (1 + df[w]))
    out = []
    for found in files:
        here = base(found)
        labels, best = {label for _, label in here}, 1.0 if here else 0.0
        for label, text, phrases in NOTICES:
            body = plain(text)
            drift, share = (0, 1.0) if [plain(p) for p in phrases] == [body] else (DRIFT, SHARE)
            total = sum(map(weight, body))
            rare = sorted({w for w in body if w in found}, key=lambda w: -weight(w))
            for s in range(-len(body), len(found) + 1):
                window = lambda k: found[max(0, s + k - drift) : max(0, s + k + drift + 1)]  # noqa: E731, B023
                got = sum(weight(w) for k, w in enumerate(body) if w in window(k))
                stretch = found[max(0, s - drift) : max(0, s + len(body) + drift)]
                exact = sum(any(0 <= s + k < len(found) and found[s + k] == w for k in range(len(body)) if body[k] == w) for w in rare[:4])
                agree = len(rare[:4]) if not drift else min(2, len(rare[:4]))
                if rare and exact >= agree and got >= share * total - 1e-9 and all(places(stretch, plain(p)) for p in phrases):
                    labels.add(label)
                    best = max(best, got / total)
        out.append((len(found), len(here), here[0][0] if here else None, here[-1][0] if here else None, ",".join(sorted({x for _, x in here})), ",".join(sorted(labels)), round(min(best, 1.0), 9)))
    return out


def rows(df):
    return df.select("doc_id", "n_words", "hits").collect()


def digest(r):
    here = [h for h in r.hits if h.base]
    return (r.n_words, len(here), min((h.start for h in here), default=None), max((h.start for h in here), default=None), ",".join(sorted({h.label for h in here})), ",".join(sorted({h.label for h in r.hits})), round(max((h.score for h in r.hits), default=0.0), 9))


def test_matches_brute_force(spark):
    rng = random.Random(3)
    filler = "the of and license software apache gnu public by cc in source free version 2 0 general mit house tree über naïve".split()
    texts = [None, "", "-- ,", "CC-BY cc  by cc by", "GNU General\nPublic\tLicense gnu general public license", "ΑMIT License MITLicense mit_license"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                parts += rng.choices(filler, k=rng.randint(1, 25))
            else:
                body = re.split(r"(?<=\W)", rng.choice([n[1] for n in NOTICES] + list(BASE)))
                for _ in range(rng.choice((0, 0, 1, 2, 6))):  # words lost, changed or put in
                    body[rng.randrange(len(body)) :][:1] = [rng.choice(filler) + " "]
                    if rng.random() < 0.3:
                        body.insert(rng.randrange(len(body)), rng.choice(filler) + " ")
                parts.append("".join(body))
        text = " ".join(parts)
        texts.append(text.upper() if rng.random() < 0.2 else text)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("n_words", F.lit("x")).withColumn("hits", F.lit(0)).repartition(3)
    got = {r.doc_id: digest(r) for r in rows(licenses.scan(df))}
    want = dict(enumerate(brute(texts)))
    assert got == want
    assert len({w[5] for w in want.values()}) > 15


def test_hits_carry_their_places(spark):
    text = "Copyright. Licensed under CC BY-NC 4.0. Permission is hereby granted, free of charge, to any kind person obtaining a copy of this software and documentation files, to deal in the Software without restriction."
    row = rows(licenses.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")))[0]
    found = plain(text)
    by = {(h.label, h.base): h for h in row.hits}
    assert set(by) == {("cc-by", True), ("cc-by-nc-4.0", False), ("mit", False)}
    assert found[by["cc-by", True].start] == "cc" and abs(by["mit", False].start - found.index("permission")) <= DRIFT
    assert found[by["cc-by-nc-4.0", False].start : by["cc-by-nc-4.0", False].stop] == ["cc", "by", "nc", "4", "0"]
    assert 0.75 <= by["mit", False].score < 1


def test_phrases_must_stand_in_full(spark):
    text = NOTICES[7][1].replace("free of charge", "free at charge")
    assert rows(licenses.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")))[0].hits == []


def test_empty_tables_long_texts_repeats_and_other_ids(spark):
    long = "lorem " * 900_000 + "mit license " * 20_000 + "é" * 200_000 + " GNU General Public License, version 3"
    df = spark.createDataFrame([("a", long), ("a", long), (None, "MIT License")], "name string, body string")
    got = rows(licenses.scan(df, id_col="name", text_col="body"))
    assert sorted((r.doc_id or "", *digest(r)[:6]) for r in got) == [("", 2, 1, 0, 0, "mit", "mit"), *[("a", 940_007, 20_001, 900_000, 940_001, "gpl,mit", "gpl,gpl-3.0,mit")] * 2]
    assert rows(licenses.scan(df.limit(0), id_col="name", text_col="body")) == []


def test_query_on_all_documents(spark):
    got = {r.doc_id: r for r in licenses.op11_license_scan(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        found, r = plain(d.text), got[d.doc_id]
        here = base(found)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(found), len(here), here[0][0] if here else None, here[-1][0] if here else None)
        assert r.base_labels == ",".join(sorted({x for _, x in here})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert r.score == 1.0 if here else 0 <= r.score <= 1
