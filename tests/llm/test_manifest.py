import random
import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tarn.llm import manifest

SF = "/root/testdata/sf0.001"


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_tree(nodes, fanout):
    """Levels from the leaves up."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + fanout])) for k in range(0, len(out[-1]), fanout)])
    return out


def plain_proof(levels, at, fanout):
    sides = []
    for level in levels[:-1]:
        begin = at - at % fanout
        sides.append(("".join(level[begin:at]), "".join(level[at + 1 : begin + fanout])))
        at //= fanout
    return sides


def plain(rows, fanout):
    """By row (tree, id, leaf), in the order of each tree: subroot, root and siblings."""
    by = {}
    for tree, key, leaf in rows:
        by.setdefault("" if tree is None else f"={tree}", []).append((key is not None, key if key is not None else 0, leaf))
    names = sorted(by, key=str.encode)
    trees = {name: plain_tree([r[2] for r in sorted(by[name])], fanout) for name in names}
    top = plain_tree([trees[n][-1][0] for n in names], fanout)
    out = []
    for k, name in enumerate(names):
        for at, (known, key, leaf) in enumerate(sorted(by[name])):
            sides = plain_proof(trees[name], at, fanout) + plain_proof(top, k, fanout)
            out.append((key if known else None, leaf, trees[name][-1][0], top[-1][0], [s[0] for s in sides], [s[1] for s in sides]))
    return out


def shown(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize(("fanout", "rows_of_part"), [(8, 16), (3, 7)])
def test_proofs_match_plain_python(spark, fanout, rows_of_part):
    rng = random.Random(fanout * 31 + rows_of_part)
    sizes = {"en": 131, "de": 8, "fr": 9, None: 5, "": 1, "pt": 64, "é": 2, "e": 17}
    rows = [(lang, rng.choice((None, rng.randint(-9, 40), rng.randint(-99, 9999))), rng.choice(("", None, "x", f"T{k}"))) for lang, n in sizes.items() for k in range(n)]
    rows += [("hot", 7, "same")] * 60
    df = spark.createDataFrame(rows, "lang string, doc_id long, text string").withColumn("leaf", F.lit(1)).withColumn("tree", F.lit("clash")).withColumn("part", F.lit(0)).repartition(5)
    made = manifest.manifest(df, ["doc_id", "lang", "text"], "lang", "doc_id", {"kept": F.col("text")}, fanout, rows_of_part)
    got = made.rows.collect()
    leaf = lambda *values: h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))
    want = plain([(lang, key, leaf(key, lang, text)) for lang, key, text in rows], fanout)
    assert shown((r.id, r.leaf, r.subroot, r.root, r.lefts, r.rights) for r in got) == shown(want)
    folded = made.rows.select(manifest.folded(F.col("leaf"), F.col("lefts"), F.col("rights")).alias("f"), "root").where("f <> root")
    assert folded.count() == 0
    assert {r.tree for r in made.subroots.collect()} == {"" if k is None else f"={k}" for k in [*sizes, "hot"]}


def test_mountains_leave_only_cut_runs():
    for n in (1, 7, 8, 9, 64, 65, 200):
        for a in range(0, n, 13):
            for b in range(a + 1, n + 1, 17):
                leaves = [h(str(k)) for k in range(n)]
                levels = plain_tree(leaves, 8)
                one = manifest.Range(a, n, 8)
                for v in leaves[a:b]:
                    one.push(v)
                one.close()
                whole = lambda level, k: a <= k * 8**level and min((k + 1) * 8**level, n) <= b
                inside = {(level, k): v for level, nodes in enumerate(levels) for k, v in enumerate(nodes) if whole(level, k)}
                assert one.nodes == inside
                assert one.peaks == {(level, k) for level, k in inside if level < len(levels) - 1 and not whole(level + 1, k // 8)}


def test_empty_and_single_rows(spark):
    df = spark.createDataFrame([(3, None, None)], "doc_id int, lang string, text string")
    row = manifest.manifest(df, ["doc_id", "text"], "lang", "doc_id").rows.first()
    assert row.leaf == row.subroot == row.root == h("1:3-") and row.lefts == [] == row.rights
    assert manifest.manifest(df.limit(0), ["doc_id", "text"], "lang", "doc_id").rows.collect() == []


def test_long_texts_and_other_ids(spark):
    rows = [("b", "x" * 2_000_000 + "É"), ("a", ""), (None, "A" * 1_500_000)]
    df = spark.createDataFrame(rows, "name string, text string").withColumn("lang", F.lit("en"))
    got = {r.id: r.leaf for r in manifest.manifest(df, ["text"], "lang", "name").rows.collect()}
    assert got == {key: h(f"{len(text.encode())}:{text}") for key, text in rows}


def test_query_matches_sql(spark):
    got = manifest.op12_merkle_manifest(spark, SF).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = list(got[0].asDict())
    assert shown(tuple(r) for r in got) == shown(tuple(r) for r in db.execute(f"SELECT {', '.join(names)} FROM ({manifest.SQL['op12_merkle_manifest']})").fetchall())
    lower = lambda t: t is None or not any("A" <= c <= "Z" for c in t)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0 or lower(text[r.doc_id]))
