"""Merkle dataset manifest (operator 12): trees of a fixed fanout over rows in order, with a proof of each row.

Rows are dealt into parts by their order, numbered by prefix sums of the parts' counts, and each part goes along its rows
with a mountain range: a stack with one open run for each level. A run that is complete is hashed and carried to the next
level, as in counting to the base of the fanout. Parts begin and end anywhere, so their edges cut runs: what is complete
in a cut run is a peak and is sent out. Peaks are merged by Spark, level by level, a group being the children of one node,
so no tree need fit a task. The last run of a tree may be short; it is hashed as it is, without padding. In a second pass
each part gets the nodes that stand beside its edges, at most two runs a level, and knows with its own all siblings of its
rows. The roots of the trees are the rows of one more tree, made in the same way.

Defined results: null values count as '-'; a null tree key is a tree of its own and comes first; null order keys come
first; repeated rows are leaves each, and rows of equal order keys are ordered by their leaf; texts are hashed whole where
they lie, however long, and never moved; other columns are not read, so none can clash; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, dropped, written

#: Children of a node; rows of a part, about; rows of a batch of proofs.
FANOUT, ROWS, SEND = 8, 16_384, 2_048


@dataclass(frozen=True)
class Manifest:
    """rows: what was asked for of each row, with leaf, lefts, rights (its siblings' digests before and after it, joined, a value a level), subroot, root.

    nodes: tree, level, place, digest, n of all nodes above the leaves, and of leaves whose run two parts share; a null tree
    is '', another one has '=' before it. subroots: tree, root. top: the nodes of the tree of subroots.
    """

    rows: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    top: DataFrame


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(*values: Column) -> Column:
    """The digest of values, each with its length in bytes before it; a null is '-'."""
    shown = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in shown]), 256)


def proof_text(lefts: Column, rights: Column) -> Column:
    """All siblings of a row, level by level, left to right."""
    return F.array_join(F.zip_with(lefts, rights, lambda left, right: F.concat(left, right)), "")


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(F.arrays_zip(lefts.alias("l"), rights.alias("r")), leaf, lambda done, side: F.sha2(F.concat(side["l"], done, side["r"]), 256))


def sizes(n: int, fanout: int = FANOUT) -> list[int]:
    """Nodes of each level of a tree of n leaves, from the leaves up."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out


def _power(exponent: Column, fanout: int) -> Column:
    return F.get(F.array(*[F.lit(fanout**k).cast("long") for k in range(int(62 / math.log2(fanout)) + 1)]), exponent)


def _height(n: Column, fanout: int) -> Column:
    """Levels above the leaves."""
    powers = F.array(*[F.lit(fanout**k).cast("long") for k in range(int(62 / math.log2(fanout)) + 1)])
    return F.size(F.filter(powers, lambda p: p < n))


class Range:
    """The mountain range of leaves start, start + 1, ... of a tree of n leaves.

    nodes: digests by (level, place) of all that is complete here; peaks: those of them whose run is cut.
    """

    def __init__(self, start: int, n: int, fanout: int = FANOUT):
        self.fanout, self.size = fanout, sizes(n, fanout)
        self.top = len(self.size) - 1
        self.first = [start]
        for _ in range(self.top):
            self.first.append(-(-self.first[-1] // fanout))
        self.next = list(self.first)
        self.open: list[list[str]] = [[] for _ in self.size]
        self.nodes: dict[tuple[int, int], str] = {}
        self.peaks: set[tuple[int, int]] = set()

    def push(self, value: str, level: int = 0) -> None:
        while True:
            at = self.next[level]
            self.next[level] = at + 1
            self.nodes[level, at] = value
            if level == self.top:  # the root
                return
            begin = at - at % self.fanout
            if begin < self.first[level]:  # another part has the run's beginning
                self.peaks.add((level, at))
                return
            run = self.open[level]
            run.append(value)
            if at + 1 < min(begin + self.fanout, self.size[level]):
                return
            value, level = digest("".join(run)), level + 1
            run.clear()

    def close(self) -> None:
        """No more leaves here: another part has what is left of open runs."""
        for level, run in enumerate(self.open):
            self.peaks.update((level, k) for k in range(self.next[level] - len(run), self.next[level]))
            run.clear()


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Table]]:
    """The head of each share (what a part has of a tree) and its rows, of batches in order; a share has at most a part's rows."""
    held: list[pa.RecordBatch] = []

    def share() -> tuple[dict, pa.Table]:
        rows = pa.Table.from_batches(held)
        return rows.column("head")[0].as_py() | {"tree": rows.column("tree")[0].as_py()}, rows.slice(1)

    for batch in batches:
        heads = np.flatnonzero(batch.column("at").to_numpy() < 0).tolist()
        cuts = [0, *heads, batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin in heads and held:
                yield share()
                held = []
            if end > begin:
                held.append(batch.slice(begin, end - begin))
    if held:
        yield share()


def indexed(rows: DataFrame, order: list[str], rows_of_part: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """rows (with tree and leaf) with part and at (place in what the part has of the tree), as a written table; and tree, part, start, k, n: where each share starts in its tree, its rows, and the tree's.

    Parts are ranges of (tree, order, leaf, row), so neither a large tree nor rows that repeat make one larger.
    """
    keys = ["tree", *order, "leaf", "row"]
    parts = max(1, math.ceil(rows.count() / rows_of_part))
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("row").withColumn("part", F.spark_partition_id())
    names = dealt.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, -1
        for batch in batches:
            places = []
            for value in batch.column("tree").to_pylist():
                tree, at = (tree, at + 1) if value == tree else (value, 0)
                places.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*names, "at"])

    table = written(dealt.mapInArrow(number, f"{fields}, at long"))
    before, whole = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1), W.partitionBy("tree")
    counts = table.groupBy("tree", "part").agg(F.count("*").alias("k"))
    return table, counts.select("tree", "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"), "k", F.sum("k").over(whole).alias("n"))


def _streamed(table: DataFrame, heads: DataFrame) -> DataFrame:
    """Each share's head and then its rows in order, parts by ranges; heads: tree, part, head."""
    rest = [f for f in table.schema if f.name not in ("tree", "part", "at")]
    head = heads.select("tree", "part", F.lit(-1).cast("long").alias("at"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest], "head")
    both = table.select("tree", "part", "at", *[f.name for f in rest], F.lit(None).cast(head.schema["head"].dataType).alias("head")).unionByName(head)
    return both.repartitionByRange("part").sortWithinPartitions("part", "tree", "at")


def forest(table: DataFrame, shares: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The node records (tree, level, place, digest, n) of an indexed table, written."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["tree", "level", "place", "digest", "n", "peak"], [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        for head, rows in _shares(batches):
            mountains = Range(head["start"], head["n"], fanout)
            for value in rows.column("leaf").to_pylist():
                mountains.push(value)
            mountains.close()
            found = [(head["tree"], *key, value, head["n"], key in mountains.peaks) for key, value in mountains.nodes.items() if key[0] or key in mountains.peaks or not mountains.top]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found, strict=True), kinds)), names)

    heads = shares.select("tree", "part", F.struct("start", "n").alias("head"))
    made = written(_streamed(table.select("tree", "part", "at", "leaf"), heads).mapInArrow(climb, "tree string, level int, place long, digest string, n long, peak boolean"))
    records, cut = made.drop("peak"), made.where("peak").drop("peak")
    run = F.array_sort(F.collect_list(F.struct("place", "digest")))
    for level in range(len(sizes(shares.agg(F.max("n")).first()[0] or 0, fanout)) - 1):
        # all children of a cut run are here: peaks of parts, or merged at the level before
        merged = cut.where(F.col("level") == level).groupBy("tree", "n", F.floor(F.col("place") / fanout).alias("place")).agg(run.alias("run"))
        merged = merged.select("tree", F.lit(level + 1).alias("level"), "place", F.sha2(F.array_join("run.digest", ""), 256).alias("digest"), "n")
        records = records.unionByName(merged)
        cut = cut.unionByName(merged.where(_height(F.col("n"), fanout) > level + 1))
    records = written(records)
    dropped(made)
    return records


def roots(records: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tree, root."""
    return records.where(F.col("level") == _height(F.col("n"), fanout)).select("tree", F.col("digest").alias("root"))


def proofs(table: DataFrame, shares: DataFrame, records: DataFrame, above: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """table without part, at, tree, with lefts and rights; above (tree, lefts, rights): what follows for all rows of a tree."""
    each = shares.select("tree", "part", "start", "k", "n", F.explode(F.sequence(F.lit(0), _height(F.col("n"), fanout))).alias("level")).where(F.col("level") < _height(F.col("n"), fanout))
    span = _power(F.col("level") + 1, fanout)
    # the runs that a share's edges lie in, at each level
    edges = each.select("tree", "part", "level", F.explode(F.array_distinct(F.array(F.floor(F.col("start") / span), F.floor((F.col("start") + F.col("k") - 1) / span)))).alias("run"))
    nodes = records.select("tree", "level", F.floor(F.col("place") / fanout).alias("run"), "place", "digest")
    beside = edges.join(nodes, ["tree", "level", "run"]).groupBy("tree", "part").agg(F.collect_list(F.struct("level", "place", "digest")).alias("beside"))
    heads = shares.join(beside, ["tree", "part"], "left")
    over = F.struct("lefts", "rights") if above is not None else F.lit(None).cast("struct<lefts:array<string>,rights:array<string>>")
    heads = (heads.join(above, "tree") if above is not None else heads).select("tree", "part", F.struct("start", "n", "beside", over.alias("above")).alias("head"))
    names = [c for c in table.columns if c not in ("tree", "part", "at")]
    fields = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names)

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, rows in _shares(batches):
            mountains = Range(head["start"], head["n"], fanout)
            for value in rows.column("leaf").to_pylist():
                mountains.push(value)
            known = {(b["level"], b["place"]): b["digest"] for b in head["beside"] or ()} | mountains.nodes
            over = head["above"] or {"lefts": [], "rights": []}
            met: dict[tuple[int, int], tuple[list[str], list[str]]] = {(mountains.top, 0): (over["lefts"], over["rights"])}

            def siblings(level: int, at: int) -> tuple[list[str], list[str]]:
                """From a node up; those above the leaves are kept, as the rows below share them."""
                if (level, at) in met:
                    return met[level, at]
                begin = at - at % fanout
                end = min(begin + fanout, mountains.size[level])
                lefts, rights = siblings(level + 1, at // fanout)
                both = ["".join(known[level, k] for k in range(begin, at)), *lefts], ["".join(known[level, k] for k in range(at + 1, end)), *rights]
                if level:
                    met[level, at] = both
                return both

            at = head["start"]
            for part in rows.select(names).to_batches(SEND):
                lefts, rights = zip(*[siblings(0, k) for k in range(at, at + part.num_rows)], strict=True)
                at += part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lefts, pa.list_(pa.string())), pa.array(rights, pa.list_(pa.string()))], [*names, "lefts", "rights"])

    return _streamed(table, heads).mapInArrow(prove, f"{fields}, lefts array<string>, rights array<string>")


def manifest(df: DataFrame, columns: list[str], tree_col: str, order_col: str, carry: dict[str, Column] | None = None, fanout: int = FANOUT, rows_of_part: int = ROWS) -> Manifest:
    """The trees of df by tree_col, in the order of order_col, with leaves of the named columns; carry: more values of each row."""
    key = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    leaves = written(df.select(key.alias("tree"), F.col(order_col).alias("id"), leaf(*map(F.col, columns)).alias("leaf"), *[v.alias(k) for k, v in (carry or {}).items()]))
    table, shares = indexed(leaves, ["id"], rows_of_part)
    nodes = forest(table, shares, fanout)
    subroots = roots(nodes, fanout)
    one = indexed(subroots.select(F.lit("").alias("tree"), F.col("root").alias("leaf"), F.col("tree").alias("name")), ["name"], rows_of_part)
    top = forest(*one, fanout)
    whole = roots(top, fanout).select(F.col("root"), F.lit("").alias("of"))
    above = written(proofs(*one, top, fanout=fanout).select(F.col("name").alias("tree"), F.col("leaf").alias("subroot"), "lefts", "rights", F.lit("").alias("of")).join(whole, "of").drop("of"))
    rows = proofs(table.withColumn("under", F.col("tree")), shares, nodes, above.select("tree", "lefts", "rights"), fanout)
    rows = rows.join(above.select(F.col("tree").alias("under"), "subroot", "root"), "under").drop("under")
    return Manifest(rows, nodes, subroots, top)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """A tree for each language and one over all of them; a third of the rows is tampered with and refused."""
    docs = documents(spark, sf_dir)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf(*map(F.col, columns[:-1]), lowered))
    rows = manifest(docs, columns, "lang", "doc_id", {"changed": changed}).rows
    root = folded(F.coalesce("changed", "leaf"), F.col("lefts"), F.col("rights"))
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof_text(F.col("lefts"), F.col("rights")), 256).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 by bits, as DuckDB has none; side: the siblings of a node; walk: from a leaf to the root.
_SQL = """WITH RECURSIVE
parts AS (SELECT doc_id, lang, text, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) AS crc FROM documents),
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed FROM parts),
placed AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low AS (SELECT tree, 0 AS level, i, leaf AS h, n FROM placed
  UNION ALL SELECT tree, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY tree, level, i // 8, n),
subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, i, subroot AS h, n FROM subs UNION ALL SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM high WHERE n > 1 GROUP BY level, i // 8, n),
side AS (SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM low a JOIN low b ON a.tree = b.tree AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL),
over AS (SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM high a JOIN high b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL),
walk AS (SELECT r AS id, tree, 0 AS level, i, coalesce(changed, leaf) AS h, '' AS proof FROM placed
  UNION ALL SELECT w.id, w.tree, w.level + 1, w.i // 8, sha256(s.l || w.h || s.r), w.proof || s.l || s.r FROM walk w JOIN side s ON s.tree = w.tree AND s.level = w.level AND s.i = w.i),
ends AS (SELECT id, tree, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM walk GROUP BY id, tree),
climb AS (SELECT e.id, 0 AS level, s.i, e.h, e.proof FROM ends e JOIN subs s USING (tree)
  UNION ALL SELECT c.id, c.level + 1, c.i // 8, sha256(o.l || c.h || o.r), c.proof || o.l || o.r FROM climb c JOIN over o ON o.level = c.level AND o.i = c.i),
done AS (SELECT id, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM climb GROUP BY id),
whole AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM placed JOIN subs USING (tree) JOIN done ON done.id = placed.r, whole"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
SQL: dict[str, str] = {"op12_merkle_manifest": _SQL}
