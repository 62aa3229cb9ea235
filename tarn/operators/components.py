"""Connected components of graphs and of wet pixels, without a group of unbounded size.

Graphs: alternating stars. Each round hangs every node's larger neighbours on the smallest it knows of, so the rounds are
as the logarithm of the longest path, and each is a grouped minimum with a join.
Pixels: wet pixels of a row become runs first (gaps and islands). Runs of a block of rows and columns are joined where they
lie, and only what touches from one block to another is left as a graph, whose nodes are the blocks' own components.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

#: Columns of a raster that share a join key; a run spans few of these tiles.
TILE = 64
#: Side of a block of pixels whose runs are joined in one task.
SIDE = 512
#: Rows of a raster whose components are ranked together.
BAND = 64


def by_key(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each key of batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        named = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        cuts = [k for k in range(1, len(named)) if named[k] != named[k - 1]]
        for begin, end in zip([0, *cuts], [*cuts, len(named)], strict=True):
            if held and named[begin] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = named[begin]
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """node, component: of each node of the edges (a, b) the smallest node that it is connected to. Nodes without an edge don't appear."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        star = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = written(star.where("u <> v").distinct())
        low = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        hung = large.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        edges = written(hung.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    heads = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads.select(F.col("v").alias("node"), F.col("v").alias("component")))


def runs(wet: DataFrame) -> DataFrame:
    """aoi_id, month, y, x0, x1 of maximal runs of wet pixels (aoi_id, month, y, x) in rows."""
    w = W.partitionBy("aoi_id", "month", "y").orderBy("x")
    island = wet.select("aoi_id", "month", "y", "x").distinct().withColumn("island", F.col("x") - F.row_number().over(w))
    return island.groupBy("aoi_id", "month", "y", "island").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("island")


def _joined(y: list[int], x0: list[int], x1: list[int], reach: int) -> list[int]:
    """For each run, sorted by row and column, the first one that it is connected to."""
    parent = list(range(len(y)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    above = 0  # the first run that may touch this one
    for k in range(len(y)):
        while above < k and (y[above] < y[k] - 1 or (y[above] == y[k] - 1 and x1[above] + reach < x0[k])):
            above += 1
        j = above
        while j < k and y[j] == y[k] - 1 and x0[j] <= x1[k] + reach:
            a, b = sorted((top(j), top(k)))
            parent[b] = a
            j += 1
    return [top(k) for k in range(len(y))]


_BLOCK = ("aoi_id", "month", "by", "bx")


def _rooted(rows: DataFrame, reach: int) -> DataFrame:
    """Runs with their block (by, bx) and the first run of it that they are connected to within it, as root; a block of SIDE by SIDE pixels fits a task."""
    kinds = {f.name: f.dataType for f in rows.schema}
    dealt = rows.withColumns({"by": F.floor(F.col("y") / SIDE), "bx": F.floor(F.col("x0") / SIDE)})
    names = [*dealt.columns, "ry", "rx"]
    schema = T.StructType([*dealt.schema, T.StructField("ry", kinds["y"]), T.StructField("rx", kinds["x0"])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _BLOCK):
            y, x0, x1 = (table.column(c).to_pylist() for c in ("y", "x0", "x1"))
            root = pa.array(_joined(y, x0, x1, reach))
            yield from table.append_column("ry", table.column("y").take(root)).append_column("rx", table.column("x0").take(root)).select(names).to_batches()

    made = dealt.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "y", "x0").mapInArrow(run, schema)
    return made.withColumn("root", F.struct("aoi_id", "month", F.col("ry").alias("y"), F.col("rx").alias("x0"))).drop("ry", "rx")


def _links(each: DataFrame, reach: int) -> DataFrame:
    """(a, b) of roots whose runs touch from one block to another: over the edge of two bands of rows, or where one run hangs over the end of its block."""
    hangs = F.col("x1") + reach >= (F.col("bx") + 1) * SIDE
    last = F.pmod(F.col("y"), F.lit(SIDE)) == SIDE - 1
    at = ["aoi_id", "month", "y", "tile"]

    def upper(rows: DataFrame) -> DataFrame:
        tiles = F.explode(F.sequence(F.floor((F.col("x0") - reach) / TILE), F.floor((F.col("x1") + reach) / TILE)))
        return rows.select(F.col("root").alias("a"), "aoi_id", "month", (F.col("y") + 1).alias("y"), F.col("x0").alias("a0"), F.col("x1").alias("a1"), tiles.alias("tile"))

    def lower(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("root").alias("b"), "aoi_id", "month", "y", "x0", "x1", F.explode(F.sequence(F.floor(F.col("x0") / TILE), F.floor(F.col("x1") / TILE))).alias("tile"))

    pairs = [(upper(each.where(last | hangs)), lower(each)), (upper(each.where(~last & ~hangs)), lower(each.where(hangs)))]
    touch = [a.join(b, at).where((F.col("a0") <= F.col("x1") + reach) & (F.col("x0") <= F.col("a1") + reach)).select("a", "b").where("a <> b").distinct() for a, b in pairs]
    return touch[0].unionByName(touch[1]).distinct()


def label(wet: DataFrame, connectivity: int = 8, least_pixels: int = 1) -> DataFrame:
    """aoi_id, month, y, x0, x1, label: runs with the label of their component, 1 to K in the order of its first pixel by rows; components of fewer pixels are left out."""
    if connectivity not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    reach = int(connectivity == 8)
    each = written(_rooted(runs(wet), reach))
    links = _links(each, reach)
    if links.limit(1).isEmpty():
        named = each.withColumn("component", F.col("root")).drop("root")
    else:
        found = components(links)
        named = each.join(found, F.col("root") == F.col("node"), "left").withColumn("component", F.coalesce("component", "root")).drop("node", "root")
    size = named.groupBy("component").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("n_pixels")).where(F.col("n_pixels") >= least_pixels)
    # ranks within bands of rows, and prefix sums over the bands, so no window has all components of a month
    size = size.drop("n_pixels").withColumn("band", F.floor(F.col("component.y") / BAND))
    inside = W.partitionBy("component.aoi_id", "component.month", "band").orderBy("component.y", "component.x0")
    earlier = W.partitionBy("aoi_id", "month").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    bands = size.groupBy(F.col("component.aoi_id").alias("aoi_id"), F.col("component.month").alias("month"), "band").agg(F.count("*").alias("n"))
    bands = bands.select(F.struct("aoi_id", "month", "band").alias("at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = size.withColumn("k", F.row_number().over(inside)).withColumn("at", F.struct("component.aoi_id", "component.month", "band"))
    labels = ranked.join(bands, "at").select("component", (F.col("before") + F.col("k")).cast("int").alias("label"))
    return named.join(labels, "component").drop("component")


def pixels(labelled: DataFrame) -> DataFrame:
    """aoi_id, month, label, y, x of labelled runs."""
    return labelled.select("aoi_id", "month", "label", "y", F.explode(F.sequence("x0", "x1")).alias("x"))
