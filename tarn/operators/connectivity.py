"""Connectivity of a drainage network: fixed graph, realised connectivity, dendritic connectivity, temporal coherence.

reaches: hydro_id, from_node, to_node, next_down_id (-1 at the outlet), length_m, ix (topology order).
node_month: month, node, active, valid. Missing rows are neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..session import written
from .components import components


def fixed_graph(reaches: DataFrame, node_month: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): reaches that are ever wet, and (a, b) where b starts at a's end and follows it in topology order."""
    ever = node_month.where("active").select(F.col("node").alias("hydro_id")).distinct()
    nodes = reaches.join(ever, "hydro_id", "left_semi")
    down = nodes.select(F.col("hydro_id").alias("b"), F.col("from_node").alias("at"), F.col("ix").alias("b_ix"))
    edges = nodes.join(down, F.col("to_node") == F.col("at")).where("b_ix > ix").select(F.col("hydro_id").alias("a"), "b")
    return nodes, edges


def each_month(rows: DataFrame, months: DataFrame) -> DataFrame:
    """rows, once for each month, with a column month. The months are one row, an array of a few thousand dates at most, that goes to wherever the rows are."""
    one = months.agg(F.array_sort(F.collect_set("month")).alias("months"))
    return rows.crossJoin(F.broadcast(one)).withColumn("month", F.explode("months")).drop("months")


def edge_gaps(edges: DataFrame, node_month: DataFrame, months: DataFrame) -> DataFrame:
    """month, a, b, gap (dry ends of the edge; null if an end isn't valid) for every edge and month; the network is small beside its months."""
    grid = each_month(edges, months)
    end = lambda side: node_month.select(F.col("month"), F.col("node").alias(side), F.col("active").alias(f"{side}_on"), F.col("valid").alias(f"{side}_ok"))
    rows = grid.join(end("a"), ["month", "a"], "left").join(end("b"), ["month", "b"], "left")
    gap = (~F.col("a_on")).cast("int") + (~F.col("b_on")).cast("int")
    return rows.select("month", "a", "b", F.when(F.col("a_ok") & F.col("b_ok"), gap).alias("gap"))


def realised(gaps: DataFrame, nodes: DataFrame, threshold: float = 0.0) -> DataFrame:
    """month, n_edges, n_active, rc_edge, rc_pair, dci of the months in gaps (month, a, b, gap)."""
    active = F.coalesce(F.col("gap") <= threshold, F.lit(False))
    edge = gaps.groupBy("month").agg(F.count("*").alias("n_edges"), F.count_if(active).alias("n_active"))
    node = lambda side: F.struct("month", F.col(side).alias("node"))
    found = components(gaps.where(active).select(node("a").alias("a"), node("b").alias("b")))
    # reaches without a link are alone: they add nothing to pairs, and their squared lengths are those of all less those of the linked
    l = F.col("length_m").cast("double")  # noqa: E741
    whole = nodes.agg(F.count("*").alias("n"), F.sum(l).alias("l"), F.sum(l * l).alias("alone"))  # one row
    linked = found.select(F.col("node.month").alias("month"), F.col("node.node").alias("hydro_id"), F.col("component.node").alias("c")).join(nodes.select("hydro_id", "length_m"), "hydro_id")
    size = linked.groupBy("month", "c").agg(F.count("*").alias("k"), F.sum(l).alias("lc"), F.sum(l * l).alias("own"))
    sums = size.groupBy("month").agg(F.sum(F.col("k") * (F.col("k") - 1)).alias("pairs"), F.sum(F.col("lc") * F.col("lc") - F.col("own")).alias("more"))
    months = gaps.select("month").distinct().join(sums, "month", "left").crossJoin(F.broadcast(whole))
    by = months.select("month", F.coalesce("pairs", F.lit(0)).alias("pairs"), "n", "l", (F.col("alone") + F.coalesce("more", F.lit(0.0))).alias("l2"))
    return edge.join(by, "month").select("month", "n_edges", "n_active", (ratio("n_active", "n_edges") * 100).alias("rc_edge"), (ratio(F.col("pairs"), F.col("n") * (F.col("n") - 1)) * 100).alias("rc_pair"), (ratio(F.col("l2"), F.col("l") * F.col("l")) * 100).alias("dci"))


def coherence(node_month: DataFrame) -> DataFrame:
    """node, valid_months, tcf: percent of valid months that are active."""
    return node_month.groupBy("node").agg(F.count_if("valid").alias("valid_months"), (ratio(F.count_if(F.col("active") & F.col("valid")), F.count_if("valid")) * 100).alias("tcf"))


def jumps(reaches: DataFrame) -> list[DataFrame]:
    """Tables (node, far) of the reach that lies 1, 2, 4, ... steps downstream, where there is one. The last one goes further than there are reaches, so what it has leads into a cycle, and its `far` are the reaches on one. Of a repeated id the smallest next reach counts."""
    n = reaches.count()
    known = reaches.select(F.col("hydro_id").alias("far")).distinct()
    step = reaches.groupBy(F.col("hydro_id").alias("node")).agg(F.min("next_down_id").alias("far"))
    out, size = [written(step.join(known, "far", "left_semi").select("node", "far"))], 1
    while size <= n and not out[-1].isEmpty():
        again = out[-1].select(F.col("node").alias("mid"), F.col("far").alias("further"))
        out.append(written(out[-1].join(again, F.col("far") == F.col("mid")).select("node", F.col("further").alias("far"))))
        size *= 2
    return out


def validate_topology(reaches: DataFrame) -> DataFrame:
    """check, n: violations of the network's contract; `cycle` counts the reaches that lie on one."""
    other = reaches.select(F.col("hydro_id").alias("down"), F.col("from_node").alias("down_from"))
    joined = reaches.where("next_down_id <> -1").join(other, F.col("next_down_id") == F.col("down"), "left")
    found = [
        reaches.agg(F.lit("null_key").alias("check"), F.count_if(F.expr("hydro_id is null or from_node is null or to_node is null or next_down_id is null")).alias("n")),
        reaches.groupBy("hydro_id").count().agg(F.lit("repeated_id").alias("check"), F.count_if(F.expr("count > 1")).alias("n")),
        joined.agg(F.lit("unknown_next").alias("check"), F.count_if(F.expr("down is null")).alias("n")),
        joined.agg(F.lit("broken_link").alias("check"), F.count_if(F.expr("down is not null and down_from <> to_node")).alias("n")),
        jumps(reaches)[-1].agg(F.lit("cycle").alias("check"), F.count_distinct("far").alias("n")),
        reaches.agg(F.lit("terminals").alias("check"), F.count_if(F.expr("next_down_id = -1")).alias("n")),
    ]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def reach_paths(reaches: DataFrame) -> DataFrame:
    """head, path (array of ids from each headwater to the last reach that is in the table). Paths into a cycle are left out."""
    *steps, endless = jumps(reaches)
    heads = reaches.select(F.col("hydro_id").alias("head")).distinct()
    heads = heads.join(reaches.select(F.col("next_down_id").alias("head")).distinct(), "head", "left_anti").join(endless.select(F.col("node").alias("head")), "head", "left_anti")
    paths, size = written(heads.select("head", F.col("head").alias("node"), F.lit(0).cast("long").alias("at"))), 1
    for jump in steps:
        longer = paths.join(jump, "node").select("head", F.col("far").alias("node"), (F.col("at") + size).alias("at"))
        paths, size = written(paths.unionByName(longer)), size * 2
    nodes = F.array_sort(F.collect_list(F.struct("at", "node")))
    return paths.groupBy("head").agg(F.transform(nodes, lambda x: x["node"]).alias("path"))
