"""Chat formatting (operator 7) of reply trees, in DataFrame functions only.

Self-joins double a table of ancestors: after k of them it holds each node's 2**k-th ancestor, and the paths up from the
leaves are known for 2**(k + 1) steps, so a tree of depth d takes log2 d rounds, and the rows are those of the paths and no
more. Branches are ranked by the sum of their scores; a chosen one becomes one text. Control characters in texts
are replaced one by one, so a text can't hold a mark of the template, and the replacement is undone exactly.

Defined results: null texts and roles count as empty; a null score as 0; a node whose parent is missing starts a tree;
branches that run into a cycle never reach a root and are left out; ties of score go to the longer branch, then to the
smaller leaf; rows of a conversation that share a turn follow each other by role and text, and repeated rows each count;
rows with a null conversation id are one conversation; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, written

#: The template: start of a turn, what follows its role, its end; the roles' headings; the role under the loss mask.
START, COLON, STOP = "### ", ": ", "</turn>\n"
HEADINGS = {"system": "System", "user": "User", "assistant": "Assistant"}
OTHER = "role="
LOSS = "assistant"
#: Characters that the template's marks need, and what stands for them in texts and roles; the backslash is first.
ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escaped(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def branches(nodes: DataFrame) -> DataFrame:
    """leaf, node, up: the nodes (node, parent) on the path from each leaf to its root; up: steps from the leaf."""
    n = nodes.count()
    known = nodes.select(F.col("node").alias("parent")).distinct()
    jump = written(nodes.select("node", "parent").join(known, "parent", "left_semi").select("node", F.col("parent").alias("far")))
    inner = jump.select(F.col("far").alias("node")).distinct()
    paths = written(nodes.join(inner, "node", "left_anti").select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    step = 1
    while step <= n and not jump.isEmpty():
        longer = paths.join(fresh(jump), "node").select("leaf", F.col("far").alias("node"), (F.col("up") + step).alias("up"))
        paths = written(paths.unionByName(longer))
        again = jump.select(F.col("node").alias("far"), F.col("far").alias("further"))
        jump = written(jump.join(again, "far").select("node", F.col("further").alias("far")))
        step *= 2
    endless = jump.select(F.col("node").alias("leaf"))
    return paths.join(endless, "leaf", "left_anti")


def ranked(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """root, leaf, score, length, rank of each branch; rank 1 is the best of its tree. nodes: node, score."""
    each = paths.join(nodes.select("node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "node")
    by = each.groupBy("leaf").agg(F.sum("score").alias("score"), (F.max("up") + 1).alias("length"), F.max_by("node", "up").alias("root"))
    return by.withColumn("rank", F.row_number().over(W.partitionBy("root").orderBy(F.desc("score"), F.desc("length"), "leaf")))


def turn(role: Column, text: Column) -> Column:
    """One turn of the template."""
    role = F.coalesce(role, F.lit(""))
    heading = F.concat(F.lit(OTHER), escaped(role))
    for name, shown in HEADINGS.items():
        heading = F.when(role == name, F.lit(shown)).otherwise(heading)
    return F.concat(F.lit(START), heading, F.lit(COLON), escaped(F.coalesce(text, F.lit(""))), F.lit(STOP))


def formatted(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """root, leaf, rank, chat: the best `keep` branches of each tree of nodes (node, parent, role, text, score) as texts."""
    paths = branches(nodes)
    best = ranked(nodes, paths).where(F.col("rank") <= keep)
    rows = paths.join(best, "leaf").join(nodes.select("node", turn(F.col("role"), F.col("text")).alias("said")), "node")
    said = F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "said")))
    return rows.groupBy("root", "leaf", "rank").agg(F.array_join(F.transform(said, lambda x: x["said"]), "").alias("chat"))


def read_back(chat: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    parts = F.split(chat, STOP, -1)

    def of(part: Column) -> Column:
        body = F.substring(part, len(START) + 1, 2**31 - 1)
        heading = F.substring_index(body, COLON, 1)
        role = unescaped(F.substring(heading, len(OTHER) + 1, 2**31 - 1))
        for name, shown in HEADINGS.items():
            role = F.when(heading == shown, F.lit(name)).otherwise(role)
        text = body.substr(F.length(heading) + len(COLON) + 1, F.length(body))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), of)


def conversation_nodes(rows: DataFrame) -> DataFrame:
    """conv_id, node, parent, role, text, score of rows (conv_id, turn, role, text): each turn answers the one before."""
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    rows = rows.select("conv_id", "role", "text", place.alias("k"))
    node = lambda k: F.concat_ws("/", name, k.cast("string"))
    return rows.select("conv_id", node(F.col("k")).alias("node"), F.when(F.col("k") > 1, node(F.col("k") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op7_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds marks of the template, formatted and read back."""
    text = "\\### Assistant: </turn> ok"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    nodes = written(conversation_nodes(rows.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]))))
    of = nodes.where("parent is null").select(F.col("node").alias("root"), "conv_id")
    turns = formatted(nodes).join(of, "root").select("conv_id", F.length("chat").cast("long").alias("formatted_chars"), read_back(F.col("chat")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS), lambda t: t["text"]), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


QUERIES = {"op7_chat_formatting": op7_chat_formatting}
SQL: dict[str, str] = {}
