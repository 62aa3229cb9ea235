"""Quality rules (operator 10): a learned decision list over statistics of texts, in DataFrame functions only.

Each text's statistics come from array functions within its row, so nothing is shuffled. Rules are learned by sequential
covering from labelled statistics: a rule grows by the threshold that gains most (FOIL's gain) on two thirds of the
rows, is pruned back on the other third, and is kept if it is precise there; rows that it covers are then put aside. All
counts are made by Spark over the labelled rows; what reaches the driver is a count for each feature and bin. The list
becomes one conditional expression, so applying it costs no join.

Defined results: a null text has no words and fails the base rules; rows without a label, or with a null one, teach
nothing; with no labels of either kind there are no rules and every text that passes the base rules is kept; repeated
rows count each; columns other than those named are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, documents, keyed, written

#: Characters that count as symbols; words of a window; least words; hundredths of words in repeated windows. Fixed values.
SYMBOLS = r"[#*$%&|<>]"
REPEAT, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Bounds of learning: labelled rows, rules, conditions of a rule, bins of a feature; what a rule must reach on held rows.
ROWS, RULES, CONDITIONS, BINS, PRECISION, SUPPORT = 200_000, 8, 4, 32, 0.97, 10
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share")


def _shifted(column: str, by: int) -> Column:
    return F.slice(column, by + 1, F.greatest(F.size(column) - by, F.lit(0)))


def _joined(column: str, by: int) -> Column:
    """Hashes of twice as long windows; the last ones, which have no partner, are cut off at the end."""
    return F.zip_with(column, _shifted(column, by), lambda a, b: F.xxhash64(a, F.coalesce(b, F.lit(0).cast("long"))))


def _repeated(windows: str) -> Column:
    """Words in windows that occur more than once: their places, sorted by hash, agree with a neighbour's."""
    ordered = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    return F.struct(ordered.alias("here"), F.slice(ordered, 2, F.size(windows)).alias("next"), F.concat(F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("k"))), F.slice(ordered, 1, F.size(windows) - 1)).alias("last"))


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the shares in FEATURES, for every row."""
    text = F.col("text")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = keyed(df, id_col, text_col).select(
        "doc_id",
        F.filter(F.split(text, WHITE + "+", -1), lambda w: w != "").alias("words"),
        lines.alias("lines"),
        F.length(text).alias("chars"), count(SYMBOLS).alias("n_symbols"), count("[A-Z]").alias("upper"), count("[0-9]").alias("digits"), count("[.,;:!?]").alias("marks"),
    )
    rows = rows.select(
        "doc_id", "chars", "n_symbols", "upper", "digits", "marks",
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    rows = rows.withColumn("distinct", F.size(F.array_distinct("h")))
    for by in (1, 2, 4):
        rows = rows.withColumn("h", _joined("h", by))
    rows = rows.withColumn("h", F.slice("h", 1, F.greatest(F.size("h") - (REPEAT - 1), F.lit(0))))
    rows = rows.withColumn("again", F.size("h") > F.size(F.array_distinct("h")))
    rows = rows.withColumn("o", F.when(F.col("again"), _repeated("h"))).drop("h")
    beside = F.zip_with(F.zip_with("o.here", "o.next", lambda a, b: F.struct(a["h"].alias("h"), a["k"].alias("k"), b["h"].alias("n"))), "o.last", lambda a, b: F.struct(a["k"].alias("k"), (a["h"].eqNullSafe(a["n"]) | a["h"].eqNullSafe(b["h"])).alias("twice")))
    places = F.sort_array(F.transform(F.filter(beside, lambda x: x["twice"]), lambda x: x["k"]))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-REPEAT).alias("last"))
    covered = F.aggregate(places, start, lambda done, k: F.struct((done["sum"] + F.least(F.lit(REPEAT), k - done["last"])).alias("sum"), k.alias("last")), lambda done: done["sum"])
    rows = rows.withColumn("n_repeat_words", F.when(F.col("again"), covered).otherwise(F.lit(0).cast("long"))).drop("o", "again")
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0)).cast("double")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share(F.col("word_chars"), F.col("n_words")).alias("word_length"), share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"), share(F.col("n_dup_lines"), F.col("n_words")).alias("dup_line_share"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"), share(F.col("distinct"), F.col("n_words")).alias("distinct_share"),
        *[share(F.col(c), F.col("word_chars")).alias(f"{n}_share") for c, n in (("upper", "upper"), ("digits", "digit"), ("marks", "mark"))],
    )


@dataclass(frozen=True)
class Condition:
    """feature <= threshold, or feature > threshold."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(conditions: list[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> list[Condition]:
    """The conditions that gain most, one after the other."""
    rule: list[Condition] = []
    while len(rule) < CONDITIONS:
        bins = F.array(*[F.struct(F.lit(f).alias("feature"), _bin(f, ts).alias("bin")) for f, ts in thresholds.items()])
        counted = rows.where(_all(rule)).select("bad", F.explode(bins).alias("b")).groupBy("b.feature", "b.bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        table = {f: [[0, 0] for _ in range(len(ts) + 1)] for f, ts in thresholds.items()}
        for r in counted:
            table[r["feature"]][r["bin"]] = [r["p"], r["n"]]
        any_ = next(iter(table.values()))
        p0, n0 = (sum(x[k] for x in any_) for k in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f, ts in thresholds.items():
            p = n = 0
            for k, t in enumerate(ts):
                p, n = p + table[f][k][0], n + table[f][k][1]
                best = max(best, (_gain(p, n, p0, n0), Condition(f, False, t)), (_gain(p0 - p, n0 - n, p0, n0), Condition(f, True, t)), key=lambda x: x[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _bin(feature: str, thresholds: list[float]) -> Column:
    """How many thresholds the feature exceeds."""
    out = F.lit(0)
    for t in thresholds:
        out = out + (F.col(feature) > t).cast("int")
    return out


def learn(rows: DataFrame) -> list[list[Condition]]:
    """Rules, each a conjunction that tells a bad text, in order. rows: FEATURES, bad (0 or 1) and fold (0 to 2; 2 is for pruning)."""
    quantiles = rows.agg(*[F.percentile_approx(f, [k / BINS for k in range(1, BINS)], 10_000).alias(f) for f in FEATURES]).first()
    thresholds = {f: sorted({float(x) for x in quantiles[f] or []}) for f in FEATURES}
    thresholds = {f: ts for f, ts in thresholds.items() if ts}
    rules: list[list[Condition]] = []
    while thresholds and len(rules) < RULES:
        left = rows.where(~_any(rules))
        rule = _grow(left.where("fold < 2"), thresholds)
        if not rule:
            break
        held = left.where("fold = 2")
        counts = held.agg(*[F.coalesce(F.sum(F.when(_all(rule[: k + 1]), x)), F.lit(0)).alias(f"{n}{k}") for k in range(len(rule)) for n, x in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]).first()
        worth = [((counts[f"p{k}"] - counts[f"n{k}"]) / max(1, counts[f"p{k}"] + counts[f"n{k}"]), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        if counts[f"p{k}"] < SUPPORT or counts[f"p{k}"] < PRECISION * (counts[f"p{k}"] + counts[f"n{k}"]):
            break
        rules.append(rule[: k + 1])
    return rules


def _any(rules: list[list[Condition]]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all(rule)
    return out


def verdict(rules: list[list[Condition]]) -> Column:
    """The ordered conditional expression: the number of the first rule that a text meets, else 0, which keeps it."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules):
        out = out.when(_all(rule), F.lit(k + 1))
    return out.otherwise(F.lit(0))


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of texts with a label, at most about ROWS by a hash of the id; bad: quality 0."""
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("quality")).where("label_id is not null and quality is not null")
    n = known.count()
    if n > ROWS:  # of the hash's 64 bits as many as it takes
        known = known.where(F.xxhash64("label_id") <= F.lit(int(-(2**63) + 2**64 * ROWS / n)).cast("long"))
    rows = stats.join(known, F.col("doc_id") == F.col("label_id"))
    return written(rows.select(*FEATURES, (F.col("quality") == 0).cast("int").alias("bad"), F.pmod(F.hash("doc_id"), F.lit(3)).alias("fold")))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules' verdict, and that of the list learned from `labels`."""
    stats = written(statistics(documents(spark, sf_dir)))  # a small row for each text: these are joined, never texts
    rules = learn(labelled(stats, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
    )


QUERIES = {"op10_quality_rules": op10_quality_rules}
SQL: dict[str, str] = {}
