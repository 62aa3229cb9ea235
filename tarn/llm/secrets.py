"""Secret scans (operator 1), in DataFrame functions only.

Patterns find assignments, access keys and runs of hex. Beside them, candidate strings get a sliding window whose Shannon
entropy is kept by incremental counts: each step adds one character, takes one off and corrects the sum of c log c. What
an allow-list knows as harmless as a whole (identifiers, plain numbers, paths of words and placeholders) is left alone. Of
its hot part all stretches that no pattern's span covers are spans (with `cut`), unless they are marks only.

Matches are exploded, one small row each, and their places come from running sums of the lengths between them, so a text
with very many matches costs no more than in proportion. A text's rows meet again by a row number, not by its id.

Defined results: a null text counts as empty and has no spans; repeated rows are scanned each for itself; columns other
than the id and the text are left out; spans count code points, the end exclusive; spans of different kinds may overlap,
ties of start go by kind in the order below; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, keyed, written

#: Kinds in order, their patterns and the least length: of group 1 for assignments, else of the match. Fixed values.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}+"
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex")
#: Candidates for entropy; the window; bits that a window needs, by class of characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW, BITS = 20, {"entropy_base64": 3.75, "entropy_hex": 3.0}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Harmless candidates: without a digit or without a letter; unique ids; words and numbers joined by marks; placeholders.
COMPONENT = r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}|(?i:example|placeholder|changeme)[0-9]{0,4}|[xX]{5,}|0{5,}"
ALLOWED = (
    r"^[^0-9]+$",
    r"^[^A-Za-z]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    rf"^[+/_=-]*({COMPONENT})([+/_=-]+({COMPONENT}))*[+/_=-]*$",
)


def entropy_span(text: Column, bits: Column) -> Column:
    """struct<from, to>: the part of a string from its first to its last window of at least so many bits; nulls if there is none."""
    at = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    late = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), at), 1, F.size(at))
    steps = F.zip_with(at, late, lambda a, b: F.struct(a.alias("new"), b.alias("old")))
    table = F.array(*[F.lit(float(c)) * F.log2(F.lit(float(max(c, 1)))) for c in range(WINDOW + 2)])
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"),
        F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("to"),
    )

    def step(done: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        same = new == old
        came, went = done["counts"][new], done["counts"][old]
        total = F.when(same, done["sum"]).otherwise(done["sum"] + table[came + 1] - table[came] - F.when(old > 0, table[went] - table[F.greatest(went - 1, F.lit(0))]).otherwise(0.0))
        counts = F.when(same, done["counts"]).otherwise(F.transform(done["counts"], lambda c, k: c + (k == new).cast("int") - ((k == old) & (old > 0)).cast("int")))
        n = done["n"] + 1
        hot = (n >= WINDOW) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= bits)
        first = F.coalesce(done["from"], F.when(hot, n - WINDOW))
        return F.struct(counts.alias("counts"), total.alias("sum"), n.alias("n"), first.alias("from"), F.when(hot, n).otherwise(done["to"]).alias("to"))

    return F.aggregate(steps, start, step, lambda done: F.struct(done["from"].alias("from"), done["to"].alias("to")))


def _found(text: Column, name: str, pattern: str) -> Column:
    """array<struct<name, k, gap, match>>: the pattern's matches, and the length of what stands before each since the last one."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.zip_with(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), matches, lambda gap, m: F.struct(F.lit(name).alias("name"), gap.alias("gap"), m.alias("match")))
    rows = F.transform(rows, lambda x, k: F.struct(x["name"].alias("name"), k.alias("k"), x["gap"].alias("gap"), x["match"].alias("match")))
    return F.when(text.rlike(pattern), rows)


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: bool = False) -> DataFrame:
    """doc_id, spans (array of struct<start, rank, kind, end>, in order) for every row. Entropy spans that touch a pattern's span are cut to what it leaves; without `cut`, as tests of this function expect, they are left out."""
    return _spans(keyed(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), cut).select("doc_id", "spans")


def _spans(rows: DataFrame, cut: bool) -> DataFrame:
    """row, doc_id, spans of rows (row, doc_id, text); row tells them apart."""
    text = F.col("text")
    none = F.array().cast("array<struct<name:string,k:int,gap:int,match:string>>")
    found = F.concat(*[F.coalesce(_found(text, *x), none) for x in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("candidate", CANDIDATE))])
    rows = rows.select("row", "doc_id", F.explode_outer(found).alias("m")).select("row", "doc_id", "m.*")
    before = W.partitionBy("row", "name").orderBy("k")
    end = F.sum(F.col("gap") + F.length("match")).over(before)
    rows = rows.select("row", "doc_id", "name", "match", (end - F.length("match")).alias("start"), end.alias("end"))

    name, match = F.col("name"), F.col("match")
    passed = (
        F.when(name == "assign", F.length(F.regexp_extract(match, ASSIGN, 1)) >= LEAST_ASSIGN)
        .when(name == "access", F.length(match) >= LEAST_ACCESS)
        .when(name == "candidate", ~F.array_contains(F.array(*[match.rlike(p) for p in ALLOWED]), True))
        .otherwise(True)
    )
    kind = F.when(name != "candidate", name).when(match.rlike("^[0-9a-fA-F]+$"), "entropy_hex").otherwise("entropy_base64")
    kind = F.when(name.isNotNull() & passed, kind)  # rows without a passing match stay, for their text
    rows = rows.withColumn("kind", kind)
    bits = F.create_map(*[F.lit(x) for kv in BITS.items() for x in kv])[F.col("kind")]
    hot = F.when(F.col("kind").startswith("entropy"), entropy_span(match, bits))
    rows = rows.withColumn("hot", hot)
    entropy = F.col("hot").isNotNull()
    rows = rows.select(
        "row", "doc_id", "match", F.col("start").alias("from"),
        F.when(~entropy | F.col("hot.to").isNotNull(), F.col("kind")).alias("kind"),
        F.when(entropy, F.col("start") + F.col("hot.from")).otherwise(F.col("start")).alias("start"),
        F.when(entropy, F.col("start") + F.col("hot.to")).otherwise(F.col("end")).alias("end"),
    )
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    is_base = F.col("kind").isin(*KINDS[:3])
    # a row's spans become events in order of place; running sums tell how many base spans and which entropy kind stand after each
    event = lambda at, sign: F.struct(F.col(at).alias("at"), F.when(is_base, F.lit(sign)).otherwise(0).alias("base"), F.when(is_base, 0).otherwise(sign * rank).alias("hot"))
    both = F.when(F.col("kind").isNotNull(), F.array(event("start", 1), event("end", -1)))
    base = F.when(is_base, F.struct(F.col("start").cast("long").alias("start"), rank.alias("rank"), "kind", F.col("end").cast("long").alias("end")))
    held = F.when(F.col("kind").isNotNull() & ~is_base, F.struct("from", "match", "start", "end"))
    rows = rows.select("row", "doc_id", base.alias("span"), held.alias("held"), F.posexplode_outer(both).alias("second", "event"))
    by = W.partitionBy("row").orderBy("event.at")
    rows = rows.select(
        "row", "doc_id", F.when(F.col("second") == 0, F.col("span")).alias("span"), F.col("event.at").alias("start"), F.lead("event.at").over(by).alias("end"),
        F.sum("event.base").over(by).alias("covers"), F.sum("event.hot").over(by).cast("int").alias("rank"), F.last("held", True).over(by).alias("held"),
    )
    part = F.substring(F.col("held.match"), F.col("start") - F.col("held.from") + 1, F.col("end") - F.col("start"))
    bare = (F.col("end") > F.col("start")) & (F.col("covers") == 0) & (F.col("rank") > 0) & part.rlike("[A-Za-z0-9]")
    if not cut:
        bare &= (F.col("start") == F.col("held.start")) & (F.col("end") == F.col("held.end"))
    hot = F.when(bare, F.struct(F.col("start").cast("long").alias("start"), "rank", F.element_at(F.array(*map(F.lit, KINDS)), F.greatest("rank", F.lit(1))).alias("kind"), F.col("end").cast("long").alias("end")))
    rows = rows.select("row", "doc_id", F.explode(F.array("span", hot)).alias("span"))
    return rows.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def redact(df: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", null_ids: bool = False) -> DataFrame:
    """df with each secret's characters in the text replaced by the mark; overlapping and touching spans get one. Each row is told by its own number in a written copy, so rows may repeat ids; rows without a span and null texts stay as they are, and without `null_ids`, as tests of this function expect, so do rows with null ids."""
    rows = written(df.select(F.struct(*df.columns).alias("of"), F.monotonically_increasing_id().alias("row")))
    scanned = rows if null_ids else rows.where(F.col("of")[id_col].isNotNull())
    some = _spans(scanned.select("row", F.col("row").alias("doc_id"), F.coalesce(F.col("of")[text_col], F.lit("")).alias("text")), cut=True).where(F.size("spans") > 0)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<at:bigint,size:bigint>>").alias("kept"))

    def step(done: Column, s: Column) -> Column:
        gap = F.array(F.struct(done["at"].alias("at"), (s["start"] - done["at"]).alias("size")))
        fresh = (s["start"] > done["at"]) | (F.size(done["kept"]) == 0)
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, F.concat(done["kept"], gap)).otherwise(done["kept"]).alias("kept"))

    kept = F.aggregate("spans", start, step, lambda done: F.concat(done["kept"], F.array(F.struct(done["at"].alias("at"), F.lit(2**31 - 1).cast("long").alias("size")))))
    some = some.select("row", kept.alias("kept"))
    text = F.col("of")[text_col]
    pieces = F.transform("kept", lambda g: text.substr((g["at"] + 1).cast("int"), g["size"].cast("int")))
    out = F.when(F.col("kept").isNotNull(), F.array_join(pieces, mark)).otherwise(text)
    return rows.join(some, "row", "left").select(F.struct(*[(out if c == text_col else F.col("of")[c]).alias(c) for c in df.columns]).alias("of")).select("of.*")



def joined(of: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts by pattern, digest of the patterns' spans, and all spans."""
    rows = spans(documents(spark, sf_dir), cut=True)
    base = F.filter("spans", lambda s: s["rank"] <= 3)
    count = [_number(k).alias(f"n_{k}") for k in KINDS[:3]]
    return rows.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {"op1_secret_scan": op1_secret_scan}
SQL: dict[str, str] = {}
