"""N-gram Jaccard join (operator 4): documents whose sets of word shingles agree to three quarters, and their groups.

The product of the incidence matrix (documents by shingles) with its transpose is taken in blocks, and never in full.

1. Equal sets become one row. A bound from the set's size says how many of its rarest shingles must meet a partner's: if
   |A and B| >= t |A or B|, the sets share one of their first n - ceil(t n) + 1 shingles in any common order. Only these
   columns are multiplied; the order is by a table of counts of all shingles, of a fixed size, so frequent ones come last.
2. Columns are dealt out in blocks, by a hash. In each, the columns with few rows are multiplied: overlaps are accumulated
   pair by pair, in numpy, and summed over the blocks. A pair goes on if its overlap here plus all that can lie behind
   the first shingles reaches what its sizes ask for. Columns with many rows are kept as they are.
3. Each row is compared with its best partner: of its pairs, and the first row of a frequent column. These links join
   most of what belongs together, so that pairs within a group are never made.
4. Pairs between groups that are left are compared. Rows of a frequent column that lie in several groups are dealt out to
   cells, row block by row block, and the product of each cell is taken over all columns of the whole sets, so no link
   between groups is lost; a cell returns a spanning forest of its links.

Shingles are told apart by 64 bits, equal sets by 128; what shares less of a hash only costs a comparison.

Defined results: a null text counts as empty; a text without words has no shingles and is linked with nothing; a text of
fewer words than a shingle has one; rows with a null id get their set's size and no group; rows that repeat an id are one
document; ties don't occur, as groups take the smallest id; columns other than the id and the text are left out; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import documents, dropped, fresh, keyed, whole_ids, written
from .rolling import distinct, mixed, shingles

#: Links need this many hundredths; words of a shingle.
PERCENT, WORDS = 75, 5
#: Bits of the table of counts, and of the parts in which it is summed.
TABLE_BITS, PART_BITS = 21, 13
#: Entries of a block of columns; entries of a task that are dealt out at once; rows of a column that make it a frequent one.
BLOCK, SEND, FREQUENT = 1 << 19, 1 << 21, 64
#: Rows of one partner that are compared in one task; rows of a side of a cell.
MEMBERS, CELL = 256, 512
#: A column of a cell with more pairs than this is multiplied as a dense one, so many columns at a time.
DENSE, WIDE = 256, 2048


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def whole(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    first = mixed(s)
    return tuple(int(mixed(np.sum(x, keepdims=True) + np.uint64(len(s)))[0]) for x in (first, mixed(first + np.uint64(1))))


def least(n):
    """Shingles of a set of n that stand first: one of them is a partner's, too."""
    return n - (PERCENT * n + 99) // 100 + 1


def profiles(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, hi, lo) of each text, hi and lo hashes of its whole set, as a written table; and how often each value of a shingle's last bits occurs."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "hi", "lo", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = keys = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            counts = np.zeros(1 << TABLE_BITS, np.uint32) if counts is None else counts
            sets = [shingles(t.as_py(), WORDS) for t in batch.column(1)]
            counts += np.bincount(np.concatenate(sets) & np.uint64((1 << TABLE_BITS) - 1), minlength=1 << TABLE_BITS).astype(np.uint32)
            hi, lo = (np.array(x, np.uint64) for x in zip(*map(whole, sets), strict=True))
            n = len(sets)
            yield pa.RecordBatch.from_arrays([keys, pa.array([len(s) for s in sets], pa.int64()), _long(hi), _long(lo), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if counts is not None:
            for k, part in enumerate(counts.reshape(-1, 1 << PART_BITS)):
                one = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(1, keys.type), one, one, one, pa.array([k], pa.int32()), pa.array([zstandard.compress(part.tobytes(), 3)], pa.binary())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zstandard.decompress(raw.as_buffer()), np.uint32)
                sums[k] = sums[k] + counts if k in sums else counts.astype(np.uint64)
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], ["part", "counts"])

    both = written(rows.mapInArrow(run, f"doc_id {kind}, n long, hi long, lo long, part int, counts binary"))
    table = np.zeros((1 << (TABLE_BITS - PART_BITS), 1 << PART_BITS), np.uint32)
    summed = both.where("part is not null").select("part", "counts").repartition("part").mapInArrow(add, "part int, counts binary")
    # 4 bytes by 2**TABLE_BITS in all; toLocalIterator would read a shuffle that goes as soon as the iterator is made (see written)
    for r in summed.collect():
        table[r["part"]] = np.frombuffer(r["counts"], np.uint32)
    return both, table.ravel()


def packed(x: np.ndarray) -> bytes:
    """The lower six bytes of each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: memoryview) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def entries(rows: DataFrame, table, blocks: int) -> DataFrame:
    """block, tokens, sets, sizes, numbers: the entries of each set's first shingles, as many as the size bound asks for, together for a block of columns: hashes of the sets, their sizes, how many entries each has, and the entries' shingles."""
    names = ["block", "tokens", "sets", "sizes", "numbers"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        mask = np.uint64(len(counts) - 1)
        tokens, keys, sizes, held, met = [], [], [], 0, set()

        def deal() -> Iterator[pa.RecordBatch]:
            token, key, size = np.concatenate(tokens), np.array(keys, np.uint64), np.array(sizes, np.uint32)
            of = np.repeat(np.arange(len(key), dtype=np.uint32), list(map(len, tokens)))
            block = token % np.uint64(blocks)
            order = np.argsort(block.astype(np.uint16) if blocks < 1 << 16 else block, kind="stable")
            token, of, block = token[order] // np.uint64(blocks), of[order], block[order]
            edge = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
            out = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                own = of[a:b]
                at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                out.append((int(block[a]), packed(token[a:b]), key[own[at]].tobytes(), size[own[at]].tobytes(), np.diff(np.append(at, b - a)).astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(zip(*out, strict=True))], names)

        for batch in batches:
            for text in batch.column(0):
                s = shingles(text.as_py(), WORDS)
                if not len(s) or (key := whole(s)[1]) in met:  # copies among what is dealt out together count once
                    continue
                met.add(key)
                first = s[np.lexsort((s, counts[s & mask]))[: least(len(s))]]
                tokens.append(first)
                keys.append(key)
                sizes.append(len(s))
                held += len(first)
                if held >= SEND:
                    yield from deal()
                    tokens, keys, sizes, held, met = [], [], [], 0, set()
        if held:
            yield from deal()

    return rows.select("text").mapInArrow(run, "block long, tokens binary, sets binary, sizes binary, numbers binary")


def _pairs(size: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within columns of these sizes and starts, some at a time."""
    for c in np.unique(size):
        left, right = np.triu_indices(c, 1)
        at = start[size == c]
        step = max(1, 4_000_000 // len(left))
        for k in range(0, len(at), step):
            yield ((at[k : k + step, None] + left).ravel(), (at[k : k + step, None] + right).ravel())


def multiplied(dealt: DataFrame, blocks: int) -> DataFrame:
    """Of each block of columns: the overlaps of pairs x < y of sets, of sizes nx and ny, in its columns of few rows; and with column: an entry x, nx of a frequent one."""

    def run(part: pa.Table) -> pa.Table:
        flat = lambda name, kind: np.frombuffer(b"".join(part.column(name).to_pylist()), kind)
        number = flat("numbers", np.uint32)
        token, key, n = unpacked(b"".join(part.column("tokens").to_pylist())), np.repeat(flat("sets", np.uint64), number), np.repeat(flat("sizes", np.uint32), number).astype(np.int64)
        order = np.lexsort((key, token))
        token, key, n = token[order], key[order], n[order]
        once = np.append(True, (token[1:] != token[:-1]) | (key[1:] != key[:-1]))  # copies from several tasks
        token, key, n = token[once], key[once], n[once]
        start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(start, len(token)))
        few = (size > 1) & (size <= FREQUENT)
        x, y = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in _pairs(size[few], start[few]):
            fits = 100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])
            x.append(a[fits])
            y.append(b[fits])
        # rows of a pair are named by places of their sets' first entries here, so a pair is one number
        names, first, name = np.unique(key, return_index=True, return_inverse=True)
        pair, overlap = np.unique(name[np.concatenate(x)] * len(names) + name[np.concatenate(y)], return_counts=True)
        px, py = pair // max(1, len(names)), pair % max(1, len(names))
        many = np.repeat(size > FREQUENT, size)
        column = token[many] * np.uint64(blocks) + np.uint64(part.column("block")[0].as_py())
        both = lambda a, b: pa.chunked_array([pa.array(a), pa.array(b)])
        none = pa.nulls(len(pair), pa.int64()), pa.nulls(int(many.sum()), pa.int64())
        return pa.table({
            "column": both(none[0], column.view(np.int64)), "x": both(names[px].view(np.int64), key[many].view(np.int64)), "nx": both(n[first[px]], n[many]),
            "y": both(names[py].view(np.int64), none[1]), "ny": both(n[first[py]], none[1]), "overlap": both(overlap.astype(np.int64), none[1]),
        })

    return dealt.groupBy("block").applyInArrow(run, "column long, x long, nx long, y long, ny long, overlap long")


def linked(both, x, y):
    """Whether sets of x and y shingles, of which they share `both`, are linked."""
    return (100 + PERCENT) * both >= PERCENT * (x + y)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b of those pairs of ids whose sets are linked. texts: doc_id, text. Rows of one a are dealt out over as many tasks as they need, with a copy of a's text each."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    salted = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts").cast("int"))
    need = salted.select(F.col("b").alias("doc_id"), "a", "part", F.lit(1).alias("side")).unionByName(
        many.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, None
        for batch in batches:
            a_s, b_s = [], []
            a, part, side, ids = (batch.column(k).to_pylist() for k in range(4))
            for k in range(batch.num_rows):
                s = shingles(batch.column(4)[k].as_py(), WORDS)
                if side[k] == 0:
                    key, mine = (a[k], part[k]), s
                elif key == (a[k], part[k]):
                    both = len(mine) + len(s) - len(distinct(np.concatenate([mine, s])))
                    if both and linked(both, len(mine), len(s)):
                        a_s.append(a[k])
                        b_s.append(ids[k])
            if a_s:
                yield pa.RecordBatch.from_arrays([pa.array(a_s, pa.int64()), pa.array(b_s, pa.int64())], ["a", "b"])

    rows = need.hint("merge").join(texts, "doc_id").select("a", "part", "side", "doc_id", "text")
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "side").mapInArrow(run, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The blocked product: what each set of the left shares with each of the right."""
    tl, tr = np.concatenate(left), np.concatenate(right)
    il, ir = (np.repeat(np.arange(len(s)), list(map(len, s))) for s in (left, right))
    columns = np.intersect1d(distinct(tl), distinct(tr), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(columns):
        return out

    def sorted_by_column(t, i):
        at = np.searchsorted(columns, t)
        keep = columns[np.minimum(at, len(columns) - 1)] == t
        at, i = at[keep], i[keep]
        order = np.argsort(at, kind="stable")
        number = np.bincount(at, minlength=len(columns))
        return at[order], i[order], number, np.cumsum(number) - number

    cl, il, nl, _ = sorted_by_column(tl, il)
    cr, ir, nr, sr = sorted_by_column(tr, ir)
    dense = nl * nr > DENSE
    some = np.flatnonzero(~dense[cl])
    for k in range(0, len(some), 1 << 16):  # few pairs: one by one
        at = some[k : k + (1 << 16)]
        times = nr[cl[at]]
        begin = np.cumsum(times) - times
        partner = ir[np.repeat(sr[cl[at]] - begin, times) + np.arange(times.sum())]
        out += np.bincount(np.repeat(il[at], times) * len(right) + partner, minlength=out.size).reshape(out.shape)
    place = np.cumsum(dense) - 1
    l_on, r_on = dense[cl], dense[cr]
    cl, il, cr, ir = place[cl[l_on]], il[l_on], place[cr[r_on]], ir[r_on]
    for k in range(0, int(dense.sum()), WIDE):
        a, b = np.zeros((len(left), WIDE), np.float32), np.zeros((len(right), WIDE), np.float32)
        on, at = slice(*np.searchsorted(cl, [k, k + WIDE])), slice(*np.searchsorted(cr, [k, k + WIDE]))
        a[il[on], cl[on] - k] = 1
        b[ir[at], cr[at] - k] = 1
        out += (a @ b.T).astype(np.int64)
    return out


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links that join what the ones before don't."""
    root: dict[int, int] = {}

    def top(k: int) -> int:
        while (up := root.get(k, k)) != k:
            root[k] = root.get(up, up)
            k = up
        return k

    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(i), top(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def cells(members: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: links between groups of rows (family, a, grp) of one family, enough to join all that are linked. Small groups of a family are dealt out together, a large one fills blocks of its own, and blocks meet in cells, but for two of one group."""
    sizes = members.groupBy("family", "grp").agg(F.count("*").alias("size")).withColumn("own", F.col("size") > CELL)
    small = sizes.groupBy("family").agg(F.ceil(F.coalesce(F.sum(F.when(~F.col("own"), F.col("size"))), F.lit(1)) / CELL).alias("parts"))
    sizes = sizes.join(small, "family")
    placed = members.join(sizes, ["family", "grp"]).select(
        "family", "a", "grp", "own", F.when(F.col("own"), F.col("grp")).otherwise(0).alias("of"),
        F.when(F.col("own"), F.pmod(F.xxhash64("a"), F.ceil(F.col("size") / CELL))).otherwise(F.pmod(F.xxhash64("grp"), "parts")).alias("k"),
    )
    placed = written(placed.withColumn("row_block", F.struct("own", "of", "k")))
    block = placed.select("family", "row_block").distinct()
    meet = block.join(fresh(block).withColumnRenamed("row_block", "other"), "family").where("row_block <= other").where("not (row_block.own and row_block.own = other.own and row_block.of = other.of)")
    meet = meet.withColumn("cell", F.xxhash64("family", "row_block", "other")).select("family", "row_block", "other", "cell")
    sides = placed.join(meet.drop("other"), ["family", "row_block"]).select("cell", "a", "grp", F.lit(0).alias("side")).unionByName(
        placed.withColumnRenamed("row_block", "other").join(meet.where("row_block <> other").drop("row_block"), ["family", "other"]).select("cell", "a", "grp", F.lit(1).alias("side"))
    )

    def run(part: pa.Table) -> pa.Table:
        group, side = np.array(part.column("grp").to_pylist(), np.int64), np.array(part.column("side").to_pylist())
        sets = [shingles(t.as_py(), WORDS) for t in part.column("text")]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        right = right if len(right) else left
        a, b = [], []
        if len(left):
            size = np.array(list(map(len, sets)))
            both = overlaps([sets[k] for k in left], [sets[k] for k in right])
            on = linked(both, size[left][:, None], size[right][None, :]) & (both > 0) & (group[left][:, None] != group[right][None, :])
            i, j = np.nonzero(on)
            pairs = np.unique(np.stack([group[left[i]], group[right[j]]]), axis=1)
            for x, y in forest(*pairs):
                a.append(x)
                b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = sides.hint("merge").join(texts.select(F.col("doc_id").alias("a"), "text"), "a").select("cell", "side", "grp", "text")
    return rows.groupBy("cell").applyInArrow(run, "a long, b long")


def families(entries: DataFrame) -> DataFrame:
    """family, a, grp of entries (column, a, grp): every two rows of a column meet in a family, and columns that share rows mostly have one."""
    family = entries.select("column", F.col("column").alias("family")).distinct()
    for _ in range(2):  # each time columns take the smallest name that their rows know of
        row = entries.join(family, "column").groupBy("a").agg(F.min("family").alias("family"))
        family = written(entries.join(row, "a").groupBy("column").agg(F.min("family").alias("family")))
    return entries.join(family, "column").select("family", "a", "grp").distinct()


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row; ids are whole numbers, others are refused."""
    rows = keyed(whole_ids(df, id_col), id_col, text_col)
    profile, table = profiles(rows)
    each = profile.where("part is null").select("doc_id", "n", "hi", "lo")
    some = rows.where("doc_id is not null")
    reps = written(each.where("n > 0 and doc_id is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")))
    total = each.where("n > 0").agg(F.sum(F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK))
    found = written(multiplied(entries(some, df.sparkSession.sparkContext.broadcast(table), blocks), blocks))

    by_id = lambda t, c, to: t.join(reps.select(F.col("lo").alias(c), F.col("rep").alias(to)), c)
    rest = F.greatest(*[F.ceil(F.col(c) * PERCENT / 100) - 1 for c in ("nx", "ny")])
    pairs = found.where("column is null").groupBy("x", "y", "nx", "ny").agg(F.sum("overlap").alias("overlap")).where(linked(F.col("overlap") + rest, F.col("nx"), F.col("ny")))
    pairs = written(by_id(by_id(pairs, "x", "a"), "y", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "overlap").where("a <> b"))
    frequent = written(by_id(found.where("column is not null"), "x", "a").select("column", "a", "nx"))
    dropped(found)
    # texts that may be compared, in one pass over all of them; the plan is the same at every size
    needed = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).unionByName(frequent.select("a")).distinct()
    some = written(some.join(needed.hint("merge"), F.col("doc_id") == F.col("a"), "left_semi"))

    # each row with its best partner
    head = frequent.groupBy("column").agg(F.min(F.struct("a", "nx")).alias("head")).select("column", F.col("head.a").alias("h"), F.col("head.nx").alias("nh"))
    stars = frequent.join(head, "column").where("a <> h").where(100 * F.least("nx", "nh") >= PERCENT * F.greatest("nx", "nh")).groupBy("a", "h").count()
    stars = stars.groupBy("a").agg(F.max_by("h", F.struct("count", "h")).alias("h")).select(F.col("h").alias("a"), F.col("a").alias("b"))
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("overlap", "a")).alias("a")).select("a", "b")
    tried = written(best.unionByName(stars).distinct())
    label = written(components(verified(tried, some)))

    # pairs and frequent columns between groups
    def named(t: DataFrame, c: str, to: str) -> DataFrame:
        return t.join(label.select(F.col("node").alias(c), F.col("component").alias("_c")), c, "left").withColumn(to, F.coalesce("_c", c)).drop("_c")

    across = named(named(pairs.select("a", "b").join(tried, ["a", "b"], "left_anti"), "a", "ga"), "b", "gb").where("ga <> gb")
    across = written(across.select("a", "b", "ga", "gb"))
    more = verified(across.select("a", "b"), some).join(across, ["a", "b"]).select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    open_ = named(frequent.select("column", "a"), "a", "grp")
    several = open_.groupBy("column").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo <> hi").select("column")
    open_ = written(open_.join(several, "column", "left_semi"))
    if not open_.isEmpty():
        more = more.unionByName(cells(families(open_), some))
    higher = components(more).select(F.col("node").alias("component"), F.col("component").alias("top"))

    all_ = named(reps.select("hi", "lo", F.col("rep")), "rep", "component").join(higher, "component", "left")
    final = all_.select("hi", "lo", F.coalesce("top", "component").alias("component_id"))
    out = each.join(final, ["hi", "lo"], "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out


def op4_jaccard_groups(spark, sf_dir: str) -> DataFrame:
    """Groups of all documents whose shingle sets agree to three quarters."""
    return groups(documents(spark, sf_dir))


QUERIES = {"op4_jaccard_groups": op4_jaccard_groups}
SQL: dict[str, str] = {}
