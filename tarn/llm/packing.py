"""Best-fit packing (operator 6): sum-of-squares packing of documents into token sequences.

Documents become pieces on the executors. A piece as long as a sequence is one, and is numbered where it lies. What is
left, at most one piece a document, is dealt into groups of about GROUP by a hash of its row, so neither long documents
nor repeated ids make a group larger, and each group is packed by itself: a piece goes where the sum of the squared counts
of open bins per residual gap becomes smallest, long pieces first. The bins that this leaves open are few; their pieces
are placed once more, best fit, and the better of both packings stays. On sf0.1 two sequences in 9,873 are more than the
tokens need (eight with groups of half the size). Which of several packings comes out follows how the rows lie.

Defined results: a null text counts as empty and has only the end id; repeated rows are packed each for itself; columns
other than the id and the text are left out; ties go to the fuller bin, then the longer, then the smaller id; an empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import of_file
from .common import documents, keyed, written

#: Pieces that are packed together, about.
GROUP = 10_000
CAPACITY, END = 1024, 2
#: Rows after which a batch of pieces is sent on.
SEND_ROWS, SEND_BYTES = 20_000, 8 << 20


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, but the first piece has what is left over."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary) of each document's pieces; path: a vocabulary file, .json or of ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = of_file(path)
        stop = np.array([end], "<u4").tobytes()
        for batch in batches:
            keys = batch.column(0)
            rows: list[tuple] = []
            held = 0

            def send(rows: list[tuple], keys: pa.Array = keys) -> pa.RecordBatch:
                at, *rest = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * keep_ids]
                return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *map(pa.array, rest, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])

            for k, made in enumerate(encode.many(batch.column(1).to_pylist())):
                ids = memoryview(made + stop)
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((k, piece, start, length, zlib.crc32(part), *[bytes(part)] * keep_ids))
                    held += len(part) * keep_ids
                    if len(rows) >= SEND_ROWS or held >= SEND_BYTES:
                        yield send(rows)
                        rows, held = [], 0
            if rows:
                yield send(rows)
        encode.forget()

    rows = keyed(df, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def sum_of_squares(lengths: list[int], capacity: int) -> list[int]:
    """The level that each item's bin had before it; 0 opens a bin. Ties go to the fullest bin.

    An item of size s moves a bin from level h to h + s, which adds 2 (N[h + s] - N[h] + 1) to the sum of squares; a bin
    that is opened or filled leaves out its term N[h] or N[h + s] and one half. Below, less 2 throughout.
    """
    count = np.zeros(capacity + 1, np.int64)
    out = []
    for s in lengths:
        before = count[: capacity + 1 - s]
        gain = 2 * (count[s:] - before)
        gain[-1] = -2 * before[-1] - 1
        gain[before == 0] = np.iinfo(np.int64).max
        gain[0] = 2 * count[s] - 1 if s < capacity else -2
        h = len(gain) - 1 - int(np.argmin(gain[::-1]))
        out.append(h)
        count[h] -= h > 0
        count[h + s] += h + s < capacity
    return out


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The same for the fullest open bin with room."""
    count = np.zeros(capacity + 1, bool)
    number = np.zeros(capacity + 1, np.int64)
    out = []
    for s in lengths:
        open_ = np.flatnonzero(count[1 : capacity + 1 - s])
        h = int(open_[-1]) + 1 if len(open_) else 0
        out.append(h)
        if h:
            number[h] -= 1
            count[h] = number[h] > 0
        if h + s < capacity:
            number[h + s] += 1
            count[h + s] = True
    return out


def place(lengths: list[int], levels: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each item's bin and offset there, and the number of bins, from the levels that a rule chose."""
    open_: dict[int, list[int]] = {}
    bins, n = np.empty(len(lengths), np.int64), 0
    for k, (s, h) in enumerate(zip(lengths, levels, strict=True)):
        if h:
            bins[k] = open_[h].pop()
        else:
            bins[k], n = n, n + 1
        if h + s < capacity:
            open_.setdefault(h + s, []).append(bins[k])
    return bins, np.array(levels, np.int64), n


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and offsets of items that come with the longest first."""
    items = lengths.tolist()
    bins, offsets, n = place(items, sum_of_squares(items, capacity), capacity)
    filled = np.bincount(bins, lengths, n)
    loose = filled[bins] < capacity
    if loose.any():
        again = lengths[loose].tolist()
        new_bins, new_offsets, m = place(again, best_fit(again, capacity), capacity)
        if m < len(np.unique(bins[loose])):
            bins[loose], offsets[loose] = new_bins + n, new_offsets
    return np.unique(bins, return_inverse=True)[1], offsets


def pack(rows: DataFrame, n_documents: int, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """rows of pieces() with sequence_id and offset. n_documents, the number of documents, sets the number of groups, as a document has one piece below the capacity at most."""
    groups = max(1, -(-n_documents // group))
    names = rows.columns
    each = written(rows)
    row = F.monotonically_increasing_id()
    whole = each.where(F.col("length") == capacity).select(*names, (-1 - row).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = pack_group(part["length"].to_numpy(np.int64), capacity)
        return part.assign(sequence_id=bins + (np.int64(part["pack_group"].iloc[0]) << 40), offset=offsets)[[*names, "sequence_id", "offset"]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rest = each.where(F.col("length") < capacity).withColumn("pack_group", F.pmod(F.xxhash64(row), F.lit(groups)).cast("int"))
    return whole.unionByName(rest.groupBy("pack_group").applyInPandas(run, f"{fields}, sequence_id long, offset long"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary): the packed sequences themselves, of pieces that kept their ids; a sequence has at most CAPACITY ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def op6_sum_of_squares_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    import public_tokenizers

    docs = documents(spark, sf_dir)
    return pack(pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), docs.count())


QUERIES = {"op6_sum_of_squares_packing": op6_sum_of_squares_packing}
SQL: dict[str, str] = {}
