"""Token counts (operator 5): a separator scan over flat token files that have no index.

A file is a run of 2-byte ids in which one id ends each document. Its blocks are ranges of bytes, which Spark deals out;
a task opens the file, reads its ranges and searches each for the separator by itself. What stands before a block's first
separator and after its last is stitched by prefix sums, first over the blocks of a run of RUN blocks, then over the runs
of a file: documents that end before a block, and tokens since the last separator. So one file of any size is many tasks.

Files are opened with pyarrow's file systems (file, hdfs, s3, gs and others), by the paths that Spark gives. A file written
by a lost or repeated attempt has a name of its own and is never read, as only the names in the written order table count.

Defined results: tokens after the last separator are no document; two separators with nothing between them are an empty
document; null blocks count as empty; blocks of a file may come in any order and are of any size; an empty table gives
an empty table, an empty file no row. In the writer a null text counts as empty, and repeated rows are written each for
itself; other columns are not read, so none can clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import rank_encoder
from .common import documents, keyed, shared_dir, written

#: Bytes of a block; the id that ends a document; blocks that are stitched at a time; bytes that a task reads, about.
BLOCK, EOD, RUN, TASK = 1 << 20, 50256, 4096, 1 << 28


def write_tokens(df: DataFrame, path: str, block: int = BLOCK, eod: int = EOD, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(blocks, order): a flat file in the shared folder for each partition of df, as ranges that don't heed documents, and each file's documents in order.

    blocks: file, block, at, length (bytes). order: file, ordinal, doc_id.
    """
    rows = keyed(df, id_col, text_col)
    folder = shared_dir(df.sparkSession)
    schema = f"file string, size long, ordinal long, doc_id {rows.schema['doc_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, store = rank_encoder(path), None
        stop, size, seen = np.array([eod], "<u2").tobytes(), 0, 0
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        out = None
        for batch in batches:
            keys = batch.column(0)
            if not len(keys):
                continue
            if out is None:
                store, at = fs.FileSystem.from_uri(name)
                store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(at)
            for text in batch.column(1):
                size += out.write(np.frombuffer(encode(text.as_py()), "<u4").astype("<u2").tobytes() + stop)
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.nulls(n, pa.int64()), pa.array(np.arange(seen, seen + n)), keys], ["file", "size", "ordinal", "doc_id"])
            seen += n
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, keys.type)], ["file", "size", "ordinal", "doc_id"])

    both = written(rows.mapInArrow(run, schema))
    return ranges(both.where("size is not null").select("file", "size"), block), both.where("size is null").select("file", "ordinal", "doc_id")


def ranges(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """file, block, at, length: the byte ranges of files (file, size), dealt to as many tasks as their bytes need, and to no fewer than the session's shuffles have."""
    total = files.agg(F.sum("size").alias("n")).first()["n"] or 0
    tasks = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK)
    blocks = files.where("size > 0").select("file", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {block})")).alias("block"))
    each = blocks.select("file", "block", (F.col("block") * block).alias("at"), F.least(F.lit(block).cast("long"), F.col("size") - F.col("block") * block).alias("length"))
    return each.repartition(tasks, "file", "block")


def read_tokens(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """file, block, at, length of the flat files at a path; the files are only listed here, not read."""
    return ranges(spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size")), block)


def stitched(summary: DataFrame) -> DataFrame:
    """f, b, at, documents, open of blocks (file, block, size, n, last): ids and documents before each, and where the document begins that is open at its start."""

    def before(by: list[str], order: str) -> W:
        return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)

    run = F.floor(F.col("block") / RUN).alias("run")
    inner = before(["file", "run"], "block")
    zero = F.lit(0).cast("long")
    blocks = summary.select("*", run).withColumn("at", F.coalesce(F.sum("size").over(inner), zero)).withColumn("end", F.col("at") + F.col("last") + 1)
    blocks = blocks.select("file", "block", "run", "size", "n", "at", "end", F.coalesce(F.sum("n").over(inner), zero).alias("documents"), F.max("end").over(inner).alias("open"))
    outer = before(["file"], "run")
    runs = blocks.groupBy("file", "run").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max("end").alias("end")).withColumn("run_at", F.coalesce(F.sum("size").over(outer), zero))
    runs = runs.select("file", "run", "run_at", F.coalesce(F.sum("n").over(outer), zero).alias("run_documents"), F.coalesce(F.max(F.col("run_at") + F.col("end")).over(outer), zero).alias("run_open"))
    return blocks.join(runs, ["file", "run"]).select(
        F.col("file").alias("f"), F.col("block").alias("b"), (F.col("run_at") + F.col("at")).alias("at"), (F.col("run_documents") + F.col("documents")).alias("documents"),
        F.coalesce(F.col("run_at") + F.col("open"), F.col("run_open")).alias("open"),
    )


def scan(blocks: DataFrame, eod: int = EOD, dtype: str = "<u2") -> DataFrame:
    """file, ordinal, start, n_tokens of each document; start: ids before it in its file, separators counted; n_tokens: without its separator.

    blocks: byte ranges as `ranges` gives them, or blocks that are at hand (file, block, data).
    """
    if np.dtype(dtype).itemsize not in (2, 4):
        raise ValueError(f"ids of {dtype} are not known")
    file = f"file {blocks.schema['file'].dataType.simpleString()}"
    at_hand = "data" in blocks.columns

    def bytes_of(batch: pa.RecordBatch) -> Iterator[bytes]:
        if at_hand:
            yield from (data.as_py() or b"" for data in batch.column(2))
            return
        names, places, lengths = (batch.column(c).to_pylist() for c in (0, 2, 3))
        name = source = None
        for k in range(len(names)):
            if names[k] != name:
                name = names[k]
                store, inside = fs.FileSystem.from_uri(name)
                source = store.open_input_file(inside)
            data = source.read_at(lengths[k], places[k])
            if len(data) != lengths[k]:
                raise OSError(f"{name} has fewer bytes than were counted")
            yield data

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes, last = [], [], []
            for data in bytes_of(batch):
                ids = np.frombuffer(data, dtype)
                ends = np.flatnonzero(ids == eod)
                found.append(ends.astype("<i4").tobytes())
                sizes.append(len(ids))
                last.append(int(ends[-1]) if len(ends) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(last, pa.int64()), pa.array(found, pa.binary())], ["file", "block", "size", "last", "ends"])

    columns = ["file", "block", "data"] if at_hand else ["file", "block", "at", "length"]
    ordered = blocks.select(*columns) if at_hand else blocks.select(*columns).sortWithinPartitions("file", "block")
    found = written(ordered.mapInArrow(search, f"{file}, block long, size long, last long, ends binary"))
    carried = stitched(found.select("file", "block", "size", (F.length("ends") / 4).cast("long").alias("n"), "last"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (ends, at, ordinal, begin) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True)):
                stop = np.frombuffer(ends, "<i4").astype(np.int64) + at
                start = np.concatenate([[begin], stop[:-1] + 1])
                files = batch.column(0).take(pa.array(np.full(len(stop), k)))
                yield pa.RecordBatch.from_arrays([files, pa.array(np.arange(ordinal, ordinal + len(stop))), pa.array(start), pa.array(stop - start)], ["file", "ordinal", "start", "n_tokens"])

    joined = found.where(F.length("ends") > 0).join(carried, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select("file", "ends", "at", "documents", "open")
    return joined.mapInArrow(measure, f"{file}, ordinal long, start long, n_tokens long")


def op5_separator_scan(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found again in flat files of their ids."""
    import public_tokenizers

    blocks, order = write_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return order.join(scan(blocks), ["file", "ordinal"]).select("doc_id", "n_tokens", F.regexp_extract("file", r"part-(\d+)-", 1).cast("long").alias("part"), "ordinal", "start")


QUERIES = {"op5_separator_scan": op5_separator_scan}
SQL: dict[str, str] = {}
