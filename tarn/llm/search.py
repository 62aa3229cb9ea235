"""Ranked lexical search (operator 13): score-at-a-time over postings in the order of their impact.

A first pass over the texts keeps, of each document, its length and how often it holds the terms that queries ask for; the
table is written, and sums over all of it give the terms' weights. In a second pass each task goes through its rows in
shards of bounded size. A shard is inverted: postings by term, and within a term by their impact, an exact integer, from
high to low. For a query, all groups of one impact that reach a falling limit are added to the documents' sums. What the
next groups of all terms can add bounds every document; when that is less than the k-th best sum, no document that was
not met can be among the best, and those that still could are few, their scores are completed from the shard's rows. So
each shard gives the exact best k of its documents, and Spark ranks those.

Queries are one block, or several if their texts have more than QUERY_BYTES in all; each block is a search of its own, so
what tasks are given has a bound however many queries there are.

Defined results: a null text has no term; documents without a term count for nothing; each repeated row is a document; a
null id comes after all others among equal scores; an item's rows with equal texts count once, those with different texts
are one query; a null item id is an item; an item without a term that any document holds has no row, nor has an empty
table; texts are read whole, however long; other columns are not read, so none can clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, keyed, written
from .words import words

TOP = 10
#: Bytes of the queries' texts of a block, about; documents and postings of a shard.
QUERY_BYTES, SHARD_ROWS, SHARD_POSTINGS = 4 << 20, 16_384, 1 << 20
#: Candidates for each place, above which a search goes on rather than completing their scores.
FEW = 16
#: How a document's length counts, in percent; the tf at which half of a term's weight is reached, by 1000. Fixed values.
LENGTH_SHARE, TF_SCALE, TF_HALF, SCALE = 75, 1000, 8, 1_000_000_000


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w * ((SCALE * tf) // (TF_SCALE * tf + TF_HALF * m))


def index(df: DataFrame, terms: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms of the document), terms, tfs (those of the given terms that it holds, ascending, and how often; little-endian 4-byte numbers) of documents with a term, written."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            at, lengths, ids, tfs = [], [], [], []
            for k, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                n, found = 0, Counter()
                for part in words(text):
                    n += len(part)
                    found.update(filter(number.__contains__, part))
                if n:
                    held = sorted((number[t], c) for t, c in found.items())
                    at.append(k)
                    lengths.append(n)
                    ids.append(np.array([h[0] for h in held], "<u4").tobytes())
                    tfs.append(np.array([h[1] for h in held], "<u4").tobytes())
            if at:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "tfs"])

    rows = keyed(df, id_col, text_col)
    return written(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, terms binary, tfs binary"))


def statistics(indexed: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term; partitions are summed before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, rows, length = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            rows += batch.num_rows
            length += pc.sum(batch.column("n")).as_py() or 0
            holding += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4"), minlength=n_terms)
        term = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *term.tolist()], pa.int64()), pa.array([rows, length, *holding[term].tolist()], pa.int64())], ["term", "k"])

    found = dict(indexed.select("n", "terms").mapInArrow(run, "term long, k long").groupBy("term").agg(F.sum("k")).collect())
    df = np.zeros(n_terms, np.int64)
    for term, k in found.items():
        if term >= 0:
            df[term] = k
    return found.get(-2, 0), found.get(-1, 0), df


class Shard:
    """The inverted postings of a few documents: by term, and within it by impact from high to low."""

    def __init__(self, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, w: np.ndarray, n_documents: int, n_all: int):
        self.rows, self.begin = len(n), np.append(0, np.cumsum(counts))
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n.astype(np.int64) * n_documents) // n_all
        doc = np.repeat(np.arange(self.rows), counts)
        self.terms, self.impact = terms, impacts(tfs.astype(np.int64), m[doc], w[terms])
        order = np.lexsort((-self.impact, terms))
        self.docs, self.falling = doc[order], -self.impact[order]  # ascending, for searchsorted
        self.first = np.searchsorted(terms[order], np.arange(len(w) + 1))

    def complete(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Whole scores of documents, ascending; times: how often the query has each term."""
        sizes = self.begin[docs + 1] - self.begin[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.begin[docs] - (ends - sizes), sizes)
        # no document here is without a posting, so no slice is empty
        return np.add.reduceat(times[self.terms[at]] * self.impact[at], ends - sizes)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k documents with the highest scores above 0, and the scores; rank orders equal ones. times: by term, for all terms."""
        lists = [(self.first[t], self.first[t + 1], int(times[t])) for t in terms.tolist() if self.first[t] < self.first[t + 1]]
        acc = np.zeros(self.rows, np.int64)
        at = [begin for begin, _, _ in lists]
        limit = max((-int(self.falling[begin]) * q for begin, _, q in lists), default=0)
        while limit > 0:
            rest = 0
            limit = limit // 2
            for j, (_, end, q) in enumerate(lists):
                # all groups whose impact, as often as the query has the term, reaches the limit
                stop = at[j] + int(np.searchsorted(self.falling[at[j] : end], -limit // q, "right")) if limit else end
                if stop > at[j]:
                    # a document stands once in a list, so plain indexing adds each
                    acc[self.docs[at[j] : stop]] -= q * self.falling[at[j] : stop]
                    at[j] = stop
                if stop < end:
                    rest -= q * int(self.falling[stop])
            if not rest:
                break
            kth = int(np.partition(acc, self.rows - k)[self.rows - k]) if self.rows >= k else 0
            if rest < kth:  # a document that was not met has at most rest
                docs = np.flatnonzero(acc + rest >= kth)
                if len(docs) <= FEW * k:
                    scores = self.complete(docs, times)
                    order = np.lexsort((rank[docs], -scores))[:k]
                    return docs[order], scores[order]
        docs = np.flatnonzero(acc)
        if len(docs) > k:  # ties of the k-th stay for the order by rank
            docs = docs[acc[docs] >= np.partition(acc[docs], len(docs) - k)[len(docs) - k]]
        order = np.lexsort((rank[docs], -acc[docs]))[:k]
        return docs[order], acc[docs[order]]


def _ranks(ids: pa.Array) -> np.ndarray:
    """Places of ids in ascending order, null last."""
    order = pc.sort_indices(pa.table({"id": ids}), sort_keys=[("id", "ascending")], null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _shards(batches: Iterator[pa.RecordBatch], rows: int, postings: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        sizes = pc.divide(pc.binary_length(batch.column("terms")), 4).to_numpy(zero_copy_only=False)
        begin = 0
        for end in range(1, batch.num_rows + 1):
            n, size = n + 1, size + int(sizes[end - 1])
            if n >= rows or size >= postings:
                yield pa.Table.from_batches([*held, batch.slice(begin, end - begin)])
                held, begin, n, size = [], end, 0, 0
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _search(docs: DataFrame, queries: dict, k: int, id_col: str, text_col: str, shard_rows: int, shard_postings: int) -> DataFrame:
    """item (place in queries), doc_id, score: the best k of each shard. queries: terms by item."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({t for terms in queries.values() for t in terms}))}
    table = index(docs, number, id_col, text_col)
    n_documents, n_all, df = statistics(table, len(number))
    asked = []
    for terms in queries.values():
        at = sorted((number[t], c) for t, c in Counter(terms).items())
        asked.append((np.array([a for a, _ in at], np.int64), np.array([c for _, c in at], np.int64)))
    shared = spark.sparkContext.broadcast((asked, np.array([weight(n_documents, d) for d in df.tolist()], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = shared.value
        times = np.zeros(len(w), np.int64)
        for rows in _shards(batches, shard_rows, shard_postings):
            raw = [b"".join(rows.column(c).to_pylist()) for c in ("terms", "tfs")]
            counts = pc.divide(pc.binary_length(rows.column("terms")), 4).to_numpy().astype(np.int64)
            shard = Shard(rows.column("n").to_numpy(), counts, *(np.frombuffer(r, "<u4").astype(np.int64) for r in raw), w, n_documents, n_all)
            ids = rows.column("doc_id").combine_chunks()
            rank = _ranks(ids)
            items, found, scores = [], [], []
            for item, (terms, often) in enumerate(asked):
                times[terms] = often
                at, score = shard.best(terms, times, k, rank)
                times[terms] = 0
                items.append(np.full(len(at), item))
                found.append(at)
                scores.append(score)
            at = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items), pa.int32()), ids.take(pa.array(at, pa.int64())), pa.array(np.concatenate(scores), pa.int64())], ["item", "doc_id", "score"])

    # documents without a term of any query are in the statistics and nowhere else
    return table.where(F.length("terms") > 0).mapInArrow(run, f"item int, doc_id {table.schema['doc_id'].dataType.simpleString()}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", query_bytes: int = QUERY_BYTES, shard_rows: int = SHARD_ROWS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the k documents with the highest scores above 0."""
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_col).alias("item_id"), F.col(query_col).alias("text")).where(F.col("text").isNotNull()).distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / query_bytes))
    out = None
    for block in range(blocks):
        queries: dict = {}
        for item, text in sorted(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect(), key=lambda r: r[1]):
            queries.setdefault(item, []).extend(t for part in words(text.encode()) for t in part)
        best = _search(docs, queries, k, id_col, text_col, shard_rows, shard_postings)
        names = spark.createDataFrame(list(enumerate(queries)), f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = best.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of all for each item of the benchmark."""
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SPLIT = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
_SQL = f"""WITH w AS (SELECT r, doc_id, {_SPLIT} AS t FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tf AS (SELECT r, doc_id, t, count(*) AS tf FROM w GROUP BY ALL),
n AS (SELECT r, sum(tf) AS n FROM tf GROUP BY r),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM n),
m AS (SELECT r, 100 - 75 + (75 * CAST(n AS BIGINT) * n_docs) // n_all AS m FROM n, s),
df AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t, n_docs),
q AS (SELECT item_id, t, count(*) AS k FROM (SELECT item_id, {_SPLIT} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
sc AS (SELECT q.item_id, tf.r, tf.doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN tf ON tf.t = q.t JOIN df ON df.t = q.t JOIN m ON m.r = tf.r GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM rk WHERE rank <= 10"""

QUERIES = {"op13_ranked_search": op13_ranked_search}
SQL: dict[str, str] = {"op13_ranked_search": _SQL}
