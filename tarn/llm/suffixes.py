"""Suffix-array dedup (operator 9): every byte that lies in a 100-byte string which also starts earlier.

The suffixes of all documents are compared to a depth of 100 bytes by a difference cover. Nine of 64 positions, counted
from a text's start, are sampled such that every two positions have a distance below 64 at which both are sampled. So two
equal strings have sampled suffixes at equal distance from their starts, which share the 37 bytes that are left at least.

1. Sampled suffixes are triples of the name of their first 37 bytes, their document and their place. They are sorted, and
   those whose name occurs once are done, as no string of theirs repeats.
2. Recursion on names: the others are named again, by the first name and by all that the 64 starts before them can see, and
   sorted. Of those that agree, all starts of all but the first repeat at once. Those that came first are named by the
   first name and the 32 bytes before it, and behind it: every string that sees the suffix sees one of these, so where no
   other has that name, too, its starts are done.
3. Merge of the remaining suffixes: the starts that are left are named by their 100 bytes and sorted; all but the first of
   adjacent equal ones repeat. Names are as long as the depth now, so no further recursion can tell them apart.

Triples are dealt out by name in packed blocks, sorted in numpy: names that one task meets more than twice are thinned
out before they are sent, so a string that a third of all rows hold costs a block two entries a task. The first names,
of 40 bits beside the block's number, only choose candidates; the later ones are of 48 bits and more beside the block's
number, and of a hash modulo a prime.
Places go back to the texts by document, whose texts stream past them.

Defined results: a null text counts as empty; texts of less than 100 bytes keep all; rows with a null id are compared
with nothing and keep all; rows that repeat an id and its text are one document, each returned; of rows with one id and
several texts each text is a document, in the order of a hash; columns other than the id and the text are left out;
earlier means a smaller id, or an earlier start in the same document, so ties don't occur; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, dropped, keyed, whole_ids, written
from .rolling import Exact, Prefixes, mixed

#: Bytes of a string; the cover's period, and the positions in it, whose differences are all numbers below the period. Fixed values.
DEPTH, PERIOD = 100, 64
COVER = (1, 2, 3, 6, 15, 17, 35, 43, 60)
#: What is left of a string behind the last position at which its sampled suffix can start.
WINDOW = DEPTH - PERIOD + 1
#: Entries of a block that is sorted in one task; entries of a task that are dealt out at once; bytes of the texts whose places are kept together.
BLOCK, SEND, SHARD = 1 << 20, 1 << 21, 1 << 23

_PACKET = ["to", "kind", "ids", "keys", "numbers", "fields"]
_SCHEMA = "to long, kind int, ids binary, keys binary, numbers binary, fields binary"


def sampled(size: int) -> np.ndarray:
    """Positions of the sampled suffixes that strings of a text of so many bytes can see."""
    if size < DEPTH:
        return np.empty(0, np.int64)
    at = (np.arange(0, size, PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at <= size - WINDOW]


def _starts(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last start that sees the sampled suffix at each position."""
    return np.maximum(at - PERIOD + 1, 0), np.minimum(at, size - DEPTH)


def _marked(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which starts lie in one of the ranges, ends included; ranges may be empty."""
    some = begin <= end
    begin, end = begin[some], end[some]
    edge = np.bincount(begin, minlength=size + 1) - np.bincount(end + 1, minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


class Entries:
    """Entries (document, fields) of a task that are dealt out together. fields: a structured array."""

    def __init__(self):
        self.ids, self.keys, self.fields, self.held = [], [], [], 0

    def add(self, doc: tuple[int, int], fields: np.ndarray) -> None:
        if len(fields):
            self.ids.append(doc[0])
            self.keys.append(doc[1])
            self.fields.append(fields)
            self.held += len(fields)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids and keys of the documents; of each entry the document's number and its fields."""
        of = np.repeat(np.arange(len(self.ids), dtype=np.uint32), list(map(len, self.fields)))
        return np.array(self.ids, np.int64), np.array(self.keys, np.int64), of, np.concatenate(self.fields)


def dealt(to: np.ndarray, kind: int, ids: np.ndarray, keys: np.ndarray, of: np.ndarray, fields: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packet for each value of `to`; entries are in the order of documents."""
    if not len(to):
        return
    order = np.argsort(to.astype(np.uint16) if to.max() < 1 << 16 else to, kind="stable")
    to, of, fields = to[order], of[order], fields[order]
    edge = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
    out = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        own = of[a:b]
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        out.append((int(to[a]), kind, ids[own[at]].tobytes(), keys[own[at]].tobytes(), np.diff(np.append(at, b - a)).astype(np.uint32).tobytes(), fields[a:b].tobytes()))
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
    for k in range(0, len(out), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 1000], strict=True), kinds, strict=True)], _PACKET)


def opened(part: pa.Table | pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What `joined` gives, of all these packets; documents are in order of id and key."""
    flat = lambda name, t: np.frombuffer(b"".join(part.column(name).to_pylist()), t)
    ids, keys = flat("ids", np.int64), flat("keys", np.int64)
    order = np.lexsort((keys, ids))
    new = _new(ids[order], keys[order])
    name = np.empty(len(ids), np.uint32)
    name[order] = np.cumsum(new) - 1
    return ids[order][new], keys[order][new], np.repeat(name, flat("numbers", np.uint32)), flat("fields", kind)


def _shard(ids: np.ndarray, keys: np.ndarray, shards: int) -> np.ndarray:
    return (ids ^ keys) % shards


def _place(of: np.ndarray, at: np.ndarray) -> np.ndarray:
    return of.astype(np.uint64) << np.uint64(32) | at.astype(np.uint64)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before."""
    out = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        out |= c[1:] != c[:-1]
    return np.append(True, out)


def _text(raw) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), np.uint8) if raw.is_valid else np.empty(0, np.uint8)


FIRST = np.dtype([("name", np.uint8, 5), ("at", "<u4")])
SECOND = np.dtype([("name", np.uint8, 5), ("seen", "<u8"), ("more", "<u4"), ("left", np.uint8, 3), ("right", np.uint8, 3), ("at", "<u4")])
THIRD = np.dtype([("name", np.uint8, 6), ("more", "<u4"), ("at", "<u4")])
AT = np.dtype([("at", "<u4")])
#: Kinds of packets: what is still to be compared; what is known to go on or to repeat; suffixes of which only the starts far before them, or near, are open.
OPEN, KNOWN, FAR, NEAR = 0, 1, 2, 3
#: Starts at least so far before a sampled suffix see as many bytes before it, the others as many behind its first name.
HALF = PERIOD // 2


def _low(x: np.ndarray, size: int) -> np.ndarray:
    """The lower bytes of numbers."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]


def _number(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, : x.shape[1]] = x
    return out.view("<u8").ravel()


def _only(at: np.ndarray) -> np.ndarray:
    out = np.empty(len(at), AT)
    out["at"] = at
    return out


def triples(rows: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Packets of the sampled suffixes of rows (doc_id, key, text) by the name of their first bytes; with KNOWN those, by shard, of names that a task has met more than twice."""

    def deal(held: Entries) -> Iterator[pa.RecordBatch]:
        ids, keys, of, (name, at) = *held.joined()[:3], zip(*[(f["name"], f["at"]) for f in held.fields], strict=True)
        name, at = np.concatenate(name), np.concatenate(at)
        order = np.argsort(name, kind="stable")
        new = _new(name[order])
        third = np.zeros(len(name), bool)
        third[order[2:]] = ~new[2:] & ~new[1:-1]
        yield from dealt(_shard(ids, keys, shards)[of[third]], KNOWN, ids, keys, of[third], _only(at[third]))
        name, at, of = name[~third], at[~third], of[~third]
        out = np.empty(len(name), FIRST)
        out["name"] = _low(name // np.uint64(blocks), 5)
        out["at"] = at
        yield from dealt(name % np.uint64(blocks), OPEN, ids, keys, of, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met = Entries(), set()
        for batch in batches:
            for doc, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), batch.column(2), strict=True):
                raw = _text(text)
                at = sampled(len(raw))
                if not len(at) or doc in met:
                    continue
                met.add(doc)
                entry = np.empty(len(at), [("name", "<u8"), ("at", "<u4")])
                entry["name"], entry["at"] = Prefixes(raw).of(at, at + WINDOW), at
                held.add(doc, entry)
                if held.held >= SEND:
                    yield from deal(held)
                    held, met = Entries(), set()
        if held.held:
            yield from deal(held)

    return rows.select("doc_id", "key", "text").mapInArrow(run, _SCHEMA)


def _sorted(packets: DataFrame, solve: Callable) -> DataFrame:
    """What solve makes of each block's entries, as packets by shard; KNOWN ones pass as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None
        for batch in batches:
            yield batch.filter(pa.array(batch.column("kind").to_numpy() == KNOWN))
            batch = batch.filter(pa.array(batch.column("kind").to_numpy() == OPEN))
            if not batch.num_rows:
                continue
            to = batch.column("to").to_numpy()
            edge = np.append(np.flatnonzero(_new(to)), len(to))
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if held and to[a] != block:
                    yield from solve(pa.Table.from_batches(held))
                    held = []
                block = to[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from solve(pa.Table.from_batches(held))

    return packets.repartition("to").sortWithinPartitions("to").mapInArrow(run, _SCHEMA)


def again(packets: DataFrame, shards: int) -> DataFrame:
    """Packets, by shard, of the sampled suffixes whose first name occurs more than once."""

    def solve(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, keys, of, fields = opened(part, FIRST)
        name, place = _number(fields["name"]), _place(of, fields["at"])
        order = np.lexsort((place, name))
        name, place = name[order], place[order]
        once = _new(name, place)  # one document from several tasks
        name, place = name[once], place[once]
        new = _new(name)
        several = ~(new & np.append(new[1:], True))
        place = np.sort(place[several])
        of = (place >> np.uint64(32)).astype(np.int64)
        yield from dealt(_shard(ids, keys, shards)[of], KNOWN, ids, keys, of, _only(place & np.uint64(2**32 - 1)))

    return _sorted(packets, solve)


def beside(rows: DataFrame, packets: list[DataFrame], use: Callable, schema, shards: int) -> DataFrame:
    """use(stream) of each task, where stream has (batch, documents, places) of texts of one shard, and places(document) is a list: for each of the packets the document's sorted places, or None."""
    last = len(packets)
    shard = F.pmod(F.coalesce(F.col("doc_id").bitwiseXOR(F.col("key")), F.col("key")), F.lit(shards))
    own, sent = ["doc_id", "key", "text", "rest"], ["ids", "keys", "numbers", "fields"]
    both = rows.select(shard.alias("to"), F.lit(last).alias("turn"), *own, *[F.lit(None).cast("binary").alias(c) for c in sent])
    for k, p in enumerate(packets):
        both = both.unionByName(p.select("to", F.lit(k).alias("turn"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in own], *sent))

    def tables(held: list[list]) -> list[dict]:
        out = []
        for rows in held:
            places = {}
            if rows:
                ids, keys, of, fields = opened(pa.Table.from_batches(rows), AT)
                order = np.lexsort((fields["at"], of))
                of, at = of[order], fields["at"][order].astype(np.int64)
                begin = np.searchsorted(of, np.arange(len(ids) + 1))
                places = {(i, j): at[begin[k] : begin[k + 1]] for k, (i, j) in enumerate(zip(ids.tolist(), keys.tolist(), strict=True))}
            out.append(places)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            shard, held, places = None, [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                to, turn = (batch.column(c).to_numpy() for c in ("to", "turn"))
                edge = np.append(np.flatnonzero(_new(to, turn)), len(to))
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    if to[a] != shard:
                        shard, held, places = to[a], [[] for _ in range(last)], None
                    part = batch.slice(a, b - a)
                    if turn[a] < last:
                        held[turn[a]].append(part)
                        continue
                    if places is None:
                        places, held = tables(held), None
                    docs = list(zip(part.column("doc_id").to_pylist(), part.column("key").to_pylist(), strict=True))
                    yield part, docs, lambda doc, places=places: [p.get(doc) for p in places]

        yield from use(stream())

    return both.repartition("to").sortWithinPartitions("to", "turn", "doc_id", "key").mapInArrow(run, schema)


def _once(stream: Iterator) -> Iterator:
    """(document, text, places) of each document once; its rows stand together."""
    last = None
    for part, docs, places in stream:
        for doc, text in zip(docs, part.column("text"), strict=True):
            if doc != last:
                last = doc
                yield doc, text, places(doc)


def _dealt_once(held: Entries, blocks: int, shards: int, *by: str) -> Iterator[pa.RecordBatch]:
    """The entries (to, fields) whose fields `by` come first in the task, by `to`; the others with KNOWN, by shard."""
    ids, keys, of, entry = held.joined()
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((keys, ids))] = np.arange(len(ids))
    f = entry["fields"]
    of_name = [entry["name"], *[f[c] for c in by]]
    order = np.lexsort((_place(rank[of], f["at"]), *reversed(of_name)))
    later = np.zeros(len(f), bool)
    later[order] = ~_new(*[c[order] for c in of_name])
    yield from dealt(_shard(ids, keys, shards)[of[later]], KNOWN, ids, keys, of[later], _only(f["at"][later]))
    yield from dealt(entry["name"][~later] % np.uint64(blocks), OPEN, ids, keys, of[~later], f[~later])


def named_again(rows: DataFrame, marks: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Packets of marked sampled suffixes by their first name, with the name of all that their starts see, and of half of it before and behind; with KNOWN those, by shard, whose names the same task has met before."""
    kind = np.dtype([("name", "<u8"), ("fields", SECOND)])

    def use(stream: Iterator) -> Iterator[pa.RecordBatch]:
        held = Entries()
        for doc, text, (at,) in _once(stream):
            if at is None:
                continue
            raw = _text(text)
            at = at[np.append(True, at[1:] != at[:-1])]
            hashes = Exact(raw)
            begin, end = _starts(at, len(raw))
            entry = np.empty(len(at), kind)
            entry["name"] = hashes.of(at, at + WINDOW)
            f = entry["fields"]
            seen, f["more"] = hashes.both(begin, end + DEPTH)
            f["seen"] = mixed(seen + (at - begin).astype(np.uint64) * np.uint64(DEPTH) + (end - begin).astype(np.uint64))
            f["name"] = _low(entry["name"] // np.uint64(blocks), 5)
            f["left"] = _low(hashes.of(np.maximum(at - HALF, 0), at + WINDOW), 3)
            f["right"] = _low(hashes.of(at, np.minimum(at + WINDOW + HALF, len(raw))), 3)
            f["at"] = at
            held.add(doc, entry)
            if held.held >= SEND:
                yield from _dealt_once(held, blocks, shards, "seen", "more")
                held = Entries()
        if held.held:
            yield from _dealt_once(held, blocks, shards, "seen", "more")

    return beside(rows, [marks], use, _SCHEMA, shards)


def _shared(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which rows have a value that another row of their group has, too."""
    order = np.lexsort((value, group))
    new = _new(group[order], value[order])
    out = np.empty(len(group), bool)
    out[order] = ~(new & np.append(new[1:], True))
    return out


def compared(packets: DataFrame, shards: int) -> DataFrame:
    """Packets by shard: KNOWN suffixes whose starts all repeat; of those that came first in their second name, the ones whose half before it (FAR), behind it (NEAR) or both (OPEN) another text of the first name has, too."""

    def solve(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, keys, of, f = opened(part, SECOND)
        place, name = _place(of, f["at"]), _number(f["name"])
        order = np.lexsort((place, f["more"], f["seen"], name))
        f, place, name = f[order], place[order], name[order]
        first = _new(name, f["seen"], f["more"])
        far, near = np.zeros(len(f), bool), np.zeros(len(f), bool)
        far[first] = _shared(name[first], _number(f["left"][first]))
        near[first] = _shared(name[first], _number(f["right"][first]))
        for kind, on in ((KNOWN, ~first), (OPEN, far & near), (FAR, far & ~near), (NEAR, near & ~far)):
            some = np.sort(place[on])
            who = (some >> np.uint64(32)).astype(np.int64)
            yield from dealt(_shard(ids, keys, shards)[who], kind, ids, keys, who, _only(some & np.uint64(2**32 - 1)))

    return _sorted(packets, solve)


def merged(rows: DataFrame, sorted_: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Packets of the remaining suffixes by the name of their 100 bytes; with KNOWN the starts, by shard, that the same task has met before."""
    kind = np.dtype([("name", "<u8"), ("fields", THIRD)])

    def use(stream: Iterator) -> Iterator[pa.RecordBatch]:
        held = Entries()
        for doc, text, (both, far, near, done) in _once(stream):
            size = len(raw := _text(text))
            on = np.zeros(size, bool)
            for at, least, most in ((both, 0, PERIOD - 1), (far, HALF, PERIOD - 1), (near, 0, HALF - 1)):
                if at is not None:
                    on |= _marked(np.maximum(at - most, 0), np.minimum(at - least, size - DEPTH), size)
            if not on.any():
                continue
            if done is not None:
                on &= ~_marked(*_starts(done, size), size)
            start = np.flatnonzero(on)
            hashes = Exact(raw)
            for k in range(0, len(start), SEND):
                some = start[k : k + SEND]
                entry = np.empty(len(some), kind)
                entry["name"], entry["fields"]["more"] = hashes.both(some, some + DEPTH)
                entry["fields"]["name"], entry["fields"]["at"] = _low(entry["name"] // np.uint64(blocks), 6), some
                held.add(doc, entry)
                if held.held >= SEND:
                    yield from _dealt_once(held, blocks, shards, "more")
                    held = Entries()
        if held.held:
            yield from _dealt_once(held, blocks, shards, "more")

    return beside(rows, [sorted_.where(F.col("kind") == k) for k in (OPEN, FAR, NEAR, KNOWN)], use, _SCHEMA, shards)


def repeated(packets: DataFrame, shards: int) -> DataFrame:
    """Packets, by shard, of the starts whose 100 bytes an earlier one has."""

    def solve(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, keys, of, f = opened(part, THIRD)
        place = _place(of, f["at"])
        name = _number(f["name"])
        order = np.lexsort((place, f["more"], name))
        name, more, place = name[order], f["more"][order], place[order]
        place = np.sort(place[~_new(name, more)])
        of = (place >> np.uint64(32)).astype(np.int64)
        yield from dealt(_shard(ids, keys, shards)[of], KNOWN, ids, keys, of, _only(place & np.uint64(2**32 - 1)))

    return _sorted(packets, solve)


def runs(places: list[int] | None, size: int) -> list[tuple[int, int]]:
    """Maximal runs [start, stop) of bytes that strings cover, in a text of so many bytes. A place is 64 times a start, plus the number of starts from there on, less 1."""
    place = np.unique(np.array(places if places is not None else [], np.int64))
    start, stop = place // PERIOD, np.minimum(place // PERIOD + place % PERIOD + DEPTH, size)
    if not len(start):
        return []
    reach = np.maximum.accumulate(stop)
    new = np.append(True, start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return list(zip(start[new].tolist(), reach[last].tolist(), strict=True))


def spans(done: np.ndarray | None, single: np.ndarray | None, size: int) -> list[tuple[int, int]]:
    """Runs of bytes to remove: done are sampled suffixes whose starts all repeat, single are starts."""
    places = [single * PERIOD] if single is not None else []
    if done is not None:
        begin, end = _starts(done, size)
        places.append(begin * PERIOD + end - begin)
    return runs(np.concatenate(places), size) if places else []


def searched(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(sampled suffixes whose starts all repeat, starts that repeat, number of shards) as packets, of rows doc_id, key, text."""
    some = rows.where("doc_id is not null")
    size, sizes = some.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.sum(F.greatest(F.octet_length("text") - DEPTH, F.lit(0))), F.lit(0))).first()
    shards, blocks = max(1, math.ceil(size / SHARD)), max(1, math.ceil(sizes * len(COVER) / PERIOD / BLOCK))
    first = written(again(triples(some, blocks, shards), shards))
    second = written(compared(named_again(some, first, blocks, shards), shards))
    dropped(first)
    third = written(repeated(merged(some, second, blocks, shards), shards))
    return second.where(F.col("kind") == KNOWN), third, shards


def with_spans(rows: DataFrame, make: Callable, schema) -> DataFrame:
    """make(batch, spans) of rows (doc_id, key, text, rest), spans of each row's text to remove; rows with a null id have none."""
    done, single, shards = searched(rows)

    def use(stream: Iterator) -> Iterator[pa.RecordBatch]:
        for part, docs, places in stream:
            found = [spans(*places(doc), len(_text(text))) if doc[0] is not None else [] for doc, text in zip(docs, part.column("text"), strict=True)]
            yield make(part, found)

    return beside(rows, [done, single], use, schema, shards)


def _keyed(df: DataFrame, id_col: str, text_col: str, *rest: str) -> DataFrame:
    """doc_id (a whole number; others are refused), key, text, rest: key tells texts of one id apart; rest is a struct of these columns."""
    df = whole_ids(df, id_col)
    of = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None).cast("boolean")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(text_col).alias("text"), of.alias("rest"))


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, spans (array of struct<start, stop>, bytes) for every row."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def make(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array([[{"start": a, "stop": b} for a, b in f] for f in found], kind)], ["doc_id", "text", "spans"])

    rows = _keyed(keyed(df, id_col, text_col), "doc_id", "text")
    return with_spans(rows, make, "doc_id long, text string, spans array<struct<start:long,stop:long>>")


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of the bytes."""
    out, at = [], 0
    for start, stop in spans:
        out.append(raw[at:start])
        at = stop
    return b"".join([*out, raw[at:]])


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, less the characters that they hold only in part."""
    out = []
    for start, stop in spans:
        while start < stop and raw[start] & 0xC0 == 0x80:
            start += 1
        while start < stop < len(raw) and raw[stop] & 0xC0 == 0x80:
            stop -= 1
        out.append((start, stop))
    return out


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with repeated passages taken out of its text, by whole characters. Each row loses what repeats in its own text; null texts and rows with a null id stay as they are."""
    names = df.columns
    rest = [c for c in names if c != text_col]

    def make(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        texts = []
        for text, of in zip(part.column("text"), found, strict=True):
            if of:
                raw = text.as_py().encode()
                texts.append(without(raw, whole_characters(raw, of)).decode())
            else:
                texts.append(text.as_py())
        of = dict(zip(rest, part.column("rest").flatten(), strict=True)) | {text_col: pa.array(texts, pa.string())}
        return pa.RecordBatch.from_arrays([of[c] for c in names], names)

    return with_spans(_keyed(df, id_col, text_col, *rest), make, df.schema)


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What each document loses as repeated 100-byte strings, and a digest of what it keeps."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def make(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        raws = [_text(t).tobytes() for t in part.column("text")]
        columns = [[len(raw) for raw in raws], [sum(b - a for a, b in of) for of in found], [len(of) for of in found], [hashlib.sha256(without(raw, of)).hexdigest() for raw, of in zip(raws, found, strict=True)]]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)]], names)

    return with_spans(_keyed(keyed(documents(spark, sf_dir), "doc_id", "text"), "doc_id", "text"), make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
SQL: dict[str, str] = {}
