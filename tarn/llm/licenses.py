"""License scans (operator 11): a positional index of licence words, looked up by a file's rarest ones.

Templates are notices as words in order, with phrases that must stand in them. The index has each word's postings
(template, place). A first pass keeps, of each document, the number of its words, the licence words that it holds, and, if
it holds all words that some template demands, their places; sums over the whole table give each word's rarity. In the
second pass a file's licence words are looked up from the rarest on, RARE of them for a template. An occurrence at p of a
word with a posting at q puts the template's start at p - q; starts on which at least AGREE different words agree are
compared with the template: the share of its words' weights that stand in their place, give or take its drift, and whether
all its phrases stand in full within that stretch.

A base phrase is a template that consists of nothing else. All its words are in a file that holds it, so its rarest word is
looked up, whatever else the file has: no place is lost.

Defined results: a null text counts as empty; a file without a hit has no labels and score 0; hits are in the order of
start, then template; places may overlap, and those of a notice with drift may be off by it; repeated rows are scanned each for itself; texts are read whole, however long;
other columns are not read, so none can clash; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed, written
from .words import words

#: Rarest words of a file that are looked up for a template; different ones that have to agree on its start.
RARE, AGREE = 4, 2
#: Share of a notice's weight that has to stand in place; words by which a place may be off.
SHARE, DRIFT = 0.75, 3

#: Base phrases and their labels. Fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices: label, text, phrases that must stand in it.
NOTICES = (
    ("gpl-3.0", "GNU General Public License, version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "GNU General Public License, version 2", ("gnu general public license version 2",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("gnu general public license", "free software foundation")),
    ("lgpl", "GNU Lesser General Public License", ("gnu lesser general public license",)),
    ("agpl", "GNU Affero General Public License", ("gnu affero general public license",)),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("except in compliance with the license", "apache org licenses")),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    ("cc-by-4.0", "CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial 4 0",)),
    ("cc-by-sa-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike 4 0",)),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("bsl-1.0", "Boost Software License, Version 1.0", ("boost software license",)),
)


def plain(text: str) -> list[bytes]:
    return [w for part in words(text.encode()) for w in part]


@dataclass
class Template:
    """A notice: its words' numbers in order, its phrases, and the words that it can't do without."""

    label: str
    base: bool
    words: list[int]
    phrases: list[list[int]]
    drift: int
    share: float
    needs: frozenset[int] = field(init=False)

    def __post_init__(self) -> None:
        self.needs = frozenset(w for p in self.phrases for w in p)


class Index:
    """Templates, the numbers of their words, and the postings of each word: (template, place)."""

    def __init__(self, base: dict[str, str] = BASE, notices: tuple = NOTICES):
        self.number: dict[bytes, int] = {}
        self.templates = [self._template(label, True, phrase, (phrase,)) for phrase, label in base.items()]
        self.templates += [self._template(label, False, text, phrases) for label, text, phrases in notices]
        self.postings: list[list[tuple[int, int]]] = [[] for _ in self.number]
        for t, template in enumerate(self.templates):
            for q, word in enumerate(template.words):
                self.postings[word].append((t, q))

    def _numbers(self, text: str) -> list[int]:
        return [self.number.setdefault(w, len(self.number)) for w in plain(text)]

    def _template(self, label: str, base: bool, text: str, phrases: tuple[str, ...]) -> Template:
        whole = [self._numbers(p) for p in phrases]
        body = self._numbers(text)
        only = whole == [body]  # nothing but a phrase: it stands there or it doesn't
        return Template(label, base, body, whole, 0 if only else DRIFT, 1.0 if only else SHARE)


class File:
    """Places of licence words in one file, by word."""

    def __init__(self, ids: np.ndarray, places: np.ndarray):
        order = np.argsort(ids, kind="stable")
        present, first = np.unique(ids[order], return_index=True)
        self.places = dict(zip(present.tolist(), np.split(places[order], first[1:]), strict=True))
        self.lists = {}

    def near(self, word: int, at: int, drift: int) -> bool:
        if word not in self.lists:
            self.lists[word] = self.places[word].tolist() if word in self.places else []
        found = self.lists[word]
        k = bisect_left(found, at - drift)
        return k < len(found) and found[k] <= at + drift

    def phrase(self, phrase: list[int], begin: int, end: int) -> bool:
        """Whether the words stand one after the other from begin on and before end."""
        rarest = min(range(len(phrase)), key=lambda k: len(self.places[phrase[k]]))
        found = self.places[phrase[rarest]]
        for p in found[np.searchsorted(found, begin + rarest) : np.searchsorted(found, end - len(phrase) + rarest, "right")].tolist():
            if all(self.near(w, p - rarest + k, 0) for k, w in enumerate(phrase)):
                return True
        return False


def hits(index: Index, weights: np.ndarray, file: File) -> list[tuple[int, int, float]]:
    """(start, template, score) of all templates that stand in a file."""
    present = file.places.keys()
    wanted = {t for t, template in enumerate(index.templates) if template.needs <= present}
    starts: dict[int, list[np.ndarray]] = {t: [] for t in wanted}
    for word in sorted(present, key=lambda w: (-weights[w], w)):  # from the rarest on
        by: dict[int, list[int]] = {}
        for t, q in index.postings[word]:
            if t in wanted and len(starts[t]) < RARE:
                by.setdefault(t, []).append(q)
        for t, at in by.items():
            starts[t].append(np.unique(np.concatenate([file.places[word] - q for q in at])))
    out = []
    for t, lists in starts.items():
        template = index.templates[t]
        start, votes = np.unique(np.concatenate(lists), return_counts=True)
        total = sum(weights[w] for w in template.words)
        # all words of a phrase that is a template of its own have to agree
        enough = len(lists) if not template.drift else min(AGREE, len(lists))
        for s in start[votes >= enough].tolist():
            got = sum(weights[w] for k, w in enumerate(template.words) if file.near(w, s + k, template.drift))
            if got >= template.share * total - 1e-9 and all(file.phrase(p, s - template.drift, s + len(template.words) + template.drift) for p in template.phrases):
                out.append((s, t, min(1.0, got / total)))
    return sorted(out)


def places(df: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, held (numbers of the licence words in it, 4 bytes each), and, where all words that a template needs are held, ids and places (8 bytes each) of all licence words; written."""
    number, needs = index.number, [t.needs for t in index.templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, held, ids, at = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                n, found, where = 0, [], []
                for part in words(text):
                    for k, word in enumerate(part, n):
                        if word in number:
                            found.append(number[word])
                            where.append(k)
                    n += len(part)
                have = set(found)
                counts.append(n)
                held.append(np.array(sorted(have), "<u4").tobytes())
                some = any(need <= have for need in needs)
                ids.append(np.array(found, "<u4").tobytes() if some else None)
                at.append(np.array(where, "<i8").tobytes() if some else None)
            binary = [pa.array(column, pa.binary()) for column in (held, ids, at)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *binary], ["doc_id", "n_words", "held", "ids", "places"])

    rows = keyed(df, id_col, text_col)
    return written(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, held binary, ids binary, places binary"))


def rarity(table: DataFrame, n_words: int) -> np.ndarray:
    """The weight of each licence word, 1 + ln((1 + documents) / (1 + those that hold it)), over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(n_words, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=n_words)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(n_words)], pa.int32()), pa.array([rows, *df.tolist()], pa.int64())], ["word", "k"])

    found = dict(table.select("held").mapInArrow(run, "word int, k long").groupBy("word").agg(F.sum("k")).collect())
    return np.array([1 + math.log((1 + found.get(-1, 0)) / (1 + found.get(w, 0))) for w in range(n_words)])


def scan(df: DataFrame, base: dict[str, str] = BASE, notices: tuple = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, hits (array of label, base, start, stop in words, score)."""
    index = Index(base, notices)
    table = places(df, index, id_col, text_col)
    weights = rarity(table, len(index.number))
    hit = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, at in zip(batch.column("ids").to_pylist(), batch.column("places").to_pylist(), strict=True):
                found = hits(index, weights, File(np.frombuffer(ids, "<u4"), np.frombuffer(at, "<i8"))) if ids else []
                named = [(index.templates[t], s, score) for s, t, score in found]
                out.append([{"label": t.label, "base": t.base, "start": s, "stop": s + len(t.words), "score": score} for t, s, score in named])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(out, pa.list_(hit))], ["doc_id", "n_words", "hits"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.drop("held").mapInArrow(run, f"doc_id {kind}, n_words long, hits array<struct<label:string,base:boolean,start:long,stop:long,score:double>>")


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    """Base phrases and notices in every document."""
    found = scan(documents(spark, sf_dir))
    base = F.filter("hits", lambda h: h["base"])
    named = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    start, score = F.transform(base, lambda h: h["start"]), F.transform("hits", lambda h: h["score"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        named(base).alias("base_labels"), named(F.col("hits")).alias("labels"), F.coalesce(F.array_max(score), F.lit(0.0)).alias("score"),
    )


QUERIES = {"op11_license_scan": op11_license_scan}
SQL: dict[str, str] = {}
