"""Language identification by compression (operator 8).

For each language a bounded sample of distinct labelled texts becomes a raw-content dictionary of zstandard, however small
other languages' are. A text is compressed with each of them, in blocks, and the language whose dictionary gives the
fewest bytes is the answer. Larger dictionaries also shorten texts of other languages, so bytes are divided by the share
that the dictionary leaves of such texts, at the text's length, unless all dictionaries have one size; the score is the
share by which it beats the next one, the gain that by which it beats no dictionary. A text is rejected if it has no
letter, or if its score or its gain is below a bound that depends on its length. The bounds come from labelled texts that
are in no dictionary, cut to each length; below the least of these lengths texts can't be told apart and are kept. Where
too few labelled texts are left for that, only long texts with a narrow margin are rejected.

Defined results: null text, or text without letters, is `und` with score 0 and rejected; ties go to the language with
more labelled texts, then to the smaller name; with one learned language the score is 1, with none every text is `und`;
repeated rows each get their answer; columns other than those named are never read, so none can clash; labels that are
null are no labels; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import median

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents

#: Bounds of the sample: texts of a language, bytes taken from each text, bytes of a dictionary. Beyond so many languages all three of them share what that many have.
TEXTS, TEXT_BYTES, DICTIONARY = 400, 1500, 65536
LANGUAGES = 64
LEVEL, BLOCK = 6, 4096
#: Without bounds: texts of so many bytes whose best two languages differ by a smaller share are rejected.
NARROW, LONG = 0.001, 200
#: Lengths with a bound; of every so many texts one is kept from the dictionaries; texts used for bounds, at most in all and at least for a length.
LENGTHS, EVERY, BOUND_TEXTS, LEAST = (32, 64, 128, 256, 512, 1024), 5, 1000, 15
#: The bound is this share of this low quantile of the smaller one of score and gain.
SHARE, QUANTILE = 0.5, 0.02

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def normal(text: str) -> bytes:
    """Lower-case letters, and one space for whatever stands between them."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


class Profiles(list):
    """(language, dictionary) or (language, compressor) pairs; (length, bound) and (length, what each dictionary leaves of other languages' texts) in order of length."""

    bounds: tuple[tuple[int, float], ...] = ()
    left: tuple[tuple[int, tuple[float, ...]], ...] = ()


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """(language, dictionary), the language with most rows first. Reads all labelled rows, and of each language keeps the TEXTS texts of smallest hash and a few for the bounds, a bounded sample that doesn't depend on the order of rows."""
    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    rows = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    counts = rows.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("texts")).orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return Profiles()
    part = min(1.0, LANGUAGES / len(counts))
    texts, size = max(EVERY, int(TEXTS * part)), max(1024, int(DICTIONARY * part))
    # hashes are even, so this threshold leaves about four times as many distinct texts of each language before any row is moved
    most = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, 4 * texts / r["texts"]))))])
    few = rows.where(F.col("h") <= most[F.col("lang")]).select("lang", "h", F.substring("text", 1, TEXT_BYTES).alias("text"))
    few = few.groupBy("lang", "h").agg(F.min("text").alias("text"))  # copies are one text
    first = F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))
    sample: dict[str, list[bytes]] = {r["lang"]: [] for r in counts}
    apart: dict[str, list[bytes]] = {r["lang"]: [] for r in counts}
    for r in few.withColumn("k", first).where(F.col("k") <= texts * EVERY // (EVERY - 1)).orderBy("lang", "k").collect():
        (sample if r["k"] % EVERY else apart)[r["lang"]].append(normal(r["text"])[:TEXT_BYTES])
    joined = {lang: b"\n".join(texts) for lang, texts in sample.items()}
    out = Profiles((lang, raw[:size]) for lang, raw in joined.items() if raw)
    out.left = left(out, sample)
    known = {raw for texts in sample.values() for raw in texts}
    out.bounds = bounds(out, [raw for texts in apart.values() for raw in texts[: max(LEAST, BOUND_TEXTS // len(apart))] if raw not in known])
    return out


def left(profiles: list[tuple[str, bytes]], sample: dict[str, list[bytes]]) -> tuple[tuple[int, tuple[float, ...]], ...]:
    """(length, shares): what each dictionary leaves, in the median, of the bytes of other languages' texts; nothing if no dictionary is larger than another."""
    if len({len(raw) for _, raw in profiles}) < 2:
        return ()
    by, out = compressors(profiles), []
    (_, plain), each = by[-1], max(3, BOUND_TEXTS // len(profiles))
    for length in LENGTHS:
        shares: dict[str, list[float]] = {lang: [] for lang, _ in profiles}
        for own, texts in sample.items():
            for raw in [raw[:length] for raw in texts if len(raw) >= length][:each]:
                whole = len(plain.compress(raw))
                for lang, c in by[:-1]:
                    if lang != own:
                        shares[lang].append(len(c.compress(raw)) / whole)
        out.append((length, tuple(median(x) if x else 1.0 for x in shares.values())))
    return tuple(out)


def at_length(table: tuple, n: int):
    """What a table by length has for n bytes: the entry of the greatest length up to n, or None."""
    return next((x for length, x in reversed(table) if length <= n), None)


def bounds(profiles: list[tuple[str, bytes]], texts: list[bytes]) -> tuple[tuple[int, float], ...]:
    """(length, bound) from labelled texts, as normal() gives them, that are in no dictionary."""
    by, out = compressors(profiles), []
    for length in LENGTHS:
        low = sorted(min(measured(raw[:length], by)[1:]) for raw in texts if len(raw) >= length)
        if len(low) >= LEAST:
            out.append((length, SHARE * low[int(QUANTILE * len(low))]))
    return tuple(out)


def compressors(profiles: list[tuple[str, bytes]]) -> Profiles:
    """(language, compressor) of each dictionary, the last one without any, for None."""
    out = Profiles()
    out.bounds, out.left = getattr(profiles, "bounds", ()), getattr(profiles, "left", ())
    for lang, raw in profiles:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=len(raw), write_content_size=False, write_checksum=False, write_dict_id=False)
        kept = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(compression_params=params)
        out.append((lang, zstandard.ZstdCompressor(dict_data=kept, compression_params=params)))
    plain = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, write_content_size=False, write_checksum=False, write_dict_id=False)
    out.append((None, zstandard.ZstdCompressor(compression_params=plain)))
    return out


def measured(raw: bytes, by: Profiles) -> tuple[int, float, float]:
    """(place of the language in by, score, gain) of a text as normal() gives it."""
    *sizes, plain = [sum(len(c.compress(raw[k : k + BLOCK])) for k in range(0, len(raw), BLOCK)) for _, c in by]
    if (shares := at_length(by.left, len(raw))) is not None:
        sizes = [s / x for s, x in zip(sizes, shares, strict=True)]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = [s for k, s in enumerate(sizes) if k != best]
    return best, 1 - sizes[best] / min(rest) if rest else 1.0, 1 - sizes[best] / plain


def answer(text: str | None, by: Profiles) -> tuple[str, float, bool]:
    """(language, score, rejected) of a whole text."""
    if not text or len(by) < 2 or not _LETTER.search(text):
        return "und", 0.0, True
    raw = normal(text)
    best, score, gain = measured(raw, by)
    if by.bounds:
        bound = at_length(by.bounds, len(raw))
        return by[best][0], score, bound is not None and min(score, gain) < bound
    return by[best][0], score, len(raw) >= LONG and score < NARROW



def classify(df: DataFrame, profiles: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressors(profiles)
        for batch in batches:
            lang, score, rejected = zip(*(answer(t.as_py(), by) for t in batch.column(1)), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def accepted(df: DataFrame, profiles: list[tuple[str, bytes]], text_col: str = "text") -> DataFrame:
    """The rows of df, with all their columns, whose text is not rejected."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressors(profiles)
        for batch in batches:
            yield batch.filter(pa.array([not answer(t.as_py(), by)[2] for t in batch.column(at)], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def held_out(doc_id) -> F.Column:
    """Every fifth row by checksum of its id is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def op8_compression_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir)
    profiles = fit(docs.where(~held_out("doc_id")))
    return classify(docs, profiles).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op8_compression_language": op8_compression_language}
SQL: dict[str, str] = {}
