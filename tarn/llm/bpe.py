"""Byte-level BPE encoding and decoding (operator 2), and the encoder that operators 5 and 6 share.

Spark partitions the rows and streams them to the libraries as Arrow batches. For rank files `tiktoken` merges, and keeps
no table; only parts with very long runs of white space, which its pattern can't take, go to `tokenizers`, with the same
ids. For .json files `tokenizers` merges: a word's ids depend on nothing but the word, so each Python worker keeps a
bounded table of words it has met and hands only new ones to the library's model. Texts with letters outside Latin, or
with rare separators, go to the library whole.

Defined results: null text counts as empty and has no ids; decoding null gives no bytes; repeated rows are encoded
alike, each for itself; columns other than the id and the text are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed

#: Words that a worker's table holds, about, before it starts anew; what it held is kept once more for words that come again.
MEMO = 250_000
#: Characters of texts whose new words go to the library at once.
SLICE = 1 << 22
#: Longer texts are encoded in parts of about so many characters, cut where a word surely starts.
PART = 400_000
#: Bytes of ids after which a batch of results is sent on.
SEND = 8 << 20

_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Only these characters: Latin letters, and marks that are neither letters, numbers nor white space of doubtful kind.
_PLAIN = re.compile(rf"[\x00-\x1b\x21-\x7e \x7f{_LETTER}¡-©«¬®-±¶-¸»¿×÷–—‘-„•…€]*")
#: The vocabularies' own split pattern, for those characters.
_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
#: Runs of white space in which the pattern steps back too far for `tiktoken`; it takes ten times as many.
_RUN = re.compile(r"\s{20000}")
_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks of a file with lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def from_ranks(path: str):
    """A `tokenizers` tokenizer that encodes as the rank file says: of all neighbours whose union is a token, the lowest rank joins first."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_chars()
    shown = {token: "".join(map(chars.__getitem__, token)) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                merges.append((rank, ranks[left], ranks[right], shown[left], shown[right]))
    merges.sort()
    model = models.BPE({shown[t]: r for t, r in ranks.items()}, [m[3:] for m in merges], ignore_merges=True)
    tokenizer = Tokenizer(model)
    split = pre_tokenizers.Split(Regex(_pattern()), "isolated")
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Encoder:
    """Texts to ids, as little-endian 4-byte numbers, by the `tokenizers` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
        else:
            self.tokenizer = from_ranks(path)
        #: How the model's vocabulary writes each byte, and each id's 4 bytes.
        self.shown = {chr(b): c for b, c in byte_chars().items() if chr(b) != c}
        self.four = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        #: Added tokens of the vocabulary, which the library finds in texts wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def model(self, words: list[str]) -> list[bytes]:
        """The same for words as the pattern splits them, without splitting again: no added token stands in them."""
        if not words:
            return []
        # no text has the byte FF, so it parts the words while all are written anew at once
        raw = b"\xff".join(map(str.encode, words)).decode("latin-1")
        for b in set(raw).intersection(self.shown):
            raw = raw.replace(b, self.shown[b])
        tokens, four = self.tokenizer.model.tokenize, self.four
        return [b"".join([four[t.id] for t in tokens(word)]) for word in raw.split("\xff")]

    def _learn(self, words: set[str]) -> None:
        """Has all these words in the table: from what it held before, else by the library's model."""
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        new = words.difference(self.memo)
        for word in new.intersection(self.older):
            self.memo[word] = self.older[word]
        rest = list(new.difference(self.memo))
        self.memo.update(zip(rest, self.model(rest), strict=True))

    def _split(self, text: str) -> list[list[str] | str]:
        """Each part's words, or the part itself where only the library knows them."""
        return [_WORDS.findall(p) if _PLAIN.fullmatch(p) and not any(t in p for t in self.added) else p for p in parts(text)]

    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text; new words of about SLICE characters of texts go to the library at once."""
        held: list[list[list[str] | str]] = []
        size = 0
        for text in texts:
            held.append(self._split(text))
            size += len(text)
            if size >= SLICE:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, texts: list[list[list[str] | str]]) -> Iterator[bytes]:
        self._learn(set().union(*(part for text in texts for part in text if not isinstance(part, str))))
        for text in texts:
            yield b"".join(self.library([part])[0] if isinstance(part, str) else b"".join(map(self.memo.__getitem__, part)) for part in text)

    def __call__(self, text: str) -> bytes:
        return next(self.many([text]))

    def forget(self) -> None:
        """Empties the table, so that a worker that goes on with other tasks holds none."""
        self.memo, self.older = {}, {}


class RankEncoder:
    """The same for a rank file by the `tiktoken` library, which is quicker on words that it never met."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        self.encoding = tiktoken.Encoding("ranked", pat_str=_pattern(), mergeable_ranks=read_ranks(path), special_tokens={})

    def __call__(self, text: str) -> bytes:
        return b"".join(encoder(self.path).library([part])[0] if _RUN.search(part) else array("I", self.encoding.encode_ordinary(part)).tobytes() for part in parts(text))

    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        return map(self, texts)

    def forget(self) -> None:
        """It keeps no table."""


def parts(text: str) -> list[str]:
    """A text, cut if long, where a word surely starts: at a space between letters, whatever stands around them."""
    out, start = [], 0
    while start < len(text):
        cut = _CUT.search(text, start + PART)
        end = cut.start() if cut else len(text)
        out.append(text[start:end])
        start = end
    return out


@functools.cache
def rank_encoder(path: str) -> RankEncoder:
    return RankEncoder(path)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a worker and vocabulary."""
    return Encoder(path)


def of_file(path: str) -> Encoder | RankEncoder:
    """The encoder of a vocabulary file; a rank file has no added tokens, so only a .json needs its own library."""
    return encoder(path) if path.endswith(".json") else rank_encoder(path)


@functools.cache
def token_bytes(path: str) -> list[bytes]:
    """Each id's bytes; ids that the vocabulary lacks have none."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        back = {c: b for b, c in byte_chars().items()}
        found = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in Tokenizer.from_file(path).get_vocab().items()}
    else:
        found = {r: t for t, r in read_ranks(path).items()}
    return [found.get(i, b"") for i in range(max(found, default=-1) + 1)]


@functools.cache
def _lengths(path: str) -> np.ndarray:
    return np.fromiter(map(len, token_bytes(path)), np.int64)


def token_starts(ids: np.ndarray, raw: bytes, path: str) -> np.ndarray:
    """The character in which each id's first byte lies. A character that ids share is the start of each of them."""
    begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    at = np.cumsum(_lengths(path)[ids]) - _lengths(path)[ids]
    return (np.cumsum(begins)[at] - 1).astype("<u4")


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary), starts (binary): each text's ids, and the character each id starts in; little-endian 4-byte numbers.

    path: a vocabulary file that each executor has, .json of `tokenizers` or a rank file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = of_file(path)
        for batch in batches:
            keep, ids, starts, held = 0, [], [], 0
            keys = batch.column(0)
            texts = batch.column(1).to_pylist()
            for k, (text, made) in enumerate(zip(texts, encode.many(texts), strict=True)):
                ids.append(made)
                starts.append(token_starts(np.frombuffer(made, "<u4"), text.encode(), path).tobytes())
                held += 2 * len(made)
                if held >= SEND:
                    yield pa.RecordBatch.from_arrays([keys.slice(keep, k + 1 - keep), pa.array(ids, pa.binary()), pa.array(starts, pa.binary())], ["doc_id", "ids", "starts"])
                    keep, ids, starts, held = k + 1, [], [], 0
            if ids:
                yield pa.RecordBatch.from_arrays([keys.slice(keep), pa.array(ids, pa.binary()), pa.array(starts, pa.binary())], ["doc_id", "ids", "starts"])
        encode.forget()

    rows = keyed(df, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, starts binary")


def decode(df: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """df with each row's bytes in `into`; a column of that name is replaced. Ids may split characters: bytes are joined before anything reads them as text, so they meet again."""
    rest = [c for c in df.columns if c != into]
    at = rest.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            keep, out, held = 0, [], 0
            for k, ids in enumerate(batch.column(at)):
                raw = ids.as_py() or b""
                out.append(b"".join(map(table.__getitem__, np.frombuffer(raw, "<u4").tolist())))
                held += len(raw)
                if held >= SEND or k + 1 == batch.num_rows:
                    part = batch.slice(keep, k + 1 - keep)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*rest, into])
                    keep, out, held = k + 1, [], 0

    rows = df.select(*rest)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, `{into}` binary")


def decode_text(raw: bytes) -> str:
    """Bytes as text; what a cut left of a character becomes U+FFFD."""
    return raw.decode("utf-8", "replace")


def op2_bpe_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Ids of every document by the multilingual rank file, and the bytes they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = decode(encode(documents(spark, sf_dir), path), path)
    n = F.length("ids") / 4
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("starts", 256).alias("starts_sha256"),
    )


QUERIES = {"op2_bpe_roundtrip": op2_bpe_roundtrip}
SQL: dict[str, str] = {}
