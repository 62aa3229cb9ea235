"""Media columns (operator 3): baseline JPEG, parsed and decoded in numpy as far as a thumbnail of luminance needs.

The reader walks the markers, builds the Huffman tables, and decodes all restart segments of all images of a batch side by
side, one symbol of each at a time; AC coefficients are skipped, and each block's DC gives one sample of the thumbnail. An
image without restart markers is one segment.

The writer stores bytes as such samples: each is a flat block whose DC is eight times the byte less 128, and the quantizer
is 8, so nothing is lost. A row of 64 samples is a restart segment. Payloads of more rows than an image may have become
several images, one behind the other.

Defined results: a null text counts as empty; a payload is padded with zeros to a positive multiple of 64; media that are
null or can't be read have nulls; repeated rows are stored each for itself; columns other than those named are left out;
an empty table gives an empty table.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed

#: Samples of a row, most rows of an image.
ROW, ROWS = 64, 8191
#: Codes of each length, 1 to 16, of the usual table for DC of luminance, whose symbols are 0 to 11. Fixed values.
DC_LENGTHS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
#: The one AC symbol that flat blocks need, the end of a block, has the code 0.
AC_LENGTHS = (1, *[0] * 15)
QUANTIZER = 8
#: Bytes of payload, or of media, that are worked on together.
TOGETHER = 1 << 20


def codes(lengths: tuple[int, ...], symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a Huffman table by its numbers of codes."""
    out, code, at = [], 0, 0
    for length, n in enumerate(lengths, 1):
        for _ in range(n):
            out.append((symbols[at], code, length))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(rows: int) -> bytes:
    """What stands before the scan of a grey image of 64 blocks by so many rows."""
    return b"".join((
        b"\xff\xd8",
        _segment(0xDB, bytes([0, *[QUANTIZER] * 64])),
        _segment(0xC0, struct.pack(">BHHBBBB", 8, 8 * rows, 8 * ROW, 1, 1, 0x11, 0)),
        _segment(0xC4, bytes([0x00, *DC_LENGTHS, *range(12)])),
        _segment(0xC4, bytes([0x10, *AC_LENGTHS, 0])),
        _segment(0xDD, struct.pack(">H", ROW)),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each DC difference from -255 to 255, with the end of the block."""
    huffman = {s: (c, n) for s, c, n in codes(DC_LENGTHS, bytes(range(12)))}
    code, length = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        c, n = huffman[size]
        code[d + 255] = ((c << size) | (d if d >= 0 else d + (1 << size) - 1)) << 1
        length[d + 255] = n + size + 1
    return code, length


_CODE, _LENGTH = _difference_codes()
_STRIDE = 128  # bytes that a row surely fits in: 64 codes of 15 bits at most


def write_images(payloads: list[bytes]) -> list[bytes]:
    """Each payload, a multiple of 64 bytes, as JPEG images."""
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ROW)
    level = samples.astype(np.int64) - 128
    level[:, 1:] -= level[:, :-1].copy()
    level += 255
    length = _LENGTH[level]
    done = np.cumsum(length, axis=1)
    at = done - length + 8 * _STRIDE * np.arange(len(level))[:, None]
    bits = (_CODE[level] << (24 - length - (at & 7))).ravel()
    at = (at >> 3).ravel()
    size = len(level) * _STRIDE
    raw = sum(np.bincount(at + k, (bits >> (16 - 8 * k)) & 255, size) for k in range(3)).astype(np.uint8).reshape(-1, _STRIDE)
    used = (done[:, -1] + 7) >> 3
    raw[np.arange(len(raw)), used - 1] |= ((1 << (8 * used - done[:, -1])) - 1).astype(np.uint8)
    row = np.repeat(np.arange(len(raw)), used)
    flat = raw[np.arange(_STRIDE) < used[:, None]]
    twice = flat == 255  # is followed by a zero, to be no marker
    stuffed = np.repeat(flat, 1 + twice)
    stuffed[np.cumsum(1 + twice)[twice] - 1] = 0
    used = used + np.bincount(row[twice], minlength=len(raw))
    stop = np.cumsum(used) + 2 * np.arange(len(raw))
    out = np.empty(len(stuffed) + 2 * len(raw), np.uint8)
    out[np.arange(len(stuffed)) + 2 * np.repeat(np.arange(len(raw)), used)] = stuffed
    out[stop] = 255
    n = [len(p) // ROW for p in payloads]
    in_image = np.concatenate([np.arange(k) % ROWS for k in n])
    last = (in_image == ROWS - 1) | np.append(in_image[1:] == 0, True)
    out[stop + 1] = np.where(last, 0xD9, 0xD0 + in_image % 8)
    ends = (stop + 2)[last]
    scans = [out[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    made, images = [], iter(scans)
    for k in n:
        made.append(b"".join(header(min(ROWS, k - a)) + next(images) for a in range(0, k, ROWS)))
    return made


class Image:
    """One image's header, and where its scan lies."""

    def __init__(self, raw: bytes, at: int):
        self.quantizer: dict[int, int] = {}
        self.tables: dict[int, bytes] = {}
        self.restart, self.frame = 0, None
        if raw[at : at + 2] != b"\xff\xd8":
            raise ValueError("no image starts here")
        at += 2
        while True:
            if raw[at : at + 1] != b"\xff":
                raise ValueError("no marker")
            marker = raw[at + 1]
            if marker == 0xFF:  # fill
                at += 1
                continue
            size = int.from_bytes(raw[at + 2 : at + 4], "big")
            body = raw[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quantizer[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.tables[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = int.from_bytes(body, "big")
            elif marker in (0xC0, 0xC1):
                self.height, self.width = struct.unpack(">HH", body[1:5])
                self.frame = [(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * body[5], 3)]
            elif 0xC2 <= marker <= 0xCF:
                raise ValueError("not baseline")
            elif marker == 0xDA:
                break
            elif marker == 0xD9 or size < 2:
                raise ValueError("no scan")
        if not self.frame or body[0] != len(self.frame) or not self.width or not self.height:
            raise ValueError("not one scan of all components")
        chosen = {body[k]: (body[k + 1] >> 4, body[k + 1] & 15) for k in range(1, 1 + 2 * body[0], 2)}
        alone = len(self.frame) == 1
        #: Of each block of an MCU: component, and contents of its DC and AC table.
        self.slots = tuple((c, self.tables[chosen[f[0]][0]], self.tables[16 | chosen[f[0]][1]]) for c, f in enumerate(self.frame) for _ in range(1 if alone else f[1] * f[2]))
        self.across, self.down = (1, 1) if alone else self.frame[0][1:3]
        most_h, most_v = (1, 1) if alone else (max(f[1] for f in self.frame), max(f[2] for f in self.frame))
        self.columns, self.rows = -(-self.width // (8 * most_h)), -(-self.height // (8 * most_v))
        self.start = at


def _scan_end(raw: np.ndarray, at: int) -> int:
    ff = np.flatnonzero(raw[at:-1] == 255) + at
    after = raw[ff + 1]
    ends = ff[(after != 0) & (after != 255) & ((after < 0xD0) | (after > 0xD7))]
    return int(ends[0]) if len(ends) else len(raw)


def _lookup(table: bytes) -> np.ndarray:
    """For each 16 bits that may come next: the symbol, and its code's length times 256; 0 where no code fits."""
    out = np.zeros(1 << 16, np.int64)
    for symbol, code, length in codes(tuple(table[:16]), table[16:]):
        out[code << (16 - length) : (code + 1) << (16 - length)] = symbol | length << 8
    return out


def _coefficients(images: list[tuple[Image, np.ndarray]]) -> list[np.ndarray]:
    """DC of each image's first component, block by block in the order of the scan; all images have the same tables."""
    first = images[0][0]
    parts, segments, mcus = [], [], []
    for image, scan in images:
        n, step = image.columns * image.rows, image.restart or image.columns * image.rows
        rst = np.flatnonzero((scan[:-1] == 255) & (scan[1:] >= 0xD0) & (scan[1:] <= 0xD7))
        keep = np.ones(len(scan), bool)
        keep[rst] = keep[rst + 1] = False
        keep[1:] &= (scan[1:] != 0) | (scan[:-1] != 255)
        begin = sum(map(len, parts))
        where = np.cumsum(keep)
        segments.append(begin + np.append(0, where[rst]))
        parts.append(scan[keep])
        mcus.append(np.minimum(step, n - step * np.arange(-(-n // step))))
        if len(mcus[-1]) != len(segments[-1]):
            raise ValueError("restart markers are missing")
    flat = np.concatenate([*parts, np.zeros(8, np.uint8)]).astype(np.int64)
    window = (flat[:-3] << 24) | (flat[1:-2] << 16) | (flat[2:-1] << 8) | flat[3:]
    bit, left = 8 * np.concatenate(segments), np.concatenate(mcus)
    limit = len(window) - 1
    luminance = sum(c == 0 for c, _, _ in first.slots)
    out = np.zeros((len(left), int(left.max()) * luminance), np.int32)
    before = np.zeros((len(first.frame), len(left)), np.int64)
    tables = {t: _lookup(t) for _, dc, ac in first.slots for t in (dc, ac)}

    def peek(bit: np.ndarray) -> np.ndarray:
        """The next 25 bits at least, as the upper ones of 32."""
        return (window[np.minimum(bit >> 3, limit)] << (bit & 7)) & 0xFFFFFFFF

    for mcu in range(int(left.max())):
        live = np.flatnonzero(left > mcu)
        everything = len(live) == len(left)
        at = bit if everything else bit[live]
        block = 0
        for c, dc, ac in first.slots:
            bits = peek(at)
            found = tables[dc][bits >> 16]
            size, length = found & 255, found >> 8
            if not length.all():
                raise ValueError("no such code")
            value = ((bits << length) & 0xFFFFFFFF) >> (32 - size)
            value = np.where(value < (1 << size) >> 1, value - (1 << size) + 1, value)
            at = at + length + size
            before[c, live] += value
            if c == 0:
                out[live, mcu * luminance + block] = before[c, live]
                block += 1
            open_, k = np.arange(len(live)), np.ones(len(live), np.int64)
            while len(open_):
                found = tables[ac][peek(at[open_]) >> 16]
                symbol, length = found & 255, found >> 8
                if not length.all():
                    raise ValueError("no such code")
                at[open_] += length + (symbol & 15)
                k[open_] += (symbol >> 4) + 1
                open_ = open_[(symbol != 0) & (k[open_] < 64)]
        if everything:
            bit = at
        else:
            bit[live] = at
    done, at = [], 0
    for m in mcus:
        done.append(np.concatenate([row[: luminance * k] for row, k in zip(out[at : at + len(m)], m, strict=True)]) if (m != m[0]).any() else out[at : at + len(m), : luminance * int(m[0])].ravel())
        at += len(m)
    return done


def _thumbnail(image: Image, dc: np.ndarray) -> np.ndarray:
    quantizer = image.quantizer[image.frame[0][3]]
    grid = dc.reshape(image.rows, image.columns, image.down, image.across).transpose(0, 2, 1, 3).reshape(image.rows * image.down, image.columns * image.across)
    across = -(-image.width * image.across // (8 * (image.across if len(image.frame) == 1 else max(f[1] for f in image.frame))))
    down = -(-image.height * image.down // (8 * (image.down if len(image.frame) == 1 else max(f[2] for f in image.frame))))
    return np.clip((grid[:down, :across] * quantizer + 4 >> 3) + 128, 0, 255).astype(np.uint8)


def read_images(media: list[bytes | None]) -> list[list[tuple[int, int, np.ndarray]] | None]:
    """(width, height, thumbnail) of each image of each of the media; None where they can't be read."""
    out: list = [[] for _ in media]
    groups: dict = {}
    for m, raw in enumerate(media):
        try:
            if not raw:
                raise ValueError("no image")
            view, at = np.frombuffer(raw, np.uint8), 0
            while at < len(raw):
                image = Image(raw, at)
                end = _scan_end(view, image.start)
                groups.setdefault((image.slots, len(image.frame)), []).append((m, len(out[m]), image, view[image.start : end]))
                out[m].append(None)
                at = end + 2
        except (ValueError, KeyError, IndexError, struct.error):
            out[m] = None
    for found in groups.values():
        found = [x for x in found if out[x[0]] is not None]
        try:
            made = _coefficients([x[2:] for x in found]) if found else []
        except ValueError:  # find the one that fails
            made = []
            for x in found:
                try:
                    made += _coefficients([x[2:]])
                except ValueError:
                    made.append(None)
        for (m, k, image, _), dc in zip(found, made, strict=True):
            if dc is None or out[m] is None:
                out[m] = None
            else:
                out[m][k] = (image.width, image.height, _thumbnail(image, dc))
    return out


def thumbnail_hash(sample: np.ndarray) -> str:
    """64 bits, as hex: which of 8 by 8 areas of the thumbnail are brighter than their mean."""
    rows, columns = (np.minimum(np.arange(9) * n // 8, n) for n in sample.shape)
    sums = np.zeros((sample.shape[0] + 1, sample.shape[1] + 1))
    sums[1:, 1:] = sample.cumsum(0, dtype=np.float64).cumsum(1)
    low_r, high_r = np.minimum(rows[:-1], sample.shape[0] - 1), np.maximum(rows[1:], rows[:-1] + 1).clip(max=sample.shape[0])
    low_c, high_c = np.minimum(columns[:-1], sample.shape[1] - 1), np.maximum(columns[1:], columns[:-1] + 1).clip(max=sample.shape[1])
    total = sums[np.ix_(high_r, high_c)] - sums[np.ix_(low_r, high_c)] - sums[np.ix_(high_r, low_c)] + sums[np.ix_(low_r, low_c)]
    mean = total / np.outer(high_r - low_r, high_c - low_c)
    return np.packbits(mean > mean.mean()).tobytes().hex()


def _together(column: pa.Array) -> Iterator[tuple[int, list]]:
    """(first row, values) of parts of a column of about TOGETHER bytes."""
    held, size, first = [], 0, 0
    for k, x in enumerate(column):
        held.append(x.as_py())
        size += len(held[-1] or b"")
        if size >= TOGETHER or k + 1 == len(column):
            yield first, held
            held, size, first = [], 0, k + 1


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes, and the images that hold them with their padding."""
    rows = keyed(df, id_col, text_col).select("doc_id", F.encode("text", "utf-8").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raws in _together(batch.column(1)):
                media = write_images([r + bytes(ROW - len(r) % ROW if len(r) % ROW or not r else 0) for r in raws])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raws)), pa.array(list(map(len, raws)), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def read(df: DataFrame, media_col: str = "media") -> DataFrame:
    """df with width, height (of all its images), samples (binary, the thumbnail's rows) and thumbnail_hash of its media; columns of these names are replaced."""
    new = {"width": "long", "height": "long", "samples": "binary", "thumbnail_hash": "string"}
    rows = df.select(*[F.col(c) for c in df.columns if c not in new])
    at, names = rows.columns.index(media_col), [*rows.columns, *new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, media in _together(batch.column(at)):
                found = []
                for images in read_images(media):
                    if images is None:
                        found.append((None,) * 4)
                        continue
                    shown = np.vstack([x[2] for x in images]) if len({x[0] for x in images}) == 1 else images[0][2]
                    found.append((max(x[0] for x in images), sum(x[1] for x in images), b"".join(x[2].tobytes() for x in images), thumbnail_hash(shown)))
                part = batch.slice(first, len(media))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)]], names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"{k} {v}" for k, v in new.items()]
    return rows.mapInArrow(run, ", ".join(fields))


def op3_jpeg_media(spark, sf_dir: str) -> DataFrame:
    """Every document's bytes as JPEG images, and what reading them back gives."""
    rows = read(store(documents(spark, sf_dir)))
    size = F.length("samples")
    return rows.select(
        "doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"), F.crc32(F.expr("substring(samples, -64)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string")), "thumbnail_hash").alias("feature"),
    )


QUERIES = {"op3_jpeg_media": op3_jpeg_media}
SQL: dict[str, str] = {}
