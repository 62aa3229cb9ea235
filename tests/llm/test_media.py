import hashlib
import random
import struct
import zlib

import numpy as np

from tarn.llm import media


def padded(raw):
    return raw + bytes(-len(raw) % 64 or (64 if not raw else 0))


def test_any_bytes_come_back(monkeypatch):
    rng = random.Random(1)
    payloads = [padded(bytes(rng.choice((0, 255, rng.randrange(256))) for _ in range(n))) for n in (0, 1, 64, 65, 500, 5000)] + [bytes([255]) * 640, bytes([0, 255]) * 320]
    for rows in (8191, 3):
        monkeypatch.setattr(media, "ROWS", rows)
        images = media.write_images(payloads)
        for payload, found, raw in zip(payloads, media.read_images(images), images, strict=True):
            assert b"".join(x[2].tobytes() for x in found) == payload
            assert sum(x[1] for x in found) == len(payload) // 8 and len(found) == -(-len(payload) // 64 // rows)
            assert media.write_images([payload]) == [raw]


class Bits:
    def __init__(self):
        self.bits = ""

    def put(self, code, length):
        self.bits += format(code, f"0{length}b") if length else ""

    def value(self, v):
        size = abs(v).bit_length()
        self.put(v if v >= 0 else v + (1 << size) - 1, size)

    def bytes(self):
        bits = self.bits + "1" * (-len(self.bits) % 8)
        return bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def coloured(width, height, h, v, restart, rng):
    """An image of three components with AC coefficients, and the DC of its luminance."""
    dc_symbols, ac_symbols = bytes(range(12)), bytes([0x00, 0x01, 0x23, 0xF0, 0x12])
    dc = {s: (c, n) for s, c, n in media.codes(media.DC_LENGTHS, dc_symbols)}
    ac_lengths = (0, 1, 2, 3, *[0] * 12)[:16]
    ac_lengths = (0, 1, 2, 2, *[0] * 12)
    ac = {s: (c, n) for s, c, n in media.codes(ac_lengths, ac_symbols)}
    columns, rows = -(-width // (8 * h)), -(-height // (8 * v))
    grid = np.zeros((rows * v, columns * h), int)
    scan, bits, before, n = b"", Bits(), [0, 0, 0], 0
    for m in range(rows * columns):
        if restart and m and m % restart == 0:
            scan += bits.bytes() + bytes([255, 0xD0 + n % 8])
            bits, before, n = Bits(), [0, 0, 0], n + 1
        for c in range(3):
            for k in range(h * v if c == 0 else 1):
                value = rng.randint(-60, 60)
                if c == 0:
                    grid[m // columns * v + k // h, m % columns * h + k % h] = value
                size = abs(value - before[c]).bit_length()
                bits.put(*dc[size])
                bits.value(value - before[c])
                before[c] = value
                at = 1
                while True:
                    s = rng.choice(ac_symbols)
                    if s == 0 or at + (s >> 4) + 1 > 63:
                        bits.put(*ac[0])
                        break
                    bits.put(*ac[s])
                    bits.put((1 << (s & 15)) - 1, s & 15)
                    at += (s >> 4) + 1
    scan += bits.bytes()
    seg = media._segment
    frame = struct.pack(">BHHB", 8, height, width, 3) + bytes([1, h << 4 | v, 0, 2, 0x11, 1, 3, 0x11, 1])
    raw = b"\xff\xd8" + seg(0xE0, b"JFIF") + seg(0xDB, bytes([0, *[16] * 64]) + bytes([1, *[9] * 64])) + seg(0xC0, frame)
    raw += seg(0xC4, bytes([0x00, *media.DC_LENGTHS]) + dc_symbols + bytes([0x10, *ac_lengths]) + ac_symbols)
    if restart:
        raw += seg(0xDD, struct.pack(">H", restart))
    raw += seg(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])) + scan + b"\xff\xd9"
    shown = np.clip((grid * 16 + 4 >> 3) + 128, 0, 255)
    return raw, shown[: -(-height // 8), : -(-width // 8)]


def test_coloured_images_with_subsampling(spark):
    rng = random.Random(2)
    made = [coloured(w, h, a, b, r, rng) for w, h, a, b, r in ((40, 24, 1, 1, 0), (50, 37, 2, 2, 0), (64, 16, 2, 1, 3), (9, 9, 1, 2, 1))]
    for (raw, shown), found in zip(made, media.read_images([raw for raw, _ in made]), strict=True):
        assert found[0][2].tolist() == shown.tolist()
    rows = [(k, raw, "x") for k, (raw, _) in enumerate(made)] + [(7, None, "x"), (8, b"", "x"), (9, b"\xff\xd8junk", "x"), (10, made[0][0][:-40], "x"), (11, made[2][0].replace(b"\xff\xd0", b"\x00\x00"), "x")]
    got = {r.k: r for r in media.read(spark.createDataFrame(rows, "k int, media binary, samples string")).collect()}
    assert [got[k].width for k in range(4)] == [40, 50, 64, 9] and got[1].height == 37
    assert all(got[k].thumbnail_hash is None for k in (7, 8, 9, 11))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in media.op3_jpeg_media(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        raw, r = (doc.text or "").encode(), got[doc.doc_id]
        whole = padded(raw)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:]))
        image = media.write_images([whole])[0]
        assert (r.media_bytes, r.media_sha256) == (len(image), hashlib.sha256(image).hexdigest()) and r.feature.startswith(f"512x{len(whole) // 8}:")


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "é" * 70, 0)], "doc_id long, text string, media int")
    got = media.read(media.store(df)).collect()
    assert sorted(bytes(r.samples) for r in got) == sorted([bytes(64), bytes(64), padded(("é" * 70).encode())])
    assert media.read(media.store(df.limit(0))).collect() == []
