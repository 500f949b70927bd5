import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from conftest import DATA

from llm import avi_mjpeg as am
from llm.session import table


def baseline_jpeg(img, quality=1, restart=0):
    """A plain grey encoder: one table of fixed-length codes for each class."""
    rows, cols = img.shape
    padded = np.pad(img, ((0, -rows % 8), (0, -cols % 8)), mode="edge").astype(float) - 128
    q = np.full((8, 8), quality)
    dc_symbols, ac_symbols = list(range(12)), [0x00, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11)]
    bits = []

    def put(v, n):
        bits.extend((v >> i) & 1 for i in range(n - 1, -1, -1))

    def size(v):
        return int(abs(v)).bit_length()

    def amplitude(v):
        s = size(v)
        put(v if v >= 0 else v + (1 << s) - 1, s)

    parts, last, n = [], 0, 0

    def flush():
        while len(bits) % 8:
            bits.append(1)
        out = np.packbits(np.array(bits, dtype=np.uint8)).tobytes().replace(b"\xff", b"\xff\x00") if bits else b""
        bits.clear()
        return out

    for y in range(0, padded.shape[0], 8):
        for x in range(0, padded.shape[1], 8):
            if restart and n and n % restart == 0:
                parts.append(flush() + bytes([0xFF, 0xD0 + (n // restart - 1) % 8]))
                last = 0
            block = np.rint(am._COS.T @ padded[y : y + 8, x : x + 8] @ am._COS / q).astype(int).reshape(-1)[am.ZIGZAG]
            d = int(block[0]) - last
            last = int(block[0])
            put(dc_symbols.index(size(d)), 4)
            amplitude(d)
            run = 0
            for v in block[1:]:
                if not v:
                    run += 1
                    continue
                while run > 15:
                    put(ac_symbols.index(0xF0), 8)
                    run -= 16
                put(ac_symbols.index(run << 4 | size(v)), 8)
                amplitude(int(v))
                run = 0
            if run:
                put(ac_symbols.index(0x00), 8)
            n += 1
    parts.append(flush())
    dht = lambda k, length, symbols: struct.pack(">HHB", 0xFFC4, 19 + len(symbols), k) + bytes(len(symbols) if i == length else 0 for i in range(1, 17)) + bytes(symbols)
    head = b"\xff\xd8" + struct.pack(">HHB", 0xFFDB, 67, 0) + bytes(q.reshape(-1)[am.ZIGZAG].tolist())
    head += struct.pack(">HHBHHBBBB", 0xFFC0, 11, 8, rows, cols, 1, 1, 0x11, 0) + dht(0, 4, dc_symbols) + dht(0x10, 8, ac_symbols)
    if restart:
        head += struct.pack(">HHH", 0xFFDD, 4, restart)
    return head + struct.pack(">HHBBBBBB", 0xFFDA, 8, 1, 1, 0, 0, 63, 0) + b"".join(parts) + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 2])
def test_baseline_frames(restart):
    rnd = np.random.default_rng(1)
    img = np.clip(np.add.outer(np.arange(21) * 5, np.arange(30) * 3) + rnd.integers(-9, 9, (21, 30)), 0, 255).astype(np.uint8)
    back = am.decode_frame(baseline_jpeg(img, restart=restart))
    assert back.shape == img.shape and np.abs(back.astype(int) - img).max() <= 2


def test_lossless_frames_also_by_the_general_decoder():
    img = np.random.default_rng(2).integers(0, 256, (5, 64)).astype(np.uint8)
    jpeg = am.encode_lossless(img)
    assert (am.decode_frame(jpeg) == img).all()
    start = jpeg.index(b"\xff\xda") + 10
    segments, _ = am._scan_parts(jpeg, start)
    slow = am._lossless(segments, (0xC3, 5, 64, [(1, 1, 1, 0)]), {0: (am._DHT[5:21], am._DHT[21:] )}, {1: 0}, 1)
    assert (slow == img).all()
    bits, codes = am._Bits(segments[0]), am._huffman(am._DHT[5:21], am._DHT[21:])
    assert [bits.signed(bits.symbol(codes)) for _ in range(3)] == [int(img[0, 0]) - 128, int(img[0, 1]) - int(img[0, 0]), int(img[0, 2]) - int(img[0, 1])]


def test_every_pair_of_samples_round_trips():
    for a in range(0, 256, 5):
        p = bytes([a, 255, 0, 255 - a] * 16)
        assert am.load_payload(am.store_payload(p))[0] == p


def test_avi_without_an_index_and_with_file_offsets():
    frames = [am.encode_lossless(np.full((2, 64), v, dtype=np.uint8)) for v in (0, 9, 200)]
    data = am.write_avi(frames, 64, 2)
    assert am.read_avi(data) == (25.0, frames)
    at = data.index(b"idx1")
    assert am.read_avi(data[:at])[1] == frames
    base = data.index(b"movi")
    moved = bytearray(data)
    for k in range(3):
        (off,) = struct.unpack_from("<I", moved, at + 8 + 16 * k + 8)
        struct.pack_into("<I", moved, at + 8 + 16 * k + 8, off + base)
    assert am.read_avi(bytes(moved))[1] == frames


@pytest.mark.parametrize("bad", [b"", b"RIFF", b"RIFF1234AVI xx", b"RIFF1234WAVE"])
def test_damaged_files(bad):
    with pytest.raises(ValueError):
        am.read_avi(bad)
    with pytest.raises(ValueError):
        am.decode_frame(b"\xff\xd8\xff\xd9")


def test_shots():
    dark, light = [np.full((4, 64), v, dtype=np.uint8) for v in (10, 200)]
    got = am.clips([dark] * 5 + [light] * 3, 25)
    assert [(c["first_frame"], c["n_frames"], c["start_ms"], c["end_ms"]) for c in got] == [(0, 5, 0, 200), (5, 3, 200, 320)]
    assert am.clips([], 25) == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    rows = am.op7_media_columns(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        p = am.padded(docs[r.doc_id].encode())
        assert len(p) % 64 == 0 and (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(docs[r.doc_id].encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r.media_sha256 == hashlib.sha256(am.store_payload(p)).hexdigest()


def test_nulls_long_texts_repeats_and_clashes(spark):
    rnd = random.Random(1)
    long = "".join(chr(rnd.randint(1, 255)) for _ in range(100_000))
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, long, "z"), (3, long, "z"), (None, "é", "z")], "doc_id long, text string, feature string")
    rows = am.media_digests(df).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].payload_bytes == 64 and by[1].payload_sha256 == by[2].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest()
    assert by[3].payload_sha256 == hashlib.sha256(am.padded(long.encode())).hexdigest() and len(rows) == 5
    assert am.media_digests(df.limit(0)).count() == 0
    clip = am.clip_rows(am.store_texts(df))
    assert clip.where("doc_id = 3").agg({"n_frames": "sum"}).first()[0] == 2 * -(-len(am.padded(long.encode())) // 4096)
    assert am.clip_rows(spark.createDataFrame([(1, None)], "doc_id long, media binary")).count() == 0


def test_cuts_right_after_a_start_are_found():
    a, b, c = (np.full((8, 8), v, dtype=np.uint8) for v in (10, 100, 200))
    firsts = lambda frames: [s["first_frame"] for s in am.clips(frames, 25.0)]
    assert firsts([a, b]) == [0, 1]
    assert firsts([a, b, b, b, c, c]) == [0, 1, 4]
    assert firsts([a, a, a, b, c, c]) == [0, 3, 4]
    assert firsts([a, a, a]) == [0]
