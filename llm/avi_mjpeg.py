"""AVI motion-JPEG columns: RIFF parsing, intra frame decoding, shots by adaptive histogram differences.

``read_avi`` walks the RIFF chunks and the ``idx1`` index of an AVI file, ``decode_frame`` decodes one
JPEG frame (baseline Huffman DCT, or the lossless predictive process with 8-bit samples), and ``clips``
cuts the frames into shots: a cut is where the difference of neighbouring luma histograms exceeds the
mean of the last differences by a number of their standard deviations.

``store_payload`` keeps arbitrary bytes losslessly as such a file: 8-bit samples, 64 to a row, in
lossless-process frames.  Its Huffman table gives difference category s a code of 9 - s bits, so every
sample takes 9 bits and frames are coded and decoded without a loop over samples.

Defined results: a null or empty text is a payload of 64 zero bytes; equal texts give equal values;
repeated rows are stored alike; an empty table gives an empty table; other columns play no part.  A frame
that is damaged raises ValueError in the reader.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import table

ROW = 64
FRAME_ROWS = 64
FPS = 25
HISTORY = 8
CUT_SIGMAS = 3.0
CUT_FLOOR = 0.10
BINS = 32

#: The order of an 8x8 block's coefficients in a JPEG scan.
ZIGZAG = np.array(
    [
        0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
        35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
    ]
)


# ---- lossless frames ---------------------------------------------------------------------------


def _fixed_code() -> tuple[np.ndarray, np.ndarray]:
    """(code of each difference + 255, difference of each 9-bit code); category s: 9 - s code bits, then s bits."""
    codes = np.zeros(511, dtype=np.uint16)
    for s in range(9):
        # canonical codes by rising length, categories 8 down to 0: code of length L is L - 1 ones and a zero
        prefix = ((1 << (8 - s)) - 1) << 1
        for d in [0] if s == 0 else [*range(-(1 << s) + 1, -(1 << (s - 1)) + 1), *range(1 << (s - 1), 1 << s)]:
            extra = d if d > 0 else d + (1 << s) - 1
            codes[d + 255] = (prefix << s) | (extra if s else 0)
    back = np.zeros(512, dtype=np.int16)
    back[codes] = np.arange(-255, 256)
    return codes, back


_CODES, _BACK = _fixed_code()
_BIT = np.arange(8, -1, -1, dtype=np.uint16)
_DHT = struct.pack(">HHB16B9B", 0xFFC4, 2 + 17 + 9, 0, *([1] * 9 + [0] * 7), *range(8, -1, -1))


def encode_lossless(samples: np.ndarray) -> bytes:
    """One grey frame of the lossless process, predictor 1, from a (rows, columns) array of bytes."""
    rows, cols = samples.shape
    x = samples.astype(np.int16)
    diff = np.empty_like(x)
    diff[:, 1:] = x[:, 1:] - x[:, :-1]
    diff[1:, 0] = x[1:, 0] - x[:-1, 0]
    diff[0, 0] = x[0, 0] - 128
    codes = _CODES[diff.reshape(-1) + 255]
    bits = ((codes[:, None] >> _BIT) & 1).astype(np.uint8).reshape(-1)
    if pad := -len(bits) % 8:
        bits = np.concatenate([bits, np.ones(pad, dtype=np.uint8)])
    data = np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")
    head = b"\xff\xd8" + struct.pack(">HHBHHBBBB", 0xFFC3, 11, 8, rows, cols, 1, 1, 0x11, 0) + _DHT
    return head + struct.pack(">HHBBBBBB", 0xFFDA, 8, 1, 1, 0, 1, 0, 0) + data + b"\xff\xd9"


def _decode_lossless_fixed(data: bytes, rows: int, cols: int) -> np.ndarray:
    n = rows * cols
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=None)
    if len(bits) < 9 * n:
        raise ValueError("the scan ends early")
    codes = bits[: 9 * n].reshape(n, 9).astype(np.uint16) @ (1 << _BIT)
    diff = _BACK[codes].astype(np.int64).reshape(rows, cols)
    diff[:, 0] = np.cumsum(diff[:, 0])
    return ((np.cumsum(diff, axis=1) + 128) & 0xFFFF).astype(np.uint8)


# ---- JPEG decoding -----------------------------------------------------------------------------


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.have, self.left = data, 0, 0, 0

    def need(self, n: int) -> None:
        while self.left < n:
            self.have = (self.have << 8) | (self.data[self.at] if self.at < len(self.data) else 0xFF)
            self.at += 1
            if self.at > len(self.data) + 8:
                raise ValueError("the scan ends early")
            self.left += 8

    def take(self, n: int) -> int:
        if not n:
            return 0
        self.need(n)
        self.left -= n
        got = (self.have >> self.left) & ((1 << n) - 1)
        self.have &= (1 << self.left) - 1
        return got

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = (code << 1) | self.take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such Huffman code")

    def signed(self, s: int) -> int:
        v = self.take(s)
        return v if not s or v >> (s - 1) else v - (1 << s) + 1


def _huffman(lengths: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    codes, code, at = {}, 0, 0
    for length, n in enumerate(lengths, 1):
        for _ in range(n):
            codes[length, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return codes


_COS = np.array([[(np.sqrt(0.125) if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for u in range(8)] for x in range(8)])


def _idct(block: np.ndarray) -> np.ndarray:
    return _COS @ block @ _COS.T


def _scan_parts(data: bytes, at: int) -> tuple[list[bytes], int]:
    """The entropy-coded segments from ``at`` on, without stuffing, and the place of the next marker."""
    parts, start = [], at
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            raise ValueError("no end of image")
        m = data[at + 1]
        if m == 0 or m == 0xFF:
            at += 2 if m == 0 else 1
        else:
            parts.append(data[start:at].replace(b"\xff\x00", b"\xff"))
            if not 0xD0 <= m <= 0xD7:
                return parts, at
            at += 2
            start = at


def decode_frame(jpeg: bytes) -> np.ndarray:
    """The luma (first component) of a baseline or lossless JPEG as a (rows, columns) array of bytes."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("no JPEG frame")
    at, quant, tables, frame, restart = 2, {}, {}, None, 0
    while at + 4 <= len(jpeg):
        if jpeg[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = jpeg[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        (size,) = struct.unpack_from(">H", jpeg, at + 2)
        body, at = jpeg[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide, key = body[0] >> 4, body[0] & 15
                step = np.zeros(64)
                step[ZIGZAG] = np.frombuffer(body[1 : 65 + 64 * wide], dtype=">u2" if wide else np.uint8)
                quant[key], body = step.reshape(8, 8), body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker in (0xC0, 0xC1, 0xC3):
            bits, rows, cols, n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("samples of 8 bits are read here")
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            frame = (marker, rows, cols, parts)
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError(f"JPEG process {marker - 0xC0} is not read here")
        elif marker == 0xDD:
            (restart,) = struct.unpack(">H", body[:2])
        elif marker == 0xDA:
            if frame is None:
                raise ValueError("a scan without a frame")
            segments, at = _scan_parts(jpeg, at)
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            if frame[0] == 0xC3:
                return _lossless(segments, frame, tables, chosen, predictor=body[1 + 2 * body[0]])
            return _baseline(segments, frame, tables, chosen, quant, restart)
    raise ValueError("no scan")


def _lossless(segments, frame, tables, chosen, predictor: int) -> np.ndarray:
    _, rows, cols, parts = frame
    if len(parts) != 1 or len(segments) != 1:
        raise ValueError("lossless frames of one component without restarts are read here")
    lengths, symbols = tables[chosen[parts[0][0]] >> 4]
    if predictor == 1 and bytes(lengths) == _DHT[5:21] and bytes(symbols) == _DHT[21:]:
        return _decode_lossless_fixed(segments[0], rows, cols)
    bits, codes = _Bits(segments[0]), _huffman(lengths, symbols)
    out = np.zeros((rows, cols), dtype=np.int64)
    for y in range(rows):
        for x in range(cols):
            a, b, c = (out[y, x - 1] if x else 0), (out[y - 1, x] if y else 0), (out[y - 1, x - 1] if x and y else 0)
            if not y:
                guess = a if x else 128
            elif not x:
                guess = b
            else:
                guess = (a, b, c, a + b - c, a + ((b - c) >> 1), b + ((a - c) >> 1), (a + b) >> 1)[predictor - 1]
            out[y, x] = (guess + bits.signed(bits.symbol(codes))) & 0xFFFF
    return out.astype(np.uint8)


def _baseline(segments, frame, tables, chosen, quant, restart: int) -> np.ndarray:
    _, rows, cols, parts = frame
    if len(chosen) != len(parts):
        raise ValueError("interleaved scans are read here")
    top_h, top_v = (max(p[1] for p in parts), max(p[2] for p in parts)) if len(parts) > 1 else (1, 1)
    across, down = -(-cols // (8 * top_h)), -(-rows // (8 * top_v))
    codes = {k: _huffman(*v) for k, v in tables.items()}
    own_h, own_v = (parts[0][1], parts[0][2]) if len(parts) > 1 else (1, 1)
    out = np.zeros((down * own_v * 8, across * own_h * 8))
    left, bits, last = iter(segments), None, {}
    for mcu in range(across * down):
        if bits is None or (restart and mcu % restart == 0):
            bits, last = _Bits(next(left, b"")), dict.fromkeys(range(len(parts)), 0)
        for i, (name, h, v, q) in enumerate(parts):
            dc, ac = codes[chosen[name] >> 4], codes[0x10 | (chosen[name] & 15)]
            for sub in range(h * v if len(parts) > 1 else 1):
                block = np.zeros(64)
                last[i] += bits.signed(bits.symbol(dc))
                block[0], k = last[i], 1
                while k < 64:
                    rs = bits.symbol(ac)
                    run, s = rs >> 4, rs & 15
                    if not s:
                        if run != 15:
                            break
                        k += 16
                        continue
                    k += run
                    if k > 63:
                        raise ValueError("a run leaves its block")
                    block[ZIGZAG[k]] = bits.signed(s)
                    k += 1
                if not i:
                    y, x = (mcu // across) * own_v + sub // own_h, (mcu % across) * own_h + sub % own_h
                    out[8 * y : 8 * y + 8, 8 * x : 8 * x + 8] = _idct(block.reshape(8, 8) * quant[q]) + 128
    return np.clip(np.rint(out[:rows, :cols]), 0, 255).astype(np.uint8)


# ---- AVI ---------------------------------------------------------------------------------------


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes], width: int, height: int, fps: int = FPS) -> bytes:
    """A motion-JPEG AVI file with one video stream and an ``idx1`` index."""
    largest = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, largest * fps, 0, 0x10, len(frames), 0, 1, largest, width, height, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, min(width, 65535), min(height, 65535))
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    strl = b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", strl))
    body, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        body.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"".join(body)) + _chunk(b"idx1", b"".join(index)))


def _walk(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", data, at)
        yield name, at + 8, min(at + 8 + size, end)
        at += 8 + size + (size & 1)


def read_avi(data: bytes) -> tuple[float, list[bytes]]:
    """(frames a second, the frames of the first video stream) by the index; without one, by the movi chunks."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    fps, movi, index, stream, streams = float(FPS), None, None, None, 0
    for name, a, b in _walk(data, 12, len(data)):
        kind = data[a : a + 4]
        if name == b"LIST" and kind == b"hdrl":
            for n2, a2, b2 in _walk(data, a + 4, b):
                if n2 == b"LIST" and data[a2 : a2 + 4] == b"strl":
                    for n3, a3, _ in _walk(data, a2 + 4, b2):
                        if n3 == b"strh" and data[a3 : a3 + 4] == b"vids" and stream is None:
                            scale, rate = struct.unpack_from("<II", data, a3 + 20)
                            fps, stream = rate / max(1, scale), streams
                    streams += 1
        elif name == b"LIST" and kind == b"movi":
            movi = (a, b)
        elif name == b"idx1":
            index = (a, b)
    if movi is None:
        raise ValueError("no movi list")
    tags = {f"{stream or 0:02d}dc".encode(), f"{stream or 0:02d}db".encode()}
    if index is None:
        return fps, [data[a:b] for n, a, b in _walk(data, movi[0] + 4, movi[1]) if n in tags]
    entries = [struct.unpack_from("<4sIII", data, at) for at in range(index[0], index[1] - 15, 16)]
    entries = [e for e in entries if e[0] in tags]
    # offsets count from the movi list's type, or in some files from the start of the file
    base = movi[0] if not entries or data[movi[0] + entries[0][2] :][:4] == entries[0][0] else 0
    return fps, [data[base + off + 8 : base + off + 8 + size] for _, _, off, size in entries]


def clips(frames: list[np.ndarray], fps: float) -> list[dict]:
    """Timed shots: clip, first_frame, n_frames, start_ms, end_ms, mean_luma, and the difference at its start."""
    hists = [np.bincount(f.reshape(-1) >> 3, minlength=BINS) / max(1, f.size) for f in frames]
    starts, jumps, past = [0], [0.0], []
    for i in range(1, len(frames)):
        d = 0.5 * float(np.abs(hists[i] - hists[i - 1]).sum())
        # without a history, after a start, the floor alone decides
        if d > (max(CUT_FLOOR, float(np.mean(past)) + CUT_SIGMAS * float(np.std(past))) if past else CUT_FLOOR):
            starts.append(i)
            jumps.append(d)
            past = []
        else:
            past = [*past, d][-HISTORY:]
    ends = [*starts[1:], len(frames)]
    return [
        {
            "clip": k,
            "first_frame": a,
            "n_frames": b - a,
            "start_ms": round(1000 * a / fps),
            "end_ms": round(1000 * b / fps),
            "mean_luma": round(float(sum(int(f.sum()) for f in frames[a:b])) / max(1, sum(f.size for f in frames[a:b])), 3),
            "difference": round(jumps[k], 4),
        }
        for k, (a, b) in enumerate(zip(starts, ends, strict=True))
        if b > a
    ]


# ---- payloads and columns ----------------------------------------------------------------------


def padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % ROW if raw else ROW)


def store_payload(payload: bytes) -> bytes:
    """The AVI file that holds the payload (a positive multiple of 64 bytes) as 8-bit samples."""
    grid = np.frombuffer(payload, dtype=np.uint8).reshape(-1, ROW)
    frames = [encode_lossless(grid[a : a + FRAME_ROWS]) for a in range(0, len(grid), FRAME_ROWS)]
    return write_avi(frames, ROW, min(FRAME_ROWS, len(grid)))


def load_payload(media: bytes) -> tuple[bytes, float, list[np.ndarray]]:
    fps, frames = read_avi(media)
    images = [decode_frame(f) for f in frames]
    return b"".join(i.tobytes() for i in images), fps, images


def clip_rows(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row for each clip of each AVI file: key, clip, first_frame, n_frames, start_ms, end_ms, mean_luma, difference.

    A null file has no clips.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, m in zip(b.column(0), b.column(1), strict=True):
                if m.is_valid and (rows := clips(*reversed(load_payload(m.as_py())[1:]))):
                    cols = {"k": pa.array([k.as_py()] * len(rows), b.column(0).type)} | {c: pa.array([r[c] for r in rows]) for c in rows[0]}
                    yield pa.RecordBatch.from_pydict(cols)

    kind = media.schema[key].dataType.simpleString()
    schema = f"k {kind}, clip long, first_frame long, n_frames long, start_ms long, end_ms long, mean_luma double, difference double"
    return media.select(key, column).mapInArrow(run, schema).withColumnRenamed("k", key)


def store_texts(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, media binary): every text as an AVI column value."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                media = [store_payload(padded((t or "").encode())) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(media, pa.binary())], names=["doc_id", "media"])

    return _slim(docs).mapInArrow(run, "doc_id long, media binary")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def feature(shots: list[dict]) -> str:
    return f"clips={len(shots)};frames={sum(s['n_frames'] for s in shots)};" + ";".join(f"{s['start_ms']}-{s['end_ms']}:{s['mean_luma']:.3f}" for s in shots)


def digest(text: str | None) -> tuple:
    raw = (text or "").encode()
    media = store_payload(padded(raw))
    back, fps, images = load_payload(media)
    return (
        len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(),
        feature(clips(images, fps)),
    )


def media_digests(docs: DataFrame) -> DataFrame:
    """Stores every text, reads the stored bytes back and describes both."""
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [digest(t.as_py()) for t in b.column("text")]
            cols = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", *names])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return _slim(docs).mapInArrow(run, schema)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` through an AVI file and back."""
    return media_digests(table(spark, sf_dir, "documents"))
