"""AVI motion-JPEG: a RIFF writer, an index parser, an intra-frame decoder and shot detection.

A media column holds whole AVI files.  Frames are baseline JPEG (SOF0), so any player
opens them.  Payload bytes become 8-bit samples: one 8x8 block per byte whose DC
quantiser is 8, which makes the inverse DCT of the block exactly that byte, and frames
decode without loss.  The Huffman table gives every DC difference nine bits, the lone AC
code (end of block) one: a frame of the writer decodes with numpy at once, while frames
of other encoders go through the general bit-serial decoder.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches

BLOCKS_WIDE = 64  # samples in a row of a frame
ROWS_MOST = 64  # rows of a frame
FPS = 25

# --- JPEG, fixed values of ITU-T T.81: zigzag order --------------------------------------
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(rows: int, cols: int) -> bytes:
    """All segments before the scan of a grey frame of rows x cols blocks."""
    dqt = _segment(0xDB, bytes([0]) + bytes([8] + [1] * 63))
    sof = _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, cols * 8, 1) + bytes([1, 0x11, 0]))
    dc = _segment(0xC4, bytes([0x00]) + bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1)))
    ac = _segment(0xC4, bytes([0x10]) + bytes([1] + [0] * 15) + bytes([0]))
    sos = _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    return b"\xff\xd8" + dqt + sof + dc + ac + sos


def _fixed_codes() -> tuple[np.ndarray, np.ndarray]:
    """Ten bits of each difference -255..255 (code, value bits, end of block), and back."""
    code, back = np.zeros(511, np.uint64), np.full(1024, 999, np.int16)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        prefix = ((1 << (8 - s)) - 1) << 1  # canonical code of category s: 8-s ones and a zero
        length = 9 - s
        if s == 0:
            prefix, length = 0b111111110, 9
        bits = d if d >= 0 else d + (1 << s) - 1
        word = ((prefix << s | bits) << 1) if length + s == 9 else 0
        code[d + 255], back[word] = word, d
    return code, back


CODE, BACK = _fixed_codes()


def encode_frame(samples: np.ndarray) -> bytes:
    """A grey baseline JPEG whose 8x8 blocks have the given byte values (rows x cols)."""
    flat = samples.astype(np.int16).ravel() - 128
    words = CODE[np.diff(flat, prepend=np.int16(0)) + 255]
    pad = -len(words) % 4
    if pad:
        words = np.concatenate([words, np.full(pad, 1023, np.uint64)])
    quad = words.reshape(-1, 4)
    packed = quad[:, 0] << np.uint64(30) | quad[:, 1] << np.uint64(20) | quad[:, 2] << np.uint64(10) | quad[:, 3]
    data = packed.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()
    used = (len(flat) * 10 + 7) // 8
    data = data[:used]
    return _header(*samples.shape) + data.replace(b"\xff", b"\xff\x00") + b"\xff\xd9"


def _decode_fixed(data: bytes, rows: int, cols: int) -> np.ndarray:
    n = rows * cols
    raw = data.replace(b"\xff\x00", b"\xff")
    need = -(-n // 4) * 5
    quint = np.frombuffer(raw.ljust(need, b"\xff"), np.uint8, need).reshape(-1, 5).astype(np.uint64)
    packed = quint[:, 0] << np.uint64(32) | quint[:, 1] << np.uint64(24) | quint[:, 2] << np.uint64(16) | quint[:, 3] << np.uint64(8) | quint[:, 4]
    words = np.stack([packed >> np.uint64(s) & np.uint64(1023) for s in (30, 20, 10, 0)], 1).ravel()[:n]
    steps = BACK[words]
    if (steps == 999).any():
        raise ValueError("bad code in scan")
    return (np.cumsum(steps, dtype=np.int32) + 128).astype(np.uint8).reshape(rows, cols)


class _Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.acc, self.n = data, 0, 0, 0

    def need(self, k: int) -> None:
        while self.n < k:
            self.acc = self.acc << 8 | (self.data[self.at] if self.at < len(self.data) else 0xFF)
            self.at += 1
            self.n += 8

    def take(self, k: int) -> int:
        if not k:
            return 0
        self.need(k)
        self.n -= k
        v = self.acc >> self.n
        self.acc &= (1 << self.n) - 1
        return v

    def symbol(self, table: dict) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (s := table.get((length, code))) is not None:
                return s
        raise ValueError("bad Huffman code")


def _extend(v: int, s: int) -> int:
    return v if not s or v >> (s - 1) else v - (1 << s) + 1


_K = np.arange(8)
_DCT = np.cos((2 * _K[:, None] + 1) * _K[None, :] * np.pi / 16) * np.where(_K == 0, np.sqrt(0.125), 0.5)[None, :]


def decode_frame(jpeg: bytes, blocks_only: bool = False) -> np.ndarray:
    """Luma of a baseline JPEG; ``blocks_only`` gives one mean per 8x8 block instead of pixels.

    ValueError for truncated or unsupported (progressive, arithmetic) frames.
    """
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    at, quant, tables, frame, restart = 2, {}, {}, None, 0
    raw_dc = raw_ac = b""
    while True:
        if at + 4 > len(jpeg) or jpeg[at] != 0xFF:
            raise ValueError("truncated JPEG")
        marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide, k = body[0] >> 4, body[0] & 15
                quant[k] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                counts, n = body[1:17], sum(body[1:17])
                if body[0] >> 4:
                    raw_ac = body[1 : 17 + n]
                else:
                    raw_dc = body[1 : 17 + n]
                table, code, k = {}, 0, 17
                for length, c in enumerate(counts, 1):
                    for _ in range(c):
                        table[(length, code)] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                tables[body[0]], body = table, body[17 + n :]
        elif marker == 0xC0:
            h, w, n = struct.unpack_from(">HHB", body, 1)
            frame = (h, w, [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(n)])
        elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
            raise ValueError("not baseline")
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            break
    if frame is None:
        raise ValueError("no frame header")
    h, w, parts = frame
    end = jpeg.rfind(b"\xff\xd9")
    data = jpeg[at : end if end >= at else len(jpeg)]
    own = raw_dc == bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1)) and raw_ac == bytes([1] + [0] * 15) + bytes([0])
    if own and len(parts) == 1 and not restart and h % 8 == 0 and w % 8 == 0 and quant[parts[0][2]][0] == 8:
        blocks = _decode_fixed(data, h // 8, w // 8)
        return blocks if blocks_only else np.kron(blocks, np.ones((8, 8), np.uint8))
    return _decode_general(data, h, w, parts, body, quant, tables, restart, blocks_only)


def _decode_general(data, h, w, parts, scan, quant, tables, restart, blocks_only):
    sampling = {p[0]: (p[1] >> 4, p[1] & 15, p[2]) for p in parts}
    order = [(scan[1 + 2 * i], scan[2 + 2 * i] >> 4, scan[2 + 2 * i] & 15) for i in range(scan[0])]
    hmax, vmax = max(s[0] for s in sampling.values()), max(s[1] for s in sampling.values())
    if len(parts) == 1:
        hmax = vmax = 1
        sampling = {k: (1, 1, q) for k, (_, _, q) in sampling.items()}
    wide, high = -(-w // (8 * hmax)), -(-h // (8 * vmax))
    luma = parts[0][0]
    lh, lv, lq = sampling[luma]
    coefs = np.zeros((high * lv, wide * lh, 64), np.int32)
    pieces, start, k = [], 0, 0
    while restart and (k := data.find(b"\xff", k)) >= 0:
        if k + 1 < len(data) and 0xD0 <= data[k + 1] <= 0xD7:
            pieces.append(data[start:k])
            start = k + 2
        k += 2
    pieces.append(data[start:])
    mcu = 0
    for piece in pieces:
        bits, last = _Bits(piece.replace(b"\xff\x00", b"\xff")), dict.fromkeys(sampling, 0)
        for _ in range(restart or wide * high):
            if mcu >= wide * high:
                break
            y, x = divmod(mcu, wide)
            for c, td, ta in order:
                ch, cv, _ = sampling[c]
                for v in range(cv):
                    for u in range(ch):
                        if bits.at > len(bits.data) + 8:
                            raise ValueError("truncated scan")
                        block = np.zeros(64, np.int32)
                        s = bits.symbol(tables[td])
                        last[c] += _extend(bits.take(s), s)
                        block[0], i = last[c], 1
                        while i < 64:
                            rs = bits.symbol(tables[0x10 | ta])
                            if rs == 0:
                                break
                            i += rs >> 4
                            if rs & 15:
                                if i > 63:
                                    raise ValueError("bad run")
                                block[ZIGZAG[i]] = _extend(bits.take(rs & 15), rs & 15)
                            i += 1
                        if c == luma:
                            coefs[y * cv + v, x * ch + u] = block
            mcu += 1
    q = np.zeros(64, np.int32)
    q[ZIGZAG] = quant[lq]
    values = (coefs * q).reshape(*coefs.shape[:2], 8, 8).astype(float)
    if blocks_only:
        return np.clip(np.rint(values[:, :, 0, 0] / 8 + 128), 0, 255).astype(np.uint8)[: -(-h // 8), : -(-w // 8)]
    pixels = np.einsum("xu,abuv,yv->axby", _DCT, values, _DCT).reshape(coefs.shape[0] * 8, coefs.shape[1] * 8)
    return np.clip(np.rint(pixels + 128), 0, 255).astype(np.uint8)[:h, :w]


# --- RIFF --------------------------------------------------------------------------------
def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes], width: int, height: int, fps: int = FPS, extra: bytes = b"") -> bytes:
    """An AVI 1.0 file of JPEG frames with an idx1 index; ``extra`` chunks precede the movie list."""
    n, biggest = len(frames), max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, biggest * fps, 0, 0x10, n, 0, 1, biggest, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIhhhh", 0, 0, 0, 0, 1, fps, 0, n, biggest, 0xFFFFFFFF, 0, 0, 0, width & 0x7FFF, height & 0x7FFF)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    movi, index = bytearray(b"movi"), bytearray()
    for f in frames:
        index += b"00dc" + struct.pack("<III", 0x10, len(movi), len(f))
        movi += _chunk(b"00dc", f)
    body = b"AVI " + hdrl + extra + _chunk(b"LIST", bytes(movi)) + _chunk(b"idx1", bytes(index))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_avi(data: bytes) -> dict:
    """fps, width, height, extra chunks and (offset, size) of each video frame.

    Frames come from idx1 where it is there and valid, else from walking the movie list.
    ValueError if this is no AVI file.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    out = {"fps": float(FPS), "width": 0, "height": 0, "frames": [], "extra": {}}
    walked, index, movi = [], None, 0
    stack = [(12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0]))]
    while stack:
        at, end = stack.pop()
        while at + 8 <= end:
            name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            stop = min(end, at + 8 + size)
            if name == b"LIST":
                kind = data[at + 8 : at + 12]
                movi = at + 8 if kind == b"movi" else movi
                stack.append((stop + (size & 1), end))
                at, end = at + 12, stop
                continue
            if name == b"avih":
                us, *_ = struct.unpack_from("<I", data, at + 8)
                out["width"], out["height"] = struct.unpack_from("<II", data, at + 8 + 32)
                out["fps"] = 1e6 / us if us else float(FPS)
            elif name[2:] in (b"dc", b"db"):
                walked.append((at + 8, stop - at - 8))
            elif name == b"idx1":
                index = [struct.unpack_from("<4sIII", data, k) for k in range(at + 8, stop - 15, 16)]
            elif name not in (b"strh", b"strf", b"JUNK"):
                out["extra"][name] = data[at + 8 : stop]
            at = stop + (size & 1)
    listed = []
    for name, _, offset, size in index or []:
        if name[2:] in (b"dc", b"db"):
            at = movi + offset
            if data[at : at + 4] != name:
                at = offset  # some writers count from the start of the file
            listed.append((at + 8, size) if data[at : at + 4] == name and at + 8 + size <= len(data) else None)
    out["frames"] = listed if listed and None not in listed else walked
    return out


# --- payloads, shots ---------------------------------------------------------------------
def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))


def encode_payload(payload: bytes) -> bytes:
    """Any bytes as an AVI file; their number stands in a chunk of its own."""
    lines = -(-len(payload) // BLOCKS_WIDE)
    n = -(-lines // ROWS_MOST)
    rows = -(-lines // n)
    full = np.zeros((n, rows, BLOCKS_WIDE), np.uint8)
    full.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    return write_avi([encode_frame(f) for f in full], BLOCKS_WIDE * 8, rows * 8, extra=_chunk(b"plen", struct.pack("<Q", len(payload))))


def decode_blocks(media: bytes) -> tuple[dict, list[np.ndarray]]:
    info = read_avi(media)
    return info, [decode_frame(media[a : a + s], blocks_only=True) for a, s in info["frames"]]


def decode_payload(info: dict, blocks: list[np.ndarray]) -> bytes:
    return np.concatenate([b.ravel() for b in blocks]).tobytes()[: struct.unpack("<Q", info["extra"][b"plen"])[0]]


def shots(frames: list[np.ndarray], window: int = 8, factor: float = 3.0, floor: float = 0.25) -> list[int]:
    """First frames of the shots.

    A cut stands where the histogram difference of two neighbouring frames exceeds both
    ``floor`` and mean + factor * deviation of up to ``window`` differences before it in
    the same shot: the threshold adapts to the motion of the shot.
    """
    if not frames:
        return []
    hist = np.stack([np.bincount(f.ravel() >> 2, minlength=64) / f.size for f in frames])
    diff = np.abs(np.diff(hist, axis=0)).sum(1) / 2
    cuts, since = [0], []
    for k, d in enumerate(diff.tolist(), 1):
        recent = since[-window:]
        limit = floor if not recent else max(floor, float(np.mean(recent)) + factor * float(np.std(recent)))
        if d > limit:
            cuts.append(k)
            since = []
        else:
            since.append(d)
    return cuts


def feature(frames: list[np.ndarray]) -> str:
    """frames:height x width in blocks:shot starts:crc32 of the sum of the histograms."""
    total = sum((np.bincount(f.ravel() >> 2, minlength=64) for f in frames), np.zeros(64, np.int64))
    h, w = frames[0].shape if frames else (0, 0)
    return f"{len(frames)}:{h}x{w}:{'-'.join(map(str, shots(frames)))}:{zlib.crc32(total.astype('<i8').tobytes()):08x}"


# --- operators ---------------------------------------------------------------------------
def to_media(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_bytes, media): each text as an AVI file. Null and empty texts are 64 zero bytes.

    Other columns are dropped, repeated rows stay, nothing is shuffled.
    """
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(slim.dtypes)["doc_id"]

    def run(frames):
        import pyarrow as pa

        schema = None
        for part in frames:
            schema = schema or pa.schema([("doc_id", part.schema.field("doc_id").type), ("n_bytes", pa.int64()), ("media", pa.binary())])
            for rows in batches([part], ["doc_id", "text"], 256):
                made = [(d, *(lambda n, p: (n, encode_payload(p)))(*payload_of(t))) for d, t in rows]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], schema.field(i).type) for i in range(3)], schema=schema)

    return slim.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, media binary")


def digests(media: DataFrame) -> DataFrame:
    """Decode every stored file and describe what was read: sizes, hashes, shot feature."""
    kind = dict(media.dtypes)["doc_id"]

    def run(frames):
        import pyarrow as pa

        for part in frames:
            types = [part.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            for rows in batches([part], ["doc_id", "n_bytes", "media"], 256):
                made = []
                for d, n, m in rows:
                    info, blocks = decode_blocks(m)
                    p = decode_payload(info, blocks)
                    made.append((d, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature(blocks)))
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)

    return media.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def clips(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """Timed clip rows of a media column: (id, clip, first_frame, n_frames, start_s, end_s, error).

    A null file gives no row; one that is no AVI or has a broken frame gives one row with
    ``error`` set and the other fields null, so bad files are seen and the job goes on.
    """
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media"))
    kind = dict(slim.dtypes)["doc_id"]

    def run(frames):
        import pyarrow as pa

        for part in frames:
            types = [part.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
            names = ["doc_id", "clip", "first_frame", "n_frames", "start_s", "end_s", "error"]
            for rows in batches([part], ["doc_id", "media"], 64):
                made = []
                for d, m in rows:
                    if m is None:
                        continue
                    try:
                        info, blocks = decode_blocks(m)
                    except (ValueError, KeyError, IndexError, struct.error) as e:
                        made.append((d, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                        continue
                    starts = [*shots(blocks), len(blocks)]
                    made += [(d, k, a, b - a, a / info["fps"], b / info["fps"], None) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)

    return slim.mapInArrow(run, f"doc_id {kind}, clip bigint, first_frame bigint, n_frames bigint, start_s double, end_s double, error string")
