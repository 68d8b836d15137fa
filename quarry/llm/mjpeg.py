"""Bytes as motion-JPEG video in an AVI file, and back; any baseline motion-JPEG file's frames.

Storing: 192 bytes are a frame of 16 x 12 blocks of 8 x 8 pixels, each block even in one byte's value. Such a block has no other
coefficient than the mean, and with a quantiser of 8 that is the value less 128, so baseline JPEG keeps it exactly. The file is
RIFF with the lists ``hdrl`` and ``movi`` and the index ``idx1``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

COLUMNS, ROWS = 16, 12
FRAME = COLUMNS * ROWS
RATE = 25

#: Categories of differences by the length of their code, 1 bit and up: text has most differences of 3 to 7 bits.
DC_CODES = [[], [], [3, 4, 5, 6, 7], [2, 0], [1, 8]]
#: The only AC symbol that is used, the end of a block, has 1 bit.
AC_CODES = [[0]]
#: The most bits of a block: code, difference, end.
BLOCK_BITS = 14

# The zigzag order of coefficients.
ZIGZAG = [
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
]


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, codes: list[list[int]]) -> bytes:
    return bytes([kind, *(len(codes[i]) if i < len(codes) else 0 for i in range(16)), *(s for own in codes for s in own)])


HEAD = (
    b"\xff\xd8"
    + _segment(0xDB, bytes([0, *[8] * 64]))
    + _segment(0xC0, struct.pack(">BHHBBBB", 8, ROWS * 8, COLUMNS * 8, 1, 1, 0x11, 0))
    + _segment(0xC4, _table(0x00, DC_CODES) + _table(0x10, AC_CODES))
    + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
)


def huffman(codes: list[list[int]]) -> dict[tuple[int, int], int]:
    """(length, code) to symbol."""
    found, code = {}, 0
    for length, own in enumerate(codes, 1):
        for symbol in own:
            found[length, code] = symbol
            code += 1
        code <<= 1
    return found


@lru_cache(1)
def _writing() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of a block by its difference + 255."""
    dc = {symbol: key for key, symbol in huffman(DC_CODES).items()}
    codes, lengths = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        n = abs(d).bit_length()
        length, code = dc[n]
        codes[d + 255] = ((code << n) | (d if d >= 0 else d + (1 << n) - 1)) << 1
        lengths[d + 255] = length + n + 1
    return codes, lengths


@lru_cache(1)
def _reading() -> tuple[np.ndarray, np.ndarray]:
    """Difference and length of the block that begins with the given bits; length 0 if none does."""
    codes, lengths = _writing()
    difference, length = np.zeros(1 << BLOCK_BITS, np.int64), np.zeros(1 << BLOCK_BITS, np.int64)
    for i, (code, n) in enumerate(zip(codes.tolist(), lengths.tolist())):
        low = code << (BLOCK_BITS - n)
        difference[low : low + (1 << (BLOCK_BITS - n))] = i - 255
        length[low : low + (1 << (BLOCK_BITS - n))] = n
    return difference, length


def frames_of(samples: np.ndarray) -> list[bytes]:
    """JPEG files of the rows of ``samples`` (frames x FRAME, unsigned bytes)."""
    if not len(samples):
        return []
    codes, lengths = _writing()
    step = np.diff(samples.astype(np.int16), axis=1, prepend=np.int16(128)).ravel() + 255
    code, size = codes[step], lengths[step].reshape(samples.shape)
    bits = size.sum(axis=1)
    whole = (bits + 7) >> 3
    start = np.cumsum(whole) - whole
    at = (start[:, None] * 8 + np.cumsum(size, axis=1) - size).ravel()
    window = code << (24 - (at & 7) - size.ravel()).astype(np.uint32)
    place, total = at >> 3, int(whole.sum())
    stored = np.zeros(total + 3, np.int64)
    for i in range(3):
        stored += np.bincount(place + i, (window >> np.uint32(16 - 8 * i)) & np.uint32(255), total + 3).astype(np.int64)
    stored[start + whole - 1] += (1 << (whole * 8 - bits)) - 1  # the rest of the last byte is ones
    raw, ends = stored[:total].astype(np.uint8).tobytes(), (start + whole).tolist()
    return [HEAD + raw[a:b].replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for a, b in zip(start.tolist(), ends)]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi(frames: list[bytes], width: int = COLUMNS * 8, height: int = ROWS * 8, rate: int = RATE) -> bytes:
    """An AVI file of JPEG frames."""
    return bytes(avi_of([frames], width, height, rate))


def avi_of(parts: Iterable[list[bytes]], width: int = COLUMNS * 8, height: int = ROWS * 8, rate: int = RATE) -> bytearray:
    """An AVI file of JPEG frames that come in parts, of which one is held beside the file. A file has less than 4 GiB."""
    out = bytearray(_front(0, 0, 0, 0, width, height, rate))
    front, own = len(out), []
    for frames in parts:
        own.append(np.fromiter(map(len, frames), np.int64, len(frames)))
        for frame in frames:
            out += _chunk(b"00dc", frame)
    sizes = np.concatenate(own) if own else np.empty(0, np.int64)
    movie = len(out) - front + 4
    index = np.zeros((len(sizes), 4), "<u4")
    index[:, 0] = int.from_bytes(b"00dc", "little")
    index[:, 1] = 0x10  # a key frame
    index[:, 2] = 4 + np.cumsum(sizes + (sizes & 1) + 8) - (sizes + (sizes & 1) + 8)
    index[:, 3] = sizes
    out += _chunk(b"idx1", index.tobytes())
    out[:front] = _front(len(sizes), int(sizes.max(initial=0)), movie, len(out) - 8, width, height, rate)
    return out


def _front(n: int, largest: int, movie: int, whole: int, width: int, height: int, rate: int) -> bytes:
    """The file up to its first frame: ``n`` frames, ``movie`` bytes in the list of frames, ``whole`` in the file."""
    main = struct.pack("<14I", 1_000_000 // rate, largest * rate, 0, 0x10, n, 0, 1, largest, width, height, 0, 0, 0, 0)
    stream = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, rate, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, width, height)
    picture = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", picture)))
    return b"RIFF" + struct.pack("<I", whole) + b"AVI " + header + b"LIST" + struct.pack("<I", movie) + b"movi"


@dataclass
class Movie:
    """A file's frames per second, and where in its bytes its frames are."""

    rate: float
    data: bytes | bytearray
    places: np.ndarray  # start and size of each frame

    @property
    def frames(self) -> list[bytes]:
        return [frame for part in self.parts(len(self.places) or 1) for frame in part]

    def parts(self, most: int) -> Iterator[list[bytes]]:
        """The frames in lists of up to ``most``."""
        for i in range(0, len(self.places), most):
            yield [bytes(self.data[at : at + size]) for at, size in self.places[i : i + most].tolist()]


def _chunks(data: bytes, start: int, end: int):
    while start + 8 <= end:
        size = int.from_bytes(data[start + 4 : start + 8], "little")
        yield bytes(data[start : start + 4]), start + 8, min(size, end - start - 8)
        start += 8 + size + (size & 1)


def _header(data: bytes, start: int, end: int) -> tuple[float, int]:
    """Frames per second, and the number of the first video stream."""
    rate, video, streams = float(RATE), None, 0
    for name, at, size in _chunks(data, start, end):
        if name == b"avih" and size >= 4 and (each := int.from_bytes(data[at : at + 4], "little")):
            rate = 1e6 / each
        elif name == b"LIST" and data[at : at + 4] == b"strl":
            kinds = [data[a : a + 4] for inner, a, _ in _chunks(data, at + 4, at + size) if inner == b"strh"]
            if video is None and b"vids" in kinds:
                video = streams
            streams += 1
    return rate, video or 0


def _in_movie(data: bytes, start: int, end: int, names: tuple[bytes, ...]) -> Iterator[tuple[int, int]]:
    """Start and size of the named chunks of a list of frames, those in its groups included."""
    for name, at, size in _chunks(data, start, end):
        if name in names:
            yield at, size
        elif name == b"LIST" and data[at : at + 4] == b"rec ":
            yield from _in_movie(data, at + 4, at + size, names)


def parse_avi(data: bytes) -> Movie:
    """The frames of the first video stream, by ``idx1``, or by the chunks of ``movi`` where there is no index. Those of further
    ``AVIX`` segments, which ``idx1`` does not list, follow.

    Raises ValueError if the bytes are no AVI file.
    """
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    rate, video, movi, index, further = float(RATE), 0, None, None, []
    for name, at, size in _chunks(data, 12, len(data)):
        kind = data[at : at + 4]
        if name == b"LIST" and kind == b"hdrl":
            rate, video = _header(data, at + 4, at + size)
        elif name == b"LIST" and kind == b"movi" and movi is None:
            movi = (at, size)
        elif name == b"idx1" and index is None:
            index = np.frombuffer(data, "<u4", size // 16 * 4, at).reshape(-1, 4).astype(np.int64)
        elif name == b"RIFF" and kind == b"AVIX":
            further += [(a, n) for inner, a, n in _chunks(data, at + 4, at + size) if inner == b"LIST" and data[a : a + 4] == b"movi"]
    names = tuple(b"%02d%s" % (video, kind) for kind in (b"dc", b"db"))
    places = np.empty((0, 2), np.int64)
    if movi is not None and index is not None:
        places = index[np.isin(index[:, 0], [int.from_bytes(n, "little") for n in names])][:, 2:]
        if len(places):
            # Offsets count from the list's name, or from the file's start in some files.
            first = movi[0] + int(places[0, 0])
            places = places + [(movi[0] if data[first : first + 4] in names else 0) + 8, 0]
    elif movi is not None:
        further.insert(0, movi)
    listed = [np.array(list(_in_movie(data, a + 4, a + n, names)), np.int64).reshape(-1, 2) for a, n in further]
    return Movie(rate, data, np.concatenate([places, *listed]))


def read_frames(frames: list[bytes]) -> np.ndarray:
    """The samples (frames x FRAME) of frames as ``frames_of`` writes them, all decoded step by step together."""
    if not frames:
        return np.empty((0, FRAME), np.uint8)
    if not all(f.startswith(HEAD) for f in frames):
        raise ValueError("not a stored frame")
    coded = [f[len(HEAD) : -2].replace(b"\xff\x00", b"\xff") for f in frames]
    sizes = np.array([len(c) for c in coded], np.int64)
    raw = np.frombuffer(b"".join(coded) + b"\0\0\0", np.uint8).astype(np.uint32)
    window = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    difference, length = _reading()
    at = (np.cumsum(sizes) - sizes) * 8
    value = np.full(len(frames), 128, np.int64)
    out = np.empty((FRAME, len(frames)), np.uint8)
    for i in range(FRAME):
        bits = (window[at >> 3] >> (24 - BLOCK_BITS - (at & 7)).astype(np.uint32)) & np.uint32((1 << BLOCK_BITS) - 1)
        value += difference[bits]
        at += length[bits]
        out[i] = value
    return np.ascontiguousarray(out.T)


# --- any baseline frame


# How many codes of 1, 2, ... bits the typical Huffman tables of the JPEG standard have, and the symbols of the AC tables in
# the order of their codes, up to those of 16 bits. These are all other symbols, in ascending order.
DC_COUNTS = [[0, 1, 5, 1, 1, 1, 1, 1, 1], [0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1]]
AC_COUNTS = [[0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125], [0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119]]
AC_FIRST = [
    "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82",
    "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1",
]


@lru_cache(1)
def typical_tables() -> dict[int, dict[tuple[int, int], int]]:
    """The tables of frames that bring none, as motion-JPEG frames often do: by class (0x10: AC) and number."""
    every = {0x00, 0xF0, *(run << 4 | size for run in range(16) for size in range(1, 11))}
    found = {}
    for i in range(2):
        first = list(bytes.fromhex(AC_FIRST[i]))
        for kind, counts, symbols in ((i, DC_COUNTS[i], list(range(12))), (0x10 | i, AC_COUNTS[i], first + sorted(every - set(first)))):
            ends = np.cumsum(counts).tolist()
            found[kind] = huffman([symbols[b - n : b] for n, b in zip(counts, ends)])
    return found


def decode_luma(data: bytes) -> np.ndarray:
    """The first component (height x width, unsigned bytes) of a baseline JPEG frame, symbol by symbol. ValueError if it is none.

    A frame without Huffman tables has the typical ones.
    """
    try:
        return _luma(data)
    except (IndexError, KeyError, struct.error) as fault:
        raise ValueError("a broken frame") from fault


def _luma(data: bytes) -> np.ndarray:
    tables = dict(typical_tables())
    quantisers: dict[int, np.ndarray] = {}
    parts, shape, interval, at = [], (0, 0), 0, 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a frame without a scan")
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                values = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1)
                quantisers[body[0] & 15], body = values.astype(np.int64), body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                counts, kind, symbols = body[1:17], body[0], body[17:]
                codes = []
                for n in counts:
                    codes.append(list(symbols[:n]))
                    symbols = symbols[n:]
                tables[kind], body = huffman(codes), symbols
        elif marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker in (0xC0, 0xC1):
            shape = struct.unpack(">HH", body[1:5])
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
        elif marker == 0xDA:
            scan = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            break
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a baseline frame")
    if not parts or 0 in shape or any(0 in p[1:3] for p in parts):
        raise ValueError("a frame without samples")
    wide, high = max(p[1] for p in parts), max(p[2] for p in parts)
    across, down = -(-shape[1] // (8 * wide)), -(-shape[0] // (8 * high))
    if len(parts) == 1:
        parts = [(parts[0][0], 1, 1, parts[0][3])]
        across, down = -(-shape[1] // 8), -(-shape[0] // 8)
        wide = high = 1
    if across * down > 4 * (len(data) - at):  # a block has two bits at least
        raise ValueError("a frame larger than its scan")
    reader = _Bits(data, at)
    blocks = np.zeros((down * parts[0][2], across * parts[0][1], 64))
    last = [0] * len(parts)
    for unit in range(across * down):
        if interval and unit and unit % interval == 0:
            reader.restart()
            last = [0] * len(parts)
        for c, (name, h, v, q) in enumerate(parts):
            for i in range(h * v):
                dc, ac = tables[scan[name] >> 4], tables[0x10 | scan[name] & 15]
                last[c] += reader.signed(reader.symbol(dc))
                values, k = {0: last[c]}, 1
                while k < 64:
                    run, n = divmod(reader.symbol(ac), 16)
                    if n == 0 and run < 15:
                        break
                    k += run
                    if n and k < 64:
                        values[k] = reader.signed(n)
                    k += 1
                if c == 0:
                    place = blocks[unit // across * v + i // h, unit % across * h + i % h]
                    for k, value in values.items():
                        place[ZIGZAG[k]] = value * quantisers[q][k]
    x, u = np.arange(8), np.arange(8)
    cosine = np.cos((2 * x[:, None] + 1) * u[None] * np.pi / 16) * np.where(u, 0.5, 0.125**0.5)
    pixels = np.einsum("xu,hwuv,yv->hxwy", cosine, blocks.reshape(*blocks.shape[:2], 8, 8), cosine)
    flat = np.clip(np.rint(pixels + 128), 0, 255).astype(np.uint8).reshape(blocks.shape[0] * 8, -1)
    # The first component may itself be sampled more thinly than others.
    return flat[: -(-shape[0] * parts[0][2] // high), : -(-shape[1] * parts[0][1] // wide)]


class _Bits:
    """Bits of a scan, without stuffed bytes."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.held, self.n = data, at, 0, 0

    def bit(self) -> int:
        if not self.n:
            byte = self.data[self.at] if self.at < len(self.data) else 0
            self.at += 2 if byte == 0xFF and self.data[self.at + 1 : self.at + 2] == b"\0" else 1
            self.held, self.n = byte, 8
        self.n -= 1
        return self.held >> self.n & 1

    def symbol(self, table: dict) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.bit()
            if (symbol := table.get((length, code))) is not None:
                return symbol
        raise ValueError("no such code")

    def signed(self, n: int) -> int:
        value = 0
        for _ in range(n):
            value = value << 1 | self.bit()
        return value if not n or value >> (n - 1) else value - (1 << n) + 1

    def restart(self) -> None:
        self.n = 0
        self.at += 2
