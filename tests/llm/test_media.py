import hashlib
import subprocess
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import media as m
from quarry.llm import mjpeg as j


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=1500))
def test_round_trip(data):
    payload = m.payload_of(data)
    assert len(payload) % 192 == 0 and len(payload) > 0 and payload.startswith(data)
    ((_, samples),) = m._read([j.parse_avi(f) for f in m._stored([payload])])
    assert samples.tobytes() == payload


def test_frames_are_baseline_jpeg():
    """A decoder that knows nothing of how frames are written gives each byte as an even block."""
    draw = np.random.default_rng(2)
    samples = draw.integers(0, 256, (4, 192)).astype(np.uint8)
    for row, frame in zip(samples, j.frames_of(samples)):
        luma = j.decode_luma(frame)
        assert (luma == np.repeat(np.repeat(row.reshape(12, 16), 8, 0), 8, 1)).all()


def test_riff_structure():
    frames = j.frames_of(np.arange(384, dtype=np.uint8).reshape(2, 192))
    data = j.avi(frames)
    assert int.from_bytes(data[4:8], "little") == len(data) - 8
    movie = j.parse_avi(data)
    assert movie.frames == frames and movie.rate == 25
    without_index = data[: data.index(b"idx1")]
    assert j.parse_avi(without_index).frames == frames
    for bad in (b"", b"RIFF", data[4:]):
        with pytest.raises(ValueError):
            j.parse_avi(bad)


def test_shots():
    dark, light = np.zeros((1, 192), np.uint8), np.full((1, 192), 255, np.uint8)
    samples = np.concatenate([dark] * 20 + [light] * 20 + [dark] * 5)
    assert m.shots(m.histograms(samples)) == [(0, 20), (20, 40), (40, 45)]
    assert m.shots(m.histograms(samples[:0])) == [] and m.shots(m.histograms(dark)) == [(0, 1)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=8), st.integers(1, 9))
def test_parts_do_not_show(sizes, part):
    """Files coded and read in parts are those of one piece."""
    draw = np.random.default_rng(len(sizes))
    payloads = [draw.integers(0, 256, (n + 1) * 192).astype(np.uint8).tobytes() for n in sizes]
    before, m.PART = m.PART, part
    try:
        stored = list(m._stored(payloads))
        back = [b"".join(s.tobytes() for k, s in m._read([j.parse_avi(f) for f in stored]) if k == i) for i in range(len(stored))]
        counts = [m.histograms(np.frombuffer(p, np.uint8).reshape(-1, 192)) for p in payloads]
        cut = [m.shots(c) for c in counts]
    finally:
        m.PART = before
    assert back == payloads and cut == [m.shots(c) for c in counts]
    assert [bytes(f) for f in stored] == [j.avi(j.frames_of(np.frombuffer(p, np.uint8).reshape(-1, 192))) for p in payloads]


def test_clips(spark):
    samples = np.concatenate([np.zeros((30, 192), np.uint8), np.full((20, 192), 250, np.uint8)])
    frames = j.frames_of(samples)
    broken = [*frames[:10], b"", b"\xff\xd8\xff\xdb", *frames[12:]]
    rows = [(1, j.avi(frames)), (2, b"no media"), (3, None), (4, j.avi([])), (5, j.avi(broken)), (6, j.avi([b"", b"noise"]))]
    found = m.clips(spark.createDataFrame(rows, "doc_id long, media binary")).collect()
    none = (None,) * 5
    assert [tuple(r) for r in found] == [
        (1, 0, 0, 30, 0.0, 1.2, 0), (1, 1, 30, 50, 1.2, 2.0, 0), (2, *none, 0), (5, 0, 0, 30, 0.0, 1.2, 2), (5, 1, 30, 50, 1.2, 2.0, 0), (6, *none, 2),
    ]


def bare_frame(values, width, height, tables=b""):
    """A grey frame of even blocks in the typical Huffman tables, which it brings only if given."""
    dc, ac = ({symbol: key for key, symbol in j.typical_tables()[k].items()} for k in (0, 0x10))
    bits, last = "", 0
    for v in values:
        d, last = v - 128 - last, v - 128
        n = abs(d).bit_length()
        bits += format(dc[n][1], f"0{dc[n][0]}b") + (format(d if d >= 0 else d + (1 << n) - 1, f"0{n}b") if n else "") + format(ac[0][1], f"0{ac[0][0]}b")
    bits += "1" * (-len(bits) % 8)
    scan = int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\0")
    size = height.to_bytes(2, "big") + width.to_bytes(2, "big")
    return b"\xff\xd8\xff\xdb\0\x43\0" + bytes([8] * 64) + b"\xff\xc0\0\x0b\x08" + size + b"\x01\x01\x11\0" + tables + b"\xff\xda\0\x08\x01\x01\0\0\x3f\0" + scan + b"\xff\xd9"


def test_frames_without_tables():
    """Codes of the standard's typical tables, and a frame that relies on them."""
    t = j.typical_tables()
    assert [len(t[k]) for k in (0, 1, 0x10, 0x11)] == [12, 12, 162, 162]
    assert t[0][2, 0b00] == 0 and t[0][9, 0b111111110] == 11 and t[1][11, 0b11111111110] == 11
    assert t[0x10][4, 0b1010] == 0 and t[0x10][11, 0b11111111001] == 0xF0 and t[0x10][16, 0b1111111111111110] == 0xFA
    assert t[0x11][2, 0b00] == 0 and t[0x11][10, 0b1111111010] == 0xF0
    luma = j.decode_luma(bare_frame([7, 200, 128, 129, 255, 0], 24, 16))
    assert luma.shape == (16, 24) and luma[::8, ::8].tolist() == [[7, 200, 128], [129, 255, 0]]
    dark, light = bare_frame([3] * 4, 16, 16), bare_frame([240] * 4, 16, 16)
    assert m.clips_of(j.avi([dark] * 12 + [light] * 13, 16, 16)) == [(0, 0, 12, 0.0, 0.48, 0), (1, 12, 25, 0.48, 1.0, 0)]


@given(st.binary(max_size=60), st.integers(0, 400), st.integers(0, 255))
@settings(max_examples=200, deadline=None)
def test_damaged_files_have_rows(noise, at, byte):
    data = bytearray(j.avi([bare_frame([9, 9], 16, 8)] * 3, 16, 8))
    data[at % len(data)] = byte
    for broken in (bytes(data), bytes(data[:at]), noise, b"RIFF\0\0\0\0AVI " + noise):
        assert isinstance(m.clips_of(broken), list)


def test_further_segments_and_groups():
    """Frames of an AVIX segment follow the indexed ones; without an index those within groups are found; sound is left out."""
    frames = j.frames_of(np.arange(4 * 192, dtype=np.int64).astype(np.uint8).reshape(4, 192))
    chunk = j._chunk
    body = b"movi" + chunk(b"00dc", frames[2]) + chunk(b"01wb", b"sound") + chunk(b"LIST", b"rec " + chunk(b"00dc", frames[3]))
    data = j.avi(frames[:2]) + chunk(b"RIFF", b"AVIX" + chunk(b"LIST", body))
    assert j.parse_avi(data).frames == frames
    assert j.parse_avi(b"RIFF\0\0\0\0AVI " + chunk(b"LIST", body)).frames == frames[2:]


def test_memory_of_a_long_text():
    """64 MB of text take less than 1 GB beside what Python and its libraries need."""
    script = (
        "import resource, pyarrow as pa, random\n"
        "from quarry.llm import media as m\n"
        "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "text = random.Random(1).randbytes(64 << 10).translate(bytes(32 + i % 95 for i in range(256))) * 1024\n"
        "before, captured = peak(), []\n"
        "m.map_texts = lambda docs, run, *rest: captured.append(run)\n"
        "m.describe(None)\n"
        "row = captured[0](None, [text])\n"
        "assert row['n_bytes'] == [64 << 20] and row['payload_bytes'][0] >= 64 << 20\n"
        "print((peak() - before) >> 10)\n"
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1000


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = m.op4_media(spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        payload = m.payload_of(texts[r.doc_id].encode())
        assert (r.n_bytes, r.payload_bytes) == (len(texts[r.doc_id].encode()), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
        media = j.avi(j.frames_of(np.frombuffer(payload, np.uint8).reshape(-1, 192)))
        assert r.media_bytes == len(media) and r.media_sha256 == hashlib.sha256(media).hexdigest()


def test_messy(messy, empty):
    stored = m.store_texts(messy)
    back = {r.doc_id: r.text for r in m.restore_texts(stored).collect()}
    assert {r.doc_id: r.text or "" for r in messy.collect()} == back
    rows = m.describe(messy).collect()
    assert len(rows) == messy.count() and m.describe(empty).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].payload_sha256 == by_id[3].payload_sha256 == hashlib.sha256(b" " * 192).hexdigest() and by_id[2].n_bytes == 0
    assert by_id[1].media_sha256 == by_id[7].media_sha256 and by_id[1].feature == by_id[7].feature
