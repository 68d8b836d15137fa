"""Media columns: AVI motion-JPEG. Texts stored as video without loss, and timed clips between shot changes."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_texts, slices, table
from .mjpeg import FRAME, Movie, avi, avi_of, decode_luma, frames_of, parse_avi, read_frames

BINS = 16
#: Frames that are written, read or compared together (1.5 MB of text).
PART = 1 << 13


def payload_of(text: bytes | None) -> bytes:
    """The text's bytes with blanks up to a positive multiple of 192."""
    text = text or b""
    return text + b" " * ((-len(text)) % FRAME or (0 if text else FRAME))


def histograms(samples: np.ndarray) -> np.ndarray:
    """Counts of the samples of each frame (row) in 16 bins."""
    place = (np.arange(len(samples)) * BINS)[:, None] + (samples >> 4)
    return np.bincount(place.ravel(), minlength=len(samples) * BINS).reshape(-1, BINS)


def _steps(counts: np.ndarray) -> np.ndarray:
    """The difference of each frame's histogram to the one before."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True, dtype=np.int64), 1)
    return np.abs(np.diff(share, axis=0)).sum(axis=1) / 2


def shots(counts: np.ndarray, reach: int = 8, spread: float = 2.0, least: float = 0.25) -> list[tuple[int, int]]:
    """Shots (first frame, end frame) from the frames' histograms.

    A shot begins where the difference to the frame before (half the sum of absolute differences, as a share of the samples) is at
    least ``least`` and exceeds the mean of the differences up to ``reach`` frames around it by ``spread`` standard deviations.
    """
    n = len(counts)
    if n < 2:
        return [(0, n)] if n else []
    step = np.concatenate([_steps(counts[i : i + PART + 1]) for i in range(0, n - 1, PART)])
    sums = np.concatenate([[0], np.cumsum(step)])
    squares = np.concatenate([[0], np.cumsum(step * step)])
    low, high = np.maximum(np.arange(n - 1) - reach, 0), np.minimum(np.arange(n - 1) + reach + 1, n - 1)
    mean = (sums[high] - sums[low]) / (high - low)
    deviation = np.sqrt(np.maximum((squares[high] - squares[low]) / (high - low) - mean * mean, 0))
    starts = [0, *(np.flatnonzero((step >= least) & (step > mean + spread * deviation)) + 1).tolist()]
    return list(zip(starts, [*starts[1:], n]))


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each row's whole text as an AVI file. Null and empty texts are one frame of blanks."""

    def run(_, texts):
        payloads = [payload_of(t) for t in texts]
        return {"n_bytes": [len(t or b"") for t in texts], "media": [bytes(m) for m in _stored(payloads)]}

    return map_texts(docs, run, "n_bytes long, media binary", id_col, text_col)


def _together(sizes: list[int], most: int = PART) -> Iterator[slice]:
    """Runs of files with up to ``most`` frames, or one file."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield slice(start, len(sizes))


def _stored(payloads: list[bytes]) -> Iterator[bytes | bytearray]:
    """The file of each payload; short ones are coded together, long ones part by part."""
    for run in _together([len(p) // FRAME for p in payloads]):
        own = payloads[run]
        samples = np.frombuffer(own[0] if len(own) == 1 else b"".join(own), np.uint8).reshape(-1, FRAME)
        if len(own) == 1:
            yield avi_of(frames_of(samples[i : i + PART]) for i in range(0, len(samples), PART))
            continue
        frames, ends = frames_of(samples), np.cumsum([len(p) // FRAME for p in own]).tolist()
        yield from (avi(frames[a:b]) for a, b in zip([0, *ends], ends))


def _read(movies: list[Movie]) -> Iterator[tuple[int, np.ndarray]]:
    """The samples of the stored files, in order: file number, some of its frames. Short files are decoded together, long ones part by part."""
    sizes = [len(m.places) for m in movies]
    for run in _together(sizes):
        first, own = run.start, movies[run]
        if len(own) == 1:
            yield from ((first, read_frames(part)) for part in own[0].parts(PART))
            continue
        samples = read_frames([f for m in own for f in m.frames])
        yield from enumerate(np.split(samples, np.cumsum(sizes[run])[:-1]), first)


def restore_texts(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, text: what ``store_texts`` stored; a null text comes back empty, null media as a null text."""
    source = stored.select(F.col(id_col).alias("doc_id"), "n_bytes", "media")

    def run(batches):
        for part in slices(batches, 2):
            found = [None if m is None else bytearray() for m in part.column(2).to_pylist()]
            given = [i for i, f in enumerate(found) if f is not None]
            for i, samples in _read([parse_avi(part.column(2)[i].as_py()) for i in given]):
                found[given[i]] += samples.tobytes()
            texts = [f if f is None else f[:n].decode() for f, n in zip(found, part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return source.mapInArrow(run, "doc_id long, text string")


def clips(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", **options) -> DataFrame:
    """A row for each shot of each AVI file: doc_id, clip, first_frame, end_frame, start_s, end_s, n_unread.

    Any baseline motion-JPEG stream is read. A frame that cannot be decoded, an empty one for example, shows what the frame before
    shows (the first such frames nothing) and counts in ``n_unread``. A file that is no AVI file, or none of whose frames can be
    decoded, has one row with a null clip. Null files and files without frames have no rows.
    """
    source = media.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media"))
    schema = pa.schema([*((n, pa.int64()) for n in ("doc_id", "clip", "first_frame", "end_frame")), ("start_s", pa.float64()), ("end_s", pa.float64()), ("n_unread", pa.int64())])

    def run(batches):
        for part in slices(batches, 1):
            rows = []
            for doc_id, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if data is not None:
                    rows += [(doc_id, *clip) for clip in clips_of(data, **options)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], field.type) for i, field in enumerate(schema)], schema=schema)

    return source.mapInArrow(run, "doc_id long, clip long, first_frame long, end_frame long, start_s double, end_s double, n_unread long")


def clips_of(data: bytes, **options) -> list[tuple]:
    """The rows of one file, see ``clips``."""
    try:
        movie = parse_avi(data)
    except ValueError:
        return [(None, None, None, None, None, 0)]
    counts, unread = np.zeros((len(movie.places), BINS), np.int32), np.zeros(len(movie.places), bool)
    at = 0
    for frames in movie.parts(PART):
        try:
            counts[at : at + len(frames)] = histograms(read_frames(frames))
        except (ValueError, IndexError):
            for i, frame in enumerate(frames, at):
                try:
                    counts[i] = np.bincount(decode_luma(frame).ravel() >> 4, minlength=BINS)
                except ValueError:
                    counts[i], unread[i] = counts[i - 1] if i else 0, True
        at += len(frames)
    if len(unread) and unread.all():
        return [(None, None, None, None, None, len(unread))]
    return [(i, a, b, a / movie.rate, b / movie.rate, int(unread[a:b].sum())) for i, (a, b) in enumerate(shots(counts, **options))]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored, read back from the stored bytes, and described: doc_id, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature (frames, then the frames at which shots begin), clips (start-end of each shot in
    seconds).

    A text is held with its file and the histograms of its frames; all else is of ``PART`` frames.
    """

    def run(_, texts):
        movies = [parse_avi(m) for m in _stored([payload_of(t) for t in texts])]
        sums, n_bytes, tails, parts = [hashlib.sha256() for _ in movies], [0] * len(movies), [b""] * len(movies), [[] for _ in movies]
        for i, samples in _read(movies):
            back = samples.tobytes()
            sums[i].update(back)
            n_bytes[i] += len(back)
            tails[i] = back[-16:]
            parts[i].append(histograms(samples).astype(np.uint8))  # a frame has 192 samples
        found = [shots(np.concatenate(p)) for p in parts]
        return {
            "n_bytes": [len(t or b"") for t in texts],
            "payload_bytes": n_bytes,
            "payload_sha256": [s.hexdigest() for s in sums],
            "tail_crc32": [zlib.crc32(t) for t in tails],
            "media_bytes": [len(m.data) for m in movies],
            "media_sha256": [hashlib.sha256(m.data).hexdigest() for m in movies],
            "feature": [f"{len(m.places)}:" + ",".join(str(a) for a, _ in own) for m, own in zip(movies, found)],
            "clips": [",".join(f"{a / m.rate:.2f}-{b / m.rate:.2f}" for a, b in own) for m, own in zip(movies, found)],
        }

    schema = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips string"
    return map_texts(docs, run, schema, id_col, text_col)


def op4_media(spark, sf_dir) -> DataFrame:
    """All ``documents`` as AVI motion-JPEG, described from what is read back."""
    return describe(table(spark, sf_dir, "documents"))
