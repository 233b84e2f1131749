"""Audio features of 8-bit recordings, kept as fixed-shape Arrow tensors with time spans.

A recording is stored losslessly as a RIFF/WAVE file of unsigned 8-bit mono samples. What
is read back is resampled by a polyphase filter (8 kHz to 16/3 kHz: up 2, down 3), cut into
overlapped Hann windows, turned into log-mel energies, and segmented by hysteresis on the
frame energies: a segment opens above the upper level and closes below the lower one. The
log-mel frames are dealt into patches of a fixed shape, the last one padded with its floor,
each with the time span it covers.

All steps see whole recordings; samples are converted, resampled and turned into frames in
blocks, so memory doesn't grow with a recording's length beyond its bytes and its features.

Defined results: a null or empty payload is stored as the least padded payload; equal
payloads have equal values; repeated rows repeat; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodegrain.llm import common

RATE = 8000
UP, DOWN, TAPS = 2, 3, 24
WINDOW, HOP, BANDS = 256, 128, 24
PATCH = (32, BANDS)
#: Frames computed at once.
BLOCK = 2048


def to_wav(samples: bytes, rate: int = RATE) -> bytes:
    """A RIFF/WAVE file of unsigned 8-bit mono samples."""
    pad = b"\0" * (len(samples) % 2)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + samples + pad


def from_wav(media: bytes) -> tuple[bytes, int]:
    """(samples, rate) of an 8-bit mono file, found by its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("only 8-bit mono samples are read")
        elif name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


@cache
def phases() -> np.ndarray:
    """One row of filter taps for each output phase, over the same window of input samples."""
    reach = np.arange(TAPS) - TAPS // 2 + 1
    rows = []
    for p in range(UP):
        t = reach - p * DOWN / UP
        cutoff = UP / DOWN
        taps = cutoff * np.sinc(cutoff * t) * (0.5 + 0.5 * np.cos(np.clip(t / (TAPS // 2), -1, 1) * np.pi))
        rows.append(taps / taps.sum())
    return np.array(rows, np.float32)


@cache
def mel_bank() -> np.ndarray:
    """Triangular filters, equally spaced in mel, over the bins of a window's spectrum."""
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), BANDS + 2) / 2595) - 1)
    bins = np.arange(WINDOW // 2 + 1) * rate / WINDOW
    rise = (bins[:, None] - edges[None, :-2]) / np.diff(edges)[None, :-1]
    fall = (edges[None, 2:] - bins[:, None]) / np.diff(edges)[None, 1:]
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def resample(samples: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Polyphase: each block of DOWN inputs gives UP outputs, one for each row of taps.

    Blocks ``first`` to ``last`` of a recording (8-bit samples, or numbers as they are) are resampled.
    """
    last = -(-len(samples) // DOWN) if last is None else last
    a, b = first * DOWN - (TAPS // 2 - 1), last * DOWN + TAPS
    part = samples[max(0, a) : max(0, b)]
    part = (part.astype(np.float32) - 128) / 128 if samples.dtype == np.uint8 else part
    padded = np.pad(part, (max(0, -a), max(0, b - max(0, a) - len(part))))
    blocks = np.lib.stride_tricks.sliding_window_view(padded, TAPS)[: (last - first) * DOWN : DOWN]
    return (blocks @ phases().T).ravel()


def log_mel(samples: np.ndarray) -> np.ndarray:
    """(frames, BANDS) log10 energies of overlapped windows of the resampled recording; a short one is one padded frame."""
    inputs = -(-len(samples) // DOWN)
    n = max(1, 1 + (inputs * UP - WINDOW) // HOP)
    hann = np.hanning(WINDOW + 1)[:-1].astype(np.float32)
    out = np.empty((n, BANDS), np.float32)
    for at in range(0, n, BLOCK):
        end = min(at + BLOCK, n)
        signal = resample(samples, at * HOP // UP, min(inputs, ((end - 1) * HOP + WINDOW) // UP))
        signal = np.pad(signal, (0, max(0, WINDOW - len(signal))))
        frames = np.lib.stride_tricks.sliding_window_view(signal, WINDOW)[::HOP][: end - at]
        power = np.abs(np.fft.rfft(frames * hann, axis=1)) ** 2
        out[at:end] = np.log10(power.astype(np.float32) @ mel_bank() + 1e-6)
    return out


def segments(energy: np.ndarray, upper: float = 0.5, lower: float = 0.25) -> list[tuple[int, int]]:
    """Frame ranges that open at ``upper`` and close below ``lower``, as shares of the energy's range."""
    low, high = float(energy.min()), float(energy.max())
    if high - low < 1e-6:
        return [(0, len(energy))]
    level = (energy - low) / (high - low)
    # The last frame that decided holds: 1 after one above the upper level, 0 after one below the lower.
    decided = np.where(level >= upper, 1, np.where(level < lower, 0, -1))
    last = np.maximum.accumulate(np.where(decided >= 0, np.arange(len(level)), 0))
    active = np.concatenate([[0], (decided[last] == 1).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(active))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def features(samples: bytes, rate: int = RATE) -> tuple[np.ndarray, np.ndarray, list[tuple[float, float]]]:
    """(patches, their time spans, active time spans) of a recording."""
    mel = log_mel(np.frombuffer(samples, np.uint8))
    step = HOP * DOWN / UP / rate
    active = [(a * step, b * step) for a, b in segments(mel.mean(1))]
    n = -(-len(mel) // PATCH[0])
    padded = np.full((n * PATCH[0], BANDS), mel.min(), np.float32)
    padded[: len(mel)] = mel
    spans = np.array([(i * PATCH[0] * step, min((i + 1) * PATCH[0], len(mel)) * step) for i in range(n)], np.float64)
    return padded.reshape(n, *PATCH), spans, active


def tensor_column(patches: np.ndarray) -> pa.ExtensionArray:
    """Patches as a fixed-shape tensor column."""
    return pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(patches))


def tensor_batch(patches: np.ndarray, spans: np.ndarray, active: list[tuple[float, float]] = ()) -> pa.RecordBatch:
    """Patches with the seconds that each covers; the active time spans go with the schema."""
    batch = pa.RecordBatch.from_arrays([tensor_column(patches), pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["log_mel", "t_start", "t_end"])
    return batch.replace_schema_metadata({"active": json.dumps([list(x) for x in active])})


def pack_tensors(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack_tensors(stream: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(patches, their time spans) of a tensor batch written as a stream."""
    batch = pa.ipc.open_stream(stream).read_next_batch()
    return batch.column(0).to_numpy_ndarray(), np.column_stack([batch.column(1), batch.column(2)])


def unpack_active(stream: bytes) -> list[tuple[float, float]]:
    """The active time spans of a tensor batch written as a stream."""
    return [tuple(x) for x in json.loads(pa.ipc.open_stream(stream).schema.metadata[b"active"])]


def payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with spaces to a positive multiple of 192, and their size before."""
    raw = (text or "").encode("utf-8")
    return raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw)), len(raw)


def summary(patches: np.ndarray, active: list[tuple[float, float]]) -> str:
    """A short description of the features, rounded so that it is stable."""
    mel = patches.astype(np.float64)
    return f"patches={len(patches)};segments={len(active)};active={sum(b - a for a, b in active):.3f};mean={mel.mean():.3f};sd={mel.std():.3f}"


def feature(samples: bytes, rate: int) -> str:
    """The summary of a recording's tensors and time spans, as they are read back from their stream."""
    stored = pack_tensors(tensor_batch(*features(samples, rate)))
    patches, spans = unpack_tensors(stored)
    if len(spans) != len(patches):
        raise ValueError("every tensor has its time span")
    return summary(patches, unpack_active(stored))


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's payload stored as a recording, read back and described."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body, size = payload(text)
                media = to_wav(body)
                back, rate = from_wav(media)
                rows.append((doc_id, size, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(back, rate)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)

    return common.map_batches(common.texts(docs, id_col, text_col), run, SCHEMA)


TENSORS = "doc_id long, tensors binary, active array<struct<t_start:double,t_end:double>>"


def extract(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """From recordings (binary), the tensor batches as Arrow streams and the active time spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("t_start", pa.float64()), ("t_end", pa.float64())]))
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                samples, rate = from_wav(body if body is not None else to_wav(payload(None)[0]))
                patches, spans, active = features(samples or b"\x80", rate)
                row = [{"t_start": a, "t_end": b} for a, b in active]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([pack_tensors(tensor_batch(patches, spans, active))], pa.binary()), pa.array([row], kind)], ["doc_id", "tensors", "active"])

    return common.map_batches(media.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{media_col}` media"), run, TENSORS)


NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
TYPES = [pa.string() if f.endswith("string") else pa.int64() for f in SCHEMA.split(", ")]
