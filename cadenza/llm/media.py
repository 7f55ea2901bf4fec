"""Media columns: 8-bit PCM payloads, polyphase resampling, log-mel tensors, energy segments.

A text's UTF-8 bytes, zero-padded to a positive multiple of 64, are the samples of a mono
8-bit WAV. The WAVs are written as a Parquet media column and read back before any feature
is computed. Features are stored in their turn: per row an Arrow stream of fixed-shape float16
tensors with the time span of each, and energy segments in seconds; they are read back too. Each
row is processed alone, so memory is bounded by the longest document and equal texts give equal
values.

Defined results: a null or empty text gives 64 zero samples; a null doc_id stays null;
repeated rows give repeated results; an empty table gives an empty table; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_docs, spread, written

RATE, UP, DOWN, TAPS = 16_000, 5, 8, 12
FRAME, HOP, MELS, FRAMES_PER_TENSOR = 256, 128, 40, 32
HIGH_DB, LOW_DB = 1.0, -1.0
HEADER = struct.Struct("<4sI4s4sIHHIIHH4sI")


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    return HEADER.pack(b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload


def from_wav(media: bytes) -> tuple[bytes, int]:
    """(samples, rate) of a mono 8-bit WAV."""
    head = HEADER.unpack_from(media)
    if head[0] != b"RIFF" or head[2] != b"WAVE" or head[6] != 1 or head[10] != 8 or len(media) < HEADER.size + head[12]:
        raise ValueError("not a mono 8-bit WAV")
    return media[HEADER.size : HEADER.size + head[12]], head[7]


def polyphase_bank(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """Row p: the taps of a windowed-sinc low-pass that meet the input at phase p."""
    n = np.arange(up * taps) - (up * taps - 1) / 2
    h = np.sinc(n / max(up, down)) * np.hamming(up * taps)
    bank = h.reshape(taps, up).T
    return (bank / bank.sum(axis=1, keepdims=True)).astype(np.float32)


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, bank: np.ndarray | None = None) -> np.ndarray:
    """Rational resampling: one strided product per phase, no zero stuffing."""
    bank = polyphase_bank(up, down) if bank is None else bank
    taps = bank.shape[1]
    n_out = -(-len(x) * up // down)
    left = taps // 2
    padded = np.concatenate([np.zeros(left, np.float32), x, np.zeros(taps + 1, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, taps)
    out = np.empty(n_out, np.float32)
    for first in range(min(up, n_out)):
        at = first * down
        count = len(out[first::up])
        out[first::up] = windows[at // up :: down][:count] @ bank[at % up][::-1]
    return out


def mel_bank(rate: float, n_fft: int = FRAME, mels: int = MELS) -> np.ndarray:
    """Triangular filters, equally spaced on the mel scale."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), mels + 2) / 2595) - 1)
    bins = np.fft.rfftfreq(n_fft, 1 / rate)
    rise = (bins[None] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - bins[None]) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


class Features:
    """Filter tables, made once per task."""

    def __init__(self) -> None:
        self.bank = polyphase_bank()
        self.rate = RATE * UP / DOWN
        self.window = np.hanning(FRAME + 1)[:-1].astype(np.float32)
        self.mel = np.ascontiguousarray(mel_bank(self.rate).T)

    def log_mel(self, samples: bytes) -> np.ndarray:
        """[frames, mels] in float32; frames overlap by half, the last one is zero-padded."""
        x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
        y = resample(x, bank=self.bank)
        frames = max(1, -(-(len(y) - FRAME) // HOP) + 1)
        y = np.concatenate([y, np.zeros((frames - 1) * HOP + FRAME - len(y), np.float32)])
        view = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
        out = np.empty((frames, MELS), np.float32)
        for at in range(0, frames, 2048):
            spectrum = np.fft.rfft(view[at : at + 2048] * self.window)
            power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
            out[at : at + 2048] = np.log(power @ self.mel + np.float32(1e-6))
        return out

    def segments(self, log_mel: np.ndarray) -> np.ndarray:
        """[n, 2] frame spans: runs above the low threshold that reach the high one (dB from the median)."""
        energy = 10 * np.log10(np.exp(log_mel.astype(np.float64)).sum(axis=1))
        energy -= np.median(energy)
        on = np.concatenate([[False], energy >= LOW_DB, [False]])
        edges = np.flatnonzero(on[1:] != on[:-1]).reshape(-1, 2)
        strong = np.concatenate([[0], np.cumsum(energy >= HIGH_DB)])
        return edges[strong[edges[:, 1]] > strong[edges[:, 0]]]

    def tensors(self, log_mel: np.ndarray) -> pa.RecordBatch:
        """Fixed-shape float16 tensors of FRAMES_PER_TENSOR x MELS with the time span each one covers; the last is zero-padded."""
        n = -(-len(log_mel) // FRAMES_PER_TENSOR)
        padded = np.zeros((n * FRAMES_PER_TENSOR, MELS), np.float16)
        padded[: len(log_mel)] = log_mel
        kind = pa.fixed_shape_tensor(pa.float16(), [FRAMES_PER_TENSOR, MELS])
        storage = pa.FixedSizeListArray.from_arrays(pa.array(padded.reshape(-1)), FRAMES_PER_TENSOR * MELS)
        start = np.arange(n) * FRAMES_PER_TENSOR
        end = np.minimum(start + FRAMES_PER_TENSOR, len(log_mel))
        seconds = lambda frame: frame * HOP / self.rate
        return pa.record_batch(
            [pa.ExtensionArray.from_storage(kind, storage), pa.array(seconds(start)), pa.array(seconds(end)), pa.array(end - start)],
            names=["log_mel", "start_s", "end_s", "frames"],
        )


def encode_media(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every text as a WAV."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                sizes.append(len(text))
                media.append(to_wav(text + bytes(-len(text) % 64 or (0 if text else 64))))
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return spread(plain_docs(documents)).mapInArrow(encode, "doc_id long, n_bytes long, media binary")


def store_media(documents: DataFrame) -> DataFrame:
    """The media column, written to the shared folder and read back."""
    return written(encode_media(documents), "media")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tensors binary, segments array<struct<start_s:double,end_s:double>>"
SPANS = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))


def media_features(media: DataFrame) -> DataFrame:
    """FEATURES of every stored medium: what was read back of it, an Arrow IPC stream of log-mel tensors, energy spans in seconds."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Features()
        for batch in batches:
            rows = []
            for doc_id, n_bytes, stored in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media")), strict=True):
                samples = from_wav(stored)[0]
                log_mel = tools.log_mel(samples)
                sink, table = pa.BufferOutputStream(), tools.tensors(log_mel)
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_batch(table)
                spans = [{"start_s": a * HOP / tools.rate, "end_s": b * HOP / tools.rate} for a, b in tools.segments(log_mel).tolist()]
                rows.append((doc_id, n_bytes, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), sink.getvalue().to_pybytes(), spans))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), SPANS]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FEATURES.split(", ")])

    return media.mapInArrow(features, FEATURES)


def store_features(media: DataFrame) -> DataFrame:
    """The feature columns, written to the shared folder and read back."""
    return written(media_features(media), "features")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, n_segments long"


def feature_digests(features: DataFrame) -> DataFrame:
    """One row per row of stored features: the tensors and spans that were read back, as shape, number of spans and digest."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, frames, segments = [], [], []
            for stream, spans in zip(batch.column("tensors").to_pylist(), batch.column("segments").to_pylist(), strict=True):
                table = pa.ipc.open_stream(stream).read_all().combine_chunks()
                tensors = table.column("log_mel").chunk(0)
                n = int(table.column("frames").to_numpy().sum())
                state = hashlib.sha256(np.ascontiguousarray(tensors.storage.flatten().to_numpy(zero_copy_only=False)))
                state.update(np.ascontiguousarray(np.stack([table.column(c).to_numpy() for c in ("start_s", "end_s")])))
                state.update(np.array([[s["start_s"], s["end_s"]] for s in spans], "<f8").tobytes())
                names.append(f"{n}x{tensors.type.shape[1]}:{len(spans)}:{state.hexdigest()}")
                frames.append(n)
                segments.append(len(spans))
            own = [batch.column(x.split()[0]) for x in DIGEST.split(", ")[:7]]
            yield pa.record_batch([*own, pa.array(names, pa.string()), pa.array(frames, pa.int64()), pa.array(segments, pa.int64())], names=[x.split()[0] for x in DIGEST.split(", ")])

    return features.mapInArrow(digest, DIGEST)


def digests(documents: DataFrame) -> DataFrame:
    """Media stored and read back, features made of them stored and read back, and both described."""
    return feature_digests(store_features(store_media(documents)))
