"""Audio kernels in NumPy: PCM decoding, blocks, levels, mel spectra, session windows."""

from __future__ import annotations

import io
import wave

import numpy as np

RATE, BLOCK = 16_000, 640


def pcm16_mono(content: bytes, rate: int = RATE) -> np.ndarray:
    """A 16-bit WAV as mono float32 in [-1, 1): channel mean, then linear resampling to round(n * rate / own rate)."""
    with wave.open(io.BytesIO(content)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("16-bit PCM expected")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(axis=1) / 32768.0
        own = w.getframerate()
    if own != rate and len(x):
        n = round(len(x) * rate / own)
        x = np.interp(np.linspace(0, len(x) - 1, n), np.arange(len(x)), x)
    return x.astype(np.float32)


def blocks(x: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """[n, size], the last block zero-padded."""
    n = -(-len(x) // size)
    out = np.zeros((n, size), np.float32)
    out.reshape(-1)[: len(x)] = x
    return out


def levels(x: np.ndarray, frames: int, size: int = BLOCK) -> np.ndarray:
    """Root mean square of each of ``frames`` blocks; 0 past the end."""
    out = np.zeros(frames)
    own = np.sqrt((blocks(x, size).astype(np.float64) ** 2).mean(axis=1))[:frames]
    out[: len(own)] = own
    return out


def hz_to_mel(f: np.ndarray) -> np.ndarray:
    """Linear below 1 kHz (200/3 Hz a mel), logarithmic above (27 mels for a factor of 6.4)."""
    f = np.asarray(f, float)
    return np.where(f < 1000, f * 3 / 200, 15 + 27 * np.log(np.maximum(f, 1e-9) / 1000) / np.log(6.4))


def mel_to_hz(m: np.ndarray) -> np.ndarray:
    m = np.asarray(m, float)
    return np.where(m < 15, m * 200 / 3, 1000 * 6.4 ** ((m - 15) / 27))


def mel_basis(rate: int = RATE, n_fft: int = 1024, mels: int = 80) -> np.ndarray:
    """[mels, bins] triangles, equally spaced on the mel scale from 0 to half the rate, each scaled to unit area."""
    edges = mel_to_hz(np.linspace(0, hz_to_mel(rate / 2), mels + 2))
    bins = np.linspace(0, rate / 2, n_fft // 2 + 1)
    up = (bins - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - bins) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


#: Fixed values of the mel features.
N_FFT, HOP, WINDOW, PREEMPHASIS, FLOOR, REFERENCE_DB = 1024, 160, 800, 0.97, 1e-5, 20.0


def mel_spectrum(x: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """[frames, 80] in dB: pre-emphasis, centred mirrored frames under a Hann window inside the FFT, power, mels."""
    if x.ndim != 1 or not len(x):
        raise ValueError("one channel with at least one sample expected")
    basis = mel_basis() if basis is None else basis
    y = np.zeros(max(len(x), N_FFT))
    y[1 : len(x)] = x[1:] - PREEMPHASIS * x[:-1]
    window = np.zeros(N_FFT)
    edge = (N_FFT - WINDOW) // 2
    window[edge : edge + WINDOW] = np.hanning(WINDOW + 2)[1:-1]
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(y, N_FFT // 2, mode="reflect"), N_FFT)[::HOP]
    power = np.abs(np.fft.rfft(frames * window)) ** 2
    return (10 * np.log10(power @ basis.T + FLOOR) - REFERENCE_DB).astype(np.float32)


def context_window(features: np.ndarray, index: int, width: int = 20) -> np.ndarray:
    """[T, d]: ``width`` rows from ``index``, moved back at the end; [n, width, d]: the clamped row."""
    if features.ndim == 3:
        return features[min(max(index, 0), len(features) - 1)]
    if len(features) < width:
        raise ValueError(f"fewer than {width} rows")
    start = min(max(index, 0), len(features) - width)
    return features[start : start + width]


def session_chunks(n: int, first: int = 20, step: int = 50) -> list[tuple[int, int]]:
    """(start, length): a first chunk, then equal ones, then the rest."""
    starts = [0, *range(first, n, step)] if n > first else [0][: n > 0]
    return [(s, min(first if s == 0 else step, n - s)) for s in starts]
