"""Waveforms in numpy: bandwidth, mono, resampling. Over rows, use them in an adapter."""

from __future__ import annotations

import io
import wave

import numpy as np


def read_wav(raw: bytes) -> tuple[np.ndarray, int]:
    """Samples from -1 to 1 (frames x channels) and their rate, of a 16-bit WAV file."""
    with wave.open(io.BytesIO(raw)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("only 16-bit samples are read")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
        return x / 32768, w.getframerate()


def mono(x: np.ndarray) -> np.ndarray:
    return x.mean(1) if x.ndim == 2 else x


def resample(x: np.ndarray, rate: int, new: int) -> np.ndarray:
    """Band-limited resampling of one channel, by its spectrum."""
    if rate == new or not len(x):
        return x
    n = round(len(x) * new / rate)
    spectrum = np.fft.rfft(x)
    out = np.zeros(n // 2 + 1, complex)
    k = min(len(out), len(spectrum))
    out[:k] = spectrum[:k]
    return np.fft.irfft(out, n) * n / len(x)


def bandwidth(x: np.ndarray, rate: int, window: int = 512, stride: float = 0.01, floor_db: float = -50.0, top_db: float = 100.0) -> int:
    """The highest frequency whose mean power is within ``floor_db`` of the strongest; 0 for silence or nothing."""
    hop = max(1, int(rate * stride))
    if not len(x):
        return 0
    padded = np.pad(x, window // 2)
    frames = np.lib.stride_tricks.sliding_window_view(padded, window)[::hop]
    at = 2 * np.pi * np.arange(window) / window
    taper = 0.35875 - 0.48829 * np.cos(at) + 0.14128 * np.cos(2 * at) - 0.01168 * np.cos(3 * at)  # Blackman-Harris: fixed values
    power = (np.abs(np.fft.rfft(frames * taper, axis=1)) ** 2).mean(0)
    db = 10 * np.log10(np.maximum(power, 1e-10))
    db = np.maximum(db, db.max() - top_db)
    loud = np.flatnonzero(db - db.max() > floor_db)
    return int(loud[-1] * rate / window) if power.max() > 1e-10 else 0
