"""WAV data to samples at a wanted rate.

Rates are changed by a windowed-sinc filter in its polyphase form: the rates' ratio is brought to up / down in lowest terms, each of the `up` phases has its own
taps, and the outputs of one phase are a matrix of input windows times these taps.  The filter cuts at the lower of both Nyquist frequencies, so what the
new rate can't hold vanishes instead of being folded back.  Windows are made in blocks, so memory beyond the samples does not grow with a file's length.
"""

from __future__ import annotations

import io
import math
import wave
from functools import lru_cache

import numpy as np

#: Zero crossings of the filter to each side, and outputs of one matrix product.
CROSSINGS, BLOCK = 16, 1 << 14


@lru_cache(8)
def taps(up: int, down: int, crossings: int = CROSSINGS) -> np.ndarray:
    """up rows of taps over the inputs -w + 1 .. w around an output's place; each row adds up to one."""
    cut = min(1.0, up / down)
    w = math.ceil(crossings / cut)
    at = np.arange(-w + 1, w + 1) - np.arange(up)[:, None] / up
    t = np.sinc(cut * at) * (0.5 + 0.5 * np.cos(np.pi * np.clip(at * cut / crossings, -1, 1)))
    return t / t.sum(1, keepdims=True)


def resample(x: np.ndarray, old: int, new: int) -> np.ndarray:
    """Samples of rate old at rate new: round(len * new / old) of them; outside its samples a signal is zero."""
    if old <= 0 or new <= 0:
        raise ValueError("rates must be positive")
    if old == new or not len(x):
        return x
    g = math.gcd(old, new)
    up, down = new // g, old // g
    n = round(len(x) * up / down)
    t = taps(up, down)
    w = t.shape[1] // 2
    padded = np.concatenate([np.zeros(w - 1), x, np.zeros(w + down + 1)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * w)
    out = np.empty(n)
    for first in range(min(up, n)):  # outputs first, first + up, ... have one phase and inputs `down` apart
        base, phase = divmod(first * down, up)
        mine = windows[base::down][: len(range(first, n, up))]
        for a in range(0, len(mine), BLOCK):
            out[first + a * up :: up][: len(mine[a : a + BLOCK])] = mine[a : a + BLOCK] @ t[phase]
    return out


def pcm(data: bytes, width: int) -> np.ndarray:
    """Integer samples of 1 to 4 bytes in [-1, 1); one byte is unsigned."""
    if width == 1:
        return (np.frombuffer(data, np.uint8).astype(float) - 128) / 128
    if width == 3:
        b = np.frombuffer(data, np.uint8).reshape(-1, 3)
        whole = np.zeros((len(b), 4), np.uint8)
        whole[:, 1:] = b
        return whole.view("<i4").reshape(-1) / 2147483648.0
    if width not in (2, 4):
        raise ValueError(f"samples of {width} bytes")
    return np.frombuffer(data, f"<i{width}") / float(1 << (8 * width - 1))


def wav_samples(content: bytes, rate: int) -> np.ndarray:
    """Mono samples at a rate from integer PCM WAV data of 8, 16, 24 or 32 bits; channels are averaged.  A frame that is cut off at the end is left out."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, old = w.getsampwidth(), w.getnchannels(), w.getframerate()
        data = w.readframes(w.getnframes())
    x = pcm(data[: len(data) // (width * channels) * width * channels], width)
    return resample(x.reshape(-1, channels).mean(1), old, rate)
