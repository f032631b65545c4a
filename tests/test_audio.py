"""Samples from WAV data, at other rates and widths."""

import io
import wave

import numpy as np
import pytest

from outlyne.sources import audio


def _wav(data: bytes, width: int, rate: int, channels: int = 1) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(data)
    return out.getvalue()


def _tone(hz, rate, seconds=0.5):
    return np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


@pytest.mark.parametrize("old", [48_000, 44_100, 22_050, 16_001, 8_000])
def test_tones_stay_or_vanish(old):
    kept = audio.resample(_tone(1000, old), old, 16_000)
    inner = slice(400, -400)
    assert len(kept) == round(int(old * 0.5) * 16_000 / old)
    assert np.abs(kept[inner] - _tone(1000, 16_000, 1.0)[: len(kept)][inner]).max() < 2e-3
    if old > 24_000:  # twelve kHz is above the new Nyquist frequency: interpolation would fold it to four
        assert np.abs(audio.resample(_tone(12_000, old), old, 16_000)[inner]).max() < 2e-3


def test_direct_sum():
    x = np.random.default_rng(3).normal(size=101)
    for old, new in ((3, 2), (2, 3), (5, 1), (1, 4), (7, 5)):
        t = audio.taps(new, old)
        w = t.shape[1] // 2
        want = [sum(t[i * old % new][k + w - 1] * x[i * old // new + k] for k in range(-w + 1, w + 1) if 0 <= i * old // new + k < len(x)) for i in range(round(len(x) * new / old))]
        assert np.allclose(audio.resample(x, old, new), want)


def test_blocks_do_not_show(monkeypatch):
    x = np.random.default_rng(4).normal(size=999)
    whole = audio.resample(x, 44_100, 16_000), audio.resample(x, 32_000, 16_000)
    monkeypatch.setattr(audio, "BLOCK", 7)
    assert np.array_equal(np.round(whole[0], 12), np.round(audio.resample(x, 44_100, 16_000), 12)) and np.allclose(whole[1], audio.resample(x, 32_000, 16_000))


def test_widths_and_channels():
    for width, full in ((2, 1 << 15), (3, 1 << 23), (4, 1 << 31)):
        ints = [0, full // 2, -full // 4, full - 1, -full]
        data = b"".join(i.to_bytes(width, "little", signed=True) for i in ints)
        assert np.allclose(audio.wav_samples(_wav(data, width, 16_000), 16_000), [i / full for i in ints], atol=0)
    assert audio.wav_samples(_wav(bytes([128, 192, 0]), 1, 16_000), 16_000).tolist() == [0.0, 0.5, -1.0]
    both = np.array([[1 << 14, 0], [0, -(1 << 14)]], "<i2").tobytes()
    assert audio.wav_samples(_wav(both, 2, 16_000, 2), 16_000).tolist() == [0.25, -0.25]
    assert audio.wav_samples(_wav(b"", 2, 8_000), 16_000).tolist() == [] and len(audio.resample(np.zeros(1), 48_000, 16_000)) == 0
    with pytest.raises(ValueError):
        audio.resample(np.zeros(1), 0, 16_000)
