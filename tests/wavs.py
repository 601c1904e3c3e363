"""WAV fixtures written with the standard library."""

import wave

import numpy as np


def write_wav(path, samples, rate=16000, width=2):
    data = np.asarray(samples, dtype=float)
    channels = 1 if data.ndim == 1 else data.shape[1]
    scaled = np.clip(np.round(data * 32767), -32768, 32767).astype("<i2")
    raw = scaled.tobytes() if width == 2 else (scaled // 256 + 128).astype("u1").tobytes()
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as out:
        out.setnchannels(channels)
        out.setsampwidth(width)
        out.setframerate(rate)
        out.writeframes(raw)


def tone(hz, seconds=0.5, rate=16000, loud=0.5):
    return loud * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)
