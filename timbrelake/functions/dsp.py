"""Spectral features on numpy arrays. Called inside Arrow batches of Spark tasks.

Frames are rows. The frames of all signals at hand form one sequence that is worked through in
blocks: short signals share a block, a long one is spread over several. Memory is bounded by the
block and by one value per frame and feature, not by frames times bins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from timbrelake.constants import MIN_SAMPLES, N_CHROMA, N_CONTRAST, N_MFCC, N_TONNETZ

_FLOOR = 1e-10


@dataclass(frozen=True)
class SignalConfig:
    """Framing and feature settings; ``center`` pads half a frame of silence at both ends."""

    n_fft: int = 2048
    hop: int = 512
    center: bool = True
    n_mels: int = 128
    rolloff: float = 0.85
    contrast_base: float = 200.0
    contrast_share: float = 0.02
    top_db: float = 80.0
    slowest_bpm: float = 30.0
    fastest_bpm: float = 300.0
    min_samples: int = MIN_SAMPLES
    # Values per block of frames, and samples per chunk of signals: 2 MB and 30 MB.
    block_values: int = 2**18
    chunk_samples: int = 4_000_000


def mel_to_hz(mel: np.ndarray) -> np.ndarray:
    """Slaney's scale: linear up to 1 kHz, logarithmic above."""
    steep = 1000.0 * np.exp(np.log(6.4) / 27.0 * (mel - 15.0))
    return np.where(mel < 15.0, mel * 200.0 / 3.0, steep)


def hz_to_mel(hz: float) -> float:
    return hz * 3.0 / 200.0 if hz < 1000.0 else 15.0 + 27.0 * np.log(hz / 1000.0) / np.log(6.4)


@functools.lru_cache(maxsize=16)
def tables(cfg: SignalConfig, rate: int) -> dict:
    """Coefficient tables shared by all signals of one sample rate."""
    n = cfg.n_fft
    freqs = np.arange(n // 2 + 1) * rate / n
    edges = mel_to_hz(np.linspace(0.0, hz_to_mel(rate / 2), cfg.n_mels + 2))
    left, mid, right = edges[:-2], edges[1:-1], edges[2:]
    rise = (freqs[:, None] - left) / (mid - left)
    fall = (right - freqs[:, None]) / (right - mid)
    mel = np.maximum(0.0, np.minimum(rise, fall)) * 2.0 / (right - left)

    m = np.arange(cfg.n_mels)[:, None]
    k = np.arange(N_MFCC)[None, :]
    dct = np.cos(np.pi * k * (m + 0.5) / cfg.n_mels) * np.sqrt(2.0 / cfg.n_mels)
    dct[:, 0] = np.sqrt(1.0 / cfg.n_mels)

    pitch = np.zeros((len(freqs), N_CHROMA))
    tone = np.floor(12.0 * np.log2(freqs[1:] / 440.0) + 0.5).astype(int) + 9
    pitch[np.arange(1, len(freqs)), tone % 12] = 1.0

    bounds = [0.0, *(cfg.contrast_base * 2.0**i for i in range(N_CONTRAST - 1)), np.inf]
    bands = [np.flatnonzero((freqs >= a) & (freqs < b)) for a, b in zip(bounds, bounds[1:])]

    c = np.arange(N_CHROMA)[:, None]
    turn = np.pi * np.array([7 / 6, 3 / 2, 2 / 3])
    radius = np.array([1.0, 1.0, 0.5])
    axes = np.empty((N_CHROMA, N_TONNETZ))
    axes[:, 0::2] = radius * np.sin(c * turn)
    axes[:, 1::2] = radius * np.cos(c * turn)
    window = 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(n) / n)
    return {
        "freqs": freqs, "mel": mel, "dct": dct, "pitch": pitch, "bands": bands, "axes": axes,
        "window": window,
    }


def frames_of(x: np.ndarray, cfg: SignalConfig) -> np.ndarray:
    """Frame i is ``x[i*hop : i*hop+n_fft]``; an incomplete tail is dropped. A view, no copy."""
    if cfg.center:
        x = np.pad(x, cfg.n_fft // 2)
    if len(x) < cfg.n_fft:
        return np.empty((0, cfg.n_fft))
    return np.lib.stride_tricks.sliding_window_view(x, cfg.n_fft)[:: cfg.hop]


#: Groups of series that are computed together.
ALL_GROUPS = frozenset(
    ["mel", "centroid", "bandwidth", "rolloff", "flatness", "contrast", "onset", "chroma", "tonnetz", "rms", "zcr"]
)


def spectrum_of(frames: np.ndarray, window: np.ndarray) -> np.ndarray:
    return np.abs(np.fft.rfft(frames * window, axis=1))


def _ratio(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return np.divide(top, bottom, out=np.zeros_like(top), where=bottom > 0)


def _contrast(S: np.ndarray, cfg: SignalConfig, bands: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(S), len(bands)))
    for i, band in enumerate(bands):
        if len(band):
            m = max(1, int(np.floor(cfg.contrast_share * len(band) + 0.5)))
            # Only the m smallest and the m largest have to be in place, not sorted.
            parted = np.partition(S[:, band], sorted({m - 1, len(band) - m}), axis=1)
            peak = np.maximum(parted[:, -m:].mean(axis=1), _FLOOR)
            valley = np.maximum(parted[:, :m].mean(axis=1), _FLOOR)
            out[:, i] = 10.0 * (np.log10(peak) - np.log10(valley))
    return out


def _blocks(
    framed: Sequence[np.ndarray], cfg: SignalConfig
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The frames of all signals in blocks, and which of them are the first of their signal."""
    limit = max(1, cfg.block_values // cfg.n_fft)
    pieces, heads, size = [], [], 0
    for frames in framed:
        for start in range(0, len(frames), limit):
            piece = frames[start : start + limit]
            if size + len(piece) > limit and size:
                yield np.concatenate(pieces), np.concatenate(heads)
                pieces, heads, size = [], [], 0
            head = np.zeros(len(piece), dtype=bool)
            head[0] = start == 0
            pieces.append(piece)
            heads.append(head)
            size += len(piece)
    if size:
        yield np.concatenate(pieces), np.concatenate(heads)


def _block(
    frames: np.ndarray, heads: np.ndarray, before: np.ndarray | None, cfg: SignalConfig, t: dict,
    wanted: frozenset[str] = ALL_GROUPS,
) -> dict:
    """Wanted features of consecutive frames; ``before`` is the level of the frame ahead of them.

    What a feature is made from (spectrum, power, level, chroma) is computed only if one that
    needs it is wanted.
    """
    out: dict[str, np.ndarray | None] = {"_last": None}
    if "rms" in wanted:
        out["rms"] = np.sqrt((frames * frames).mean(axis=1))
    if "zcr" in wanted:
        positive = frames >= 0
        out["zcr"] = (positive[:, 1:] != positive[:, :-1]).sum(axis=1) / (frames.shape[1] - 1)
    if wanted <= {"rms", "zcr"}:
        return out
    freqs = t["freqs"]
    S = spectrum_of(frames, t["window"])
    total = S.sum(axis=1)
    if wanted & {"centroid", "bandwidth"}:
        centroid = out["centroid"] = _ratio(S @ freqs, total)
        if "bandwidth" in wanted:
            offset = (freqs[None, :] - centroid[:, None]) ** 2
            out["bandwidth"] = np.sqrt(_ratio((S * offset).sum(axis=1), total))
    if "rolloff" in wanted:
        reached = np.cumsum(S, axis=1) >= cfg.rolloff * total[:, None]
        out["rolloff"] = freqs[np.argmax(reached, axis=1)]
    if wanted & {"flatness", "onset"}:
        audible = np.maximum(S, 1e-5)
        level = np.log(audible)
        # Geometric over arithmetic mean of the power; its floor 1e-10 is that of S squared.
        out["flatness"] = np.exp(2.0 * level.mean(axis=1)) / (audible * audible).mean(axis=1)
        earlier = np.vstack([level[:1] if before is None else before, level[:-1]])
        earlier[heads] = level[heads]
        out["onset"] = np.maximum(0.0, level - earlier).mean(axis=1)
        out["_last"] = level[-1:]
    if "contrast" in wanted:
        out["contrast"] = _contrast(S, cfg, t["bands"])
    if wanted & {"mel", "chroma", "tonnetz"}:
        power = S * S
        if "mel" in wanted:
            out["mel"] = power @ t["mel"]
        if wanted & {"chroma", "tonnetz"}:
            chroma = power @ t["pitch"]
            top = np.broadcast_to(chroma.max(axis=1, keepdims=True), chroma.shape)
            chroma = out["chroma"] = _ratio(chroma, top)
            if "tonnetz" in wanted:
                whole = np.broadcast_to(chroma.sum(axis=1, keepdims=True), chroma.shape)
                out["tonnetz"] = _ratio(chroma, whole) @ t["axes"]
    return out


def tempo_of(onset: np.ndarray, rate: int, cfg: SignalConfig) -> float:
    """Beats per minute of the strongest autocorrelation lag; 0 without any onset or lag."""
    per_minute = 60.0 * rate / cfg.hop
    first = max(1, int(np.ceil(per_minute / cfg.fastest_bpm)))
    last = min(len(onset) - 1, int(np.floor(per_minute / cfg.slowest_bpm)))
    if first > last:
        return 0.0
    strength = np.round([onset[lag:] @ onset[:-lag] for lag in range(first, last + 1)], 9)
    return per_minute / float(first + np.argmax(strength)) if strength.max() > 0 else 0.0


_ORDER = ["centroid", "bandwidth", "rolloff", "flatness", "contrast", "onset", "chroma",
          "tonnetz", "rms", "zcr"]
_WIDTH = N_MFCC + 4 + N_CONTRAST + 1 + N_CHROMA + N_TONNETZ + 2
_ONSET_AT = N_MFCC + 4 + N_CONTRAST


#: Width of each group of series in the matrix of all of them.
_WIDTHS = {"contrast": N_CONTRAST, "chroma": N_CHROMA, "tonnetz": N_TONNETZ}


def groups_of(columns: Sequence[int]) -> frozenset[str]:
    """The groups that hold the given columns of the matrix."""
    names = ["mel"] * N_MFCC
    for name in _ORDER:
        names += [name] * _WIDTHS.get(name, 1)
    return frozenset(names[i] for i in columns)


def analyse(
    signals: Sequence[np.ndarray], rate: int, cfg: SignalConfig, wanted: frozenset[str] = ALL_GROUPS
) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Features of signals of one sample rate.

    Returns the matrix of all their frames times the feature series in compact order, the number
    of frames of each signal, and the tempo of each. Groups that are not wanted are zero; tempo is
    zero without onset strength.
    """
    t = tables(cfg, int(rate))
    framed = [frames_of(np.asarray(x, dtype=np.float64), cfg) for x in signals]
    counts = np.array([len(frames) for frames in framed])
    found, before = [], None
    for frames, heads in _blocks(framed, cfg):
        found.append(_block(frames, heads, before, cfg, t, wanted))
        before = found[-1].pop("_last")
    if not found:
        return np.empty((0, _WIDTH)), counts, [0.0] * len(framed)
    whole = {name: np.concatenate([block[name] for block in found]) for name in found[0]}
    matrix = np.zeros((len(next(iter(whole.values()))), _WIDTH))
    if "mel" in wanted:
        energy = 10.0 * np.log10(np.maximum(whole["mel"], _FLOOR))
        some = counts[counts > 0]
        loudest = np.maximum.reduceat(energy.max(axis=1), np.cumsum(some) - some)
        floor = np.repeat(loudest - cfg.top_db, some)[:, None]
        matrix[:, :N_MFCC] = np.maximum(energy, floor) @ t["dct"]
    at = N_MFCC
    for name in _ORDER:
        width = _WIDTHS.get(name, 1)
        if name in whole:
            matrix[:, at : at + width] = whole[name].reshape(-1, width)
        at += width
    if "onset" not in wanted:
        return matrix, counts, [0.0] * len(framed)
    onsets = np.split(matrix[:, _ONSET_AT], np.cumsum(counts)[:-1])
    return matrix, counts, [tempo_of(onset, rate, cfg) for onset in onsets]


def summaries(matrix: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean, population std, min and max per signal and series; zeros for a signal without frames."""
    out = np.zeros((len(counts), matrix.shape[1], 4))
    full = counts > 0
    if full.any():
        size = counts[full]
        starts = np.cumsum(size) - size
        mean = np.add.reduceat(matrix, starts) / size[:, None]
        spread = np.add.reduceat((matrix - np.repeat(mean, size, axis=0)) ** 2, starts)
        low, high = np.minimum.reduceat(matrix, starts), np.maximum.reduceat(matrix, starts)
        out[full] = np.stack([mean, np.sqrt(spread / size[:, None]), low, high], axis=2)
    return out
