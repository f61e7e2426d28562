"""Digital filters in numpy over the last axis of arrays, for use inside tasks."""

from __future__ import annotations

from fractions import Fraction

import numpy as np


def welch(x: np.ndarray, rate: float, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and one-sided power densities: Hann windows, half overlap, mean removed from each."""
    n = x.shape[-1]
    size = min(size or n, n)
    step = max(size - size // 2, 1)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    parts = np.lib.stride_tricks.sliding_window_view(x, size, axis=-1)[..., ::step, :]
    parts = (parts - parts.mean(-1, keepdims=True)) * window
    power = np.abs(np.fft.rfft(parts, axis=-1)) ** 2 / (rate * (window**2).sum())
    power[..., 1 : (-1 if size % 2 == 0 else None)] *= 2
    return np.fft.rfftfreq(size, 1 / rate), power.mean(-2)


def butterworth(order: int, cutoff: float | tuple[float, float], kind: str, rate: float) -> np.ndarray:
    """Second-order sections (b0 b1 b2 1 a1 a2) of a Butterworth filter; kind is low, high or band."""
    edges = np.atleast_1d(np.asarray(cutoff, float))
    if (edges <= 0).any() or (edges >= rate / 2).any() or len(edges) == 2 and edges[0] >= edges[1]:
        raise ValueError("cutoffs must rise between 0 and half the rate")
    poles = -np.exp(1j * np.pi * np.arange(-order + 1, order, 2) / (2 * order))
    warped = 4.0 * np.tan(np.pi * edges / rate)
    zeros, gain = np.zeros(0, complex), 1.0
    if kind == "low":
        poles, gain = poles * warped[0], warped[0] ** order
    elif kind == "high":
        gain = float(np.real(1 / np.prod(-poles)))
        poles, zeros = warped[0] / poles, np.zeros(order, complex)
    else:
        width, middle = warped[1] - warped[0], np.sqrt(warped[0] * warped[1])
        half = poles * width / 2
        root = np.sqrt(half**2 - middle**2)
        poles, zeros, gain = np.concatenate((half + root, half - root)), np.zeros(order, complex), width**order
    gain *= float(np.real(np.prod(4 - zeros) / np.prod(4 - poles)))
    zeros = np.concatenate(((4 + zeros) / (4 - zeros), -np.ones(len(poles) - len(zeros))))
    poles = (4 + poles) / (4 - poles)
    upper = sorted(poles[poles.imag > 1e-12], key=lambda p: abs(abs(p) - 1), reverse=True)
    real = sorted(poles[np.abs(poles.imag) <= 1e-12].real)
    pairs = [(p, p.conjugate()) for p in upper] + [tuple(real[i : i + 2]) for i in range(0, len(real), 2)]
    zs = sorted(zeros.real, key=lambda z: -z)
    zs = [zs[i // 2] if i % 2 == 0 else zs[-1 - i // 2] for i in range(len(zs))] if kind == "band" else zs
    out = []
    for pair in pairs:
        own, zs = zs[: len(pair)], zs[len(pair) :]
        b, a = np.real(np.poly(own)), np.real(np.poly(pair))
        out.append(np.concatenate((np.pad(b, (0, 3 - len(b))), np.pad(a, (0, 3 - len(a))))))
    sections = np.array(out)
    sections[0, :3] *= gain
    return sections


def _run(sections: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Filter along the last axis; state has shape (sections, ..., 2)."""
    y = np.moveaxis(x, -1, 0).copy()
    for (b0, b1, b2, _, a1, a2), z in zip(sections, state, strict=True):
        z0, z1 = z[..., 0].copy(), z[..., 1].copy()
        for i in range(len(y)):
            v = y[i]
            out = b0 * v + z0
            z0 = b1 * v - a1 * out + z1
            z1 = b2 * v - a2 * out
            y[i] = out
    return np.moveaxis(y, 0, -1)


def _steady(sections: np.ndarray) -> np.ndarray:
    """State of each section for a constant input of 1."""
    out, scale = [], 1.0
    for b0, b1, b2, _, a1, a2 in sections:
        gain = (b0 + b1 + b2) / (1 + a1 + a2)
        out.append((scale * (gain - b0), scale * (b2 - a2 * gain)))
        scale *= gain
    return np.array(out)


def zero_phase(sections: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Forward and backward filtering with odd extension at both ends."""
    ends = int(min((sections[:, 2] == 0).sum(), (sections[:, 5] == 0).sum()))
    pad = min(3 * (2 * len(sections) + 1 - ends), x.shape[-1] - 1)
    if pad > 0:
        left = 2 * x[..., :1] - x[..., pad:0:-1]
        right = 2 * x[..., -1:] - x[..., -2 : -pad - 2 : -1]
        wide = np.concatenate((left, x, right), -1)
    else:
        wide = x
    steady = _steady(sections)
    start = lambda v: steady.reshape(len(sections), *([1] * (x.ndim - 1)), 2) * v[None, ..., None]
    y = _run(sections, wide, start(wide[..., 0]))[..., ::-1]
    y = _run(sections, y, start(y[..., 0]))[..., ::-1]
    return y[..., pad : pad + x.shape[-1]] if pad > 0 else y


def bandpass(x: np.ndarray, rate: float, low: float = 0.5, high: float = 40.0, order: int = 4) -> np.ndarray:
    """High-pass, then low-pass, both zero-phase."""
    if not 0 < low < high < rate / 2:
        raise ValueError("cutoffs must rise between 0 and half the rate")
    return zero_phase(butterworth(order, high, "low", rate), zero_phase(butterworth(order, low, "high", rate), x))


def filter_within(x: np.ndarray, rate: float, begin: float, end: float, kind: str, cutoff: float | tuple[float, float], order: int = 4, pad_seconds: float = 2.0) -> np.ndarray:
    """Only [begin, end) seconds filtered, with context on both sides; other samples unchanged."""
    n = x.shape[-1]
    a, b = (int(min(max(round(t * rate), 0), n)) for t in (begin, end))
    if b <= a:
        raise ValueError("the interval is empty")
    pad = int(round(pad_seconds * rate))
    left, right = max(0, a - pad), min(n, b + pad)
    out = x.copy()
    out[..., a:b] = zero_phase(butterworth(order, cutoff, kind, rate), x[..., left:right])[..., a - left : b - left]
    return out


def notch(x: np.ndarray, rate: float, freqs: list[float], width: float = 2.0) -> np.ndarray:
    """Sinusoids near freqs fitted in overlapping windows and taken away; none given, x itself."""
    if not len(freqs):
        return x
    n = x.shape[-1]
    size = int(min(n, max(round(2 * rate / width), 16)))
    step = max(size // 2, 1)
    starts = list(range(0, n - size + 1, step))
    if starts[-1] + size < n:
        starts.append(n - size)
    taper = np.hanning(size + 2)[1:-1] + 1e-6
    total, weight = np.zeros_like(x), np.zeros(n)
    t = np.arange(size) / rate
    basis = np.concatenate([[np.sin(2 * np.pi * f * t), np.cos(2 * np.pi * f * t)] for f in freqs])
    solve = np.linalg.pinv(basis.T)
    for s in starts:
        total[..., s : s + size] += ((x[..., s : s + size] @ solve.T) @ basis) * taper
        weight[s : s + size] += taper
    return x - total / weight


def resample_fft(x: np.ndarray, native: float, target: float) -> np.ndarray:
    """Band-limited resampling by the spectrum."""
    if native <= 0 or target <= 0:
        raise ValueError("rates must be positive")
    n = x.shape[-1]
    m = int(round(n * target / native))
    if native == target or not n:
        return x.copy()
    spectrum = np.fft.rfft(x, axis=-1)
    out = np.zeros((*x.shape[:-1], m // 2 + 1), complex)
    k = min(n, m) // 2 + 1
    out[..., :k] = spectrum[..., :k]
    if min(n, m) % 2 == 0 and n != m:  # the bin at half the lower rate stands for two
        out[..., k - 1] = out[..., k - 1] * 0.5 if m > n else out[..., k - 1].real * 2
    return np.fft.irfft(out, m, axis=-1) * (m / n)


def resample_poly(x: np.ndarray, native: float, target: float) -> np.ndarray:
    """Polyphase resampling by the ratio of whole numbers up to 1000, with a Kaiser-windowed low-pass."""
    if native <= 0 or target <= 0:
        raise ValueError("rates must be positive")
    if native == target:
        return x.copy()
    ratio = Fraction(target / native).limit_denominator(1000)
    up, down = ratio.numerator, ratio.denominator
    n = x.shape[-1]
    m = -(-n * up // down)
    half = 10 * max(up, down)
    at = np.arange(-half, half + 1)
    taps = np.sinc(at / max(up, down)) * np.kaiser(2 * half + 1, 5.0)
    taps *= up / taps.sum()
    where = np.arange(m) * down  # places of outputs at the raised rate
    out = np.zeros((*x.shape[:-1], m))
    first = -(-(where - half) // up)  # the first input within reach of each output
    for k in range(2 * half // up + 1):
        i = first + k
        tap = where - i * up
        good = (i >= 0) & (i < n) & (np.abs(tap) <= half)
        out[..., good] += x[..., i[good]] * taps[tap[good] + half]
    return out
