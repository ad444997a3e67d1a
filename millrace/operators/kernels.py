"""Weights of moving windows: textbook window functions, symmetric, ``size`` points each.

Parameters (``std``, ``tau``, ``beta``, ``alpha``, ``power`` and ``width``) are given by name.
"""

from __future__ import annotations

from collections.abc import Callable
from math import cos, exp, pi, sin, sqrt

from millrace.errors import QueryError

# Coefficients of windows that are alternating sums of cosines.
_COSINE_SUMS = {
    "hann": (0.5, 0.5),
    "hamming": (0.54, 0.46),
    "blackman": (0.42, 0.5, 0.08),
    "nuttall": (0.3635819, 0.4891775, 0.1365995, 0.0106411),
    "blackmanharris": (0.35875, 0.48829, 0.14128, 0.01168),
    "flattop": (0.21557895, 0.41663158, 0.277263158, 0.083578947, 0.006947368),
}


def _bessel(x: float) -> float:
    """The modified Bessel function of order 0, by its power series."""
    term, total, n = 1.0, 1.0, 0
    while term > 1e-17 * total:
        n += 1
        term *= (x / (2 * n)) ** 2
        total += term
    return total


def _parzen(x: float, size: int) -> float:
    far = abs(x) / (size / 2)
    return 2 * (1 - far) ** 3 if far > 0.5 else 1 - 6 * far**2 + 6 * far**3


def _bohman(u: float) -> float:
    far = abs(u)
    return 0.0 if far >= 1 else (1 - far) * cos(pi * far) + sin(pi * far) / pi


def _tukey(u: float, alpha: float) -> float:
    inside = 1 - abs(u)  # distance from the nearer end, in halves of the window
    return 1.0 if alpha <= 0 or inside >= alpha else 0.5 * (1 - cos(pi * inside / alpha))


# By x, the distance from the middle, u, the same as a share of half the window, and the size.
_SHAPES: dict[str, Callable[..., float]] = {
    "boxcar": lambda x, u, size: 1.0,
    "triang": lambda x, u, size: 1 - 2 * abs(x) / (size + size % 2),
    "bartlett": lambda x, u, size: 1 - abs(u),
    "cosine": lambda x, u, size: cos(pi * x / size),
    "parzen": lambda x, u, size: _parzen(x, size),
    "bohman": lambda x, u, size: _bohman(u),
    "gaussian": lambda x, u, size, std: exp(-0.5 * (x / std) ** 2),
    "general_gaussian": lambda x, u, size, power, width: exp(-0.5 * abs(x / width) ** (2 * power)),
    "exponential": lambda x, u, size, tau=1.0: exp(-abs(x) / tau),
    "kaiser": lambda x, u, size, beta: _bessel(beta * sqrt(max(0.0, 1 - u * u))) / _bessel(beta),
    "tukey": lambda x, u, size, alpha=0.5: _tukey(u, alpha),
}
KERNELS = (*_COSINE_SUMS, *_SHAPES)


def kernel(name: str, size: int, **options: float) -> list[float]:
    """The weights of a window, oldest row first."""
    if name not in KERNELS:
        raise QueryError(f"unknown window type: {name}")
    if size < 2:
        return [1.0] * size
    middle = (size - 1) / 2
    if name in _COSINE_SUMS:
        if options:
            raise QueryError(f"the {name} window takes no options")
        parts = _COSINE_SUMS[name]
        return [sum((-1) ** j * a * cos(2 * pi * j * k / (size - 1)) for j, a in enumerate(parts)) for k in range(size)]
    try:
        return [_SHAPES[name](k - middle, (k - middle) / middle, size, **options) for k in range(size)]
    except (TypeError, ZeroDivisionError) as problem:
        raise QueryError(f"options of the {name} window: {problem}") from None
