"""Weekly profiles as 200 DCT-II coefficients in base64 text."""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom.params import COEFFICIENTS, SLOTS_PER_WEEK


def basis(n: int = SLOTS_PER_WEEK, k: int = COEFFICIENTS) -> np.ndarray:
    """Orthonormal DCT-II rows, k x n."""
    rows = np.cos(np.pi / n * np.outer(np.arange(k), np.arange(n) + 0.5)) * np.sqrt(2 / n)
    rows[0] /= np.sqrt(2)
    return rows


def compress(profiles: np.ndarray, k: int = COEFFICIENTS) -> np.ndarray:
    """Rows of a week each (single precision) as int16 coefficients, rounded half to even."""
    if profiles.shape[-1] != SLOTS_PER_WEEK:
        raise ValueError(f"a week has {SLOTS_PER_WEEK} slots, not {profiles.shape[-1]}")
    return np.rint(profiles.astype(np.float32).astype(np.float64) @ basis(k=k).T).clip(-32768, 32767).astype(np.int16)


def decompress(coefficients: np.ndarray, n: int = SLOTS_PER_WEEK) -> np.ndarray:
    return coefficients.astype(np.float64) @ basis(n, coefficients.shape[-1])


def to_text(coefficients: np.ndarray) -> str:
    """Big-endian int16, base64 without line breaks."""
    return base64.b64encode(coefficients.astype(">i2").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">i2").astype(np.int16)


def coefficients_in(text: Column, k: int = COEFFICIENTS) -> Column:
    """array<int>: the coefficients that a text holds."""
    raw = F.unbase64(text)
    unsigned = lambda i: F.conv(F.hex(F.substring(raw, 2 * i + 1, F.lit(2))), 16, 10).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(unsigned(i) < 32768, unsigned(i)).otherwise(unsigned(i) - 65536))


def coefficients_of(profile: Column, k: int = COEFFICIENTS, n: int = SLOTS_PER_WEEK) -> Column:
    """The same coefficients by higher-order functions: array<int> of an array of n doubles."""

    def one(i: Column) -> Column:
        terms = F.zip_with(profile, F.sequence(F.lit(0), F.lit(n - 1)), lambda v, j: v * F.cos(F.lit(np.pi / n) * i * (j + 0.5)))
        scale = F.when(i == 0, F.lit(float(np.sqrt(1 / n)))).otherwise(F.lit(float(np.sqrt(2 / n))))
        return F.rint(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) * scale).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), one)


def pack_text(coefficients: Column) -> Column:
    """Big-endian int16 as base64 in one line."""
    digits = F.array_join(F.transform(coefficients, lambda c: F.lpad(F.right(F.hex(c.cast("long")), F.lit(4)), 4, "0")), "")
    return F.regexp_replace(F.base64(F.unhex(digits)), r"\s", "")
