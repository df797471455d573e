"""Lift and Fisher's exact test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the hypergeometric sum that are held at once.
STEP = 1 << 20
_SMALL = np.array([math.lgamma(i + 1) for i in range(32)])


def lift(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Share of the first row's hits over the second row's, null where a share is undefined or zero below."""
    return F.when((a + b > 0) & (c + d > 0) & (c > 0), (a / (a + b)) / (c / (c + d)))


def log_factorial(x: np.ndarray) -> np.ndarray:
    """Stirling's series; exact for small numbers."""
    x = np.asarray(x, dtype=np.float64)
    y = np.maximum(x, 32)
    series = y * np.log(y) - y + 0.5 * np.log(2 * np.pi * y) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return np.where(x < 32, _SMALL[np.minimum(x, 31).astype(int)], series)


def fisher_p(a: int, b: int, c: int, d: int) -> float:
    """Two-sided p of a 2 x 2 table: the sum over tables with its margins that are no likelier."""
    r1, r2, k, n = a + b, c + d, a + c, a + b + c + d
    fixed = float(log_factorial(r1) + log_factorial(r2) + log_factorial(k) + log_factorial(n - k) - log_factorial(n))
    chance = lambda x: fixed - log_factorial(x) - log_factorial(r1 - x) - log_factorial(k - x) - log_factorial(r2 - k + x)
    seen, total = float(chance(np.array(a))), 0.0
    for lo in range(max(0, k - r2), min(r1, k) + 1, STEP):
        x = chance(np.arange(lo, min(lo + STEP, min(r1, k) + 1)))
        total += float(np.exp(x[x <= seen + 1e-9]).sum())
    return min(total, 1.0)


def fisher(a: Column, b: Column, c: Column, d: Column) -> Column:
    """fisher_p of each row, in Arrow batches; there are as many rows as tables."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([fisher_p(*map(int, x)) for x in zip(a, b, c, d, strict=True)], dtype="float64")

    return run(a, b, c, d)
