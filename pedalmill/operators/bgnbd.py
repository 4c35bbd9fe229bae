"""BG/NBD: who is still a customer, and how often they will buy (Fader, Hardie and Lee, 2005)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct (frequency, recency, age) in weeks that may come to the driver for the fit: the model sees no more of a customer.
MAX_CELLS = 2_000_000


def _nll(log_p: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray, w: np.ndarray, penalty: float) -> float:
    r, alpha, a, b = np.exp(log_p)
    lg = np.vectorize(math.lgamma)
    a1 = lg(r + x) - math.lgamma(r) + r * math.log(alpha)
    a2 = math.lgamma(a + b) + lg(b + x) - math.lgamma(b) - lg(a + b + x)
    a3 = -(r + x) * np.log(alpha + t)
    a4 = np.where(x > 0, math.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + tx), -np.inf)
    ll = a1 + a2 + np.logaddexp(a3, a4)
    return float(-(w * ll).sum() / w.sum() + penalty * (np.exp(log_p) ** 2).sum())


def fit(cells: pd.DataFrame, penalty: float = 0.01, rounds: int = 400) -> tuple[float, float, float, float]:
    """(r, alpha, a, b) by Nelder-Mead over their logarithms; ``cells``: frequency, recency, age, n."""
    x, tx, t, w = (cells[c].to_numpy(float) for c in ("frequency", "recency", "age", "n"))
    scale = max(t.max(), 1.0)
    f = lambda p: _nll(p, x, tx / scale * 10, t / scale * 10, w, penalty)
    simplex = [np.full(4, 0.1)]
    simplex += [simplex[0] + 0.4 * np.eye(4)[i] for i in range(4)]
    values = [f(p) for p in simplex]
    for _ in range(rounds):
        order = np.argsort(values)
        simplex, values = [simplex[i] for i in order], [values[i] for i in order]
        if abs(values[-1] - values[0]) < 1e-10:
            break
        mid = np.mean(simplex[:-1], axis=0)
        mirror = mid + (mid - simplex[-1])
        fm = f(mirror)
        if fm < values[0]:
            further = mid + 2 * (mid - simplex[-1])
            ff = f(further)
            simplex[-1], values[-1] = (further, ff) if ff < fm else (mirror, fm)
        elif fm < values[-2]:
            simplex[-1], values[-1] = mirror, fm
        else:
            inner = mid + 0.5 * (simplex[-1] - mid)
            fi = f(inner)
            if fi < values[-1]:
                simplex[-1], values[-1] = inner, fi
            else:
                simplex = [simplex[0], *[simplex[0] + 0.5 * (p - simplex[0]) for p in simplex[1:]]]
                values = [values[0], *[f(p) for p in simplex[1:]]]
    r, alpha, a, b = np.exp(simplex[int(np.argmin(values))])
    return float(r), float(alpha * scale / 10), float(a), float(b)


def _hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    term, total = np.ones_like(z), np.ones_like(z)
    for k in range(2000):
        term = term * (a + k) * (b + k) / ((c + k) * (k + 1)) * z
        total = total + term
        if np.abs(term).max(initial=0.0) < 1e-12:
            break
    return total


def forecast(summary: DataFrame, weeks: int, penalty: float = 0.01) -> DataFrame:
    """``summary`` (customer, frequency, recency, age in weeks) with p_alive and expected, purchases in ``weeks``.

    The fit uses the histogram of (frequency, recency, age), whose size depends on the weeks observed and
    not on the customers; more than MAX_CELLS cells raise, none is left out. Scores are column arithmetic in Arrow
    batches. A customer without a repeat is alive with certainty; an empty summary gives an empty result.
    """
    cells = summary.groupBy("frequency", "recency", "age").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} distinct (frequency, recency, age); sum up longer periods than weeks")
    if cells.empty:
        return summary.withColumns({"p_alive": F.lit(None).cast("double"), "expected": F.lit(None).cast("double")})
    r, alpha, a, b = fit(cells, penalty)

    def alive(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.Series:
        x, tx, t = (s.astype(float) for s in (x, tx, t))
        odds = a / (b + np.maximum(x, 1) - 1) * ((alpha + t) / (alpha + tx)) ** (r + x)
        return pd.Series(np.where(x > 0, 1 / (1 + odds), 1.0))

    def expected(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.Series:
        p = alive(x, tx, t).to_numpy()
        x, t = x.astype(float).to_numpy(), t.astype(float).to_numpy()
        z = weeks / (alpha + t + weeks)
        h = _hyp2f1(r + x, b + x, a + b + x - 1, z)
        first = (a + b + x - 1) / (a - 1) if abs(a - 1) > 1e-9 else np.full_like(x, np.nan)
        e = first * (1 - ((alpha + t) / (alpha + t + weeks)) ** (r + x) * h)
        return pd.Series(np.maximum(e * np.where(x > 0, p, 1.0), 0.0))

    three = ("frequency", "recency", "age")
    doubles = lambda f: F.pandas_udf(f, "double")(*three)
    return summary.withColumn("p_alive", doubles(alive)).withColumn("expected", doubles(expected))
