"""TS9 with changes of slope: the harmonic model with a hinge at each of a few knots spread over an
item's history, most of them kept at zero by a lasso.

Sums of products of all columns are aggregated by Spark, one table for each item and window; what
follows works on these tables in batches. The columns without a penalty (trend, seasons, holidays)
are solved out exactly, which leaves a small table of the hinges alone; coordinate descent on that
gives their changes of slope. The penalty is a share of the least one that keeps all hinges at
zero, so it has no unit."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forecast import ITEM, QUANTILES, TS, Y, Z, _design, _future, _long, _moment

KEYS = [ITEM, "window", "cutoff"]
#: Knots, the share of the history they are spread over, and the penalty's share of the largest.
KNOTS, SPREAD, PENALTY = 12, 0.8, 0.02
SWEEPS, TOLERANCE = 1000, 1e-10


def _with_hinges(rows: DataFrame, spans: DataFrame, knots: int) -> DataFrame:
    """Columns h_0 .. : how far a point lies behind each knot, in spans of its item's history."""
    at = (F.unix_timestamp(F.col(TS).cast("timestamp")) - F.col("__from")) / F.greatest(F.col("__to") - F.col("__from"), F.lit(1))
    x = rows.join(spans, KEYS).withColumn("__at", at)
    return x.withColumns({f"h_{j}": F.greatest(F.col("__at") - SPREAD * (j + 1) / (knots + 1), F.lit(0.0)) for j in range(knots)}).drop("__at", "__from", "__to")


def lasso(gram: np.ndarray, target: np.ndarray, penalty: float) -> np.ndarray:
    """Coordinate descent on batches of sums of products (n, k, k) and (n, k): minimises
    x' gram x / 2 - target x + weight * sum(|x| * size), with the weight ``penalty`` times the least
    that gives zero, and columns scaled to equal size."""
    size = np.sqrt(np.maximum(np.einsum("nii->ni", gram), 1e-300))
    real = size > 1e-8 * np.maximum(size.max(axis=1, keepdims=True), 1e-300)
    g = np.where(real[:, :, None] & real[:, None, :], gram / size[:, :, None] / size[:, None, :], np.eye(gram.shape[1]))
    t = np.where(real, target / size, 0.0)
    weight = penalty * np.abs(t).max(axis=1)
    x = np.zeros_like(t)
    for _ in range(SWEEPS):
        before = x.copy()
        for j in range(x.shape[1]):
            rest = t[:, j] - np.einsum("nk,nk->n", g[:, j], x) + x[:, j]
            x[:, j] = np.sign(rest) * np.maximum(np.abs(rest) - weight, 0.0)
        if np.abs(x - before).max(initial=0.0) <= TOLERANCE * max(np.abs(x).max(initial=0.0), 1.0):
            break
    return np.where(real, x / size, 0.0)


def _solve(pdf: pd.DataFrame, k: int, knots: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of all columns and residual variances."""
    n = k + knots
    a = np.zeros((len(pdf), n, n))
    for i in range(n):
        for j in range(i, n):
            a[:, i, j] = a[:, j, i] = pdf[f"a_{i}_{j}"].to_numpy(float)
    b = np.stack([pdf[f"b_{i}"].to_numpy(float) for i in range(n)], 1)
    size = np.sqrt(np.maximum(np.einsum("nii->ni", a[:, :k, :k]), 1e-300))
    scaled = a[:, :k, :k] / size[:, :, None] / size[:, None, :] + 1e-10 * np.eye(k)
    right = np.concatenate([a[:, :k, k:], b[:, :k, None]], 2) / size[:, :, None]
    out = np.linalg.solve(scaled, right) / size[:, :, None]      # what the free columns take of each hinge and of y
    inner = a[:, k:, k:] - np.einsum("nkh,nkj->nhj", a[:, :k, k:], out[:, :, :knots])
    hinge = lasso((inner + inner.transpose(0, 2, 1)) / 2, b[:, k:] - np.einsum("nkh,nk->nh", a[:, :k, k:], out[:, :, knots]), penalty)
    beta = np.concatenate([out[:, :, knots] - np.einsum("nkh,nh->nk", out[:, :, :knots], hinge), hinge], 1)
    sse = pdf["yy"].to_numpy(float) - 2 * np.einsum("ni,ni->n", beta, b) + np.einsum("ni,nij,nj->n", beta, a, beta)
    used = k + (hinge != 0).sum(axis=1)
    return beta, np.maximum(sse, 0.0) / np.maximum(pdf["n"].to_numpy(float) - used, 1)


def fit_changepoints(windows: DataFrame, fourier: int = 2, calendar: DataFrame | None = None, country: str = "US", freq: str = "day",
                     knots: int = KNOTS, penalty: float = PENALTY) -> tuple[DataFrame, DataFrame, list[str]]:
    """((item, window, cutoff, beta, s2), each item's span of history, the columns without a penalty):
    beta holds the latter's coefficients, then the change of slope at each knot, for one span."""
    train = windows.where(F.col("split") == "train")
    second = F.unix_timestamp(F.col(TS).cast("timestamp"))
    spans = train.groupBy(*KEYS).agg(F.min(second).alias("__from"), F.max(second).alias("__to"))
    x, cols = _design(train, fourier, calendar, country, freq)
    x = _with_hinges(x, spans, knots)
    every = cols + [f"h_{j}" for j in range(knots)]
    sums = [F.sum(F.col(every[i]) * F.col(every[j])).alias(f"a_{i}_{j}") for i in range(len(every)) for j in range(i, len(every))]
    sums += [F.sum(F.col(c) * F.col(Y)).alias(f"b_{i}") for i, c in enumerate(every)]
    sums += [F.sum(F.col(Y) * F.col(Y)).alias("yy"), F.count(F.lit(1)).alias("n")]
    schema = f"{ITEM} string, window int, cutoff {_moment(freq)}, beta array<double>, s2 double"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        beta, s2 = _solve(pdf, len(cols), knots, penalty)
        return pdf[KEYS].assign(beta=list(beta), s2=s2)

    fit = x.where(F.col(Y).isNotNull()).groupBy(*KEYS).agg(*sums).mapInPandas(lambda it: (solve(p) for p in it if len(p)), schema)
    return fit, spans, cols


def forecast_changepoints(windows: DataFrame, horizon: int, fourier: int = 2, calendar: DataFrame | None = None, country: str = "US",
                          freq: str = "day", knots: int = KNOTS, penalty: float = PENALTY) -> DataFrame:
    """TS9 with changes of slope: as ``forecast_harmonic``, the last slope carried on."""
    fit, spans, cols = fit_changepoints(windows, fourier, calendar, country, freq, knots, penalty)
    fut, _ = _design(_future(windows.where(F.col("split") == "train"), horizon, freq), fourier, calendar, country, freq)
    j = _with_hinges(fut, spans, knots).join(fit, KEYS)
    mean = sum((F.col(c) * F.col("beta")[i] for i, c in enumerate(cols + [f"h_{q}" for q in range(knots)])), F.lit(0.0))
    sd = F.sqrt(F.col("s2"))
    return _long(j, "Changepoints", {q: mean + F.lit(Z[q]) * sd for q in QUANTILES})
