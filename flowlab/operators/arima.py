"""TS8: ARIMA by the two-stage regression of Hannan and Rissanen, all orders from one table.

For each item one table of sums of products of (1, y_t, y_(t-1), ..., y_(t-L)) is aggregated by
Spark, and nothing else: differences are linear in these columns, so are the residuals of a long
autoregression (once its coefficients are known, from the same table), and so are the lags of
both. The normal equations of every (p, d, q) are therefore products of that table with small
matrices. Items are solved in batches; the least AIC chooses among all orders, which is fair as
all are fitted to the same points. Forecasts come from the recursion of the chosen order on the
last points, summed up again; intervals from its psi weights."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forecast import ITEM, QUANTILES, TS, Y, Z, _age, _moment, _shift

KEYS = [ITEM, "window", "cutoff"]
#: Lags of the first stage's long autoregression.
LONG = 6


def lag_table(train: DataFrame, lags: int, freq: str = "day") -> DataFrame:
    """(item, window, cutoff, a_i_j, n, last_0 .. last_lags): sums of products of 1, y_t, ...,
    y_(t-lags) over all points that have these lags, and the last values, newest first. Every
    value is sent to the period it is a lag of, one shuffle by (item, period): a long item is
    spread over all tasks, and no ordered window is needed."""
    sent = train.where(F.col(Y).isNotNull()).select(*KEYS, TS, F.col(Y).alias("__y"), _age(freq).alias("__age"))
    moved = sent.select(*KEYS, "__y", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("__lag"), "__age")
    moved = moved.withColumn("__to", F.col("__age") - F.col("__lag")).where("__to >= 0")
    row = moved.groupBy(*KEYS, "__to").agg(*[F.max(F.when(F.col("__lag") == i, F.col("__y"))).alias(f"y{i}") for i in range(lags + 1)],
                                           F.count(F.lit(1)).alias("__have"))
    cols = ["x0", *(f"y{i}" for i in range(lags + 1))]
    full = row.withColumn("x0", F.lit(1.0)).where(F.col("__have") == lags + 1)
    k = len(cols)
    sums = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"a_{i}_{j}") for i in range(k) for j in range(i, k)]
    newest = F.col("__to") == 0
    return full.groupBy(*KEYS).agg(*sums, F.count(F.lit(1)).alias("n"), *[F.max(F.when(newest, F.col(f"y{i}"))).alias(f"last_{i}") for i in range(lags + 1)])


def _tables(pdf: pd.DataFrame, k: int) -> np.ndarray:
    a = np.zeros((len(pdf), k, k))
    for i in range(k):
        for j in range(i, k):
            a[:, i, j] = a[:, j, i] = pdf[f"a_{i}_{j}"].to_numpy(float)
    return a


def _least_squares(gram: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and sum of squares of regressions of ``y`` (n, k) on ``x`` (n, r, k), both given
    as combinations of the columns of ``gram`` (n, k, k); regressors are scaled before a small ridge."""
    xx = np.einsum("nik,nkl,njl->nij", x, gram, x)
    xy = np.einsum("nik,nkl,nl->ni", x, gram, y)
    size = np.sqrt(np.maximum(np.einsum("nii->ni", xx), 1e-300))
    beta = np.linalg.solve(xx / size[:, :, None] / size[:, None, :] + 1e-10 * np.eye(x.shape[1]), (xy / size)[:, :, None])[:, :, 0] / size
    rest = y - np.einsum("ni,nik->nk", beta, x)
    return beta, np.maximum(np.einsum("nk,nkl,nl->n", rest, gram, rest), 0.0)


def _difference(d: int, at: int, k: int) -> np.ndarray:
    """The d-th difference at lag ``at`` as a combination of the columns."""
    row = np.zeros(k)
    row[1 + at:2 + at + d] = [1.0] if d == 0 else [1.0, -1.0] if d == 1 else [1.0, -2.0, 1.0]
    return row


def solve(gram: np.ndarray, n: np.ndarray, orders, long: int) -> dict:
    """For each order (p, d, q): coefficients (constant, phi, theta), sum of squares, AIC, and the
    residual at lag 0 as a combination of the columns (for the last residuals)."""
    items, k = len(gram), gram.shape[1]
    one = np.zeros(k)
    one[0] = 1.0
    out, residual = {}, {}
    for p, d, q in orders:
        w = [_difference(d, i, k) for i in range(max(p, long if q else 0) + 1)]
        x = [np.broadcast_to(v, (items, k)) for v in (one, *w[1:p + 1])]
        if q and d not in residual:                              # the long autoregression of this difference
            far = np.broadcast_to(np.stack([one, *w[1:long + 1]]), (items, long + 1, k))
            beta, _ = _least_squares(gram, far, np.broadcast_to(w[0], (items, k)))
            residual[d] = w[0] - np.einsum("ni,nik->nk", beta, far)
        for j in range(1, q + 1):                                # moved j periods back: all columns but the constant
            e = np.zeros((items, k))
            e[:, 0] = residual[d][:, 0]
            e[:, 1 + j:] = residual[d][:, 1:k - j]
            x.append(e)
        beta, sse = _least_squares(gram, np.stack(x, 1), np.broadcast_to(w[0], (items, k)))
        aic = n * np.log(np.maximum(sse, 1e-300) / np.maximum(n, 1)) + 2 * (1 + p + q)
        out[p, d, q] = (beta, sse, aic, residual.get(d))
    return out


def psi_weights(phi: np.ndarray, theta: np.ndarray, d: int, horizon: int) -> np.ndarray:
    """(items, horizon): what an error adds to the series h periods later."""
    items, p, q = len(phi), phi.shape[1], theta.shape[1]
    psi = np.zeros((items, horizon))
    for h in range(horizon):
        psi[:, h] = 1.0 if h == 0 else (theta[:, h - 1] if h <= q else 0.0) + sum((phi[:, i] * psi[:, h - 1 - i] for i in range(min(p, h))), np.zeros(items))
    for _ in range(d):
        psi = psi.cumsum(axis=1)
    return psi


def forecast_arima(windows: DataFrame, horizon: int, max_p: int = 2, ds=(0, 1), max_q: int = 1, long: int = LONG,
                   freq: str = "day", with_order: bool = False, orders=None) -> DataFrame:
    """TS8. For each item and window the order (p, d, q), p up to ``max_p``, d of ``ds`` (0 to 2), q up
    to ``max_q`` (or one of ``orders``), of the least AIC; its forecasts as rows (item, window,
    cutoff, step, ts, algorithm 'ARIMA', quantile, value), with the order and its coefficients if
    asked. Items without points enough for all lags, or without all of these up to the cutoff,
    have no rows; points without a value are left out."""
    orders = sorted(orders or itertools.product(range(max_p + 1), ds, range(max_q + 1)))
    if not {d for _, d, _ in orders} <= {0, 1, 2}:
        raise ValueError("differences of order 0 to 2")
    lags = max([max(p, long + q if q else 0) + d for p, d, q in orders])
    table = lag_table(windows.where(F.col("split") == "train"), lags, freq)\
        .where((F.col("n") > 2 + 2 * max(p + q for p, _, q in orders)) & F.col("last_0").isNotNull())
    k = lags + 2
    schema = f"{ITEM} string, window int, cutoff {_moment(freq)}, p int, d int, q int, coefficients array<double>, step int, quantile double, value double"

    def one_batch(pdf: pd.DataFrame) -> pd.DataFrame:
        n = pdf["n"].to_numpy(float)
        fits = solve(_tables(pdf, k), n, orders, long)
        best = np.stack([fits[o][2] for o in orders]).argmin(axis=0)
        columns = np.concatenate([np.ones((len(pdf), 1)), np.stack([pdf[f"last_{i}"].to_numpy(float) for i in range(lags + 1)], 1)], 1)
        parts = []
        for b in np.unique(best).tolist():
            (p, d, q), at = orders[b], np.flatnonzero(best == b)
            beta, sse, _, residual = (None if v is None else v[at] for v in fits[orders[b]])
            own, y = pdf.iloc[at], columns[at]
            c, phi, theta = beta[:, 0], beta[:, 1:1 + p], beta[:, 1 + p:]
            w = [y @ _difference(d, i, k) for i in range(p)]                  # newest first
            e = []
            for j in range(q):
                moved = np.zeros_like(residual)
                moved[:, 0], moved[:, 1 + j:] = residual[:, 0], residual[:, 1:k - j]
                e.append(np.einsum("nk,nk->n", moved, y))
            tail = [y @ _difference(i, 0, k) for i in range(d)]              # the last value, its difference, ...
            sd = np.sqrt(np.maximum(sse, 0)[:, None] / np.maximum(n[at] - 1 - p - q, 1)[:, None] * (psi_weights(phi, theta, d, horizon) ** 2).cumsum(axis=1))
            for h in range(1, horizon + 1):
                nxt = c + sum((phi[:, i] * w[i] for i in range(p)), 0.0) + sum((theta[:, j] * e[j] for j in range(q)), 0.0)
                w, e = [nxt, *w][:p], [np.zeros(len(at)), *e][:q]
                level = nxt
                for i in range(d - 1, -1, -1):
                    tail[i] = tail[i] + level
                    level = tail[i]
                for quantile in QUANTILES:
                    parts.append(pd.DataFrame({ITEM: own[ITEM], "window": own["window"], "cutoff": own["cutoff"], "p": p, "d": d, "q": q,
                                               "coefficients": list(beta), "step": h, "quantile": quantile, "value": level + Z[quantile] * sd[:, h - 1]}))
        return pd.concat(parts)

    out = table.mapInPandas(lambda it: (one_batch(pdf) for pdf in it if len(pdf)), schema)
    return out.select(*KEYS, "step", _shift(F.col("cutoff"), F.col("step"), freq).alias(TS), F.lit("ARIMA").alias("algorithm"), "quantile", "value",
                      *(["p", "d", "q", "coefficients"] if with_order else []))
