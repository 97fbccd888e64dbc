"""TS7 with parameters chosen by grid, by a parallel scan.

Exponential smoothing is an affine recursion: state -> A state + g y, with A and g fixed by the
parameters (level; level and trend; level, trend and a season). Affine maps compose, so an item's
history is cut into slices of periods, each of which composes its own map for every point of the
grid at once; the maps of an item's slices, a few rows, are scanned in order, which gives every
slice the state it starts from; the slices are then replayed for the one-step errors. The point
of the least sum of squares is chosen for each item, and the scan's last state forecasts. An item
of any length is spread over as many tasks as it has slices."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .forecast import ITEM, QUANTILES, SEASONS, TS, Y, Z, _age, _long, _moment, _shift, hw_system

KEYS = [ITEM, "window", "cutoff"]
#: Periods in a slice.
SLICE = 512
#: Smoothing parameters tried: level, trend, season.
GRID = {"alpha": (0.1, 0.3, 0.5, 0.8), "beta": (0.05, 0.2), "gamma": (0.05, 0.2)}


def grid_points(kind: str, grid=None) -> list[tuple[float, float, float]]:
    """(alpha, beta, gamma) of every point; what a kind has no use for is 0."""
    g = GRID | (grid or {})
    return list(itertools.product(g["alpha"], g["beta"] if kind != "simple" else (0.0,), g["gamma"] if kind == "season" else (0.0,)))


def system(kind: str, point, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A, g, h): the next state is A x + g y, the one-step forecast h x."""
    a, b, c = point
    if kind == "simple":
        return np.array([[1 - a]]), np.array([a]), np.array([1.0])
    if kind == "trend":
        return np.array([[1 - a, 1 - a], [-a * b, 1 - a * b]]), np.array([a, a * b]), np.array([1.0, 1.0])
    mat, g = hw_system(a, b, c, m)
    h = np.zeros(m + 2)
    h[0] = h[1] = h[m + 1] = 1.0                                 # level, trend, the term of one season ago
    return np.array(mat), np.array(g), h


def _systems(kind, points, m):
    parts = [system(kind, p, m) for p in points]
    return tuple(np.stack(x) for x in zip(*parts))


def _compose(kind, points, m):
    """Slice -> its number of periods and, for each point, what its values add to A^n x."""
    a, g, _ = _systems(kind, points, m)
    dims = a.shape[1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        y = pdf[Y].to_numpy(float)
        first = int(pdf["at"].iloc[0]) == 0
        x = np.zeros((len(points), dims))
        if first:
            x[:, 0] = y[0]                                       # the first value is the first level
        for v in y[1:] if first else y:
            x = np.einsum("pij,pj->pi", a, x) + g * v
        return pd.DataFrame([{ITEM: pdf[ITEM].iloc[0], "window": pdf["window"].iloc[0], "cutoff": pdf["cutoff"].iloc[0],
                              "slice": pdf["slice"].iloc[0], "n": len(y), "adds": x.ravel().tolist()}])
    return run


def _scan(kind, points, m):
    """The slices of an item in order -> the state each starts from, and the last state."""
    a, _, _ = _systems(kind, points, m)
    dims = a.shape[1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slice")
        x, rows = np.zeros((len(points), dims)), []
        for r in pdf.itertuples(index=False):
            rows.append((int(r.slice), x.ravel().tolist()))
            power = np.stack([np.linalg.matrix_power(mat, int(r.n)) for mat in a])
            x = np.einsum("pij,pj->pi", power, x) + np.array(r.adds).reshape(len(points), dims)
        rows.append((-1, x.ravel().tolist()))
        out = pd.DataFrame(rows, columns=["slice", "state"])
        return out.assign(**{k: pdf[k].iloc[0] for k in KEYS})[[*KEYS, "slice", "state"]]
    return run


def _replay(kind, points, m):
    """Slice and the state it starts from -> sum of squared one-step errors of every point."""
    a, g, h = _systems(kind, points, m)
    dims = a.shape[1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        y = pdf[Y].to_numpy(float)
        x = np.array(pdf["state"].iloc[0]).reshape(len(points), dims).copy()
        sse = np.zeros(len(points))
        first = int(pdf["at"].iloc[0]) == 0
        if first:
            x[:, 0] = y[0]
        for v in y[1:] if first else y:
            sse += (v - np.einsum("pi,pi->p", h, x)) ** 2
            x = np.einsum("pij,pj->pi", a, x) + g * v
        return pd.DataFrame([{ITEM: pdf[ITEM].iloc[0], "window": pdf["window"].iloc[0], "cutoff": pdf["cutoff"].iloc[0],
                              "sse": sse.tolist(), "errors": len(y) - int(first)}])
    return run


def _slices(train: DataFrame, freq: str, size: int) -> DataFrame:
    """Training points with their period since the item's first point, and its slice. Points without
    a value are left out and those behind them move up."""
    x = train.where(F.col(Y).isNotNull()).select(*KEYS, Y, _age(freq).alias("age"))
    first = x.groupBy(*KEYS).agg(F.max("age").alias("__n1"))
    return x.join(first, KEYS).withColumn("at", F.col("__n1") - F.col("age")).withColumn("slice", F.expr(f"at div {size}").cast("long")).drop("__n1", "age")


def fit_grid(windows: DataFrame, kind: str = "season", m: int | None = None, freq: str = "day", grid=None, size: int = SLICE) -> DataFrame:
    """(item, window, cutoff, alpha, beta, gamma, sse, errors, state): for each item and window the
    point of the grid with the least sum of squared one-step errors over the training points (the
    first of equal ones), that sum, the number of errors, and the state after the last point."""
    m, points = m or SEASONS[freq], grid_points(kind, grid)
    keys = f"{ITEM} string, window int, cutoff {_moment(freq)}"
    x = cut_lineage(_slices(windows.where(F.col("split") == "train"), freq, size))      # composed and replayed
    composed = x.groupBy(*KEYS, "slice").applyInPandas(_compose(kind, points, m), f"{keys}, slice long, n long, adds array<double>")
    states = cut_lineage(composed.groupBy(*KEYS).applyInPandas(_scan(kind, points, m), f"{keys}, slice long, state array<double>"))   # a row for each slice
    replayed = x.join(states, [*KEYS, "slice"]).groupBy(*KEYS, "slice").applyInPandas(_replay(kind, points, m), f"{keys}, sse array<double>, errors long")
    dims = system(kind, points[0], m)[0].shape[0]
    sse = replayed.select(*KEYS, "errors", F.posexplode("sse").alias("point", "sse")).groupBy(*KEYS, "point").agg(F.sum("sse").alias("sse"), F.sum("errors").alias("errors"))
    best = sse.groupBy(*KEYS).agg(F.min(F.struct("sse", "point", "errors")).alias("b")).select(*KEYS, "b.*")
    table = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(c).alias("gamma")) for a, b, c in points])
    last = states.where("slice = -1").drop("slice")
    return best.join(last, KEYS).withColumn("__p", F.element_at(table, F.col("point") + 1)) \
        .select(*KEYS, "__p.*", "sse", "errors", F.slice("state", F.col("point") * dims + 1, dims).alias("state"))


def forecast_grid(windows: DataFrame, horizon: int, kind: str = "season", m: int | None = None, freq: str = "day", grid=None,
                  size: int = SLICE) -> DataFrame:
    """TS7 with the parameters of :func:`fit_grid`: level, trend and season of the last state, and
    an interval from the one-step errors widened by the steps' multipliers of the parameters."""
    m = m or SEASONS[freq]
    fit = fit_grid(windows, kind, m, freq, grid, size)
    fut = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(TS, _shift(F.col("cutoff"), F.col("step"), freq))
    x, h, a, b, c = F.col("state"), F.col("step"), F.col("alpha"), F.col("beta"), F.col("gamma")
    mean = x[0]
    if kind != "simple":
        mean = mean + h * x[1]
    if kind == "season":
        mean = mean + F.element_at(x, (2 + F.lit(m) - (h - 1) % m).cast("int"))
    # what an error of one step adds j steps later
    weight = lambda j: a * (1 + j * b) + F.when((j % m == 0) & (F.lit(kind) == "season"), c).otherwise(0.0)
    total = F.when(h > 1, F.aggregate(F.sequence(F.lit(1), F.greatest(h - 1, F.lit(1))), F.lit(0.0), lambda acc, j: acc + weight(j) * weight(j))).otherwise(0.0)
    sd = F.sqrt(F.try_divide(F.col("sse"), F.col("errors")) * (1 + total))
    name = {"simple": "ETSgrid", "trend": "HoltGrid", "season": "HoltWintersGrid"}[kind]
    return _long(fut.withColumn("__mean", mean).withColumn("__sd", F.coalesce(sd, F.lit(0.0))), name, {q: F.col("__mean") + F.lit(Z[q]) * F.col("__sd") for q in QUANTILES})


def recursion(y, kind: str, point, m: int) -> tuple[float, list[float]]:
    """Sum of squared one-step errors and last state, value by value (the definition)."""
    mat, g, h = system(kind, point, m)
    x, sse = np.zeros(len(g)), 0.0
    x[0] = y[0]
    for v in y[1:]:
        sse += float(v - h @ x) ** 2
        x = mat @ x + g * v
    return sse if math.isfinite(sse) else math.inf, x.tolist()
