"""Forecasting workflow (TS1-TS17) on long series ``(item_id, ts, target_value)``.

Design: windows, items, quantiles and algorithms are columns, so one plan evaluates all of
them. Every model reduces to grouped aggregates that combine map-side (weighted value
counts, closed-form smoothing sums, regression sums), so a hot item never has to sit whole
in one task: NPTS sums weights per distinct value before ranking, SES is a weighted sum,
AR(1) uses ``regr_*`` aggregates over a one-step self-join, the harmonic model solves the
normal equations from per-item sums of products.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import year_range
from .mapping import add_constant, apply_mapping, drop_fields

ITEM, TS, Y = "item_id", "ts", "target_value"

# ---- fixed values -------------------------------------------------------------------------
QUANTILES = [0.1, 0.5, 0.9]
QUANTILE_NAMES = {0.1: "p10", 0.5: "p50", 0.9: "p90"}
# Standard normal quantiles for the Gaussian interval models.
Z = {0.1: -1.2815515655446004, 0.5: 0.0, 0.9: 1.2815515655446004}
# Holiday rules: (country, holiday, month, day, weekday 1=Sun..7=Sat, nth; -1 = last).
# day > 0 means a fixed date; otherwise the nth weekday of the month.
HOLIDAY_RULES = [
    ("US", "New Year's Day", 1, 1, 0, 0),
    ("US", "Martin Luther King Jr. Day", 1, 0, 2, 3),
    ("US", "Washington's Birthday", 2, 0, 2, 3),
    ("US", "Memorial Day", 5, 0, 2, -1),
    ("US", "Independence Day", 7, 4, 0, 0),
    ("US", "Labor Day", 9, 0, 2, 1),
    ("US", "Columbus Day", 10, 0, 2, 2),
    ("US", "Veterans Day", 11, 11, 0, 0),
    ("US", "Thanksgiving", 11, 0, 5, 4),
    ("US", "Christmas Day", 12, 25, 0, 0),
    ("DE", "Neujahr", 1, 1, 0, 0),
    ("DE", "Tag der Arbeit", 5, 1, 0, 0),
    ("DE", "Tag der Deutschen Einheit", 10, 3, 0, 0),
    ("DE", "Erster Weihnachtstag", 12, 25, 0, 0),
    ("DE", "Zweiter Weihnachtstag", 12, 26, 0, 0),
    ("GB", "New Year's Day", 1, 1, 0, 0),
    ("GB", "Early May Bank Holiday", 5, 0, 2, 1),
    ("GB", "Spring Bank Holiday", 5, 0, 2, -1),
    ("GB", "Summer Bank Holiday", 8, 0, 2, -1),
    ("GB", "Christmas Day", 12, 25, 0, 0),
    ("GB", "Boxing Day", 12, 26, 0, 0),
]
# -------------------------------------------------------------------------------------------


def _shift(c: Column, k, freq: str = "day") -> Column:
    """Date ``c`` moved by ``k`` periods (k may be a Column)."""
    if freq == "day":
        return F.date_add(c, k)
    if freq == "week":
        return F.date_add(c, k * 7 if isinstance(k, int) else k * F.lit(7))
    if freq == "month":
        return F.add_months(c, k)
    if freq == "hour":
        return c + F.make_dt_interval(F.lit(0), (F.lit(k) if isinstance(k, int) else k).cast("int"))
    raise ValueError(f"unsupported frequency {freq}")


def _period_diff(a: Column, b: Column, freq: str = "day") -> Column:
    """Whole periods from b to a."""
    if freq == "day":
        return F.datediff(a, b)
    if freq == "week":
        return F.floor(F.datediff(a, b) / 7)
    if freq == "month":
        return F.round(F.months_between(a, b)).cast("int")
    if freq == "hour":
        return F.floor((F.unix_seconds(a) - F.unix_seconds(b)) / 3600).cast("int")
    raise ValueError(f"unsupported frequency {freq}")


def _age(freq: str) -> Column:
    """Whole periods from a training point to the cutoff."""
    return _period_diff(F.col("cutoff"), F.col(TS), freq).cast("int")


def _moment(freq: str) -> str:
    """Type of a period's start: dates, but hours of a day are timestamps."""
    return "timestamp" if freq == "hour" else "date"


#: Periods of a season, by frequency.
SEASONS = {"hour": 24, "day": 7, "week": 52, "month": 12}


# ---- TS1 / AGG2 / TS2 / TS3 ------------------------------------------------------------------

def prepare_series(raw: DataFrame, ds: str = "ds", y: str = "y", item_col: str | None = None,
                   item_value: str = "1", years: tuple | None = None, inclusive: bool = False,
                   drop=("index",)) -> DataFrame:
    """TS1. Raw ``(index, ds 'yyyy-MM-dd', y)`` -> ``(ts timestamp, target_value double, item_id string)``:
    drop the index, rename and cast, constant item id unless an item column is given,
    optional year range written as a date range (pushed to the scan)."""
    df = drop_fields(raw, list(drop))
    if years is not None:
        df = year_range(df, ds, years[0], years[1], inclusive)
    m = [(ds, "string", "timestamp", "timestamp"), (y, "double", Y, "double")]
    if item_col:
        m.append((item_col, "string", ITEM, "string"))
    out = apply_mapping(df, m)
    return out if item_col else add_constant(out, ITEM, str(item_value), "string")


def to_daily(series: DataFrame, ts: str = "timestamp", freq: str = "day") -> DataFrame:
    """AGG2 for forecasting: sum duplicates into one row per (item, period start date)."""
    unit = {"hour": "hour", "day": "day", "week": "week", "month": "month"}[freq]
    d = F.date_trunc(unit, F.col(ts)).cast(_moment(freq))
    return series.groupBy(F.col(ITEM), d.alias(TS)).agg(F.sum(Y).alias(Y))


def fill_gaps(series: DataFrame, freq: str = "day", middlefill: str = "zero", backfill: str = "zero",
              end=None, fill_value: float = 0.0) -> DataFrame:
    """TS2. Complete every item's calendar from its first point to the common end (the latest
    point of any item, or ``end``). Middle gaps (before the item's last point) get
    ``middlefill``, the tail after it gets ``backfill``: zero | value | mean | median | ffill |
    nan. ``median`` is the item's exact median, ``ffill`` the last point before the gap: each
    point's value is laid over the dates up to the item's next point and joined by date.
    Adds ``was_filled``; filled points are not scored.
    """
    kinds = {middlefill, backfill}
    span = series.groupBy(ITEM).agg(F.min(TS).alias("__first"), F.max(TS).alias("__last"), F.avg(Y).alias("__mean"),
                                    (F.percentile(Y, 0.5) if "median" in kinds else F.lit(None).cast("double")).alias("__median"))
    if end is None:
        end = series_end(series)        # one scalar
    end_col = F.lit(end).cast(_moment(freq))
    step = {"hour": F.expr("INTERVAL 1 HOUR"), "day": F.expr("INTERVAL 1 DAY"), "week": F.expr("INTERVAL 7 DAYS"),
            "month": F.expr("INTERVAL 1 MONTH")}[freq]
    cal = span.select(ITEM, "__last", "__mean", "__median",
                      F.explode(F.sequence(F.col("__first"), end_col, step)).alias(TS))
    j = cal.join(series.select(ITEM, TS, Y), [ITEM, TS], "left")
    if "ffill" in kinds:
        # a point holds from its date to the day before the next one: lay its value over those dates
        ahead = Window.partitionBy(ITEM).orderBy(TS)
        held = series.select(ITEM, F.col(TS).alias("__from"), F.col(Y).alias("__held"),
                             F.coalesce(F.lead(TS).over(ahead), _shift(end_col, 1, freq)).alias("__to"))
        held = held.select(ITEM, "__held", F.explode(F.filter(F.sequence("__from", "__to", step), lambda x: x < F.col("__to"))).alias(TS))
        j = j.join(held, [ITEM, TS], "left")

    def fill(kind):
        return {"zero": F.lit(0.0), "value": F.lit(float(fill_value)), "mean": F.col("__mean"), "median": F.col("__median"),
                "nan": F.lit(None).cast("double"), "ffill": F.col("__held") if "ffill" in kinds else None}[kind]

    filled = (F.when(F.col(Y).isNotNull(), F.col(Y))
              .when(F.col(TS) <= F.col("__last"), fill(middlefill))
              .otherwise(fill(backfill)))
    return j.select(ITEM, TS, filled.alias(Y), F.col(Y).isNull().alias("was_filled"))


def series_years(series: DataFrame, ts: str = TS) -> tuple[int, int]:
    """First and last year of a series (two scalars); (1970, 1970) for an empty one."""
    lo, hi = series.agg(F.year(F.min(ts)), F.year(F.max(ts))).first()
    return (lo, hi) if lo is not None else (1970, 1970)


def holiday_calendar(spark, countries, start_year: int, end_year: int) -> DataFrame:
    """Holiday table ``(country, ds, holiday)`` generated from rules; size = #years x #rules.
    The years come from the data it serves (``series_years``), with room for a horizon."""
    rules = [r for r in HOLIDAY_RULES if r[0] in countries]
    arr = F.array(*[F.struct(F.lit(c).alias("country"), F.lit(h).alias("holiday"), F.lit(m).alias("m"),
                             F.lit(d).alias("d"), F.lit(w).alias("w"), F.lit(n).alias("n"))
                    for c, h, m, d, w, n in rules])
    y = spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("y"), F.inline(arr))
    first = F.make_date("y", "m", F.lit(1))
    last = F.last_day(first)
    nth = F.date_add(first, ((F.col("w") - F.dayofweek(first) + 7) % 7 + 7 * (F.col("n") - 1)).cast("int"))
    lastw = F.date_sub(last, ((F.dayofweek(last) - F.col("w") + 7) % 7).cast("int"))
    ds = (F.when(F.col("d") > 0, F.make_date("y", "m", "d"))
          .when(F.col("n") == -1, lastw).otherwise(nth))
    return y.select("country", ds.alias("ds"), "holiday")


def calendar_features(series: DataFrame, calendar: DataFrame | None = None, country: str = "US",
                      fourier_yearly: int = 2, fourier_weekly: int = 1) -> DataFrame:
    """TS3. Day of week, month, day of year, holiday flag (JOI5) and Fourier terms."""
    from .joins import attach_holidays

    d = F.col(TS)
    out = series.withColumn("dow", F.dayofweek(d)).withColumn("month", F.month(d)) \
        .withColumn("doy", F.dayofyear(d))
    for k in range(1, fourier_yearly + 1):
        a = 2 * math.pi * k * F.dayofyear(d) / 365.25
        out = out.withColumn(f"sin_y{k}", F.sin(a)).withColumn(f"cos_y{k}", F.cos(a))
    for k in range(1, fourier_weekly + 1):
        a = 2 * math.pi * k * F.dayofweek(d) / 7.0
        out = out.withColumn(f"sin_w{k}", F.sin(a)).withColumn(f"cos_w{k}", F.cos(a))
    if calendar is not None:
        out = attach_holidays(out, calendar, country, TS, "holiday")
        out = out.withColumn("is_holiday", F.col("holiday").isNotNull().cast("int"))
    return out


# ---- TS4 backtest windows -------------------------------------------------------------------

def series_end(series: DataFrame):
    """The latest date of the series (one scalar to the driver)."""
    return series.agg(F.max(TS)).first()[0]


def backtest_windows(series: DataFrame, horizon: int, n_windows: int = 1, end=None,
                     freq: str = "day") -> DataFrame:
    """TS4. Tag rows with ``(window, cutoff, split)`` for ``n_windows`` back-to-back test
    windows of ``horizon`` periods (hours, days, weeks or months) ending at ``end``. Window 1 is the
    newest. A row may belong to several windows (train of an older one, test of a newer one).
    Raises for other than 1 to 5 windows, or if the test windows cover more than half of the
    longest series."""
    if not 1 <= n_windows <= 5:
        raise ValueError("1 to 5 backtest windows")
    if freq not in SEASONS:
        raise ValueError(f"unsupported frequency {freq}")
    begin = series.agg(F.min(TS)).first()[0]
    if end is None:
        end = series_end(series)
    if isinstance(end, str):
        end = _dt.datetime.fromisoformat(end) if freq == "hour" else _dt.date.fromisoformat(end[:10])
    def back(k):
        return _shift(F.lit(end).cast(_moment(freq)), -k * horizon, freq)

    if begin is not None and end is not None:
        n = {"hour": int((end - begin).total_seconds()) // 3600, "day": (end - begin).days, "week": (end - begin).days // 7,
             "month": 12 * (end.year - begin.year) + end.month - begin.month}[freq] + 1
        if 2 * n_windows * horizon > n:
            raise ValueError("the test windows cover more than half of the series")
    arr = F.array(*[F.struct(F.lit(k).alias("window"), back(k).alias("cutoff")) for k in range(1, n_windows + 1)])
    x = series.select("*", F.inline(arr))
    lim = _shift(F.col("cutoff"), horizon, freq)
    split = F.when(F.col(TS) <= F.col("cutoff"), F.lit("train")).when(F.col(TS) <= lim, F.lit("test"))
    return x.withColumn("split", split).filter(F.col("split").isNotNull())


def final_cutoff(series: DataFrame, end=None, freq: str = "day") -> DataFrame:
    """Whole series as the training part of window 0 (for the real forecast, TS15)."""
    if end is None:
        end = series_end(series)
    return series.withColumn("window", F.lit(0)).withColumn("cutoff", F.lit(end).cast(_moment(freq))) \
        .withColumn("split", F.lit("train"))


def _future(train: DataFrame, horizon: int, freq: str = "day", keys=(ITEM, "window", "cutoff")) -> DataFrame:
    """One row per (item, window, step) for the ``horizon`` periods after each cutoff."""
    k = train.select(*keys).distinct()
    return k.select(*keys, F.posexplode(F.sequence(F.lit(1), F.lit(horizon))).alias("__p", "step")) \
        .drop("__p").withColumn(TS, _shift(F.col("cutoff"), F.col("step"), freq))


def _long(df: DataFrame, algo: str, cols: dict) -> DataFrame:
    """Wide quantile columns -> long ``(quantile, value)`` rows tagged with the algorithm."""
    arr = F.array(*[F.struct(F.lit(q).alias("quantile"), c.alias("value")) for q, c in cols.items()])
    base = [c for c in df.columns if c in (ITEM, "window", "cutoff", "step", TS)]
    return df.select(*base, F.lit(algo).alias("algorithm"), F.inline(arr))


# ---- models -----------------------------------------------------------------------------------

def forecast_seasonal_naive(windows: DataFrame, horizon: int, m: int | None = None, freq: str = "day") -> DataFrame:
    """TS5. Value of the same position in the last full season (``m`` periods; by default that of
    the frequency) before the cutoff, repeated. Point forecast: all quantiles equal it."""
    m = m or SEASONS[freq]
    train = windows.filter(F.col("split") == "train")
    fut = _future(train, horizon, freq)
    back = m - 1 - ((F.col("step") - 1) % m)
    f = fut.withColumn("__src", _shift(F.col("cutoff"), (-back).cast("int"), freq))
    t = train.select(ITEM, "window", F.col(TS).alias("__src"), F.col(Y).alias("__v"))
    j = f.join(t, [ITEM, "window", "__src"], "left")
    return _long(j, "SeasonalNaive", {q: F.col("__v") for q in QUANTILES})


def weighted_quantiles(values: DataFrame, keys, value: str, weight: str, quantiles=QUANTILES) -> DataFrame:
    """Per group, for each q the smallest value whose cumulative weight reaches q x total.

    Weights are summed per distinct value first (map-side combine); the cumulative weight
    over the sorted distinct values is computed with range partitioning, so even a group
    holding most of the values is spread over many tasks."""
    from .ranking import cumulative_within_group

    keys = list(keys)
    agg = values.groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    x = cumulative_within_group(agg, keys, [value], "__w", cum_col="__cum", total_col="__tot")
    out = [F.min(F.when(F.round(F.col("__cum"), 9) >= F.round(F.col("__tot") * q, 9), F.col(value)))
           .alias(QUANTILE_NAMES.get(q, f"q{q}")) for q in quantiles]
    return x.groupBy(*keys).agg(*out)


def forecast_npts(windows: DataFrame, horizon: int, kernel: str = "exponential", decay: float = 0.01,
                  season: str | None = None, freq: str = "day") -> DataFrame:
    """TS6. Non-parametric: the future value follows the weighted empirical distribution of
    the training history; weight ``exp(-decay x age in periods)`` (or 1 for ``uniform``);
    with ``season`` ('dayofweek', 'month' or 'hour') only history of the target's season counts.
    Because each weight is relative to the cutoff, the distribution is the same for every
    step (apart from its season); quantiles are its weighted quantiles."""
    train = windows.filter(F.col("split") == "train")
    age = _age(freq)
    wt = F.exp(-F.lit(decay) * age) if kernel == "exponential" else F.lit(1.0)
    keys = [ITEM, "window", "cutoff"]
    phase = {"dayofweek": F.dayofweek, "month": F.month, "hour": F.hour}[season](TS) if season else None
    h = train.select(*keys, F.col(Y).alias("__v"), wt.alias("__wt"),
                     *([phase.alias("__season")] if season else []))
    qk = keys + (["__season"] if season else [])
    q = weighted_quantiles(h, qk, "__v", "__wt")
    fut = _future(train, horizon, freq)
    if season:
        fut = fut.withColumn("__season", phase)
    j = fut.join(q, qk, "left")
    return _long(j, "NPTS", {qq: F.col(QUANTILE_NAMES[qq]) for qq in QUANTILES})


def forecast_ets(windows: DataFrame, horizon: int, alpha: float = 0.3, nonnegative: bool = False, freq: str = "day") -> DataFrame:
    """TS7. Simple exponential smoothing, in closed form: level at the cutoff =
    sum over history of alpha(1-alpha)^age y + (1-alpha)^n y_first, a weighted sum (one
    aggregate). Interval: weighted residual spread around the level, widened with the step
    as in SES (sigma sqrt(1 + (h-1) alpha^2)). ``nonnegative`` cuts all quantiles at zero."""
    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    age = _age(freq)
    a = F.lit(alpha)
    st = train.groupBy(*keys).agg(F.min(TS).alias("__first"),
                                  F.min_by(Y, F.col(TS)).alias("__y0"),
                                  F.sum(a * F.pow(1 - a, age) * F.col(Y)).alias("__s"))
    # the first point carries (1-alpha)^(n-1) instead of alpha(1-alpha)^(n-1)
    n1 = _period_diff(F.col("cutoff"), F.col("__first"), freq)
    lvl = F.col("__s") - a * F.pow(1 - a, n1) * F.col("__y0") + F.pow(1 - a, n1) * F.col("__y0")
    st = st.withColumn("__level", lvl)
    wts = a * F.pow(1 - a, age)
    r = train.join(st.select(*keys, "__level"), keys).groupBy(*keys).agg(
        F.sqrt(F.try_divide(F.sum(wts * F.pow(F.col(Y) - F.col("__level"), 2)), F.sum(wts))).alias("__sd"))
    fut = _future(train, horizon, freq).join(st.select(*keys, "__level"), keys).join(r, keys)
    spread = F.col("__sd") * F.sqrt(1 + (F.col("step") - 1) * alpha * alpha)
    value = {q: F.col("__level") + F.lit(Z[q]) * spread if q != 0.5 else F.col("__level") for q in QUANTILES}
    return _long(fut, "ETS", {q: F.greatest(v, F.lit(0.0)) if nonnegative else v for q, v in value.items()})


def holt_weights(alpha: float, beta: float, max_lag: int) -> list[tuple]:
    """Holt's recursion is linear: state (level, trend) = A state + g y with
    A = [[1-a, 1-a], [-a b, 1-a b]], g = (a, a b). So the final state is
    sum_k A^k g y_(T-k) + A^(T-1) (y_1, 0). Returns rows (lag, wl, wb, cl, cb) with
    (wl, wb) = A^k g and (cl, cb) = A^k e1 for k = 0..max_lag (one row per lag)."""
    a11, a12 = 1.0 - alpha, 1.0 - alpha
    a21, a22 = -(alpha * beta), 1.0 - alpha * beta
    wl, wb, cl, cb = alpha, alpha * beta, 1.0, 0.0
    rows = []
    for k in range(max_lag + 1):
        rows.append((k, wl, wb, cl, cb))
        wl, wb = a11 * wl + a12 * wb, a21 * wl + a22 * wb
        cl, cb = a11 * cl + a12 * cb, a21 * cl + a22 * cb
    return rows


def forecast_holt(windows: DataFrame, horizon: int, alpha: float = 0.3, beta: float = 0.1, freq: str = "day") -> DataFrame:
    """TS7 (trend). Holt's linear method with level_1 = y_1, trend_1 = 0, evaluated exactly as
    weighted sums: the weights per lag come from ``holt_weights`` (a table with one row per
    period of history, joined by lag), so fitting is one grouped aggregate. Forecast
    level + h trend; interval from the weighted spread of the history around the fitted
    line, widened by sqrt(1 + sum_(j<h) a^2 (1 + j b)^2)."""
    spark = windows.sparkSession
    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    age = _age(freq)
    max_lag = train.agg(F.max(age)).first()[0] or 0          # one scalar
    w = spark.createDataFrame(holt_weights(alpha, beta, int(max_lag)),
                              "lag int, wl double, wb double, cl double, cb double")
    x = train.select(*keys, TS, Y, age.alias("lag"))
    first = x.groupBy(*keys).agg(F.max("lag").alias("__n1"), F.max_by(Y, F.col("lag")).alias("__y1"))
    x = x.join(first, keys).join(F.broadcast(w), "lag")      # one row per lag: bounded by the span
    x = x.withColumn("__in", F.col("lag") < F.col("__n1"))
    st = x.groupBy(*keys).agg(
        (F.coalesce(F.sum(F.when(F.col("__in"), F.col("wl") * F.col(Y))), F.lit(0.0))
         + F.max(F.when(~F.col("__in"), F.col("cl") * F.col(Y)))).alias("__l"),
        (F.coalesce(F.sum(F.when(F.col("__in"), F.col("wb") * F.col(Y))), F.lit(0.0))
         + F.max(F.when(~F.col("__in"), F.col("cb") * F.col(Y)))).alias("__b"))
    a = F.lit(alpha)
    fitted = F.col("__l") - F.col("lag") * F.col("__b")
    wt = a * F.pow(1 - a, F.col("lag"))
    sd = x.select(*keys, "lag", Y).join(st, keys).groupBy(*keys).agg(
        F.sqrt(F.try_divide(F.sum(wt * F.pow(F.col(Y) - fitted, 2)), F.sum(wt))).alias("__sd"))
    fut = _future(train, horizon, freq).join(st, keys).join(sd, keys)
    h = F.col("step")
    mean = F.col("__l") + h * F.col("__b")
    # sum_(j=1..h-1) (1 + j b)^2 = (h-1) + b h(h-1) + b^2 (h-1)h(2h-1)/6
    s2 = (h - 1) + F.lit(beta) * h * (h - 1) + F.lit(beta * beta) * (h - 1) * h * (2 * h - 1) / 6.0
    spread = F.col("__sd") * F.sqrt(1 + F.lit(alpha * alpha) * s2)
    return _long(fut, "Holt", {q: mean + F.lit(Z[q]) * spread for q in QUANTILES})


def hw_system(alpha: float, beta: float, gamma: float, m: int):
    """Additive Holt-Winters as a linear system x_t = A x_(t-1) + g y_t with
    x = (level, trend, s_t, s_(t-1), ..., s_(t-m+1)). Returns (A, g) as nested lists."""
    d = m + 2
    A = [[0.0] * d for _ in range(d)]
    last = m + 1                                     # s_(t-m) in the previous state
    A[0][0], A[0][1], A[0][last] = 1.0 - alpha, 1.0 - alpha, -alpha
    A[1][0], A[1][1], A[1][last] = -(alpha * beta), 1.0 - alpha * beta, -(alpha * beta)
    A[2][0], A[2][1], A[2][last] = -(gamma * (1.0 - alpha)), -(gamma * (1.0 - alpha)), gamma * alpha + 1.0 - gamma
    for i in range(1, m):
        A[2 + i][1 + i] = 1.0
    g = [alpha, alpha * beta, gamma * (1.0 - alpha)] + [0.0] * (m - 1)
    return A, g


def apply_matrix(A, x):
    """A x, summing the non-zero terms left to right (the oracle sums in the same order)."""
    out = []
    for row in A:
        acc = None
        for a, v in zip(row, x):
            if a != 0.0:
                acc = a * v if acc is None else acc + a * v
        out.append(0.0 if acc is None else acc)
    return out


def linear_weights(A, g, max_lag: int) -> list[tuple]:
    """Rows (lag, A^k g ..., A^k e_0 ...) for k = 0..max_lag."""
    w, c = list(g), [1.0] + [0.0] * (len(g) - 1)
    rows = []
    for k in range(max_lag + 1):
        rows.append((k, *w, *c))
        w, c = apply_matrix(A, w), apply_matrix(A, c)
    return rows


def hw_multipliers(alpha: float, beta: float, gamma: float, m: int, horizon: int) -> list[float]:
    """sqrt(1 + sum_(j=1..h-1) (alpha (1 + j beta) + gamma [j mod m = 0])^2) for h = 1..horizon."""
    out, acc = [], 0.0
    for h in range(1, horizon + 1):
        out.append(math.sqrt(1.0 + acc))
        c = alpha * (1.0 + h * beta) + (gamma if h % m == 0 else 0.0)
        acc += c * c
    return out


def forecast_holt_winters(windows: DataFrame, horizon: int, alpha: float = 0.3, beta: float = 0.1,
                          gamma: float = 0.2, m: int | None = None, freq: str = "day") -> DataFrame:
    """TS7 (trend + season). Additive Holt-Winters with level_1 = y_1, trend_1 = 0 and zero
    initial seasonal terms, evaluated exactly as weighted sums over the history (weights per
    lag from the system's matrix powers; one grouped aggregate). Forecast
    level + h trend + the seasonal term of the step's phase; interval from the weighted
    spread around the fitted values, widened by the Holt-Winters step multiplier."""
    spark, m = windows.sparkSession, m or SEASONS[freq]
    A, g = hw_system(alpha, beta, gamma, m)
    d = m + 2
    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    age = _age(freq)
    max_lag = train.agg(F.max(age)).first()[0] or 0          # one scalar
    schema = "lag int, " + ", ".join([f"w{i} double" for i in range(d)] + [f"c{i} double" for i in range(d)])
    w = spark.createDataFrame(linear_weights(A, g, int(max_lag)), schema)
    x = train.select(*keys, TS, Y, age.alias("lag"))
    first = x.groupBy(*keys).agg(F.max("lag").alias("__n1"))
    x = x.join(first, keys).join(F.broadcast(w), "lag")      # one row per lag: bounded by the span
    inside = F.col("lag") < F.col("__n1")
    st = x.groupBy(*keys).agg(*[
        (F.coalesce(F.sum(F.when(inside, F.col(f"w{i}") * F.col(Y))), F.lit(0.0))
         + F.max(F.when(~inside, F.col(f"c{i}") * F.col(Y)))).alias(f"__x{i}") for i in range(d)])
    st = st.withColumn("__S", F.array(*[F.col(f"__x{i}") for i in range(2, d)]))
    a = F.lit(alpha)
    fitted = F.col("__x0") - F.col("lag") * F.col("__x1") + F.element_at("__S", (F.col("lag") % m + 1).cast("int"))
    wt = a * F.pow(1 - a, F.col("lag"))
    sd = x.select(*keys, "lag", Y).join(st, keys).groupBy(*keys).agg(
        F.sqrt(F.try_divide(F.sum(wt * F.pow(F.col(Y) - fitted, 2)), F.sum(wt))).alias("__sd"))
    mult = F.array(*[F.lit(v) for v in hw_multipliers(alpha, beta, gamma, m, horizon)])
    fut = _future(train, horizon, freq).join(st, keys).join(sd, keys)
    h = F.col("step")
    season = F.element_at("__S", (F.lit(m) - (h - 1) % m).cast("int"))
    mean = F.col("__x0") + h * F.col("__x1") + season
    spread = F.col("__sd") * F.element_at(mult, h)
    return _long(fut, "HoltWinters", {q: mean + F.lit(Z[q]) * spread for q in QUANTILES})


def forecast_ar(windows: DataFrame, horizon: int, freq: str = "day") -> DataFrame:
    """TS8. AR(1) with intercept: y_t = c + phi y_(t-1), fitted by ``regr_*`` aggregates over a
    one-step self-join (no ordered window). h-step mean phi^h y_T + c(1-phi^h)/(1-phi),
    Gaussian interval with variance sigma^2 sum_(j<h) phi^(2j)."""
    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    prev = train.select(*keys, _shift(F.col(TS), 1, freq).alias(TS), F.col(Y).alias("__prev"))
    pairs = train.select(*keys, TS, Y).join(prev, keys + [TS])
    fit = pairs.groupBy(*keys).agg(
        F.regr_slope(Y, "__prev").alias("__phi"), F.regr_intercept(Y, "__prev").alias("__c"),
        F.regr_count(Y, "__prev").alias("__n"), F.regr_syy(Y, "__prev").alias("__syy"),
        F.regr_sxy(Y, "__prev").alias("__sxy"), F.regr_sxx(Y, "__prev").alias("__sxx"))
    last = train.groupBy(*keys).agg(F.max_by(Y, F.col(TS)).alias("__yT"))
    sse = F.col("__syy") - F.try_divide(F.col("__sxy") * F.col("__sxy"), F.col("__sxx"))
    fit = fit.withColumn("__s2", F.try_divide(F.greatest(sse, F.lit(0.0)), F.col("__n") - 2))
    fut = _future(train, horizon, freq).join(fit, keys).join(last, keys)
    phi, c, hh = F.coalesce(F.col("__phi"), F.lit(0.0)), F.coalesce(F.col("__c"), F.col("__yT")), F.col("step")
    ph = F.pow(phi, hh)
    geo = F.when(F.abs(1 - phi) < 1e-12, hh).otherwise((1 - ph) / (1 - phi))
    mean = ph * F.col("__yT") + c * geo
    var_sum = F.when(F.abs(1 - phi * phi) < 1e-12, hh).otherwise((1 - F.pow(phi, 2 * hh)) / (1 - phi * phi))
    sd = F.sqrt(F.coalesce(F.col("__s2"), F.lit(0.0)) * var_sum)
    return _long(fut, "AR", {q: mean + F.lit(Z[q]) * sd for q in QUANTILES})


def _solve_all(pdf, k: int):
    """Least-squares coefficients and residual variances of a batch of normal equations (columns
    a_i_j, b_i, yy, n), solved together. Rows are scaled to unit diagonal before a small relative
    ridge, so constant or tiny series stay solvable; the ridge takes the least coefficients then."""
    import numpy as np

    a = np.zeros((len(pdf), k, k))
    for i in range(k):
        for j in range(i, k):
            a[:, i, j] = a[:, j, i] = pdf[f"a_{i}_{j}"].to_numpy(float)
    b = np.stack([pdf[f"b_{i}"].to_numpy(float) for i in range(k)], 1)
    size = np.sqrt(np.maximum(np.einsum("nii->ni", a), 1e-300))
    scaled = a / size[:, :, None] / size[:, None, :] + 1e-10 * np.eye(k)
    beta = np.linalg.solve(scaled, (b / size)[:, :, None])[:, :, 0] / size
    sse = pdf["yy"].to_numpy(float) - 2 * np.einsum("ni,ni->n", beta, b) + np.einsum("ni,nij,nj->n", beta, a, beta)
    return beta, np.maximum(sse, 0.0) / np.maximum(pdf["n"].to_numpy(float) - k, 1)


def forecast_ar_p(windows: DataFrame, horizon: int, p: int = 2, freq: str = "day") -> DataFrame:
    """TS8 (order p). y_t = c + sum_i phi_i y_(t-i) by least squares per item. The lagged
    columns come from p equi-joins on t - i (no ordered window); X'X, X'y and y'y are grouped
    sums (partial aggregation), the last p values are conditional maxima. One row per item
    then goes through an Arrow-batched pandas function that solves the (p+1)x(p+1) system
    and runs the h-step recursion; the interval uses the psi-weights of the fitted model."""
    import numpy as np
    import pandas as pd

    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    base = train.select(*keys, TS, F.col(Y).alias("__y"))
    x = base
    for i in range(1, p + 1):
        lag = base.select(*keys, _shift(F.col(TS), i, freq).alias(TS), F.col("__y").alias(f"__l{i}"))
        x = x.join(lag, keys + [TS])
    cols = ["__one"] + [f"__l{i}" for i in range(1, p + 1)]
    x = x.withColumn("__one", F.lit(1.0))
    k = p + 1
    sums = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"a_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col(cols[i]) * F.col("__y")).alias(f"b_{i}") for i in range(k)]
    sums += [F.sum(F.col("__y") * F.col("__y")).alias("yy"), F.count(F.lit(1)).alias("n")]
    st = x.groupBy(*keys).agg(*sums)
    age = _age(freq)
    last = train.filter(age < p).groupBy(*keys).agg(
        *[F.max(F.when(age == j, F.col(Y))).alias(f"last_{j}") for j in range(p)])
    j = st.join(last, keys)
    out_schema = f"{ITEM} string, window int, cutoff {_moment(freq)}, step int, algorithm string, quantile double, value double"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        beta, s2 = _solve_all(pdf, k)
        c, phi = beta[:, 0], beta[:, 1:]
        hist = np.stack([pdf[f"last_{q}"].to_numpy(float) for q in range(p)], 1)      # newest first
        psi, acc, parts = [np.ones(len(pdf))], np.zeros(len(pdf)), []
        for h in range(1, horizon + 1):                                # all items of the batch step together
            mean = c + np.einsum("np,np->n", phi, hist)
            hist = np.concatenate([mean[:, None], hist[:, :-1]], 1)
            acc = acc + psi[h - 1] ** 2
            psi.append(sum((phi[:, q] * psi[h - 1 - q] for q in range(p) if h - 1 - q >= 0), np.zeros(len(pdf))))
            sd = np.sqrt(s2 * acc)
            for q in QUANTILES:
                parts.append(pd.DataFrame({ITEM: pdf[ITEM], "window": pdf["window"], "cutoff": pdf["cutoff"], "step": h, "algorithm": f"AR{p}", "quantile": q, "value": mean + Z[q] * sd}))
        return pd.concat(parts)

    return j.mapInPandas(lambda it: (solve(pdf) for pdf in it), out_schema) \
        .select(*keys, "step", _shift(F.col("cutoff"), F.col("step"), freq).alias(TS), "algorithm", "quantile", "value")


def _design(df: DataFrame, fourier: int, calendar: DataFrame | None, country: str, freq: str = "day") -> tuple[DataFrame, list]:
    """Trend, yearly harmonics, those of the week (days and hours) and of the day (hours), holidays."""
    d = F.col(TS)
    t = F.datediff(d, F.lit("1970-01-01").cast("date")) / 365.25
    x = df.withColumn("x_trend", t)
    cols = ["x_one", "x_trend"]
    x = x.withColumn("x_one", F.lit(1.0))
    for k in range(1, fourier + 1):
        a = 2 * math.pi * k * F.dayofyear(d) / 365.25
        x = x.withColumn(f"x_sy{k}", F.sin(a)).withColumn(f"x_cy{k}", F.cos(a))
        cols += [f"x_sy{k}", f"x_cy{k}"]
    for k in range(1, 4) if freq in ("day", "hour") else ():
        a = 2 * math.pi * k * F.dayofweek(d) / 7.0
        x = x.withColumn(f"x_sw{k}", F.sin(a)).withColumn(f"x_cw{k}", F.cos(a))
        cols += [f"x_sw{k}", f"x_cw{k}"]
    for k in range(1, 4) if freq == "hour" else ():
        a = 2 * math.pi * k * F.hour(d) / 24.0
        x = x.withColumn(f"x_sh{k}", F.sin(a)).withColumn(f"x_ch{k}", F.cos(a))
        cols += [f"x_sh{k}", f"x_ch{k}"]
    if calendar is not None:
        from .joins import attach_holidays
        x = attach_holidays(x, calendar, country, TS, "__hol").withColumn(
            "x_hol", F.col("__hol").isNotNull().cast("double")).drop("__hol")
        cols.append("x_hol")
    return x, cols


def forecast_harmonic(windows: DataFrame, horizon: int, fourier: int = 2, calendar: DataFrame | None = None,
                      country: str = "US", freq: str = "day") -> DataFrame:
    """TS9. Trend + yearly/weekly Fourier terms (+ holiday flag) by least squares per item.

    X'X and X'y are sums of products: computed as grouped aggregates (partial, skew-safe),
    then each item's small system (k x k, k <= 15) is solved in an Arrow-batched pandas
    function over one row per item. Interval from the residual variance."""
    import pandas as pd

    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    x, cols = _design(train, fourier, calendar, country, freq)
    k = len(cols)
    sums = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"a_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col(cols[i]) * F.col(Y)).alias(f"b_{i}") for i in range(k)]
    sums += [F.sum(F.col(Y) * F.col(Y)).alias("yy"), F.count(F.lit(1)).alias("n")]
    st = x.groupBy(*keys).agg(*sums)

    out_schema = ", ".join([f"{ITEM} string", "window int", f"cutoff {_moment(freq)}"] + [f"beta_{i} double" for i in range(k)]
                           + ["s2 double"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        beta, s2 = _solve_all(pdf, k)
        return pdf[[ITEM, "window", "cutoff"]].assign(**{f"beta_{i}": beta[:, i] for i in range(k)}, s2=s2)

    fit = st.mapInPandas(lambda it: (solve(p) for p in it), out_schema)
    fut, _ = _design(_future(train, horizon, freq), fourier, calendar, country, freq)
    j = fut.join(fit, keys)
    mean = sum((F.col(cols[i]) * F.col(f"beta_{i}") for i in range(k)), F.lit(0.0))
    sd = F.sqrt(F.col("s2"))
    return _long(j, "Harmonic", {q: mean + F.lit(Z[q]) * sd for q in QUANTILES})


# ---- TS10 / TS11 / TS12 / TS13 / TS14 metrics and selection ------------------------------------

def actuals(windows: DataFrame) -> DataFrame:
    """Scored test points (filled points are excluded)."""
    t = windows.filter(F.col("split") == "test")
    if "was_filled" in t.columns:
        t = t.filter(~F.col("was_filled"))
    return t.select(ITEM, "window", TS, F.col(Y).alias("y"))


def mase_scale(windows: DataFrame, m: int = 7, freq: str = "day") -> DataFrame:
    """Mean |y_t - y_(t-m)| on the training part, per (item, window), by a self-join on t - m."""
    train = windows.filter(F.col("split") == "train").select(ITEM, "window", TS, Y)
    lagged = train.select(ITEM, "window", _shift(F.col(TS), m, freq).alias(TS), F.col(Y).alias("__lag"))
    return train.join(lagged, [ITEM, "window", TS]).groupBy(ITEM, "window").agg(
        F.avg(F.abs(F.col(Y) - F.col("__lag"))).alias("scale"))


def evaluate(forecasts: DataFrame, windows: DataFrame, m: int | None = None, quantiles=QUANTILES, freq: str = "day",
             by=()) -> DataFrame:
    """TS10 + TS11 per (algorithm, window), and per item if ``by`` says so: RMSE, MAPE, WAPE, MASE on the p50 point forecast
    and weighted quantile loss per quantile, and their mean (Q14: root and absolute)."""
    act = actuals(windows)
    f = forecasts.join(act, [ITEM, "window", TS])
    keys = ["algorithm", "window", *by]
    wql = []
    for q in quantiles:
        fq = F.col("value")
        loss = F.when(F.col("quantile") == q, F.lit(q) * F.greatest(F.col("y") - fq, F.lit(0.0))
                      + F.lit(1 - q) * F.greatest(fq - F.col("y"), F.lit(0.0)))
        wql.append(F.try_divide(2 * F.sum(loss), F.sum(F.when(F.col("quantile") == q, F.abs("y"))))
                   .alias(f"wQL_{QUANTILE_NAMES[q]}"))
    p50 = F.col("quantile") == 0.5
    err = F.when(p50, F.col("y") - F.col("value"))
    point = f.groupBy(*keys).agg(
        F.sqrt(F.avg(F.pow(err, 2))).alias("RMSE"),
        F.avg(F.when(p50 & (F.col("y") != 0), F.abs(err) / F.abs(F.col("y")))).alias("MAPE"),
        F.try_divide(F.sum(F.abs(err)), F.sum(F.when(p50, F.abs("y")))).alias("WAPE"),
        *wql)
    point = point.withColumn("avg_wQL", sum(F.col(f"wQL_{QUANTILE_NAMES[q]}") for q in quantiles) / len(quantiles))
    per_item = f.filter(p50).groupBy("algorithm", "window", ITEM).agg(F.avg(F.abs(err)).alias("__mae"))
    mase = per_item.join(mase_scale(windows, m or SEASONS[freq], freq), [ITEM, "window"]).groupBy(*keys).agg(
        F.avg(F.try_divide(F.col("__mae"), F.col("scale"))).alias("MASE"))
    return point.join(mase, keys, "left")


METRICS = ["RMSE", "MAPE", "WAPE", "MASE", "wQL_p10", "wQL_p50", "wQL_p90", "avg_wQL"]


def summarise_windows(metrics: DataFrame) -> DataFrame:
    """TS12. Per-window rows (COMPUTED) plus their mean per algorithm (SUMMARY, window 0)."""
    per = metrics.withColumn("EvaluationType", F.lit("COMPUTED"))
    summ = metrics.groupBy("algorithm").agg(*[F.avg(m).alias(m) for m in METRICS]) \
        .withColumn("window", F.lit(0)).withColumn("EvaluationType", F.lit("SUMMARY"))
    return per.select("algorithm", "window", "EvaluationType", *METRICS).unionByName(
        summ.select("algorithm", "window", "EvaluationType", *METRICS))


def auto_select_items(item_metrics: DataFrame, metric: str = "avg_wQL") -> DataFrame:
    """TS13 per item: of the metrics of each (algorithm, window, item), the algorithm with the
    lowest mean over the windows; windows without a value (no demand) are left out, names break
    ties, and an item without any value gets the first name."""
    mean = item_metrics.groupBy(ITEM, "algorithm").agg(F.avg(metric).alias(metric))
    best = F.struct(F.col(metric).isNull(), F.col(metric), F.col("algorithm"))
    return mean.groupBy(ITEM).agg(F.min_by("algorithm", best).alias("algorithm"), F.min(metric).alias(metric), F.count(metric).alias("candidates"))


def best_per_item(forecasts: DataFrame, selected: DataFrame) -> DataFrame:
    """The rows of each item's selected algorithm."""
    return forecasts.join(selected.select(ITEM, "algorithm"), [ITEM, "algorithm"])


def auto_select(summary: DataFrame, metric: str = "avg_wQL") -> DataFrame:
    """TS13. Lowest mean wQL wins (algorithm name breaks ties); rank table of all."""
    s = summary.filter(F.col("EvaluationType") == "SUMMARY")
    w = Window.orderBy(F.col(metric).asc_nulls_last(), F.col("algorithm"))   # one row per algorithm
    return s.select("algorithm", metric, F.rank().over(w).alias("rank")) \
        .withColumn("selected", F.col("rank") == 1)


def metrics_table(summary: DataFrame, digits: int = 4) -> DataFrame:
    """TS14. Metrics as rows, algorithms as columns, rounded."""
    s = summary.filter(F.col("EvaluationType") == "SUMMARY").select("algorithm", *METRICS)
    long = s.unpivot(["algorithm"], METRICS, "metric", "value")
    algos = [r[0] for r in s.select("algorithm").distinct().collect()]   # <= a few names
    return long.groupBy("metric").pivot("algorithm", sorted(algos)).agg(F.round(F.first("value"), digits))


# ---- TS15 / TS16 / TS17 ---------------------------------------------------------------------------

MODELS = {
    "NPTS": lambda w, h, **kw: forecast_npts(w, h, **kw),
    "ETS": lambda w, h, **kw: forecast_ets(w, h, **kw),
    "AR": lambda w, h, **kw: forecast_ar(w, h, **kw),
    "ARp": lambda w, h, **kw: forecast_ar_p(w, h, **kw),
    "Holt": lambda w, h, **kw: forecast_holt(w, h, **kw),
    "HoltWinters": lambda w, h, **kw: forecast_holt_winters(w, h, **kw),
    "SeasonalNaive": lambda w, h, **kw: forecast_seasonal_naive(w, h, **kw),
    "Harmonic": lambda w, h, **kw: forecast_harmonic(w, h, **kw),
    "ARIMA": lambda w, h, **kw: _arima(w, h, **kw),
    "HoltWintersGrid": lambda w, h, **kw: _grid(w, h, **kw),
    "Changepoints": lambda w, h, **kw: _changepoints(w, h, **kw),
}


def _changepoints(windows: DataFrame, horizon: int, **kw) -> DataFrame:
    from .changepoints import forecast_changepoints

    return forecast_changepoints(windows, horizon, **kw)


def _arima(windows: DataFrame, horizon: int, **kw) -> DataFrame:
    from .arima import forecast_arima

    return forecast_arima(windows, horizon, **kw)


def _grid(windows: DataFrame, horizon: int, **kw) -> DataFrame:
    from .smoothing import forecast_grid

    return forecast_grid(windows, horizon, **kw)


def create_forecast(series: DataFrame, horizon: int, algorithm: str = "NPTS", end=None, freq: str = "day", **kw) -> DataFrame:
    """TS15. All items, ``horizon`` periods after the end of the series, p10/p50/p90 long rows."""
    return MODELS[algorithm](final_cutoff(series, end, freq), horizon, freq=freq, **kw).drop("window")


def forecast_wide(long: DataFrame) -> DataFrame:
    """TS16. ``(item, ts, quantile, value)`` -> ``(item, ts, p10, p50, p90)``."""
    keys = [c for c in long.columns if c not in ("quantile", "value")]
    return long.groupBy(*keys).pivot("quantile", QUANTILES).agg(F.first("value")) \
        .withColumnsRenamed({str(q): QUANTILE_NAMES[q] for q in QUANTILES})


def forecast_long(wide: DataFrame) -> DataFrame:
    """TS16. Inverse of ``forecast_wide``."""
    ids = [c for c in wide.columns if c not in QUANTILE_NAMES.values()]
    return wide.unpivot(ids, list(QUANTILE_NAMES.values()), "quantile_name", "value")


def forecast_map(long: DataFrame) -> DataFrame:
    """Edge JSON shape: per item, ``map(p10 -> array<struct<Timestamp, Value>>)``."""
    pts = long.groupBy(ITEM, "quantile").agg(F.array_sort(F.collect_list(F.struct(
        F.date_format(TS, "yyyy-MM-dd'T'HH:mm:ss").alias("Timestamp"), F.col("value").alias("Value")))).alias("pts"))
    name = F.concat(F.lit("p"), (F.col("quantile") * 100).cast("int").cast("string"))
    return pts.groupBy(ITEM).agg(F.map_from_entries(F.collect_list(F.struct(name, F.col("pts")))).alias("Predictions"))


def _attributes(cols) -> dict[str, list[int]]:
    """Columns of the design by the attribute they stand for."""
    of = {"x_trend": "trend", "x_sy": "yearly_seasonality", "x_cy": "yearly_seasonality", "x_sw": "weekly_seasonality", "x_cw": "weekly_seasonality",
          "x_sh": "daily_seasonality", "x_ch": "daily_seasonality", "x_hol": "holiday"}
    out: dict[str, list[int]] = {}
    for i, c in enumerate(cols):
        for prefix, name in of.items():
            if c.startswith(prefix):
                out.setdefault(name, []).append(i)
    return out


def forecast_harmonic_subsets(windows: DataFrame, horizon: int, fourier: int = 2, calendar: DataFrame | None = None,
                              country: str = "US", freq: str = "day") -> tuple[DataFrame, list[str]]:
    """The harmonic model with every subset of its attributes (the intercept always stays), as
    algorithms '0' to '2^n - 1' whose bits say which of the attributes are in, and their names.
    All are solved from one table of sums of products for each item, by its submatrices."""
    import numpy as np
    import pandas as pd

    train = windows.filter(F.col("split") == "train")
    keys = [ITEM, "window", "cutoff"]
    x, cols = _design(train, fourier, calendar, country, freq)
    k, groups = len(cols), _attributes(cols)
    names = list(groups)
    sums = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"a_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col(cols[i]) * F.col(Y)).alias(f"b_{i}") for i in range(k)]
    sums += [F.sum(F.col(Y) * F.col(Y)).alias("yy"), F.count(F.lit(1)).alias("n")]
    schema = f"{ITEM} string, window int, cutoff {_moment(freq)}, subset int, beta array<double>, s2 double"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for subset in range(1 << len(names)):
            own = sorted([0] + [i for b, name in enumerate(names) if subset >> b & 1 for i in groups[name]])
            sub = pd.DataFrame({f"a_{i}_{j}": pdf[f"a_{own[i]}_{own[j]}"] for i in range(len(own)) for j in range(i, len(own))}
                               | {f"b_{i}": pdf[f"b_{c}"] for i, c in enumerate(own)} | {"yy": pdf["yy"], "n": pdf["n"]})
            beta, s2 = _solve_all(sub, len(own))
            full = np.zeros((len(pdf), k))
            full[:, own] = beta
            parts.append(pdf[keys].assign(subset=subset, beta=list(full), s2=s2))
        return pd.concat(parts)

    fit = x.groupBy(*keys).agg(*sums).mapInPandas(lambda it: (solve(p) for p in it if len(p)), schema)
    fut, _ = _design(_future(train, horizon, freq), fourier, calendar, country, freq)
    j = fut.join(fit, keys)
    mean = sum((F.col(cols[i]) * F.col("beta")[i] for i in range(k)), F.lit(0.0))
    arr = F.array(*[F.struct(F.lit(q).alias("quantile"), (mean + F.lit(Z[q]) * F.sqrt("s2")).alias("value")) for q in QUANTILES])
    return j.select(*keys, "step", TS, F.col("subset").cast("string").alias("algorithm"), F.inline(arr)), names


def shapley(loss: dict[int, float], n: int) -> list[float]:
    """Exact Shapley values of ``n`` players from the loss of every subset (by bits): the mean, over
    all orders, of what each takes off the loss. They add up to the loss without any minus that
    with all."""
    out = []
    for i in range(n):
        rest = [s for s in range(1 << n) if not s >> i & 1]
        out.append(sum(math.factorial(s.bit_count()) * math.factorial(n - s.bit_count() - 1) / math.factorial(n) * (loss[s] - loss[s | 1 << i]) for s in rest))
    return out


def explain_impact(windows: DataFrame, horizon: int, calendar: DataFrame | None = None, country: str = "US", freq: str = "day",
                   m: int | None = None) -> DataFrame:
    """TS17. (attribute, delta, impact): the exact Shapley value of every attribute of the harmonic
    model (trend, yearly, weekly and daily season, holidays), as the part of the mean wQL that it
    takes off; and that scaled to -1..1 by the largest absolute value. The deltas add up to the loss
    of the intercept alone minus that of the whole model. The driver gets one number a subset."""
    from ..session import cut_lineage

    forecasts, names = forecast_harmonic_subsets(windows, horizon, calendar=calendar, country=country, freq=freq)
    losses = cut_lineage(evaluate(forecasts, windows, m, freq=freq).groupBy("algorithm").agg(F.avg("avg_wQL").alias("loss")))
    loss = {int(r.algorithm): r.loss for r in losses.collect()}       # 2^attributes rows
    spark, schema = windows.sparkSession, "attribute string, delta double, impact double"
    if len(loss) < 1 << len(names) or any(v is None for v in loss.values()):
        return spark.createDataFrame([], schema)
    values = shapley(loss, len(names))
    top = max(map(abs, values), default=0.0)
    return spark.createDataFrame([(a, v, v / top if top else None) for a, v in zip(names, values)], schema)
