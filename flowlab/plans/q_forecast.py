"""Registered forecasting queries (TS*, AGG2, JOI5, FLT2, FLT6, PRJ5, PRJ11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as fc
from ..operators.aggregates import resample
from ..operators.filters import query_forecast, year_range
from ..operators.joins import attach_holidays
from ..operators.mapping import add_constant, derive_year
from .registry import register
from .views import demand, with_views

H, NW, YEARS = 28, 3, (1995, 2002)
DECAY, ALPHA, M = 0.01, 0.3, 7
HA, HB = 0.3, 0.1            # Holt level and trend smoothing
WA, WB, WG, WM = 0.3, 0.1, 0.2, 7   # Holt-Winters smoothing and season
ALGOS_SQL = ["NPTS", "ETS", "AR", "SeasonalNaive", "Holt", "HoltWinters"]


# ---- Spark pipeline ---------------------------------------------------------------------------
def raw_series(spark, sf):
    """Demand in raw CSV shape: (index, ds 'yyyy-MM-dd', y, item_id)."""
    d = demand(spark, sf)
    return d.select(F.lit(0).alias("index"), F.date_format("timestamp", "yyyy-MM-dd").alias("ds"),
                    F.col("target_value").alias("y"), "item_id")


def prepared(spark, sf, years=None):
    return fc.prepare_series(raw_series(spark, sf), item_col="item_id", years=years)


def daily(spark, sf):
    """Daily series, checkpointed: gap filling, the series end and the windows all read it."""
    from ..session import cut_lineage

    return cut_lineage(fc.to_daily(prepared(spark, sf)))


def filled(spark, sf, freq="day"):
    from ..session import cut_lineage

    return fc.fill_gaps(cut_lineage(fc.to_daily(prepared(spark, sf), freq=freq)), freq=freq)


def windows(spark, sf, cal=None):
    """Backtest windows, checkpointed: every model, the actuals and the MASE scale read them,
    so they are computed once and their lineage is cut (safe against lost executors)."""
    from ..session import cut_lineage

    cal = cal or DAY
    return cut_lineage(fc.backtest_windows(filled(spark, sf, cal.freq), cal.horizon, cal.n_windows, freq=cal.freq))


def us_holidays(series):
    """US holidays of the years of a series, and of the year after it (a horizon may reach it)."""
    lo, hi = fc.series_years(series)
    return fc.holiday_calendar(series.sparkSession, ("US",), lo, hi + 1)


def model(name, w, cal):
    at = {"freq": cal.freq}
    return {"npts": lambda: fc.forecast_npts(w, cal.horizon, decay=DECAY, **at), "ets": lambda: fc.forecast_ets(w, cal.horizon, alpha=ALPHA, **at),
            "ar": lambda: fc.forecast_ar(w, cal.horizon, **at), "snaive": lambda: fc.forecast_seasonal_naive(w, cal.horizon, m=cal.m, **at),
            "holt": lambda: fc.forecast_holt(w, cal.horizon, alpha=HA, beta=HB, **at),
            "hwin": lambda: fc.forecast_holt_winters(w, cal.horizon, WA, WB, WG, cal.m, **at)}[name]()


def all_forecasts(spark, sf, w=None, cal=None):
    cal = cal or DAY
    w = w if w is not None else windows(spark, sf, cal)
    out = None
    for name in ("npts", "ets", "ar", "snaive", "holt", "hwin"):
        part = model(name, w, cal)
        out = part if out is None else out.unionByName(part)
    return out


def metrics(spark, sf, cal=None, by=()):
    """Metrics per (algorithm, window); checkpointed because the summary, the selection and
    the pivot each read them more than once (the table is tiny)."""
    from ..session import cut_lineage

    cal = cal or DAY
    w = windows(spark, sf, cal)
    return cut_lineage(fc.evaluate(all_forecasts(spark, sf, w, cal), w, m=cal.m, freq=cal.freq, by=by))


# ---- SQL twins ---------------------------------------------------------------------------------
class Calendar:
    """How a frequency counts, in SQL; and the horizon, windows and seasons of its queries."""

    def __init__(self, freq: str, horizon: int, n_windows: int, m: int):
        self.freq, self.horizon, self.n_windows, self.m = freq, horizon, n_windows, m
        self.interval = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}[freq]

    def plus(self, c: str, k: str) -> str:
        if self.freq == "month":
            return f"CAST({c} + to_months(CAST({k} AS INTEGER)) AS DATE)"
        return f"CAST({c} + CAST(({k}) * {7 if self.freq == 'week' else 1} AS INTEGER) AS DATE)"

    def age(self, a: str, b: str) -> str:
        return {"day": f"({a} - {b})", "week": f"(({a} - {b}) // 7)", "month": f"date_diff('month', {b}, {a})"}[self.freq]


DAY, WEEK, MONTH = Calendar("day", H, NW, M), Calendar("week", 4, 3, 13), Calendar("month", 3, 3, 12)
ALL_PREP_SQL = with_views("""
SELECT TRY_CAST(ds AS TIMESTAMP) AS "timestamp", TRY_CAST(y AS DOUBLE) AS target_value, item_id
FROM (SELECT strftime("timestamp", '%Y-%m-%d') AS ds, target_value AS y, item_id FROM demand) r""", "demand")
PREP_SQL = with_views(f"""
SELECT TRY_CAST(ds AS TIMESTAMP) AS "timestamp", TRY_CAST(y AS DOUBLE) AS target_value, item_id
FROM (SELECT strftime("timestamp", '%Y-%m-%d') AS ds, target_value AS y, item_id FROM demand) r
WHERE ds >= '{YEARS[0] + 1}-01-01' AND ds < '{YEARS[1]}-01-01'""", "demand")
def series_sql(cal: Calendar = DAY) -> str:
    return f"""SELECT item_id, CAST(date_trunc('{cal.freq}', "timestamp") AS DATE) AS ts, sum(target_value) AS target_value
FROM ({ALL_PREP_SQL}) p GROUP BY ALL"""


def filled_sql(cal: Calendar = DAY) -> str:
    return f"""
WITH d AS ({series_sql(cal)}),
span AS (SELECT item_id, min(ts) AS f, max(ts) AS l FROM d GROUP BY 1),
e AS (SELECT max(ts) AS e FROM d),
cal AS (SELECT item_id, l, CAST(unnest(generate_series(f, e.e, {cal.interval})) AS DATE) AS ts FROM span, e)
SELECT cal.item_id, cal.ts,
       CASE WHEN d.target_value IS NOT NULL THEN d.target_value WHEN cal.ts <= l THEN 0.0 ELSE 0.0 END AS target_value,
       d.target_value IS NULL AS was_filled
FROM cal LEFT JOIN d USING (item_id, ts)"""


def windows_sql(cal: Calendar = DAY) -> str:
    return f"""
WITH f AS ({filled_sql(cal)}),
w AS (SELECT CAST(k AS INTEGER) AS "window", {cal.plus("e", f"-k * {cal.horizon}")} AS cutoff
      FROM range(1, {cal.n_windows + 1}) t(k), (SELECT max(ts) AS e FROM f) m)
SELECT f.*, w."window", w.cutoff, CASE WHEN ts <= cutoff THEN 'train' ELSE 'test' END AS split
FROM f, w WHERE ts <= {cal.plus("cutoff", str(cal.horizon))}"""


def future_sql(cal: Calendar = DAY) -> str:
    return f"""SELECT item_id, "window", cutoff, CAST(step AS INTEGER) AS step, {cal.plus("cutoff", "step")} AS ts
FROM (SELECT DISTINCT item_id, "window", cutoff FROM wins WHERE split = 'train') k, range(1, {cal.horizon + 1}) s(step)"""


DAILY_SQL, FILLED_SQL, WINDOWS_SQL, FUTURE_SQL = series_sql(), filled_sql(), windows_sql(), future_sql()
KEYS = 'item_id, "window", cutoff'


def _long_sql(src: str, algo: str, cols: dict) -> str:
    parts = [f"SELECT item_id, \"window\", cutoff, step, ts, '{algo}' AS algorithm, CAST({q} AS DOUBLE) AS quantile, {c} AS value FROM {src}"
             for q, c in cols.items()]
    return " UNION ALL ".join(parts)


def npts_sql(cal: Calendar = DAY) -> str:
    return f"""
h AS (SELECT {KEYS}, target_value AS v, exp(-{DECAY} * {cal.age('cutoff', 'ts')}) AS wt FROM wins WHERE split = 'train'),
a AS (SELECT {KEYS}, v, sum(wt) AS w FROM h GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY {KEYS} ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(w) OVER (PARTITION BY {KEYS}) AS tot FROM a),
q AS (SELECT {KEYS}, {", ".join(f"min(CASE WHEN round(cum, 9) >= round(tot * {q}, 9) THEN v END) AS {n}" for q, n in fc.QUANTILE_NAMES.items())}
      FROM c GROUP BY ALL),
npts_j AS (SELECT fu.*, q.p10, q.p50, q.p90 FROM fut fu LEFT JOIN q USING (item_id, "window", cutoff)),
npts AS ({_long_sql("npts_j", "NPTS", {0.1: "p10", 0.5: "p50", 0.9: "p90"})})"""


def ets_sql(cal: Calendar = DAY) -> str:
    return f"""
tr AS (SELECT *, {cal.age('cutoff', 'ts')} AS age FROM wins WHERE split = 'train'),
st AS (SELECT {KEYS}, min(ts) AS f, arg_min(target_value, ts) AS y0, sum({ALPHA} * pow(1 - {ALPHA}, age) * target_value) AS s
       FROM tr GROUP BY ALL),
lv AS (SELECT {KEYS}, s - {ALPHA} * pow(1 - {ALPHA}, {cal.age('cutoff', 'f')}) * y0 + pow(1 - {ALPHA}, {cal.age('cutoff', 'f')}) * y0 AS lvl FROM st),
sd AS (SELECT {KEYS}, sqrt(sum({ALPHA} * pow(1 - {ALPHA}, age) * pow(target_value - lvl, 2))
                           / sum({ALPHA} * pow(1 - {ALPHA}, age))) AS sd
       FROM tr JOIN lv USING (item_id, "window", cutoff) GROUP BY ALL),
ets_j AS (SELECT fu.*, lvl, sd * sqrt(1 + (step - 1) * {ALPHA} * {ALPHA}) AS spread
          FROM fut fu JOIN lv USING (item_id, "window", cutoff) JOIN sd USING (item_id, "window", cutoff)),
ets AS ({_long_sql("ets_j", "ETS", {0.1: f"lvl + ({fc.Z[0.1]}) * spread", 0.5: "lvl",
                                    0.9: f"lvl + ({fc.Z[0.9]}) * spread"})})"""


def ar_sql(cal: Calendar = DAY) -> str:
    return f"""
trn AS (SELECT {KEYS}, ts, target_value FROM wins WHERE split = 'train'),
pr AS (SELECT t.*, p.target_value AS prev FROM trn t JOIN trn p
        ON t.item_id = p.item_id AND t."window" = p."window" AND t.cutoff = p.cutoff AND t.ts = {cal.plus('p.ts', '1')}),
fit AS (SELECT {KEYS}, regr_slope(target_value, prev) AS phi, regr_intercept(target_value, prev) AS c,
               regr_count(target_value, prev) AS n,
               CASE WHEN regr_count(target_value, prev) - 2 = 0 THEN NULL ELSE
                 greatest(regr_syy(target_value, prev) - CASE WHEN regr_sxx(target_value, prev) = 0 THEN NULL ELSE
                   regr_sxy(target_value, prev) * regr_sxy(target_value, prev) / regr_sxx(target_value, prev) END, 0.0)
                 / (regr_count(target_value, prev) - 2) END AS s2
        FROM pr GROUP BY ALL),
lst AS (SELECT {KEYS}, arg_max(target_value, ts) AS yT FROM trn GROUP BY ALL),
ar0 AS (SELECT fu.*, coalesce(phi, 0.0) AS ph, coalesce(c, yT) AS cc, yT, s2
        FROM fut fu JOIN fit USING (item_id, "window", cutoff) JOIN lst USING (item_id, "window", cutoff)),
ar1 AS (SELECT *, pow(ph, step) * yT + cc * CASE WHEN abs(1 - ph) < 1e-12 THEN step ELSE (1 - pow(ph, step)) / (1 - ph) END AS mean,
               sqrt(coalesce(s2, 0.0) * CASE WHEN abs(1 - ph * ph) < 1e-12 THEN step ELSE (1 - pow(ph, 2 * step)) / (1 - ph * ph) END) AS sd
        FROM ar0),
ar AS ({_long_sql("ar1", "AR", {0.1: f"mean + ({fc.Z[0.1]}) * sd", 0.5: "mean + 0.0 * sd", 0.9: f"mean + ({fc.Z[0.9]}) * sd"})})"""


def snaive_sql(cal: Calendar = DAY) -> str:
    return f"""
sn0 AS (SELECT fu.*, {cal.plus('cutoff', f'-({cal.m} - 1 - ((step - 1) % {cal.m}))')} AS src FROM fut fu),
sn1 AS (SELECT sn0.*, t.target_value AS v FROM sn0 LEFT JOIN wins t
        ON t.split = 'train' AND t.item_id = sn0.item_id AND t."window" = sn0."window" AND t.ts = sn0.src),
snaive AS ({_long_sql("sn1", "SeasonalNaive", {0.1: "v", 0.5: "v", 0.9: "v"})})"""


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


_A11, _A21, _A22 = 1.0 - HA, -(HA * HB), 1.0 - HA * HB
def holt_sql(cal: Calendar = DAY) -> str:
    return f"""
hk AS (SELECT max({cal.age('cutoff', 'ts')}) AS K FROM wins WHERE split = 'train'),
hw(lag, wl, wb, cl, cb) AS (
  SELECT 0, {_d(HA)}, {_d(HA * HB)}, {_d(1.0)}, {_d(0.0)}
  UNION ALL
  SELECT lag + 1, {_d(_A11)} * wl + {_d(_A11)} * wb, {_d(_A21)} * wl + {_d(_A22)} * wb,
         {_d(_A11)} * cl + {_d(_A11)} * cb, {_d(_A21)} * cl + {_d(_A22)} * cb
  FROM hw WHERE lag < (SELECT K FROM hk)),
ht AS (SELECT {KEYS}, ts, target_value, CAST({cal.age('cutoff', 'ts')} AS INTEGER) AS lag FROM wins WHERE split = 'train'),
hf AS (SELECT {KEYS}, max(lag) AS n1 FROM ht GROUP BY ALL),
hx AS (SELECT ht.*, hf.n1, hw.wl, hw.wb, hw.cl, hw.cb FROM ht JOIN hf USING (item_id, "window", cutoff) JOIN hw USING (lag)),
hs AS (SELECT {KEYS}, coalesce(sum(CASE WHEN lag < n1 THEN wl * target_value END), 0.0)
                      + max(CASE WHEN lag >= n1 THEN cl * target_value END) AS l,
              coalesce(sum(CASE WHEN lag < n1 THEN wb * target_value END), 0.0)
                      + max(CASE WHEN lag >= n1 THEN cb * target_value END) AS b FROM hx GROUP BY ALL),
hd AS (SELECT {KEYS}, sqrt(sum({_d(HA)} * pow(1 - {_d(HA)}, lag) * pow(target_value - (l - lag * b), 2))
                           / sum({_d(HA)} * pow(1 - {_d(HA)}, lag))) AS sd
       FROM ht JOIN hs USING (item_id, "window", cutoff) GROUP BY ALL),
holt_j AS (SELECT fu.*, l + step * b AS mean,
                  sd * sqrt(1 + {_d(HA * HA)} * ((step - 1) + {_d(HB)} * step * (step - 1)
                                                  + {_d(HB * HB)} * (step - 1) * step * (2 * step - 1) / 6.0)) AS spread
           FROM fut fu JOIN hs USING (item_id, "window", cutoff) JOIN hd USING (item_id, "window", cutoff)),
holt AS ({_long_sql("holt_j", "Holt", {0.1: f"mean + ({fc.Z[0.1]}) * spread", 0.5: "mean + 0.0 * spread",
                                       0.9: f"mean + ({fc.Z[0.9]}) * spread"})})"""


def _matrix_sql(A, prefix: str) -> list[str]:
    """SQL for A x with x = prefix0..prefixN, non-zero terms summed left to right."""
    out = []
    for row in A:
        terms = [f"{_d(a)} * {prefix}{j}" for j, a in enumerate(row) if a != 0.0]
        out.append(" + ".join(terms) if terms else _d(0.0))
    return out


def hw_sql(cal: Calendar = DAY) -> str:
    WM = cal.m
    A, g = fc.hw_system(WA, WB, WG, WM)
    d = WM + 2
    ws, cs = [f"w{i}" for i in range(d)], [f"c{i}" for i in range(d)]
    init = [_d(v) for v in g] + [_d(1.0)] + [_d(0.0)] * (d - 1)
    step = _matrix_sql(A, "w") + _matrix_sql(A, "c")
    mult = "[" + ", ".join(_d(v) for v in fc.hw_multipliers(WA, WB, WG, WM, cal.horizon)) + "]"
    S = "[" + ", ".join(f"x{i}" for i in range(2, d)) + "]"
    xs = ",\n".join(f"coalesce(sum(CASE WHEN lag < n1 THEN w{i} * target_value END), 0.0) "
                    f"+ max(CASE WHEN lag >= n1 THEN c{i} * target_value END) AS x{i}" for i in range(d))
    return f"""
wk AS (SELECT max({cal.age('cutoff', 'ts')}) AS K FROM wins WHERE split = 'train'),
ww(lag, {", ".join(ws + cs)}) AS (
  SELECT 0, {", ".join(init)}
  UNION ALL
  SELECT lag + 1, {", ".join(step)} FROM ww WHERE lag < (SELECT K FROM wk)),
wt AS (SELECT {KEYS}, ts, target_value, CAST({cal.age('cutoff', 'ts')} AS INTEGER) AS lag FROM wins WHERE split = 'train'),
wf AS (SELECT {KEYS}, max(lag) AS n1 FROM wt GROUP BY ALL),
wx AS (SELECT wt.*, wf.n1, {", ".join("ww." + c for c in ws + cs)}
       FROM wt JOIN wf USING (item_id, "window", cutoff) JOIN ww USING (lag)),
wsum AS (SELECT {KEYS}, {xs} FROM wx GROUP BY ALL),
wst AS (SELECT {KEYS}, x0, x1, {S} AS S FROM wsum),
wsd AS (SELECT {KEYS}, sqrt(sum({_d(WA)} * pow(1 - {_d(WA)}, lag)
                                * pow(target_value - (x0 - lag * x1 + S[lag % {WM} + 1]), 2))
                           / sum({_d(WA)} * pow(1 - {_d(WA)}, lag))) AS sd
        FROM wt JOIN wst USING (item_id, "window", cutoff) GROUP BY ALL),
hw_j AS (SELECT fu.*, x0 + step * x1 + S[{WM} - (step - 1) % {WM}] AS mean, sd * {mult}[step] AS spread
         FROM fut fu JOIN wst USING (item_id, "window", cutoff) JOIN wsd USING (item_id, "window", cutoff)),
hwin AS ({_long_sql("hw_j", "HoltWinters", {0.1: f"mean + ({fc.Z[0.1]}) * spread", 0.5: "mean + 0.0 * spread",
                                            0.9: f"mean + ({fc.Z[0.9]}) * spread"})})"""


def forecasts_sql(which=("npts", "ets", "ar", "snaive", "holt", "hwin"), cal: Calendar = DAY) -> str:
    blocks = {"npts": npts_sql, "ets": ets_sql, "ar": ar_sql, "snaive": snaive_sql, "holt": holt_sql, "hwin": hw_sql}
    body = ",".join(blocks[w](cal) for w in which)
    union = " UNION ALL ".join(f"SELECT * FROM {w}" for w in which)
    return f"WITH RECURSIVE wins AS ({windows_sql(cal)}), fut AS ({future_sql(cal)}), {body} {union}"


def metrics_sql(cal: Calendar = DAY, by: str = "") -> str:
    return f"""
WITH fcs AS ({forecasts_sql(cal=cal)}),
wins AS ({windows_sql(cal)}),
act AS (SELECT item_id, "window", ts, target_value AS y FROM wins WHERE split = 'test' AND NOT was_filled),
f AS (SELECT fcs.*, act.y FROM fcs JOIN act USING (item_id, "window", ts)),
pt AS (SELECT algorithm, "window"{by},
          sqrt(avg(pow(CASE WHEN quantile = 0.5 THEN y - value END, 2))) AS RMSE,
          avg(CASE WHEN quantile = 0.5 AND y <> 0 THEN abs(y - value) / abs(y) END) AS MAPE,
          sum(abs(CASE WHEN quantile = 0.5 THEN y - value END)) / nullif(sum(CASE WHEN quantile = 0.5 THEN abs(y) END), 0) AS WAPE,
          {", ".join(f"2 * sum(CASE WHEN quantile = {q} THEN {q} * greatest(y - value, 0.0) + (1 - {q}) * greatest(value - y, 0.0) END) / nullif(sum(CASE WHEN quantile = {q} THEN abs(y) END), 0) AS wQL_{n}" for q, n in fc.QUANTILE_NAMES.items())}
       FROM f GROUP BY ALL),
trn AS (SELECT item_id, "window", ts, target_value FROM wins WHERE split = 'train'),
sc AS (SELECT a.item_id, a."window", avg(abs(a.target_value - b.target_value)) AS scale
       FROM trn a JOIN trn b ON a.item_id = b.item_id AND a."window" = b."window" AND a.ts = {cal.plus('b.ts', str(cal.m))} GROUP BY ALL),
pi AS (SELECT algorithm, "window", item_id, avg(abs(y - value)) AS mae FROM f WHERE quantile = 0.5 GROUP BY ALL),
ms AS (SELECT algorithm, "window"{by}, avg(CASE WHEN scale = 0 THEN NULL ELSE mae / scale END) AS MASE
       FROM pi JOIN sc USING (item_id, "window") GROUP BY ALL)
SELECT pt.*, (wQL_p10 + wQL_p50 + wQL_p90) / 3 AS avg_wQL, ms.MASE FROM pt LEFT JOIN ms USING (algorithm, "window"{by})"""


METRICS_SQL = metrics_sql()
MET_COLS = ", ".join(fc.METRICS)
SUMMARY_SQL = f"""
WITH m AS ({METRICS_SQL})
SELECT algorithm, "window", 'COMPUTED' AS EvaluationType, {MET_COLS} FROM m
UNION ALL
SELECT algorithm, 0 AS "window", 'SUMMARY' AS EvaluationType, {", ".join(f"avg({c}) AS {c}" for c in fc.METRICS)}
FROM m GROUP BY algorithm"""


# ---- registrations --------------------------------------------------------------------------
@register("ts1_prepare_series", PREP_SQL)
def q_prepare(spark, sf):
    return prepared(spark, sf, YEARS)


@register("flt2_year_range", with_views("""SELECT item_id, "timestamp", target_value FROM demand
WHERE "timestamp" >= TIMESTAMP '1996-01-01' AND "timestamp" < TIMESTAMP '1999-01-01'""", "demand"))
def q_year_range(spark, sf):
    return year_range(demand(spark, sf), "timestamp", 1995, 1999)


@register("flt2_year_range_inclusive", with_views("""SELECT item_id, "timestamp", target_value FROM demand
WHERE "timestamp" >= TIMESTAMP '1995-01-01' AND "timestamp" < TIMESTAMP '2000-01-01'""", "demand"))
def q_year_range_incl(spark, sf):
    return year_range(demand(spark, sf), "timestamp", 1995, 1999, inclusive=True)


@register("prj5_add_constant", with_views("SELECT *, 'all' AS scope FROM demand", "demand"))
def q_add_constant(spark, sf):
    return add_constant(demand(spark, sf), "scope", "all")


@register("prj11_derive_year", f"SELECT *, CAST(year(CAST(ds AS DATE)) AS INTEGER) AS year FROM (SELECT 0 AS \"index\", strftime(\"timestamp\", '%Y-%m-%d') AS ds, target_value AS y, item_id FROM ({with_views('SELECT * FROM demand', 'demand')}) d) r")
def q_derive_year(spark, sf):
    return derive_year(raw_series(spark, sf), "ds")


@register("agg2_resample_weekly", with_views("""
SELECT item_id, date_trunc('week', "timestamp") AS "timestamp", sum(target_value) AS target_value FROM demand GROUP BY ALL""",
                                             "demand"))
def q_resample(spark, sf):
    return resample(demand(spark, sf), "week", "sum", ts="timestamp")


def _resample_sql(unit):
    return with_views(f"""SELECT item_id, date_trunc('{unit}', "timestamp") AS "timestamp", sum(target_value) AS target_value
FROM demand GROUP BY ALL""", "demand")


@register("agg2_resample_daily", _resample_sql("day"))
def q_resample_day(spark, sf):
    return resample(demand(spark, sf), "day", "sum", ts="timestamp")


@register("agg2_resample_monthly", _resample_sql("month"))
def q_resample_month(spark, sf):
    return resample(demand(spark, sf), "month", "sum", ts="timestamp")


@register("agg2_resample_hourly", """
SELECT event_type AS item_id, date_trunc('hour', ts) AS "timestamp", sum(value) AS target_value FROM events GROUP BY ALL""")
def q_resample_hour(spark, sf):
    from .views import table

    e = table(spark, sf, "events").select(F.col("event_type").alias("item_id"), F.col("ts").alias("timestamp"), F.col("value").alias("target_value"))
    return resample(e, "hour", "sum", ts="timestamp")


@register("ts2_fill_gaps_median_ffill", f"""
WITH d AS ({DAILY_SQL}),
span AS (SELECT item_id, min(ts) AS f, max(ts) AS l, median(target_value) AS med FROM d GROUP BY 1),
e AS (SELECT max(ts) AS e FROM d),
cal AS (SELECT item_id, l, med, CAST(unnest(generate_series(f, e.e, INTERVAL 1 DAY)) AS DATE) AS ts FROM span, e)
SELECT cal.item_id, cal.ts, CASE WHEN d.target_value IS NOT NULL THEN d.target_value WHEN cal.ts <= l THEN med
       ELSE last_value(d.target_value IGNORE NULLS) OVER (PARTITION BY cal.item_id ORDER BY cal.ts) END AS target_value,
       d.target_value IS NULL AS was_filled
FROM cal LEFT JOIN d USING (item_id, ts)""")
def q_fill_median(spark, sf):
    return fc.fill_gaps(daily(spark, sf), middlefill="median", backfill="ffill")


@register("ts4_backtest_windows_weekly", f"""
WITH f AS (SELECT item_id, CAST(date_trunc('week', "timestamp") AS DATE) AS ts, sum(target_value) AS target_value FROM ({ALL_PREP_SQL}) p GROUP BY ALL),
w AS (SELECT CAST(k AS INTEGER) AS "window", CAST(e - CAST(k * 28 AS INTEGER) AS DATE) AS cutoff FROM range(1, 3) t(k), (SELECT max(ts) AS e FROM f) m)
SELECT f.*, w."window", w.cutoff, CASE WHEN ts <= cutoff THEN 'train' ELSE 'test' END AS split FROM f, w WHERE ts <= cutoff + 28""")
def q_windows_weekly(spark, sf):
    return fc.backtest_windows(fc.to_daily(prepared(spark, sf), freq="week"), 4, 2, freq="week")


@register("ts4_backtest_windows_monthly", f"""
WITH f AS (SELECT item_id, CAST(date_trunc('month', "timestamp") AS DATE) AS ts, sum(target_value) AS target_value FROM ({ALL_PREP_SQL}) p GROUP BY ALL),
w AS (SELECT CAST(k AS INTEGER) AS "window", CAST(e - to_months(CAST(k * 3 AS INTEGER)) AS DATE) AS cutoff FROM range(1, 4) t(k), (SELECT max(ts) AS e FROM f) m)
SELECT f.*, w."window", w.cutoff, CASE WHEN ts <= cutoff THEN 'train' ELSE 'test' END AS split FROM f, w WHERE ts <= cutoff + to_months(3)""")
def q_windows_monthly(spark, sf):
    return fc.backtest_windows(fc.to_daily(prepared(spark, sf), freq="month"), 3, 3, freq="month")


@register("ts2_fill_gaps", FILLED_SQL)
def q_fill(spark, sf):
    return filled(spark, sf)


HOLIDAY_SQL = f"""
SELECT country, CASE WHEN d > 0 THEN make_date(y, m, d)
                     WHEN n = -1 THEN CAST(last_day(make_date(y, m, 1)) - CAST(((dayofweek(last_day(make_date(y, m, 1))) + 1) - w + 7) % 7 AS INTEGER) AS DATE)
                     ELSE CAST(make_date(y, m, 1) + CAST((w - (dayofweek(make_date(y, m, 1)) + 1) + 7) % 7 + 7 * (n - 1) AS INTEGER) AS DATE) END AS ds,
       holiday
FROM (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS y FROM (SELECT year(min(ts)) AS lo, year(max(ts)) AS hi FROM ({DAILY_SQL}) s)) yy,
     (VALUES {", ".join("('%s', '%s', %d, %d, %d, %d)" % (c, h.replace("'", "''"), m, d, w, n) for c, h, m, d, w, n in fc.HOLIDAY_RULES)})
       r(country, holiday, m, d, w, n)"""


@register("joi5_holiday_calendar", HOLIDAY_SQL)
def q_holidays(spark, sf):
    return fc.holiday_calendar(spark, ("US", "DE", "GB"), *fc.series_years(demand(spark, sf), "timestamp"))


@register("joi5_attach_holidays", f"""
WITH d AS ({DAILY_SQL}), c AS ({HOLIDAY_SQL}),
cu AS (SELECT ds, min(holiday) AS holiday FROM c WHERE country = 'US' GROUP BY ds)
SELECT d.*, cu.holiday FROM d LEFT JOIN cu ON d.ts = cu.ds""")
def q_attach_holidays(spark, sf):
    d = daily(spark, sf)
    return attach_holidays(d, us_holidays(d), "US", "ts", "holiday")


@register("ts3_calendar_features", f"""
WITH d AS ({DAILY_SQL}), c AS ({HOLIDAY_SQL}),
cu AS (SELECT ds, min(holiday) AS holiday FROM c WHERE country = 'US' GROUP BY ds)
SELECT d.*, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(month(ts) AS INTEGER) AS month,
       CAST(dayofyear(ts) AS INTEGER) AS doy,
       sin(2 * pi() * 1 * dayofyear(ts) / 365.25) AS sin_y1, cos(2 * pi() * 1 * dayofyear(ts) / 365.25) AS cos_y1,
       sin(2 * pi() * 2 * dayofyear(ts) / 365.25) AS sin_y2, cos(2 * pi() * 2 * dayofyear(ts) / 365.25) AS cos_y2,
       sin(2 * pi() * 1 * (dayofweek(ts) + 1) / 7.0) AS sin_w1, cos(2 * pi() * 1 * (dayofweek(ts) + 1) / 7.0) AS cos_w1,
       cu.holiday, CAST(cu.holiday IS NOT NULL AS INTEGER) AS is_holiday
FROM d LEFT JOIN cu ON d.ts = cu.ds""")
def q_calendar(spark, sf):
    d = daily(spark, sf)
    return fc.calendar_features(d, us_holidays(d), "US")


@register("ts4_backtest_windows", WINDOWS_SQL)
def q_windows(spark, sf):
    return windows(spark, sf)


@register("ts5_seasonal_naive", forecasts_sql(("snaive",)))
def q_snaive(spark, sf):
    return fc.forecast_seasonal_naive(windows(spark, sf), H, m=M)


@register("ts6_npts", forecasts_sql(("npts",)))
def q_npts(spark, sf):
    return fc.forecast_npts(windows(spark, sf), H, decay=DECAY)


NPTS_SEASONAL_SQL = f"""
WITH wins AS ({WINDOWS_SQL}), fut AS ({FUTURE_SQL}),
h AS (SELECT {KEYS}, dayofweek(ts) AS season, target_value AS v, 1.0 AS wt FROM wins WHERE split = 'train'),
a AS (SELECT {KEYS}, season, v, sum(wt) AS w FROM h GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY {KEYS}, season ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(w) OVER (PARTITION BY {KEYS}, season) AS tot FROM a),
q AS (SELECT {KEYS}, season, {", ".join(f"min(CASE WHEN round(cum, 9) >= round(tot * {q}, 9) THEN v END) AS {n}" for q, n in fc.QUANTILE_NAMES.items())}
      FROM c GROUP BY ALL),
j AS (SELECT fu.*, q.p10, q.p50, q.p90 FROM fut fu LEFT JOIN q ON fu.item_id = q.item_id AND fu."window" = q."window"
        AND fu.cutoff = q.cutoff AND dayofweek(fu.ts) = q.season)
{_long_sql("j", "NPTS", {0.1: "p10", 0.5: "p50", 0.9: "p90"})}"""


@register("ts6_npts_seasonal", NPTS_SEASONAL_SQL)
def q_npts_seasonal(spark, sf):
    return fc.forecast_npts(windows(spark, sf), H, kernel="uniform", season="dayofweek")


@register("ts7_ets", forecasts_sql(("ets",)))
def q_ets(spark, sf):
    return fc.forecast_ets(windows(spark, sf), H, alpha=ALPHA)


@register("ts7_holt", forecasts_sql(("holt",)))
def q_holt(spark, sf):
    return fc.forecast_holt(windows(spark, sf), H, alpha=HA, beta=HB)


@register("ts7_holt_winters", forecasts_sql(("hwin",)))
def q_holt_winters(spark, sf):
    return fc.forecast_holt_winters(windows(spark, sf), H, WA, WB, WG, WM)


@register("ts8_ar", forecasts_sql(("ar",)))
def q_ar(spark, sf):
    return fc.forecast_ar(windows(spark, sf), H)


@register("ts8_ar_p")
def q_ar_p(spark, sf):
    return fc.forecast_ar_p(windows(spark, sf), H, p=3)


@register("ts8_arima")
def q_arima(spark, sf):
    return fc.MODELS["ARIMA"](windows(spark, sf, WEEK), WEEK.horizon, freq="week")


@register("ts7_holt_winters_grid")
def q_grid(spark, sf):
    return fc.MODELS["HoltWintersGrid"](windows(spark, sf), H, m=M)


@register("ts9_harmonic")
def q_harmonic(spark, sf):
    w = windows(spark, sf)
    return fc.forecast_harmonic(w, H, calendar=us_holidays(w))


@register("ts9_changepoints")
def q_changepoints(spark, sf):
    w = windows(spark, sf)
    return fc.MODELS["Changepoints"](w, H, calendar=us_holidays(w))


@register("ts10_ts11_evaluate", METRICS_SQL)
def q_evaluate(spark, sf):
    return metrics(spark, sf)


def _register_calendar(cal):
    """Each model and the evaluation of all of them, by weeks or months."""
    name = {"week": "weekly", "month": "monthly"}[cal.freq]
    for key, query in {"snaive": "ts5_seasonal_naive", "npts": "ts6_npts", "ets": "ts7_ets", "holt": "ts7_holt", "hwin": "ts7_holt_winters", "ar": "ts8_ar"}.items():
        register(f"{query}_{name}", forecasts_sql((key,), cal))(lambda spark, sf, key=key: model(key, windows(spark, sf, cal), cal))
    register(f"ts10_ts11_evaluate_{name}", metrics_sql(cal))(lambda spark, sf: metrics(spark, sf, cal))


_register_calendar(WEEK)
_register_calendar(MONTH)


@register("ts13_auto_select_items", f"""
WITH m AS ({metrics_sql(WEEK, ", item_id")}),
a AS (SELECT item_id, algorithm, avg(avg_wQL) AS avg_wQL FROM m GROUP BY ALL)
SELECT item_id, first(algorithm ORDER BY avg_wQL IS NULL, avg_wQL, algorithm) AS algorithm, min(avg_wQL) AS avg_wQL, count(avg_wQL) AS candidates FROM a GROUP BY 1""")
def q_select_items(spark, sf):
    return fc.auto_select_items(metrics(spark, sf, WEEK, by=("item_id",)))


@register("ts12_summarise_windows", SUMMARY_SQL)
def q_summary(spark, sf):
    return fc.summarise_windows(metrics(spark, sf))


@register("ts13_auto_select", f"""
WITH s AS ({SUMMARY_SQL})
SELECT algorithm, avg_wQL, CAST(rank() OVER (ORDER BY avg_wQL ASC NULLS LAST, algorithm) AS INTEGER) AS rank,
       rank() OVER (ORDER BY avg_wQL ASC NULLS LAST, algorithm) = 1 AS selected
FROM s WHERE EvaluationType = 'SUMMARY'""")
def q_select(spark, sf):
    return fc.auto_select(fc.summarise_windows(metrics(spark, sf)))


@register("ts14_metrics_table", f"""
WITH s AS ({SUMMARY_SQL}), u AS (UNPIVOT (SELECT algorithm, {MET_COLS} FROM s WHERE EvaluationType = 'SUMMARY')
                                 ON {MET_COLS} INTO NAME metric VALUE value)
SELECT metric, {", ".join(f"round(max(CASE WHEN algorithm = '{a}' THEN value END), 4) AS \"{a}\"" for a in sorted(ALGOS_SQL))}
FROM u GROUP BY metric""")
def q_metrics_table(spark, sf):
    return fc.metrics_table(fc.summarise_windows(metrics(spark, sf)))


def _final(spark, sf):
    return fc.create_forecast(filled(spark, sf), H, "NPTS", decay=DECAY)


_FINAL_SQL = f"""
WITH f AS ({FILLED_SQL}),
wins AS (SELECT f.*, 0 AS "window", (SELECT max(ts) FROM f) AS cutoff, 'train' AS split FROM f),
fut AS ({FUTURE_SQL}), {npts_sql()}
SELECT item_id, cutoff, step, ts, algorithm, quantile, value FROM npts"""


@register("ts15_create_forecast", _FINAL_SQL)
def q_create_forecast(spark, sf):
    return _final(spark, sf)


_WIDE_SQL = f"""
WITH l AS ({_FINAL_SQL})
SELECT item_id, cutoff, step, ts, algorithm, max(CASE WHEN quantile = 0.1 THEN value END) AS p10,
       max(CASE WHEN quantile = 0.5 THEN value END) AS p50, max(CASE WHEN quantile = 0.9 THEN value END) AS p90
FROM l GROUP BY ALL"""


@register("ts16_forecast_wide", _WIDE_SQL)
def q_wide(spark, sf):
    return fc.forecast_wide(_final(spark, sf))


@register("ts16_forecast_long", f"""
SELECT item_id, cutoff, step, ts, algorithm, quantile_name, value FROM (UNPIVOT ({_WIDE_SQL}) ON p10, p50, p90
  INTO NAME quantile_name VALUE value)""")
def q_long(spark, sf):
    return fc.forecast_long(fc.forecast_wide(_final(spark, sf)))


@register("flt6_query_forecast", f"SELECT * FROM ({_WIDE_SQL}) w WHERE item_id = 'Brand#1'")
def q_query_forecast(spark, sf):
    return query_forecast(fc.forecast_wide(_final(spark, sf)), {"item_id": "Brand#1"})


@register("ts16_forecast_map")
def q_forecast_map(spark, sf):
    return fc.forecast_map(_final(spark, sf))


@register("ts17_explain_impact")
def q_impact(spark, sf):
    w = windows(spark, sf)
    return fc.explain_impact(w, H, us_holidays(w))
