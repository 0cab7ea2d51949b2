"""What every query must return, as DuckDB SQL written apart from the library."""

from __future__ import annotations

from collections.abc import Sequence

from checks.adapters import cte

KEYS = "nx, ny, fcstDate, fcstTime"
BASE_COLUMNS = ("seq", "T1H", "REH", "WSD", "RN1", "UUU", "VVV", "SKY")
SCORES = ("R_rain", "R_heat", "R_wind", "R_uv", "R_typhoon", "R_total")


def r6(x: str) -> str:
    return f"(floor(({x}) * 1e6 + 0.49) / 1e6)"


def r6s(*names: str) -> str:
    return ", ".join(f"{r6(n)} AS {n}" for n in names)


def at(d: str, t: str) -> str:
    return f"try_strptime({d} || {t}, '%Y%m%d%H%M')"


def newest(table: str, keys: str, order: Sequence[str]) -> str:
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rk "
        f"FROM {table}) WHERE rk = 1"
    )


# ---- text ----------------------------------------------------------------


def number(x: str) -> str:
    return (
        f"(CASE WHEN regexp_full_match(trim({x}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
        f"THEN TRY_CAST(trim({x}) AS DOUBLE) END)"
    )


def mm_range(x: str) -> str:
    t = f"(CASE WHEN trim({x}) IN ('강수없음', '-', '') THEN '0' ELSE trim({x}) END)"
    t = f"replace(replace(replace({t}, '㎜', 'mm'), 'mm', ''), ' ', '')"
    one = "\\d+(?:\\.\\d+)?"
    return f"""greatest(coalesce({number(t)},
      CASE WHEN regexp_full_match({t}, '{one}~{one}')
           THEN (CAST(split_part({t}, '~', 1) AS DOUBLE) + CAST(split_part({t}, '~', 2) AS DOUBLE)) / 2
           WHEN regexp_full_match({t}, '{one}미만') THEN CAST(replace({t}, '미만', '') AS DOUBLE) * 0.5
           WHEN regexp_full_match({t}, '{one}이상') THEN CAST(replace({t}, '이상', '') AS DOUBLE) END,
      0.0), 0.0)"""


def mm_search(x: str) -> str:
    t = f"trim({x})"
    return f"""greatest(coalesce(CASE WHEN contains({t}, '강수없음') THEN 0.0
      WHEN contains({t}, '1mm 미만') OR starts_with({t}, '<1') OR contains(lower({t}), '<1mm') THEN 0.5
      ELSE coalesce(TRY_CAST(nullif(regexp_extract({t}, '(-?\\d+(?:\\.\\d+)?)\\s*mm', 1, 'i'), '') AS DOUBLE), {number(t)}, 0.0)
      END, 0.0), 0.0)"""


def mm_collector(x: str) -> str:
    t = f"trim({x})"
    digits = f"regexp_replace({t}, '[^0-9.]', '', 'g')"
    return f"""(CASE WHEN {t} IS NULL OR {t} IN ('', 'None', 'nan') THEN NULL
      WHEN contains({t}, '없음') THEN 0.0
      WHEN contains({t}, '미만') THEN CASE WHEN {digits} = '' THEN 0.5 ELSE greatest(0.1, {number(digits)} * 0.5) END
      ELSE {number(f"replace({t}, 'mm', '')")} END)"""


# ---- scores ---------------------------------------------------------------


def logistic(x: str, k: float, x0: float) -> str:
    return f"(1 / (1 + exp(-{k} * (({x}) - {x0}))))"


def clip(x: str, a: float, b: float) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {a}), {b}) END)"


def smooth(x: str) -> str:
    c = f"least(greatest({x}, 0.0), 1.0)"
    return f"({c} * {c} * (3 - 2 * {c}))"


def line(x: str, xs: Sequence[float], ys: Sequence[float]) -> str:
    parts = [f"WHEN {x} <= {xs[0]} THEN {ys[0]}e0"]
    for i in range(1, len(xs)):
        parts.append(
            f"WHEN {x} <= {xs[i]} THEN {ys[i-1]}e0 + ({x} - {xs[i-1]}) * ({ys[i]}e0 - {ys[i-1]}e0) / ({xs[i]}e0 - {xs[i-1]}e0)"
        )
    return f"(CASE {' '.join(parts)} ELSE {ys[-1]}e0 END)"


def minmax(x: str, lo: str, hi: str) -> str:
    return f"""(CASE WHEN {lo} IS NULL THEN 0.0
      WHEN abs({hi} - {lo}) < 1e-9 THEN CASE WHEN {x} > {lo} THEN 1.0 ELSE 0.0 END
      ELSE {clip(f'({x} - {lo}) / ({hi} - {lo} + 1e-6)', 0.0, 1.0)} END)"""


def rain_sql(rn1: str, pcp: str, pop: str) -> str:
    dry = f"({rn1}) <= 0.2"
    pop01 = f"(least(greatest(coalesce({pop}, 0.0), 0.0), 100.0) / 100)"
    extra = f"""((CASE WHEN {dry} THEN 0.012 ELSE 0.004 END) * pow({pop01}, 1.7)
      + 0.03 * (CASE WHEN {dry} THEN 1.0 ELSE 0.4 END) * (1 - exp(-(({pcp}) / 38.0))))"""
    base = f"""(CASE WHEN {dry} THEN least({extra}, 0.07) ELSE
      least(greatest(0.985 * (1 - exp(-pow(({rn1}) / 30.0, 0.95)))
        + 0.12 * (1 - exp(-(greatest(({rn1}) - 22.0, 0.0) / 16.0))) + {extra}, 0.0), 1.3) END)"""
    k, x0 = 3.2, 0.56
    scaled = f"({logistic(base, k, x0)} - {logistic('0.0', k, x0)}) / ({logistic('1.0', k, x0)} - {logistic('0.0', k, x0)} + 1e-9)"
    return f"least(greatest({scaled}, 0.010), 0.97)"


def heat_sql(t: str, rh: str, w: str) -> str:
    t = f"coalesce({t}, 24.0e0)"
    rh = f"least(greatest(coalesce({rh}, 60.0e0), 0.0), 100.0)"
    w = f"greatest(coalesce({w}, 1.5e0), 0.0)"
    r0 = line(t, (16, 20, 24, 26, 28, 31, 34, 37, 40), (0.10, 0.16, 0.24, 0.30, 0.42, 0.60, 0.76, 0.88, 0.96))
    r01 = f"least(greatest(({r0} - 0.12) / 0.84, 0.0), 1.0)"
    soft = f"({r01} * (1 - {r01}))"
    cool = f"0.020 * {smooth(f'({rh} - 75) / 20')} * {smooth(f'({t} - 18) / 5')} * (1 - {smooth(f'({t} - 27) / 2')}) * (1 - {r01})"
    hot = f"0.060 * least(greatest(({rh} - 60) / 40, 0.0), 1.0) * {smooth(f'({t} - 31.5) / 4')} * {soft}"
    wind = f"0.040 * (ln(1 + {w}) / ln(11.0)) * {smooth(f'({t} - 26) / 4')} * {soft}"
    return f"least(greatest({r0} + {cool} + {hot} - {wind}, 0.12), 0.96)"


def wind_sql(speed: str) -> str:
    return line(f"coalesce({speed}, 0.0)", (0, 4, 8, 12, 16, 22, 30), (0.0, 0.02, 0.15, 0.45, 0.70, 0.90, 1.00))


def uv_sql(uvi: str) -> str:
    return f"coalesce({logistic(clip(f'{uvi} / 12.0', 0.0, 1.0), 5, 0.4)}, 0.0)"


def uv_estimate_sql(sky: str, warm: str, hour: str, pcp: str, pop: str) -> str:
    daylight = f"(CASE WHEN {hour} BETWEEN 10 AND 15 THEN 1.0 WHEN {hour} BETWEEN 8 AND 17 THEN 0.7 ELSE 0.3 END)"
    damp = f"""((CASE WHEN coalesce({pcp}, 0) > 0 THEN 0.4 ELSE 1.0 END)
      * (1 - 0.5 * least(greatest(coalesce({pop}, 0) / 100.0, 0.0), 1.0)))"""
    raw = f"((0.45 * (4 - coalesce({sky}, 3.0)) / 3.0 + 0.35 * coalesce({warm}, 0.5) + 0.20 * {daylight}) * {damp})"
    return f"coalesce({logistic(clip(raw, 0.0, 1.0), 5, 0.5)}, 0.0)"


def storm_sql(d: str, strength: str, warning: str) -> str:
    near = f"coalesce(least(greatest(exp(-({d} / 300.0)) / (1 + exp(({d} - 700.0) / 80.0)), 0.0), 1.0), 0.0)"
    near = f"(CASE WHEN {d} IS NULL THEN 0.0 ELSE {near} END)"
    raw = f"""least(greatest(0.75 * {near} + 0.20 * pow({near}, 1.2) * coalesce({strength}, 0.0)
      + 0.05 * pow({near}, 1.5) * least(greatest(coalesce({warning}, 0.0), 0.0), 1.0), 0.0), 1.0)"""
    s0 = logistic("0.0", 6, 0.35)
    return f"(0.010 + 0.990 * least(greatest(({logistic(raw, 6, 0.35)} - {s0}) / (1 - {s0}), 0.0), 1.0))"


TOTAL = """least(greatest(0.7 * greatest(R_rain, R_heat, R_wind, R_uv, R_typhoon)
  + 0.3 * least(greatest(0.28 * R_rain + 0.18 * R_heat + 0.22 * R_wind + 0.12 * R_uv + 0.20 * R_typhoon, 0.0), 1.0), 0.0), 1.0)"""

# fx_score with the numbers of each run.
RUN_STATS = """stats AS (
  SELECT dt, quantile_cont(TY_MAX_WIND, 0.05) AS slo, quantile_cont(TY_MAX_WIND, 0.95) AS shi,
    quantile_cont(greatest(T1H, TMP), 0.05) AS wlo, quantile_cont(greatest(T1H, TMP), 0.95) AS whi,
    count(T1H) AS n_t1h
  FROM fx_score GROUP BY dt),
s AS (SELECT f.*, slo, shi, wlo, whi, n_t1h, sqrt(UUU * UUU + VVV * VVV) AS vector FROM fx_score f JOIN stats USING (dt))"""
SCORE_PARTS = {
    "R_rain": rain_sql(mm_search("RN1"), "greatest(coalesce(PCP, 0.0), 0.0)", "POP"),
    "R_heat": heat_sql("(CASE WHEN n_t1h > 0 THEN T1H ELSE TMP END)", "REH", "WSD"),
    "R_wind": wind_sql("greatest(WSD, WSD_vil, vector)"),
    "R_uv": uv_sql("UVI"),
    "R_typhoon": storm_sql("TY_DISTANCE_KM", minmax("TY_MAX_WIND", "slo", "shi"), "TY_WARNING"),
}
ESTIMATE = uv_estimate_sql(
    "SKY", minmax("greatest(T1H, TMP)", "wlo", "whi"), "CAST(substring(fcstTime, 1, 2) AS INT)", "PCP", "POP"
)


def score_query(name: str, expression: str) -> str:
    return f"{cte('fx_score')}, {RUN_STATS} SELECT dt, seq, {r6(expression)} AS {name} FROM s"


# ---- silver and gold --------------------------------------------------------


def feed_sql(table: str, columns: Sequence[str], keys: str) -> str:
    inner = f"(SELECT {keys}, seq, {', '.join(columns)} FROM {table})"
    return newest(inner, keys, ["seq", *columns])


LABELS = """labels AS (
  SELECT nx, ny, nullif(string_agg(DISTINCT admin_name, '|' ORDER BY admin_name), '') AS admin_names
  FROM fx_regions GROUP BY nx, ny)"""

MERGED = f"""base AS ({newest('fx_base', KEYS, BASE_COLUMNS)}),
vil AS ({feed_sql('fx_vil', ['PCP', 'POP', 'WSD'], KEYS)}),
ty AS ({feed_sql('fx_ty', ['TY_DISTANCE_KM', 'TY_MAX_WIND', 'TY_WARNING'], KEYS)}),
uv AS ({feed_sql('fx_uv', ['UVI'], KEYS)})"""


def silver_cte() -> str:
    return f"""{cte('fx_base', 'fx_vil', 'fx_ty', 'fx_uv', 'fx_regions')},
{MERGED}, {LABELS},
merged AS (
  SELECT b.nx, b.ny, b.fcstDate, b.fcstTime, b.seq, T1H, REH, coalesce(b.WSD, v.WSD) AS WSD, RN1, UUU, VVV, SKY,
    PCP, POP, TY_DISTANCE_KM, TY_MAX_WIND, TY_WARNING, UVI, '2025080112' AS dt, admin_names
  FROM base b LEFT JOIN vil v USING ({KEYS}) LEFT JOIN ty USING ({KEYS}) LEFT JOIN uv USING ({KEYS})
    LEFT JOIN labels USING (nx, ny)),
stats AS (SELECT quantile_cont(TY_MAX_WIND, 0.05) AS slo, quantile_cont(TY_MAX_WIND, 0.95) AS shi FROM merged),
parts AS (
  SELECT merged.*,
    {rain_sql('greatest(coalesce(RN1, 0.0), 0.0)', 'greatest(coalesce(PCP, 0.0), 0.0)', 'POP')} AS R_rain,
    {heat_sql('T1H', 'REH', 'WSD')} AS R_heat,
    {wind_sql('greatest(WSD, sqrt(UUU * UUU + VVV * VVV))')} AS R_wind,
    {uv_sql('UVI')} AS R_uv,
    {storm_sql('TY_DISTANCE_KM', minmax('TY_MAX_WIND', 'slo', 'shi'), 'TY_WARNING')} AS R_typhoon
  FROM merged, stats),
silver AS (SELECT *, {TOTAL} AS R_total, {at('fcstDate', 'fcstTime')} AS fcst_ts FROM parts)"""


def backfill_sql() -> str:
    keys = KEYS + ", dt"
    return f"""{cte('fx_base_runs', 'fx_vil_runs', 'fx_ty_runs', 'fx_regions')},
base AS ({newest('fx_base_runs', keys, BASE_COLUMNS)}),
vil AS ({feed_sql('fx_vil_runs', ['PCP', 'POP', 'WSD'], keys)}),
ty AS ({feed_sql('fx_ty_runs', ['TY_DISTANCE_KM', 'TY_MAX_WIND', 'TY_WARNING'], keys)}), {LABELS},
merged AS (
  SELECT b.nx, b.ny, b.fcstDate, b.fcstTime, b.dt, b.seq, T1H, REH, coalesce(b.WSD, v.WSD) AS WSD, RN1, UUU, VVV, SKY,
    PCP, POP, TY_DISTANCE_KM, TY_MAX_WIND, TY_WARNING, admin_names
  FROM base b LEFT JOIN vil v USING ({keys}) LEFT JOIN ty USING ({keys}) LEFT JOIN labels USING (nx, ny)),
stats AS (SELECT dt, quantile_cont(TY_MAX_WIND, 0.05) AS slo, quantile_cont(TY_MAX_WIND, 0.95) AS shi,
  quantile_cont(T1H, 0.05) AS wlo, quantile_cont(T1H, 0.95) AS whi FROM merged GROUP BY dt),
parts AS (
  SELECT merged.*,
    {rain_sql('greatest(coalesce(RN1, 0.0), 0.0)', 'greatest(coalesce(PCP, 0.0), 0.0)', 'POP')} AS R_rain,
    {heat_sql('T1H', 'REH', 'WSD')} AS R_heat,
    {wind_sql('greatest(WSD, sqrt(UUU * UUU + VVV * VVV))')} AS R_wind,
    {uv_estimate_sql('SKY', minmax('T1H', 'wlo', 'whi'), 'CAST(substring(fcstTime, 1, 2) AS INT)', 'PCP', 'POP')} AS R_uv,
    {storm_sql('TY_DISTANCE_KM', minmax('TY_MAX_WIND', 'slo', 'shi'), 'TY_WARNING')} AS R_typhoon
  FROM merged JOIN stats USING (dt)),
silver AS (SELECT *, {TOTAL} AS R_total, {at('fcstDate', 'fcstTime')} AS fcst_ts FROM parts)
SELECT * REPLACE ({r6s(*SCORES)}) FROM silver"""


NEWEST_REGION = """newest AS (
  SELECT * EXCLUDE (rk), CASE WHEN R_total >= 0.8 THEN 'VERY_HIGH' WHEN R_total >= 0.6 THEN 'HIGH'
    WHEN R_total >= 0.4 THEN 'MED' ELSE 'LOW' END AS risk_level
  FROM (SELECT *, row_number() OVER (PARTITION BY admin_names
      ORDER BY fcst_ts DESC NULLS LAST, dt DESC, R_total DESC NULLS LAST, nx, ny) AS rk
    FROM silver WHERE admin_names IS NOT NULL) WHERE rk = 1)"""
DAILY = """daily AS (
  SELECT CAST(strptime(fcstDate, '%Y%m%d') AS DATE) AS date, admin_names, avg(R_total) AS r_total_avg,
    max(R_total) AS r_total_max, count(*) AS obs_cnt,
    first(fcstTime ORDER BY R_total DESC NULLS LAST, fcstTime DESC) AS max_time
  FROM silver WHERE admin_names IS NOT NULL GROUP BY 1, 2)"""


def gold_sql(tail: str, *parts: str) -> str:
    return f"{silver_cte()}, {', '.join(parts)} {tail}"


# ---- time ------------------------------------------------------------------

HOURS = f"""hours AS (
  SELECT DISTINCT ts FROM (
    SELECT {at('fcstDate', 'fcstTime')} AS ts FROM fx_base
    UNION ALL SELECT {at('fcstDate', 'fcstTime')} FROM fx_items) WHERE ts IS NOT NULL)"""
NOW = "now AS (SELECT strptime(now_text, '%Y%m%d%H%M') AS ts FROM fx_poll)"

TRACK = f"""track AS (
  SELECT storm, seq, try_strptime(typTm, '%Y%m%d%H%M') AS time, coalesce(CAST(typLat AS DOUBLE), NULL) AS lat, lon, typWs AS wind
  FROM fx_track WHERE try_strptime(typTm, '%Y%m%d%H%M') IS NOT NULL AND typLat IS NOT NULL)"""


def minutes(a: str, b: str) -> str:
    return f"(epoch({a}) - epoch({b}))"


def interpolated(name: str, targets: str, knots: str, value: str, inside: bool = False, series: str = "storm") -> str:
    """CTE ``name`` (series, time, value): linear between the neighbours in ``knots``."""
    edge = "" if inside else "WHEN p.pt IS NULL THEN n.nv WHEN n.nt IS NULL THEN p.pv"
    none = "WHEN p.pt IS NULL OR n.nt IS NULL THEN NULL" if inside else ""
    return f"""{name}_k AS (SELECT {series}, time AS kt, {value} AS kv FROM {knots} WHERE {value} IS NOT NULL),
{name}_p AS (SELECT t.{series}, t.time, k.kt AS pt, k.kv AS pv FROM {targets} t ASOF LEFT JOIN {name}_k k
  ON t.{series} = k.{series} AND t.time >= k.kt),
{name}_n AS (SELECT t.{series}, t.time, k.kt AS nt, k.kv AS nv FROM {targets} t ASOF LEFT JOIN {name}_k k
  ON t.{series} = k.{series} AND t.time <= k.kt),
{name} AS (SELECT p.{series}, p.time,
  CASE WHEN p.pt = p.time THEN p.pv {edge} {none}
    ELSE p.pv + (n.nv - p.pv) * ({minutes('p.time', 'p.pt')} / {minutes('n.nt', 'p.pt')}) END AS v
  FROM {name}_p p JOIN {name}_n n USING ({series}, time))"""


def three(name: str, targets: str, knots: str, inside: bool = False) -> str:
    parts = [interpolated(f"{name}_{v}", targets, knots, v, inside) for v in ("lat", "lon", "wind")]
    return ",\n".join(parts) + f""",
{name} AS (SELECT storm, time, a.v AS lat, o.v AS lon, w.v AS wind
  FROM {name}_lat a JOIN {name}_lon o USING (storm, time) JOIN {name}_wind w USING (storm, time))"""


POINTS = f"points AS ({newest('track', 'storm, time', ['seq', 'lat', 'lon', 'wind'])})"
HOURLY = f"""span AS (SELECT storm, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time FROM points GROUP BY storm),
{three('hourly', 'span', 'points', inside=True)}"""
ALIGN_TARGETS = """wanted AS (
  SELECT storm, ts AS time FROM (SELECT DISTINCT storm FROM fx_track), hours)"""

ONE_TRACK = f"""one AS (SELECT 0 AS storm, seq, time, lat, lon, wind FROM track),
points AS ({newest('one', 'time', ['seq', 'lat', 'lon', 'wind'])}),
{HOURLY},
targets AS (SELECT DISTINCT 0 AS storm, ts AS time FROM hours),
{three('positions', 'targets', 'hourly')}"""
GRID = f"""grid AS (SELECT nx, ny, lat, lon FROM (
  SELECT *, row_number() OVER (PARTITION BY nx, ny ORDER BY admin_code, lat, lon) AS rk FROM fx_regions) WHERE rk = 1)"""

ISSUE = """issue AS (
  SELECT event_id, ts, (SELECT max(i) FROM unnest(list_concat(
      list_transform([2, 5, 8, 11, 14, 17, 20, 23], lambda h: date_trunc('day', ts) + to_hours(h)),
      list_transform([2, 5, 8, 11, 14, 17, 20, 23], lambda h: date_trunc('day', ts) - INTERVAL 24 HOUR + to_hours(h)))) u(i)
    WHERE i <= date_trunc('minute', ts) - INTERVAL 25 MINUTE) AS base_ts
  FROM events)"""
POLL_SLOTS = """poll AS (SELECT ts, CASE WHEN ts - date_trunc('hour', ts) IS NULL THEN ts END AS unused,
    date_trunc('day', ts) + INTERVAL 20 HOUR AS base_ts FROM now),
primary_slots AS (SELECT strftime(s, '%Y%m%d') AS fcstDate, strftime(s, '%H%M') AS fcstTime FROM (
  SELECT unnest(generate_series(greatest(base_ts + INTERVAL 1 HOUR, date_trunc('hour', ts)),
    greatest(base_ts + INTERVAL 1 HOUR, date_trunc('hour', ts)) + INTERVAL 5 HOUR, INTERVAL 1 HOUR)) AS s FROM poll)),
other_slots AS (SELECT strftime(s, '%Y%m%d') AS fcstDate, strftime(s, '%H%M') AS fcstTime FROM (
  SELECT unnest(generate_series(base_ts + INTERVAL 1 HOUR, base_ts + INTERVAL 6 HOUR, INTERVAL 1 HOUR)) AS s FROM poll))"""

UV_OFFSETS = """uv_values AS (
  SELECT admin_code, seq, strptime(base_text, '%Y%m%d%H%M') AS base_ts, 0 AS "offset", CAST(CASE WHEN kind = 'click' THEN v3 ELSE v0 END AS DOUBLE) AS value
    FROM fx_uv_items WHERE kind <> 'signup'
  UNION ALL SELECT admin_code, seq, strptime(base_text, '%Y%m%d%H%M'), 3, CAST(v3 AS DOUBLE) FROM fx_uv_items WHERE kind <> 'click'
  UNION ALL SELECT admin_code, seq, strptime(base_text, '%Y%m%d%H%M'), 6, CAST(v6 AS DOUBLE) FROM fx_uv_items WHERE kind NOT IN ('click', 'signup')),
uv_offsets AS (SELECT admin_code, base_ts, "offset", arg_max(value, seq) AS value FROM uv_values GROUP BY ALL)"""


def uv_based(anchor: str) -> str:
    return f"""inside AS (SELECT * FROM uv_offsets WHERE base_ts BETWEEN {anchor} - INTERVAL 48 HOUR AND {anchor}),
based AS (SELECT * FROM inside WHERE (admin_code, base_ts) IN (SELECT admin_code, max(base_ts) FROM inside GROUP BY admin_code))"""


# Items of landed responses, and what each run asks for at its hour.
LANDED_ITEMS = f"""asked AS (SELECT *, strptime(dt, '%Y%m%d%H') AS now FROM fx_landed WHERE kind IN ('list', 'xml')),
items AS (
  SELECT seq, 0 AS pos, service, dt, now, nx, ny, day AS baseDate, base_time AS baseTime, day AS fcstDate, fcst_time AS fcstTime, c1 AS category, v1 AS value FROM asked
  UNION ALL SELECT seq, 1, service, dt, now, nx, ny, day, base_time, day, fcst_time, c2, v2 FROM asked),
timed AS (SELECT *, {at('baseDate', 'baseTime')} AS base FROM items)"""


def last_values(categories: Sequence[str]) -> str:
    return ", ".join(f"arg_max(value, seq * 2 + pos) FILTER (WHERE category = '{c}') AS {c}" for c in categories)


def newest_items(service: str, newest_base: str, categories: Sequence[str]) -> str:
    listed = ", ".join(f"'{c}'" for c in categories)
    return f"""tried AS (SELECT * FROM timed WHERE service = '{service}' AND base BETWEEN {newest_base} - INTERVAL 3 HOUR AND {newest_base}),
kept AS (SELECT * FROM tried WHERE (dt, nx, ny, base) IN (SELECT (dt, nx, ny, max(base)) FROM tried GROUP BY dt, nx, ny) AND category IN ({listed}))"""


ULTRA = ("T1H", "RN1", "SKY", "UUU", "VVV", "REH", "PTY", "LGT", "VEC", "WSD")
ULTRA_ITEMS = newest_items("ultra_shortfcst", "date_trunc('hour', now - INTERVAL 45 MINUTE) + INTERVAL 30 MINUTE", ULTRA)
RUN_HOURS = f"""run_hours AS (
  SELECT dt, ts FROM (
    SELECT dt, ts, row_number() OVER (PARTITION BY dt ORDER BY ts DESC) AS rk
    FROM (SELECT DISTINCT dt, {at('fcstDate', 'fcstTime')} AS ts FROM kept)) WHERE rk <= 6)"""
CALLS = """calls AS (SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY nx, ny ORDER BY admin_code) AS rk FROM fx_regions) WHERE rk = 1)"""


def text12(x: str) -> str:
    return f"strftime({x}, '%Y%m%d%H%M')"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["scan_run_partition"] = (
        f"{cte('fx_base_runs')} SELECT {KEYS}, seq, T1H, dt FROM fx_base_runs WHERE dt = '2025080106'"
    )
    sql["bronze_partitioned"] = (
        f"{cte('fx_base_runs')} SELECT dt, count(*) AS n_rows, min(seq) AS min_seq, max(seq) AS max_seq FROM fx_base_runs GROUP BY dt"
    )
    sql["response_triage"] = f"""{cte('fx_responses')} SELECT event_id,
      CASE WHEN kind IN ('single', 'list') THEN 'good' ELSE kind END AS status FROM fx_responses"""
    sql["response_quarantine"] = f"SELECT * FROM ({sql['response_triage']}) WHERE status IN ('error', 'not_json', 'quota', 'unreadable')"
    sql["raw_items_explode"] = f"""{cte('fx_responses')}
      SELECT event_id, 0 AS pos, nx, ny, fcstDate AS baseDate, '0500' AS baseTime, fcstDate, fcstTime, category, fcstValue
        FROM fx_responses WHERE kind IN ('single', 'list')
      UNION ALL SELECT event_id, 1, nx, ny, fcstDate, '0500', fcstDate, fcstTime, 'SKY', sky FROM fx_responses WHERE kind = 'list'"""
    sql["call_list_clean"] = f"""{cte('fx_calls')} SELECT trim(areaNo) AS admin_code, CAST(nx AS INT) AS nx, CAST(ny AS INT) AS ny
      FROM fx_calls WHERE areaNo IS NOT NULL"""
    sql["region_map_clean"] = f"""{cte('fx_region_map')} SELECT DISTINCT CAST(NX AS INT) AS nx, TRY_CAST(NY AS INT) AS ny,
      trim(Name) AS admin_name FROM fx_region_map"""
    canonical = f"""{cte('fx_raw_wide')}, canon AS (SELECT CAST(nx AS INT) AS nx, CAST(ny AS INT) AS ny,
      replace(fcstDate, '-', '') AS fcstDate, lpad(replace(fcstTime, ':', ''), 4, '0') AS fcstTime,
      CAST(baseDate AS VARCHAR) AS baseDate, lpad(CAST(baseTime AS VARCHAR), 4, '0') AS baseTime,
      TRY_CAST(T1H AS DOUBLE) AS T1H, TRY_CAST(RN1 AS DOUBLE) AS RN1, WSD, seq FROM fx_raw_wide)"""
    sql["canonicalize"] = f"{canonical} SELECT * FROM canon"
    sql["fcst_timestamp"] = f"""{canonical} SELECT seq, {at('fcstDate', 'fcstTime')} AS fcst_ts,
      CAST(epoch({at('fcstDate', 'fcstTime')}) AS BIGINT) - 32400 AS instant FROM canon"""
    sql["pick_max_variants"] = f"""{cte('fx_score')} SELECT dt, seq, greatest(WSD, WSD_vil) AS wsd,
      {r6(f"greatest(greatest(coalesce(PCP, 0.0), 0.0), {mm_range('RN1')})")} AS pcp FROM fx_score"""
    sql["risk_level"] = f"""{cte('fx_base')} SELECT seq, CASE WHEN REH / 1e2 >= 0.8 THEN 'VERY_HIGH' WHEN REH / 1e2 >= 0.6 THEN 'HIGH'
      WHEN REH / 1e2 >= 0.4 THEN 'MED' ELSE 'LOW' END AS risk_level FROM fx_base"""
    sql["run_dt"] = "SELECT event_id, strftime(ts, '%Y%m%d%H') AS dt FROM events"
    nowcast = f"""nc0 AS (SELECT nx, ny, baseDate AS fcstDate, baseTime AS fcstTime, seq, T1H, REH, WSD FROM fx_nc),
      nc AS ({newest('nc0', KEYS, ['seq', 'T1H', 'REH', 'WSD'])})"""
    sql["coalesce_join"] = f"""{cte('fx_base', 'fx_nc')}, {nowcast}
      SELECT {KEYS}, b.seq, coalesce(b.T1H, n.T1H) AS T1H, coalesce(b.REH, n.REH) AS REH, coalesce(b.WSD, n.WSD) AS WSD,
        RN1, UUU, VVV, SKY FROM fx_base b LEFT JOIN nc n USING ({KEYS})"""
    nowcast_merge = f"""nc0 AS (SELECT nx, ny, baseDate AS fcstDate, baseTime AS fcstTime, seq, REH, T1H, WSD FROM fx_nc),
      nc AS ({newest('nc0', KEYS, ['seq', 'REH', 'T1H', 'WSD'])})"""
    sql["silver_merge"] = f"""{cte('fx_base', 'fx_nc', 'fx_vil', 'fx_ty', 'fx_uv')}, {nowcast_merge}, {MERGED}
      SELECT {KEYS}, b.seq, coalesce(b.T1H, n.T1H) AS T1H, coalesce(b.REH, n.REH) AS REH, coalesce(b.WSD, n.WSD, v.WSD) AS WSD,
        RN1, UUU, VVV, SKY, PCP, POP, TY_DISTANCE_KM, TY_MAX_WIND, TY_WARNING, UVI
      FROM base b LEFT JOIN nc n USING ({KEYS}) LEFT JOIN vil v USING ({KEYS}) LEFT JOIN ty USING ({KEYS}) LEFT JOIN uv USING ({KEYS})"""
    sql["region_labels"] = f"""{cte('fx_regions')} SELECT nx, ny, string_agg(DISTINCT admin_name, '|' ORDER BY admin_name) AS admin_names,
      string_agg(DISTINCT admin_name, ', ' ORDER BY admin_name) AS names_comma FROM fx_regions GROUP BY nx, ny"""
    sql["attach_regions"] = f"""{cte('fx_base', 'fx_regions')}, {LABELS}
      SELECT {KEYS}, seq, admin_names FROM fx_base LEFT JOIN labels USING (nx, ny)"""
    value = f"CASE WHEN category = 'PCP' THEN {mm_collector('fcstValue')} ELSE {number('fcstValue')} END"
    means = {c: f"avg(v) FILTER (WHERE category = '{c}')" for c in ("PCP", "POP", "REH", "TMP", "WSD", "PTY")}
    sql["short_fcst_wide"] = f"""{cte('fx_items')}, items AS (SELECT *, {value} AS v FROM fx_items)
      SELECT {KEYS}, CAST(epoch({at('fcstDate', 'fcstTime')}) AS BIGINT) - 32400 AS valid_instant,
        {r6(means['PCP'])} AS PCP, {r6(means['POP'])} AS POP, CAST(floor({means['PTY']}) AS INT) AS PTY, {r6(means['REH'])} AS REH,
        CAST(NULL AS INT) AS SKY, {r6(means['TMP'])} AS TMP, {r6(means['WSD'])} AS WSD
      FROM items WHERE v IS NOT NULL GROUP BY {KEYS}"""
    lasts = ", ".join(
        f"arg_max(fcstValue, seq) FILTER (WHERE category = '{c}') AS {c}" for c in ("PCP", "PTY", "REH", "TMP", "WSD")
    )
    sql["nowcast_wide"] = f"""{cte('fx_items_based')} SELECT baseDate, baseTime, nx, ny, {lasts}
      FROM fx_items_based GROUP BY baseDate, baseTime, nx, ny"""
    sql["dedupe_keys"] = f"{cte('fx_base')} {newest('fx_base', KEYS, BASE_COLUMNS)}"
    sql["feeds_union"] = f"""{cte('fx_base', 'fx_vil')} SELECT {KEYS}, seq, T1H, WSD, CAST(NULL AS DOUBLE) AS POP FROM fx_base
      UNION ALL SELECT {KEYS}, seq, NULL, WSD, POP FROM fx_vil"""
    half = "tan(pi() / 4 + radians({}) / 2)"
    sn = f"(ln(cos(radians(30)) / cos(radians(60))) / ln({half.format(60)} / {half.format(30)}))"
    re = "(6371.00877e0 / 5.0e0)"
    sf = f"(pow({half.format(30)}, {sn}) * cos(radians(30)) / {sn})"
    ra = f"({re} * {sf} / pow({half.format('lat')}, {sn}))"
    ro = f"({re} * {sf} / pow({half.format(38)}, {sn}))"
    theta = f"(radians(lon) - radians(126)) * {sn}"
    cells = f"""CAST(trunc({ra} * sin({theta}) + 43 + 0.5) AS INT) AS nx, CAST(trunc({ro} - {ra} * cos({theta}) + 136 + 0.5) AS INT) AS ny"""
    sql["grid_assign"] = f"{cte('fx_regions')} SELECT admin_code, {cells} FROM (SELECT admin_code, lat, lon FROM fx_regions)"
    first_point = """(SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY admin_code
        ORDER BY lat IS NULL OR lon IS NULL, admin_name, lat, lon) AS rk FROM fx_points) WHERE rk = 1)"""
    sql["region_dimension"] = f"""{cte('fx_points')} SELECT admin_code, admin_name, lat, lon, {cells},
      substring(admin_code, 1, 5) AS SIG_CD FROM {first_point}"""
    sql["grid_unique"] = f"""{cte('fx_points')}, placed AS (SELECT admin_code, lat, lon, {cells} FROM fx_points WHERE lat IS NOT NULL)
      SELECT nx, ny, {r6s('lat', 'lon')} FROM (SELECT *, row_number() OVER (PARTITION BY nx, ny ORDER BY admin_code, lat, lon) AS rk FROM placed) WHERE rk = 1"""
    sql["call_list_unique"] = f"""{cte('fx_regions')} SELECT admin_code, admin_name, {r6s('lat', 'lon')}, nx, ny FROM (
      SELECT *, row_number() OVER (PARTITION BY nx, ny ORDER BY admin_code) AS rk FROM fx_regions) WHERE rk = 1"""
    sql["sample_cells"] = f"{cte('fx_regions')} SELECT admin_code, nx, ny FROM fx_regions ORDER BY nx, ny, admin_code LIMIT 20"
    for name, reader in (("range", mm_range), ("search", mm_search), ("collector", mm_collector)):
        sql[f"parse_mm_{name}"] = f"{cte('fx_amounts')} SELECT event_id, {r6(reader('txt'))} AS mm FROM fx_amounts"
    sql["percentile_minmax"] = f"""{cte('fx_ty_runs')}, e AS (SELECT dt, quantile_cont(TY_DISTANCE_KM, 0.05) AS p5,
        quantile_cont(TY_DISTANCE_KM, 0.95) AS p95 FROM fx_ty_runs GROUP BY dt)
      SELECT dt, seq, {r6s('p5', 'p95')}, {r6(minmax('TY_DISTANCE_KM', 'p5', 'p95'))} AS scaled FROM fx_ty_runs JOIN e USING (dt)"""
    sql["rain_risk"] = score_query("R_rain", SCORE_PARTS["R_rain"])
    sql["heat_risk"] = score_query("R_heat", SCORE_PARTS["R_heat"])
    sql["wind_risk"] = score_query("R_wind", SCORE_PARTS["R_wind"])
    sql["uv_risk_direct"] = score_query("R_uv", SCORE_PARTS["R_uv"])
    sql["uv_risk_estimated"] = score_query("R_uv", ESTIMATE)
    sql["typhoon_risk"] = score_query("R_typhoon", SCORE_PARTS["R_typhoon"])
    parts = ", ".join(f"{e} AS {n}" for n, e in SCORE_PARTS.items())
    sql["score_all"] = f"""{cte('fx_score')}, {RUN_STATS}, parts AS (SELECT dt, seq, {parts} FROM s),
      scored AS (SELECT *, {TOTAL} AS R_total FROM parts) SELECT dt, seq, {r6s(*SCORES)} FROM scored"""
    sql["total_risk"] = f"""{cte('fx_base')}, p AS (SELECT seq, coalesce(T1H, 0) / 40.0 AS R_rain, coalesce(REH, 0) / 100.0 AS R_heat,
        coalesce(WSD, 0) / 30.0 AS R_wind, UUU / 10.0 AS R_uv, SKY / 4.0 AS R_typhoon FROM fx_base)
      SELECT seq, {r6(TOTAL)} AS R_total FROM p"""
    sql["track_clean"] = f"{cte('fx_track')}, {TRACK} SELECT storm, seq, {text12('time')} AS time, lat, lon, wind FROM track"
    shown = f"storm, {text12('time')} AS time, {r6s('lat', 'lon', 'wind')}"
    sql["track_hourly"] = f"{cte('fx_track')}, {TRACK}, {POINTS}, {HOURLY} SELECT {shown} FROM hourly"
    sql["track_align"] = f"""{cte('fx_track', 'fx_base', 'fx_items')}, {TRACK}, {POINTS}, {HOURLY}, {HOURS}, {ALIGN_TARGETS},
      {three('aligned', 'wanted', 'hourly')} SELECT {shown} FROM aligned"""
    sql["interp_series"] = f"""{cte('fx_track')}, {TRACK}, {POINTS},
      wanted AS (SELECT storm, time + INTERVAL 25 MINUTE AS time FROM points), {interpolated('filled', 'wanted', 'points', 'wind')}
      SELECT storm, {text12('time')} AS time, {r6('v')} AS wind FROM filled"""
    d = """2 * 6371.0e0 * asin(sqrt(pow(sin((radians(p.lat) - radians(g.lat)) / 2), 2)
      + cos(radians(g.lat)) * cos(radians(p.lat)) * pow(sin((radians(p.lon) - radians(g.lon)) / 2), 2)))"""
    sql["storm_distance"] = f"""{cte('fx_track', 'fx_base', 'fx_items', 'fx_regions')}, {TRACK}, {HOURS}, {ONE_TRACK}, {GRID}
      SELECT nx, ny, strftime(time, '%Y%m%d') AS fcstDate, strftime(time, '%H%M') AS fcstTime,
        {r6(d)} AS TY_DISTANCE_KM, {r6('CASE WHEN p.lat IS NOT NULL THEN p.wind END')} AS TY_MAX_WIND,
        CASE WHEN p.lat IS NOT NULL THEN 0e0 END AS TY_WARNING
      FROM grid g, positions p"""
    sql["storm_latest_announcement"] = f"""{cte('fx_track')} SELECT storm,
      max(tmFc) FILTER (WHERE regexp_full_match(tmFc, '\\d{{12}}')) AS tmFc FROM fx_track GROUP BY storm"""
    sql["target_hours"] = f"""{cte('fx_base', 'fx_items')}, {HOURS} SELECT DISTINCT {text12("date_trunc('hour', ts)")} AS ts
      FROM (SELECT ts FROM hours ORDER BY ts DESC LIMIT 6)"""
    sql["storm_target_slots"] = f"""{cte('fx_base', 'fx_items')}, {HOURS} SELECT {text12('ts')} AS ts FROM (
      SELECT unnest(generate_series((SELECT max(ts) FROM hours) - INTERVAL 5 HOUR, (SELECT max(ts) FROM hours), INTERVAL 1 HOUR)) AS ts)"""
    sql["issue_time"] = f"WITH {ISSUE} SELECT event_id, strftime(base_ts, '%Y%m%d') AS baseDate, strftime(base_ts, '%H%M') AS baseTime FROM issue"
    sql["target_slots"] = f"""WITH {ISSUE}, slots AS (SELECT event_id, unnest(generate_series(s, s + INTERVAL 5 HOUR, INTERVAL 1 HOUR)) AS t
        FROM (SELECT event_id, greatest(base_ts + INTERVAL 1 HOUR, date_trunc('hour', ts)) AS s FROM issue))
      SELECT event_id, strftime(t, '%Y%m%d') AS fcstDate, strftime(t, '%H%M') AS fcstTime FROM slots"""
    slotted = f"{cte('fx_items_based', 'fx_poll')}, {NOW}, {POLL_SLOTS}"
    sql["target_slots_semi"] = f"""{slotted} SELECT * FROM fx_items_based
      WHERE (fcstDate, fcstTime) IN (SELECT fcstDate, fcstTime FROM primary_slots)"""
    sql["target_slots_fallback"] = f"""{slotted}, hits AS (SELECT * FROM fx_items_based
        WHERE (fcstDate, fcstTime) IN (SELECT fcstDate, fcstTime FROM primary_slots))
      SELECT * FROM hits UNION ALL SELECT * FROM fx_items_based
        WHERE (fcstDate, fcstTime) IN (SELECT fcstDate, fcstTime FROM other_slots) AND (nx, ny) NOT IN (SELECT nx, ny FROM hits)"""
    sql["latest_base_asof"] = f"""{cte('fx_items_based', 'fx_poll')}, {NOW},
      timed AS (SELECT *, {at('baseDate', 'baseTime')} AS b FROM fx_items_based WHERE baseTime LIKE '%00'),
      tries AS (SELECT timed.* FROM timed, now WHERE b BETWEEN date_trunc('hour', ts - INTERVAL 10 MINUTE) - INTERVAL 3 HOUR
        AND date_trunc('hour', ts - INTERVAL 10 MINUTE))
      SELECT nx, ny, baseDate, baseTime, seq, category, fcstValue FROM tries
      WHERE (nx, ny, b) IN (SELECT nx, ny, max(b) FROM tries GROUP BY nx, ny)"""
    sql["uv_offsets"] = f"""{cte('fx_uv_items')}, {UV_OFFSETS} SELECT admin_code, {text12('base_ts')} AS base_ts, "offset", value FROM uv_offsets"""
    sql["uv_asof_base"] = f"""{cte('fx_uv_items', 'fx_poll')}, {NOW}, {UV_OFFSETS}, {uv_based('(SELECT ts FROM now)')}
      SELECT admin_code, {text12('base_ts')} AS base_ts, "offset", value FROM based"""
    anchor = "(SELECT date_trunc('hour', ts) - INTERVAL 11 HOUR FROM now)"
    sql["uv_hourly"] = f"""{cte('fx_uv_items', 'fx_poll', 'fx_regions')}, {NOW}, {UV_OFFSETS}, {uv_based(anchor)},
      knots AS (SELECT admin_code, base_ts + to_hours("offset") AS time, value FROM based),
      wanted AS (SELECT admin_code, unnest(generate_series({anchor}, {anchor} + INTERVAL 11 HOUR, INTERVAL 1 HOUR)) AS time
        FROM (SELECT DISTINCT admin_code FROM based)),
      {interpolated('filled', 'wanted', 'knots', 'value', series='admin_code')}
      SELECT nx, ny, strftime(time, '%Y%m%d') AS fcstDate, strftime(time, '%H%M') AS fcstTime,
        CAST(greatest(CASE WHEN hour(time) BETWEEN 6 AND 20 THEN round_even(v, 0) ELSE 0 END, 0) AS INT) AS UVI
      FROM filled JOIN fx_regions USING (admin_code)"""
    sql["silver_build"] = f"{silver_cte()} SELECT * REPLACE ({r6s(*SCORES)}) FROM silver"
    sql["silver_build_bucketed"] = sql["silver_build"]
    sql["silver_backfill"] = backfill_sql()
    latest = f"admin_names, fcst_ts, dt, {r6s(*SCORES)}, risk_level"
    sql["gold_latest"] = gold_sql(f"SELECT {latest} FROM newest", NEWEST_REGION)
    daily = f"date, admin_names, {r6s('r_total_avg', 'r_total_max')}, obs_cnt, max_time"
    sql["gold_daily"] = gold_sql(f"SELECT {daily} FROM daily", DAILY)
    sql |= {"silver_written": sql["silver_build"], "gold_written": sql["gold_latest"], "gold_daily_written": sql["gold_daily"]}
    sql["export_latest"] = gold_sql(f"SELECT admin_names, fcst_ts, {r6s('R_total')}, risk_level FROM newest", NEWEST_REGION)
    sql["export_daily"] = sql["gold_daily"]
    sql["alert_rows"] = gold_sql(f"SELECT {latest} FROM newest WHERE R_total >= 0.6", NEWEST_REGION)
    sql["alert_lines"] = gold_sql(
        f"""SELECT 0 AS part, CASE WHEN count(*) FILTER (WHERE R_total >= 0.6) = 0 THEN '✅ *기상 위험 알림* | 현재 위험 지역 없음'
          ELSE '*🚨 기상 위험 지역 알림*' END AS line FROM newest
        UNION ALL SELECT 1, (CASE risk_level WHEN 'VERY_HIGH' THEN '🔴' WHEN 'HIGH' THEN '🟠' ELSE '⚠️' END) || ' *' || admin_names
          || '*  |  위험도: `' || printf('%.2f', floor({r6('R_total')} * 100 + 0.5) / 100) || '` (' || risk_level || ')  |  예보: '
          || strftime(fcst_ts, '%Y-%m-%d %H:%M:%S') FROM newest WHERE R_total >= 0.6""",
        NEWEST_REGION,
    )
    sql["run_summary"] = gold_sql(
        "SELECT count(*) FILTER (WHERE R_total >= 0.6) AS high_risk, count(*) AS total FROM newest", NEWEST_REGION
    )
    sql["feed_summary"] = f"""{cte('fx_ty')} SELECT count(*) AS n_rows, count(DISTINCT fcstTime) AS hours,
      min(fcstTime) AS first_time, max(fcstTime) AS last_time FROM fx_ty"""
    sql["geojson_features"] = gold_sql(
        f"""SELECT 'Feature' AS kind, 'Point' AS shape, {r6s('lon', 'lat')}, admin_code, admin_names, {r6s('R_total')}, T1H, fcstTime
        FROM newest JOIN fx_regions USING (nx, ny)""",
        NEWEST_REGION,
    )
    nowcast_columns = ("T1H", "RN1", "UUU", "VVV", "REH", "PTY", "VEC", "WSD")
    landed = f"{cte('fx_landed', 'fx_regions')}, {LANDED_ITEMS}"
    sql["bronze_nowcast"] = f"""{landed}, {newest_items('ultra_nowcast', "date_trunc('hour', now - INTERVAL 10 MINUTE)", nowcast_columns)}
      SELECT dt, nx, ny, baseDate, baseTime, {last_values(nowcast_columns)} FROM kept GROUP BY dt, nx, ny, baseDate, baseTime"""
    sql["bronze_ultra"] = f"""{landed}, {ULTRA_ITEMS}
      SELECT dt, {KEYS}, baseDate, baseTime, {last_values(ULTRA)} FROM kept GROUP BY dt, {KEYS}, baseDate, baseTime"""
    short_value = f"CASE WHEN category = 'PCP' THEN {mm_collector('value')} ELSE {number('value')} END"
    short_means = {c: f"avg(v) FILTER (WHERE category = '{c}')" for c in ("PCP", "POP", "PTY", "REH", "SKY", "TMP", "WSD")}
    sql["bronze_short_fcst"] = f"""{landed}, {CALLS}, shorts AS (
        SELECT *, {short_value} AS v, {at('fcstDate', 'fcstTime')} AS t, date_trunc('day', now) + INTERVAL 14 HOUR AS issued FROM items
        WHERE service = 'short_fcst' AND category IN ('POP', 'PCP', 'PTY', 'TMP', 'REH', 'WSD', 'SKY')),
      hits AS (SELECT * FROM shorts WHERE t BETWEEN now AND now + INTERVAL 5 HOUR),
      kept AS (SELECT * FROM hits UNION ALL SELECT * FROM shorts WHERE t BETWEEN issued + INTERVAL 1 HOUR AND issued + INTERVAL 6 HOUR
        AND (dt, nx, ny) NOT IN (SELECT (dt, nx, ny) FROM hits)),
      wide AS (SELECT dt, {KEYS}, CAST(epoch(any_value(t)) AS BIGINT) - 32400 AS valid_ts_kst,
        {", ".join(f"{r6(short_means[c])} AS {c}" for c in ("PCP", "POP", "REH", "TMP", "WSD"))},
        {", ".join(f"CAST(floor({short_means[c]}) AS INT) AS {c}" for c in ("PTY", "SKY"))}
        FROM kept WHERE v IS NOT NULL GROUP BY dt, {KEYS})
      SELECT CAST(c.admin_code AS BIGINT) AS admin_code, w.* FROM wide w LEFT JOIN calls c USING (nx, ny)"""
    sql["bronze_uv"] = f"""{landed}, {CALLS}, {ULTRA_ITEMS}, {RUN_HOURS},
      anchors AS (SELECT dt, min(ts) AS anchor FROM run_hours GROUP BY dt),
      uv_values AS (SELECT dt, area AS admin_code, seq, strptime(asked, '%Y%m%d%H') AS base_ts, 0 AS "offset", CAST(v1 AS DOUBLE) AS value FROM asked WHERE service = 'uv'
        UNION ALL SELECT dt, area, seq, strptime(asked, '%Y%m%d%H'), 3, CAST(v2 AS DOUBLE) FROM asked WHERE service = 'uv'),
      uv_offsets AS (SELECT dt, admin_code, base_ts, "offset", arg_max(value, seq) AS value FROM uv_values
        WHERE admin_code IN (SELECT admin_code FROM calls) GROUP BY ALL),
      inside AS (SELECT o.* FROM uv_offsets o JOIN anchors USING (dt) WHERE base_ts BETWEEN anchor - INTERVAL 48 HOUR AND anchor),
      based AS (SELECT * FROM inside WHERE (dt, admin_code, base_ts) IN (SELECT (dt, admin_code, max(base_ts)) FROM inside GROUP BY dt, admin_code)),
      knots AS (SELECT dt || admin_code AS storm, base_ts + to_hours("offset") AS time, value FROM based),
      wanted AS (SELECT DISTINCT dt || admin_code AS storm, ts AS time FROM based JOIN run_hours USING (dt)),
      {interpolated('filled', 'wanted', 'knots', 'value')}
      SELECT substring(storm, 1, 10) AS dt, nx, ny, strftime(time, '%Y%m%d') AS fcstDate, strftime(time, '%H%M') AS fcstTime,
        CAST(greatest(CASE WHEN hour(time) BETWEEN 6 AND 20 THEN round_even(v, 0) ELSE 0 END, 0) AS INT) AS UVI
      FROM filled JOIN calls ON calls.admin_code = substring(storm, 11)"""
    sql["bronze_storm"] = f"""{landed}, {ULTRA_ITEMS}, {RUN_HOURS}, {GRID},
      track AS (SELECT dt AS storm, seq, strptime(track_time, '%Y%m%d%H%M') AS time, lat, lon, wind FROM asked WHERE service = 'typhoon'),
      {POINTS}, {HOURLY},
      ends AS (SELECT dt AS storm, max(ts) AS e FROM run_hours GROUP BY dt),
      targets AS (SELECT storm, unnest(generate_series(e - INTERVAL 5 HOUR, e, INTERVAL 1 HOUR)) AS time FROM ends),
      {three('positions', 'targets', 'hourly')}
      SELECT storm AS dt, nx, ny, strftime(time, '%Y%m%d') AS fcstDate, strftime(time, '%H%M') AS fcstTime,
        {r6(d)} AS TY_DISTANCE_KM, {r6('CASE WHEN p.lat IS NOT NULL THEN p.wind END')} AS TY_MAX_WIND,
        CASE WHEN p.lat IS NOT NULL THEN 0e0 END AS TY_WARNING
      FROM grid g, positions p"""
    status = "CASE WHEN kind IN ('list', 'xml') THEN 'good' ELSE kind END"
    part = "CASE WHEN kind IN ('list', 'xml') THEN service WHEN kind = 'no_data' THEN 'no_data' ELSE 'quarantine' END"
    per_item = "CASE WHEN kind NOT IN ('list', 'xml') THEN 0 WHEN service IN ('uv', 'typhoon') THEN 1 ELSE 2 END"
    sql["bronze_counts"] = f"""{cte('fx_landed')} SELECT dt, {part} AS part, {status} AS status, count(*) AS responses,
      sum({per_item})::BIGINT AS items FROM fx_landed GROUP BY ALL"""
    sql["bronze_quarantine"] = f"""{cte('fx_landed')} SELECT seq, service, dt, kind AS status, text FROM fx_landed
      WHERE kind NOT IN ('list', 'xml', 'no_data')"""
    sql["bronze_to_gold"] = f"""{landed}, {ULTRA_ITEMS}, {LABELS},
      rows AS (SELECT DISTINCT dt, {KEYS}, admin_names FROM kept JOIN labels USING (nx, ny) WHERE admin_names IS NOT NULL)
      SELECT CAST(strptime(fcstDate, '%Y%m%d') AS DATE) AS date, count(DISTINCT admin_names) AS regions, count(*) AS rows FROM rows GROUP BY 1"""
    sql["stream_bronze_ingest"] = f"""{cte('fx_responses')}
      SELECT event_id, 0 AS pos, nx, ny, fcstDate, fcstTime, category, fcstValue, fcstDate || '05' AS dt FROM fx_responses WHERE kind IN ('single', 'list')
      UNION ALL SELECT event_id, 1, nx, ny, fcstDate, fcstTime, 'SKY', sky, fcstDate || '05' FROM fx_responses WHERE kind = 'list'"""
    sql["stream_restarted"] = f"SELECT dt, count(*) AS items FROM ({sql['stream_bronze_ingest']}) GROUP BY dt"
    sql["stream_quarantine"] = f"""{cte('fx_responses')} SELECT event_id, kind AS status, text FROM fx_responses
      WHERE kind IN ('error', 'not_json')"""
    sql["stream_dedupe_items"] = f"""{cte('fx_items')} SELECT * EXCLUDE (rk) FROM (
      SELECT {KEYS}, category, fcstValue, row_number() OVER (PARTITION BY {KEYS}, category ORDER BY seq DESC, fcstValue DESC) AS rk FROM fx_items) WHERE rk = 1"""
    sql["stream_daily_stats"] = f"""{cte('fx_base')}, silver AS (
        SELECT fcstDate, fcstTime, CAST(nx AS VARCHAR) || '-' || CAST(ny AS VARCHAR) AS admin_names, T1H / 40.0 AS R_total FROM fx_base),
      {DAILY} SELECT {daily} FROM daily"""
    sql["stream_append_newest"] = sql["stream_dedupe_items"]
    sql["stream_drop_repeats"] = f"{cte('fx_items')} SELECT DISTINCT {KEYS}, category FROM fx_items"
    sql["gold_daily_incremental"] = f"{backfill_sql().rsplit('SELECT * REPLACE', 1)[0].rstrip()}, {DAILY} SELECT {daily} FROM daily"
    sql["run_summary_observed"] = sql["run_summary"]
    sql["silver_box"] = f"""{silver_cte()} SELECT {KEYS}, {r6s('R_total')} FROM silver
      WHERE nx BETWEEN 44 AND 47 AND ny BETWEEN 60 AND 71 AND fcstDate BETWEEN '20250803' AND '20250809'"""
    sql["asof_polls"] = f"""{cte('fx_items_based')}, timed AS (SELECT *, {at('baseDate', 'baseTime')} AS base FROM fx_items_based),
      polls AS (SELECT seq AS poll, nx, ny, base + INTERVAL 10 MINUTE AS asked_at FROM timed WHERE baseTime LIKE '%30'),
      known AS (SELECT nx, ny, base, max(seq) AS seq, arg_max(fcstValue, seq) AS fcstValue FROM timed WHERE baseTime LIKE '%00' GROUP BY nx, ny, base),
      found AS (SELECT p.*, k.base, k.seq, k.fcstValue FROM polls p ASOF LEFT JOIN known k ON p.nx = k.nx AND p.ny = k.ny AND p.asked_at >= k.base)
      SELECT poll, nx, ny, CASE WHEN base >= asked_at - INTERVAL 2 HOUR THEN {text12('base')} END AS base_ts,
        CASE WHEN base >= asked_at - INTERVAL 2 HOUR THEN seq END AS seq, CASE WHEN base >= asked_at - INTERVAL 2 HOUR THEN fcstValue END AS fcstValue FROM found"""
    sql["latest_forecast_base"] = f"""{cte('fx_items_based', 'fx_poll')}, {NOW},
      timed AS (SELECT *, {at('baseDate', 'baseTime')} AS b FROM fx_items_based WHERE baseTime LIKE '%30'),
      newest AS (SELECT date_trunc('hour', ts - INTERVAL 45 MINUTE) + INTERVAL 30 MINUTE AS n FROM now),
      tries AS (SELECT timed.* FROM timed, newest WHERE b BETWEEN n - INTERVAL 3 HOUR AND n)
      SELECT nx, ny, baseDate, baseTime, seq, category, fcstValue FROM tries
      WHERE (nx, ny, b) IN (SELECT (nx, ny, max(b)) FROM tries GROUP BY nx, ny)"""
    good = "kind IN ('list', 'xml')"
    sql["xml_items"] = f"""{cte('fx_landed')} SELECT seq, CASE WHEN {good} THEN 'good' WHEN kind = 'quota' THEN 'quota' ELSE 'empty' END AS status,
      CASE WHEN {good} THEN v1 END AS h0, CASE WHEN {good} THEN v2 END AS h3 FROM fx_landed WHERE service = 'uv'"""
    sql["csv_dimension"] = f"""{cte('fx_regions')} SELECT admin_code, admin_name, {r6s('lat', 'lon')}, nx, CAST(NULL AS INT) AS ny,
      CAST(NULL AS VARCHAR) AS SIG_CD FROM fx_regions"""
    sql["short_fcst_unique"] = f"""{cte('fx_items', 'fx_regions')}, {CALLS}, items AS (SELECT *, {value} AS v FROM fx_items),
      wide AS (SELECT {KEYS}, CAST(epoch({at('fcstDate', 'fcstTime')}) AS BIGINT) - 32400 AS valid_ts_kst,
        {r6(means['PCP'])} AS PCP, {r6(means['POP'])} AS POP, CAST(floor({means['PTY']}) AS INT) AS PTY, {r6(means['REH'])} AS REH,
        CAST(NULL AS INT) AS SKY, {r6(means['TMP'])} AS TMP, {r6(means['WSD'])} AS WSD FROM items WHERE v IS NOT NULL GROUP BY {KEYS})
      SELECT CAST(c.admin_code AS BIGINT) AS admin_code, w.* FROM wide w LEFT JOIN calls c USING (nx, ny)"""
    sql["runs_due"] = f"{cte('fx_base_runs')} SELECT DISTINCT dt FROM fx_base_runs WHERE dt = '2025080106'"
    sql["feed_sorted"] = f"{cte('fx_base_runs')} SELECT dt, count(*) AS n_rows, CAST(0 AS BIGINT) AS inversions FROM fx_base_runs GROUP BY dt"
    return sql
