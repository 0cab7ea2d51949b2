"""The given tables, seen as forecast feeds.

One SQL text each, valid in Spark and DuckDB, so that a query and its SQL check
start from the same rows. Every text reads its whole table. Dates fall into
August 2025 so that keys repeat at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CELL = (
    "CAST(40 + l_suppkey % 20 AS int) AS nx, CAST(60 + floor(l_suppkey / 20) AS int) AS ny"
)
_SEQ = "CAST((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS bigint) AS seq"
_TIME = "lpad(CAST((l_linenumber * 3) % 24 AS string), 2, '0') || '00' AS fcstTime"
_RUN = (
    "CASE WHEN l_returnflag = 'A' THEN '2025080100' WHEN l_returnflag = 'N' THEN '2025080106' "
    "ELSE '2025080112' END AS dt"
)
_BASE_VALUES = """
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity * 8e-1 END AS T1H,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_discount * 1e3 END AS REH,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_tax * 375e0 END AS WSD,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice / 1500e0 ELSE 0e0 END AS RN1,
  l_discount * 100e0 AS UUU, l_tax * -100e0 AS VVV,
  CAST(1 + l_linenumber % 4 AS double) AS SKY"""
_STORM_VALUES = """
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice / 100e0 END AS TY_DISTANCE_KM,
  l_quantity AS TY_MAX_WIND, CASE WHEN l_linestatus = 'O' THEN 0e0 ELSE 1e0 END AS TY_WARNING"""

_EVENT_CELL = "CAST(40 + user_id % 20 AS int) AS nx, CAST(60 + floor(user_id / 20) AS int) AS ny"
_EVENT_SLOT = """CAST(20250800 + day(ts) AS string) AS fcstDate,
  lpad(CAST(CAST(floor(hour(ts) / 3) AS int) * 3 AS string), 2, '0') || '00' AS fcstTime"""
_CATEGORY = """CASE event_type WHEN 'signup' THEN 'TMP' WHEN 'error' THEN 'REH' WHEN 'click' THEN 'PCP'
    WHEN 'view' THEN 'WSD' ELSE 'PTY' END"""
_VALUE = """CASE WHEN event_type <> 'click' THEN CAST(CAST(floor(value) AS int) % 100 AS string)
    WHEN event_id % 6 = 0 THEN '강수없음' WHEN event_id % 6 = 1 THEN '1mm 미만'
    WHEN event_id % 6 = 2 THEN '10~20mm' WHEN event_id % 6 = 3 THEN '50mm 이상'
    WHEN event_id % 6 = 4 THEN '-' ELSE CAST(CAST(floor(value) AS int) % 60 AS string) || 'mm' END"""
_WHOLE = "CAST(CAST(floor(value) AS int) % 60 AS string)"

TABLES: dict[str, str] = {
    # Ultra-short forecast, the base feed.
    "fx_base": f"""
SELECT {_CELL}, CAST(20250800 + day(l_shipdate) AS string) AS fcstDate, {_TIME}, {_SEQ},{_BASE_VALUES}
FROM {{lineitem}}""",
    "fx_base_runs": f"""
SELECT {_CELL}, CAST(20250800 + day(l_shipdate) AS string) AS fcstDate, {_TIME}, {_RUN}, {_SEQ},{_BASE_VALUES}
FROM {{lineitem}}""",
    # Nowcast: only a base time.
    "fx_nc": f"""
SELECT {_CELL}, CAST(20250801 + (l_partkey * 7) % 31 AS string) AS baseDate,
  lpad(CAST((l_linenumber * 3) % 24 AS string), 2, '0') || '00' AS baseTime, {_SEQ},
  l_quantity * 9e-1 AS T1H, l_discount * 9e2 AS REH, l_tax * 300e0 AS WSD
FROM {{lineitem}}""",
    # Short-range forecast.
    "fx_vil": f"""
SELECT {_CELL}, CAST(20250801 + l_partkey % 31 AS string) AS fcstDate, {_TIME}, {_SEQ},
  CASE WHEN l_linestatus = 'O' THEN l_extendedprice / 3000e0 ELSE 0e0 END AS PCP,
  l_discount * 1e3 AS POP, l_tax * 200e0 AS WSD
FROM {{lineitem}}""",
    "fx_vil_runs": f"""
SELECT {_CELL}, CAST(20250801 + l_partkey % 31 AS string) AS fcstDate, {_TIME}, {_RUN}, {_SEQ},
  CASE WHEN l_linestatus = 'O' THEN l_extendedprice / 3000e0 ELSE 0e0 END AS PCP,
  l_discount * 1e3 AS POP, l_tax * 200e0 AS WSD
FROM {{lineitem}}""",
    # Storm; half of its hours are not in the base feed.
    "fx_ty": f"""
SELECT {_CELL}, CAST(20250801 + l_orderkey % 31 AS string) AS fcstDate,
  lpad(CAST((l_linenumber * 3 + l_partkey % 2) % 24 AS string), 2, '0') || '00' AS fcstTime, {_SEQ},{_STORM_VALUES}
FROM {{lineitem}}""",
    "fx_ty_runs": f"""
SELECT {_CELL}, CAST(20250801 + l_orderkey % 31 AS string) AS fcstDate,
  lpad(CAST((l_linenumber * 3 + l_partkey % 2) % 24 AS string), 2, '0') || '00' AS fcstTime, {_RUN}, {_SEQ},{_STORM_VALUES}
FROM {{lineitem}}""",
    # UV index; only every sixth hour.
    "fx_uv": f"""
SELECT {_CELL}, CAST(20250801 + (l_orderkey + l_partkey) % 31 AS string) AS fcstDate,
  lpad(CAST((l_linenumber * 6) % 24 AS string), 2, '0') || '00' AS fcstTime, {_SEQ},
  l_discount * 120e0 AS UVI
FROM {{lineitem}}""",
    # Feed as it comes, before canonical keys.
    "fx_raw_wide": f"""
SELECT CAST(40 + l_suppkey % 20 AS string) AS nx, CAST(60 + floor(l_suppkey / 20) AS bigint) AS ny,
  substring(CAST(20250800 + day(l_shipdate) AS string), 1, 4) || '-' || substring(CAST(20250800 + day(l_shipdate) AS string), 5, 2)
    || '-' || substring(CAST(20250800 + day(l_shipdate) AS string), 7, 2) AS fcstDate,
  CAST((l_linenumber * 3) % 24 AS string) || ':00' AS fcstTime,
  CAST(20250731 AS int) AS baseDate, CAST(l_linenumber * 100 + 30 AS int) AS baseTime,
  CAST(l_quantity AS string) AS T1H,
  CASE WHEN l_orderkey % 5 = 0 THEN '강수없음' WHEN l_orderkey % 5 = 1 THEN '1mm 미만'
    ELSE CAST(l_linenumber AS string) END AS RN1,
  l_tax * 375e0 AS WSD, {_SEQ}
FROM {{lineitem}}""",
    # Scored by run from columns of all kinds.
    "fx_score": f"""
SELECT {_RUN}, {_SEQ}, CAST(20250800 + day(l_shipdate) AS string) AS fcstDate, {_TIME},
  CASE WHEN l_returnflag = 'A' OR l_orderkey % 17 = 0 THEN NULL ELSE l_quantity * 8e-1 END AS T1H,
  CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_quantity * 7e-1 + 2e0 END AS TMP,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_discount * 1e3 END AS REH,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_tax * 375e0 END AS WSD,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_tax * 200e0 + l_discount * 50e0 END AS WSD_vil,
  l_discount * 100e0 AS UUU, l_tax * -100e0 AS VVV,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(1 + l_linenumber % 4 AS double) END AS SKY,
  CASE l_linenumber WHEN 1 THEN '강수없음' WHEN 2 THEN '1mm 미만' WHEN 3 THEN CAST(l_partkey % 90 AS string) || '.5mm'
    WHEN 4 THEN '30.0~50.0mm' WHEN 5 THEN NULL WHEN 6 THEN '50mm 이상' ELSE CAST(l_partkey % 30 AS string) END AS RN1,
  l_extendedprice / 3000e0 AS PCP, l_discount * 1e3 AS POP,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_discount * 120e0 END AS UVI,{_STORM_VALUES}
FROM {{lineitem}}""",
    # Items: one row per cell, hour and category.
    "fx_items": f"""
SELECT CAST(40 + user_id % 20 AS int) AS nx, CAST(60 AS int) AS ny, {_EVENT_SLOT},
  event_id AS seq, {_CATEGORY} AS category, {_VALUE} AS fcstValue
FROM {{events}}""",
    # The same over as many cells as there are users, with base times.
    "fx_items_based": f"""
SELECT {_EVENT_CELL}, {_EVENT_SLOT}, CAST(20250800 + day(ts) AS string) AS baseDate,
  lpad(CAST(hour(ts) AS string), 2, '0') || CASE WHEN event_id % 2 = 0 THEN '00' ELSE '30' END AS baseTime,
  event_id AS seq, {_CATEGORY} AS category, {_VALUE} AS fcstValue
FROM {{events}}""",
    # A poll late on the 15th, as text.
    "fx_poll": """
SELECT '20250815' || lpad(CAST(max(hour(ts)) - 1 AS string), 2, '0') || '10' AS now_text FROM {events}""",
    # Responses as landed: lists, single objects, no data, refusals, and no JSON.
    "fx_responses": f"""
SELECT event_id, nx, ny, kind, fcstDate, fcstTime, category, fcstValue, sky,
  CASE kind
    WHEN 'not_json' THEN '<html>busy</html>'
    WHEN 'no_data' THEN '{{{{"response":{{{{"header":{{{{"resultCode":"03","resultMsg":"NO_DATA"}}}}}}}}}}}}'
    WHEN 'error' THEN '{{{{"response":{{{{"header":{{{{"resultCode":"22","resultMsg":"LIMIT"}}}}}}}}}}}}'
    WHEN 'single' THEN '{{{{"response":{{{{"header":{{{{"resultCode":"00","resultMsg":"NORMAL_SERVICE"}}}},"body":{{{{"items":{{{{"item":'
      || first_item || '}}}}}}}}}}}}}}}}'
    ELSE '{{{{"response":{{{{"header":{{{{"resultCode":"00","resultMsg":"NORMAL_SERVICE"}}}},"body":{{{{"items":{{{{"item":['
      || first_item || ',' || second_item || ']}}}}}}}}}}}}}}}}' END AS text
FROM (
  SELECT event_id, nx, ny, kind, fcstDate, fcstTime, category, fcstValue, sky,
    '{{{{"baseDate":"' || fcstDate || '","baseTime":"0500","category":"' || category || '","fcstDate":"' || fcstDate
      || '","fcstTime":"' || fcstTime || '","fcstValue":"' || fcstValue || '","nx":' || CAST(nx AS string)
      || ',"ny":' || CAST(ny AS string) || '}}}}' AS first_item,
    '{{{{"baseDate":"' || fcstDate || '","baseTime":"0500","category":"SKY","fcstDate":"' || fcstDate
      || '","fcstTime":"' || fcstTime || '","fcstValue":' || sky || '}}}}' AS second_item
  FROM (
    SELECT event_id, {_EVENT_CELL}, {_EVENT_SLOT}, {_CATEGORY} AS category, {_VALUE} AS fcstValue,
      CAST(1 + event_id % 4 AS string) AS sky,
      CASE WHEN event_id % 20 = 2 THEN 'not_json' WHEN event_id % 15 = 1 THEN 'no_data'
        WHEN event_id % 25 = 3 THEN 'error' WHEN event_id % 10 = 0 THEN 'single' ELSE 'list' END AS kind
    FROM {{events}}
  ) a
) b""",
    # Responses of all services as landed by three polls.
    "fx_landed": f"""
SELECT seq, service, dt, nx, ny, area, asked, kind, day, base_time, fcst_time, c1, v1, c2, v2, track_time, lat, lon, wind,
  CASE kind WHEN 'not_json' THEN 'busy'
    WHEN 'quota' THEN '<r><cmmMsgHeader><returnAuthMsg>LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR</returnAuthMsg></cmmMsgHeader></r>'
    WHEN 'xml' THEN '<response><header><resultCode>00</resultCode></header><body><items><item><h0>' || v1 || '</h0><h3>' || v2
      || '</h3></item></items></body></response>'
    ELSE replace(replace(CASE kind
      WHEN 'no_data' THEN '«"response":«"header":«"resultCode":"03","resultMsg":"NO_DATA"»»»'
      WHEN 'error' THEN '«"response":«"header":«"resultCode":"22","resultMsg":"LIMIT"»»»'
      ELSE '«"response":«"header":«"resultCode":"00","resultMsg":"NORMAL_SERVICE"»,"body":«"items":«"item":' || items || '»»»»'
      END, '«', '{{{{'), '»', '}}}}') END AS text
FROM (
  SELECT *, CASE service
    WHEN 'uv' THEN '«"code":"A07","h0":"' || v1 || '","h3":"' || v2 || '"»'
    WHEN 'typhoon' THEN '[«"typTm":"' || track_time || '","typLat":"' || CAST(lat AS string) || '","typLon":"' || CAST(lon AS string)
      || '","typWs":"' || CAST(wind AS string) || '"»]'
    ELSE '[«"baseDate":"' || day || '","baseTime":"' || base_time || '","category":"' || c1 || '","nx":' || CAST(nx AS string)
      || ',"ny":' || CAST(ny AS string) || CASE WHEN service = 'ultra_nowcast' THEN ',"obsrValue":"' || v1
        ELSE ',"fcstDate":"' || day || '","fcstTime":"' || fcst_time || '","fcstValue":"' || v1 END
      || '"»,«"baseDate":"' || day || '","baseTime":"' || base_time || '","category":"' || c2
      || CASE WHEN service = 'ultra_nowcast' THEN '","obsrValue":"' || v2
        ELSE '","fcstDate":"' || day || '","fcstTime":"' || fcst_time || '","fcstValue":"' || v2 END || '"»]' END AS items
  FROM (
    SELECT *, CASE service WHEN 'ultra_nowcast' THEN lpad(CAST(16 - k % 6 AS string), 2, '0') || '00'
        WHEN 'ultra_shortfcst' THEN lpad(CAST(16 - k % 6 AS string), 2, '0') || '30' ELSE '1400' END AS base_time,
      lpad(CAST(14 + CAST(floor(seq / 7) AS int) % 9 AS string), 2, '0') || '00' AS fcst_time,
      CASE WHEN service = 'uv' THEN CAST(seq % 11 AS string) WHEN c1 <> 'PCP' THEN CAST(seq % 50 AS string)
        WHEN seq % 4 = 0 THEN '강수없음' WHEN seq % 4 = 1 THEN '1mm 미만' ELSE CAST(seq % 30 AS string) || '.5mm' END AS v1,
      CASE WHEN service = 'uv' THEN CAST(seq % 7 AS string) ELSE CAST(1 + seq % 4 AS string) END AS v2,
      day || lpad(CAST(CAST(floor(seq / 11) AS int) % 24 AS string), 2, '0') || '20' AS track_time,
      20e0 + (seq % 200) * 5e-2 AS lat, 130e0 - (seq % 90) * 1e-1 AS lon, CAST(15 + seq % 30 AS double) AS wind,
      CASE WHEN seq % 20 = 2 THEN CASE WHEN service = 'uv' THEN 'quota' ELSE 'not_json' END WHEN seq % 15 = 1 THEN 'no_data'
        WHEN seq % 25 = 3 THEN 'error' WHEN service = 'uv' AND seq % 2 = 0 THEN 'xml' ELSE 'list' END AS kind,
      CASE service WHEN 'uv' THEN CAST(20250800 + day_number + CAST(floor((16 - k % 60) / 24) AS int) AS string)
        || lpad(CAST(((16 - k % 60) % 24 + 24) % 24 AS string), 2, '0') END AS asked
    FROM (
      SELECT event_id AS seq, CAST(40 + user_id % 20 AS int) AS nx, CAST(60 + CAST(floor(user_id / 20) AS int) % 3 AS int) AS ny,
        lpad(CAST(1 + user_id % 200 AS string), 10, '0') AS area, CAST(floor(event_id / 15) AS int) AS k,
        CAST(5 + (event_id % 3) * 10 AS int) AS day_number, CAST(20250805 + (event_id % 3) * 10 AS string) AS day,
        CAST(20250805 + (event_id % 3) * 10 AS string) || '16' AS dt,
        CASE CAST(floor(event_id / 3) AS int) % 5 WHEN 0 THEN 'ultra_nowcast' WHEN 1 THEN 'ultra_shortfcst' WHEN 2 THEN 'short_fcst'
          WHEN 3 THEN 'typhoon' ELSE 'uv' END AS service,
        CASE CAST(floor(event_id / 45) AS int) % 8 WHEN 0 THEN 'T1H' WHEN 1 THEN 'RN1' WHEN 2 THEN 'REH' WHEN 3 THEN 'WSD'
          WHEN 4 THEN 'PTY' WHEN 5 THEN 'PCP' WHEN 6 THEN 'TMP' ELSE 'UUU' END AS c1,
        CASE CAST(floor(event_id / 45) AS int) % 3 WHEN 0 THEN 'SKY' WHEN 1 THEN 'POP' ELSE 'VEC' END AS c2
      FROM {{events}}
    ) a
  ) b
) c""",
    # Amounts as text, in every dialect.
    "fx_amounts": f"""
SELECT event_id, CASE event_id % 18
  WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '-' WHEN 3 THEN '강수없음' WHEN 4 THEN '적설없음'
  WHEN 5 THEN {_WHOLE} || '.5mm' WHEN 6 THEN {_WHOLE} || '.0' WHEN 7 THEN '1mm 미만'
  WHEN 8 THEN {_WHOLE} || '.0mm미만' WHEN 9 THEN '0.1mm 미만' WHEN 10 THEN {_WHOLE} || '~70mm'
  WHEN 11 THEN {_WHOLE} || 'mm 이상' WHEN 12 THEN {_WHOLE} || '-20mm' WHEN 13 THEN '<1mm'
  WHEN 14 THEN '-' || {_WHOLE} WHEN 15 THEN {_WHOLE} || '.0㎜' WHEN 16 THEN ' ' || {_WHOLE} || ' mm '
  ELSE {_WHOLE} || '.0~90.0mm' END AS txt
FROM {{events}}""",
    # Regions with their points.
    "fx_regions": """
SELECT lpad(CAST(c_custkey AS string), 10, '0') AS admin_code,
  c_mktsegment || '-' || CAST(c_nationkey AS string) AS admin_name,
  33e0 + (c_custkey % 97) * 55e-3 AS lat, 125e0 + (c_custkey % 89) * 6e-2 AS lon,
  CAST(40 + (c_custkey % 1000) % 20 AS int) AS nx, CAST(60 + floor((c_custkey % 1000) / 20) AS int) AS ny
FROM {customer}""",
    # Points of regions, with repeated codes and some without a place.
    "fx_points": """
SELECT lpad(CAST(CAST(floor(c_custkey / 3) AS bigint) AS string), 10, '0') AS admin_code,
  c_mktsegment || '-' || CAST(c_nationkey AS string) AS admin_name,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 33e0 + (c_custkey % 97) * 55e-3 END AS lat,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 125e0 + (c_custkey % 89) * 6e-2 END AS lon
FROM {customer}""",
    # A region map and a call list with other column names.
    "fx_region_map": """
SELECT CAST(40 + (c_custkey % 1000) % 20 AS string) AS NX,
  CASE WHEN c_custkey % 31 = 0 THEN 'none' ELSE CAST(60 + CAST(floor((c_custkey % 1000) / 20) AS int) AS string) END AS NY,
  '  ' || c_mktsegment || ' ' AS Name, c_acctbal
FROM {customer}""",
    "fx_calls": """
SELECT CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE ' ' || lpad(CAST(c_custkey AS string), 10, '0') || '  ' END AS areaNo,
  CAST(40 + (c_custkey % 1000) % 20 AS string) AS nx, CAST(60 + floor((c_custkey % 1000) / 20) AS double) AS ny
FROM {customer}""",
    # Storm track items; minutes past the hour, several announcements per time.
    "fx_track": """
SELECT CAST(user_id AS bigint) AS storm, event_id AS seq,
  CAST(20250800 + day(ts) AS string) || lpad(CAST(CAST(floor(hour(ts) / 3) AS int) * 3 AS string), 2, '0')
    || CASE WHEN event_id % 50 = 7 THEN 'xx' ELSE '20' END AS typTm,
  CASE WHEN event_id % 40 = 9 THEN NULL ELSE CAST(20e0 + day(ts) * 5e-1 + (event_id % 10) * 1e-2 AS string) END AS typLat,
  130e0 - day(ts) * 2e-1 AS lon, 135e0 AS longitude,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 15e0 + event_id % 30 END AS typWs,
  CASE WHEN event_id % 3 = 0 THEN CAST(20250800 + day(ts) AS string)
    ELSE CAST(20250800 + day(ts) AS string) || lpad(CAST(hour(ts) AS string), 2, '0') || '00' END AS tmFc
FROM {events}""",
    # UV items: index text by offset, or a single value.
    "fx_uv_items": """
SELECT lpad(CAST(user_id AS string), 10, '0') AS admin_code, event_id AS seq,
  CAST(20250800 + day(ts) AS string) || lpad(CAST(hour(ts) AS string), 2, '0') || '00' AS base_text,
  CAST(CAST(floor(value) AS int) % 10 AS string) AS v0, CAST(CAST(floor(value) AS int) % 10 + 1 AS string) AS v3,
  CAST(CAST(floor(value) AS int) % 10 + 2 AS string) AS v6, event_type AS kind
FROM {events}""",
}


class Tables:
    """The given tables of one scale, and the feeds made of them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        text = TABLES[name]
        used = {t: self.given(t) for t in ("lineitem", "events", "customer") if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def cte(*names: str) -> str:
    """The same feeds as the start of a DuckDB query."""
    given = {t: t for t in ("lineitem", "events", "customer")}
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n].format(**given)})" for n in names)
