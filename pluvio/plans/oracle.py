"""DuckDB SQL for each query key, over the driver's tables (views named after
the tables). Written as plain SQL from the query semantics, independently of the
Spark code; float outputs rounded to 4 places like the Spark side."""
from __future__ import annotations

DEVICES = ("click", "error", "purchase", "signup", "view")
HAZARDS = ("Flood", "Slope-failure", "Wind-Storm")
PUBLISHED = HAZARDS + ("Fire", "Infrastructure", "Lightning ")
MEASURES = ("number_of_incidents", "affected_hhs", "affected_individuals", "casualties_ind", "missing_ind",
            "injured_ind", "displaced_hh", "displaced_ind", "partially_damaged_shelters",
            "totally_damaged_shelters", "damaged_waterpoints", "damaged_latrines", "damaged_health_facilities",
            "damaged_food_distribution_site")
TOTALLED = tuple(m for m in MEASURES if m not in ("casualties_ind", "missing_ind", "injured_ind"))
STATION_NUMBERS = [f"st{p}_{m}" for p in "ab" for m in ("temp_out", "hi_temp", "low_temp", "wind_speed", "bar", "rain",
                                                        "rain_rate", "hi_speed")] + ["stb_hi_solar_rad", "stb_uv_index"]
ANOMALY = "Value suspected to be anomalous; removed"
RESET = "Value anomalous; removed."
GAP = "There is gap in previous data"


def r4(expr, name):
    return f'round({expr}, 4) AS "{name}"'


def inlist(vals):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


READINGS = """readings AS (
  SELECT event_type AS device, ts, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value
  FROM events)"""

# A mean is that of the exact sum of the readings, so it doesn't depend on their order: what
# the engine's average leaves over, in steps of 2^-64, is put right.
def _steps(v):
    whole, part = f"trunc({v})", f"({v} - trunc({v})) * 4294967296"
    return (f"(CAST({whole} AS HUGEINT) * 18446744073709551616::HUGEINT + CAST(trunc({part}) AS HUGEINT) * 4294967296::HUGEINT"
            f" + CAST(trunc(({part} - trunc({part})) * 4294967296) AS HUGEINT))")


def _summed(v, i):
    return f"avg({v}) AS q{i}, count({v}) AS n{i}, sum({_steps(f'({v})')}) AS w{i}"


def _mean(i):
    return f"q{i} + CAST(w{i} - n{i} * {_steps(f'q{i}')} AS DOUBLE) / 18446744073709551616.0 / n{i}"


_MASKED = "CASE WHEN anom THEN NULL ELSE value END"


BUCKET = READINGS + f""",
b0 AS (SELECT device, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, {_summed('value', 1)}
       FROM readings WHERE ts IS NOT NULL GROUP BY 1, 2),
b AS (SELECT device, slot, {_mean(1)} AS value FROM b0),
c AS (SELECT device, slot, value, value - lag(value) OVER (PARTITION BY device ORDER BY slot) AS raw_interval
      FROM b),
c2 AS (SELECT *, CASE WHEN raw_interval < 0 THEN 0.0 ELSE raw_interval END AS interval FROM c),
grid AS (SELECT d.device, s.slot FROM (SELECT DISTINCT device FROM b) d,
         (SELECT unnest(generate_series(min(slot), max(slot), INTERVAL 15 MINUTE)) AS slot FROM b) s)"""

# the pipeline's slot table: raw mean, masked mean, anomaly flag in one aggregation
GRIDDED = READINGS + f""",
ra AS (SELECT *, CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06') AND (value > 100 OR value < 1) AS anom
       FROM readings WHERE ts IS NOT NULL),
slots0 AS (SELECT device, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, {_summed('value', 1)}, {_summed(_MASKED, 2)},
                  min(CASE WHEN anom THEN '{ANOMALY}' END) AS anomaly
           FROM ra GROUP BY 1, 2),
slots AS (SELECT device, slot, {_mean(1)} AS accumulated, {_mean(2)} AS value, anomaly FROM slots0),
dif AS (SELECT *, value - lag(value) OVER (PARTITION BY device ORDER BY slot) AS raw_interval FROM slots),
dif2 AS (SELECT *, CASE WHEN raw_interval < 0 THEN 0.0 ELSE raw_interval END AS interval FROM dif),
grid AS (SELECT d.device, s.slot FROM (SELECT DISTINCT device FROM slots) d,
         (SELECT unnest(generate_series(min(slot), max(slot), INTERVAL 15 MINUTE)) AS slot FROM slots) s),
g AS (SELECT grid.device, grid.slot, CAST(grid.slot AS DATE) AS date, accumulated, value, anomaly,
             interval, raw_interval
      FROM grid LEFT JOIN dif2 USING (device, slot)),
gd AS (SELECT * FROM g WHERE slot < (SELECT max(CAST(slot AS DATE)) FROM g)),
rl AS (SELECT *, CASE WHEN count(*) OVER w = 12 THEN coalesce(sum(interval) OVER w, 0) END AS max_3_hour
       FROM gd WINDOW w AS (PARTITION BY device, date ORDER BY slot ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
daily AS (SELECT date, device, sum(interval) AS interval,
                 CASE WHEN sum(interval) IS NOT NULL THEN max(max_3_hour) END AS max_3_hr_interval
          FROM rl GROUP BY 1, 2),
hourly AS (SELECT device, date_trunc('hour', slot) AS datehour, sum(interval) AS precipitation
           FROM rl GROUP BY 1, 2)"""


def _strict(m, h):
    f = f"FILTER (WHERE type_of_incident = '{h}')"
    return (f"coalesce(CASE WHEN count(*) {f} = count({m}) {f} THEN sum({m}) {f} END, 0.0)"
            f' AS "{m}_{h}"')


INCIDENTS = f"""inc_raw AS (
  SELECT strftime(DATE '2024-01-01' + CAST(o_orderkey % 36 AS INTEGER) + 2, '%d/%m/%Y') AS date_of_assessment,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE strftime(DATE '2024-01-01' + CAST(o_orderkey % 36 AS INTEGER), '%d/%m/%Y') END AS date_of_incident,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS incident,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Flood' WHEN '2-HIGH' THEN 'Slope-failure'
              WHEN '3-MEDIUM' THEN 'Wind-Storm' WHEN '4-NOT SPECIFIED' THEN 'Fire'
              WHEN '5-LOW' THEN 'Infrastructure' END AS type_of_incident,
         1.0::DOUBLE AS number_of_incidents,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS affected_hhs,
         l_quantity * 5.0 AS affected_individuals,
         CAST(l_linenumber % 3 AS DOUBLE) AS casualties_ind,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber % 2 AS DOUBLE) END AS missing_ind,
         CAST(l_linenumber % 4 AS DOUBLE) AS injured_ind, l_quantity - 1.0 AS displaced_hh,
         CASE WHEN o_orderkey % 19 <> 0 THEN l_quantity * 2.0 END AS displaced_ind,
         CAST(l_linenumber * 2 AS DOUBLE) AS partially_damaged_shelters,
         CASE WHEN o_orderkey % 23 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS totally_damaged_shelters,
         CAST(l_linenumber - 1 AS DOUBLE) AS damaged_waterpoints, CAST(l_partkey % 5 AS DOUBLE) AS damaged_latrines,
         CAST(l_suppkey % 3 AS DOUBLE) AS damaged_health_facilities,
         CAST(l_partkey % 2 AS DOUBLE) AS damaged_food_distribution_site,
         'block ' || CAST(l_linenumber AS VARCHAR) AS camp_other,
         'Camp ' || CAST(o_custkey % 25 AS VARCHAR) AS camp,
         l_extendedprice / 10000.0 AS gps_log, l_tax AS gps_lat,
         CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid,
         'org' || CAST(l_suppkey AS VARCHAR) AS organization
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
inc AS (
  SELECT * REPLACE (
           CAST(try_strptime(date_of_assessment, '%d/%m/%Y') AS DATE) AS date_of_assessment,
           coalesce(CAST(try_strptime(date_of_incident, '%d/%m/%Y') AS DATE),
                    CAST(try_strptime(date_of_assessment, '%d/%m/%Y') AS DATE)) AS date_of_incident)
  FROM inc_raw),
ip AS (
  SELECT date_of_incident AS date, {", ".join(_strict(m, h) for m in MEASURES for h in HAZARDS)}
  FROM inc WHERE incident = 'Yes' AND type_of_incident IN ({inlist(HAZARDS)}) AND date_of_incident IS NOT NULL
  GROUP BY 1),
cut AS (SELECT max(date_of_incident) AS m FROM inc
        WHERE incident = 'Yes' AND type_of_incident IN ({inlist(PUBLISHED)}))"""


def _totals(src="x"):
    out = []
    for m in TOTALLED:
        cols = [f'"{m}_{h}"' for h in HAZARDS]
        allnull = " AND ".join(f"{c} IS NULL" for c in cols)
        s = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
        out.append(f"CASE WHEN {allnull} THEN NULL ELSE {s} END AS total_{m}")
    return ", ".join(out)


def _station(parity, p):
    return f"""st{p}_raw AS (
  SELECT date_trunc('hour', ts) AS hour, avg(value) AS temp_out, max(value) AS hi, min(value) AS low_temp,
         count(*) AS n, 'dir ' || CAST(min(user_id % 16) AS VARCHAR) AS wind_dir,
         CAST(max(event_id) % 40 AS DOUBLE) AS hi_speed, 'dir ' || CAST(max(user_id % 16) AS VARCHAR) AS hi_dir,
         max(value) * 2.0 AS hi_solar_rad, min(value) / 50.0 AS uv_index, avg(user_id) AS bar, sum(value) / 100.0 AS rain,
         max(value) / 100.0 AS rain_rate
  FROM events WHERE user_id % 2 = {parity} GROUP BY 1),
st{p} AS (
  SELECT hour AS time_date, temp_out AS st{p}_temp_out, CASE WHEN n < 3 THEN NULL ELSE hi END AS st{p}_hi_temp,
         low_temp AS st{p}_low_temp, CAST(n AS DOUBLE) AS st{p}_wind_speed, wind_dir AS st{p}_wind_dir,
         CASE WHEN n < 2 THEN NULL ELSE bar END AS st{p}_bar, rain AS st{p}_rain, rain_rate AS st{p}_rain_rate,
         hi_speed AS st{p}_hi_speed, hi_dir AS st{p}_hi_dir{", hi_solar_rad AS stb_hi_solar_rad, uv_index AS stb_uv_index" if p == "b" else ""}
  FROM st{p}_raw WHERE hour <= (SELECT m FROM cut))"""


STATIONS = INCIDENTS + ",\n" + _station(0, "a") + ",\n" + _station(1, "b")

DAILY_WEATHER = STATIONS + """,
dw AS (
  SELECT CAST(time_date AS DATE) AS date,
         round(max(sta_hi_temp), 2) AS sta_hi_temp, round(max(stb_hi_temp), 2) AS stb_hi_temp,
         round(max(sta_hi_speed), 2) AS sta_hi_speed, round(max(stb_hi_speed), 2) AS stb_hi_speed,
         round(max(stb_hi_solar_rad), 2) AS stb_hi_solar_rad,
         round(CAST(sum(CAST(stb_uv_index AS DECIMAL(38,9))) AS DOUBLE) / count(stb_uv_index), 2) AS stb_uv_index,
         round(min(sta_low_temp), 2) AS sta_low_temp, round(min(stb_low_temp), 2) AS stb_low_temp,
         CAST(round(coalesce(sum(CAST(sta_rain AS DECIMAL(38,9))), 0), 2) AS DOUBLE) AS sta_rain, CAST(round(coalesce(sum(CAST(sta_rain_rate AS DECIMAL(38,9))), 0), 2) AS DOUBLE) AS sta_rain_rate,
         CAST(round(coalesce(sum(CAST(stb_rain AS DECIMAL(38,9))), 0), 2) AS DOUBLE) AS stb_rain, CAST(round(coalesce(sum(CAST(stb_rain_rate AS DECIMAL(38,9))), 0), 2) AS DOUBLE) AS stb_rain_rate,
         round(CAST(sum(CAST(sta_temp_out AS DECIMAL(38,9))) AS DOUBLE) / count(sta_temp_out), 2) AS sta_temp_out, round(CAST(sum(CAST(sta_wind_speed AS DECIMAL(38,9))) AS DOUBLE) / count(sta_wind_speed), 2) AS sta_wind_speed,
         round(CAST(sum(CAST(stb_temp_out AS DECIMAL(38,9))) AS DOUBLE) / count(stb_temp_out), 2) AS stb_temp_out, round(CAST(sum(CAST(stb_wind_speed AS DECIMAL(38,9))) AS DOUBLE) / count(stb_wind_speed), 2) AS stb_wind_speed,
         round(CAST(sum(CAST(stb_bar AS DECIMAL(38,9))) AS DOUBLE) / count(stb_bar), 2) AS stb_bar
  FROM sta LEFT JOIN stb USING (time_date) GROUP BY 1)"""


def _station_flag(ts, probe):
    return (f"CASE WHEN {ts} < DATE '2024-01-08' AND {probe} IS NULL THEN '-' "
            f"WHEN {ts} > DATE '2024-01-22' AND {probe} IS NULL THEN 'Data were not collected due to COVID 19' "
            f"WHEN {probe} IS NULL THEN 'missing' END")


HOURLY_TABLE = GRIDDED + ",\n" + STATIONS + f""",
hw AS (SELECT datehour, {", ".join(f"max(precipitation) FILTER (WHERE device = '{d}') AS precip_{d}" for d in DEVICES)}
       FROM hourly GROUP BY 1),
ht AS (SELECT hw.*, sta.* EXCLUDE (time_date), stb.* EXCLUDE (time_date),
              {_station_flag("datehour", "sta_low_temp")} AS quality_sta,
              {_station_flag("datehour", "stb_hi_temp")} AS quality_stb
       FROM hw LEFT JOIN sta ON hw.datehour = sta.time_date LEFT JOIN stb ON hw.datehour = stb.time_date)"""

GEO = """pts AS (SELECT vec_id AS point_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
                CAST(label AS VARCHAR) AS camp FROM embeddings),
x0 AS (SELECT r_name AS name, -0.4::DOUBLE + 0.16::DOUBLE * r_regionkey AS x0 FROM region),
corners(ring, seq, dx, y) AS (
  VALUES (0, 0, 0.0::DOUBLE, -0.3::DOUBLE), (0, 1, 0.2::DOUBLE, -0.25::DOUBLE), (0, 2, 0.22::DOUBLE, 0.3::DOUBLE), (0, 3, -0.02::DOUBLE, 0.25::DOUBLE),
          (1, 0, 0.06::DOUBLE, -0.05::DOUBLE), (1, 1, 0.12::DOUBLE, -0.05::DOUBLE), (1, 2, 0.12::DOUBLE, 0.06::DOUBLE), (1, 3, 0.06::DOUBLE, 0.05::DOUBLE),
          (2, 0, 0.01::DOUBLE, 0.31::DOUBLE), (2, 1, 0.1::DOUBLE, 0.31::DOUBLE), (2, 2, 0.1::DOUBLE, 0.39::DOUBLE), (2, 3, 0.01::DOUBLE, 0.38::DOUBLE)),
verts AS (SELECT name, ring, seq, x0 + dx AS x, y FROM x0, corners),
edges AS (SELECT a.name, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by
          FROM verts a JOIN verts b ON a.name = b.name AND a.ring = b.ring AND b.seq = (a.seq + 1) % 4),
inside AS (SELECT p.point_id, e.name FROM pts p, edges e GROUP BY 1, 2
           HAVING sum(CASE WHEN ((e.ay > p.y) <> (e.by > p.y))
                            AND p.x < (e.bx - e.ax) * (p.y - e.ay) / (e.by - e.ay) + e.ax
                           THEN 1 ELSE 0 END) % 2 = 1),
cmap AS (SELECT CAST(r_regionkey AS VARCHAR) AS old_name, r_name AS new_name FROM region)"""

OFFICIAL = """off_raw AS (
  SELECT o_orderkey AS row_id,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END AS date,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price,
         o_orderkey % 10 = 0 AS trace
  FROM orders),
off1 AS (SELECT *, TRY_CAST(substr(date, 1, 2) AS DOUBLE) AS first2 FROM off_raw),
off2 AS (SELECT *, CASE WHEN first2 > 12 THEN substr(date, 1, 2) WHEN NOT (first2 > 12) THEN substr(date, 4, 2) END AS dd,
                   TRY_CAST(replace(CASE WHEN first2 > 12 THEN substr(date, 4, 2) WHEN NOT (first2 > 12) THEN substr(date, 1, 2) END, '/', '') AS DOUBLE) AS mm
         FROM off1),
off AS (SELECT row_id, date AS date_text,
               CAST(try_strptime(dd || '/' || CAST(CAST(mm AS INTEGER) AS VARCHAR) || '/2020', '%d/%m/%Y') AS DATE) AS date,
               CASE WHEN trace THEN 0.5 ELSE price END AS rain_official,
               CASE WHEN trace THEN 'Trace' END AS quality_official
        FROM off2)"""

EXPORTS = READINGS + """,
ex AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, NULL::VARCHAR AS date, device AS device_name, value
       FROM readings WHERE ts < TIMESTAMP '2024-01-16'
       UNION ALL
       SELECT strftime(ts, '%Y-%m-%d %H:%M:%S'), NULL, device, value
       FROM readings WHERE ts < TIMESTAMP '2024-01-16' AND ts >= TIMESTAMP '2024-01-09'
       UNION ALL
       SELECT NULL, strftime(ts, '%-d/%-m/%Y %-H:%M'), device, value FROM readings WHERE NOT (ts < TIMESTAMP '2024-01-16'))"""


def W(ctes, body):
    return f"WITH {ctes}\n{body}"


S: dict[str, str] = {}

# ---------------------------------------------------------------- sources / schema
S["null_tokens"] = """SELECT CASE WHEN o_orderstatus IN ('P', 'O') THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       count(*) AS n FROM orders GROUP BY 1"""
S["rename_map"] = "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey FROM nation"
S["select_reorder"] = f"SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus, {r4('o_totalprice', 'o_totalprice')}, o_orderpriority FROM orders"
S["select_prefix"] = "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders"
S["add_missing_cols"] = "SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS quality_extra FROM orders"
S["regex_columns"] = (f"SELECT o_orderkey AS oorderkey, o_custkey AS ocustkey, o_orderstatus AS oorderstatus, "
                      f"{r4('o_totalprice', 'ototalprice')}, o_orderdate AS oorderdate, o_orderpriority AS oorderpriority FROM orders")
S["zero_fill"] = W(INCIDENTS, "SELECT uid, " + ", ".join(r4(f"coalesce({m}, 0)", m) for m in MEASURES) + " FROM inc_raw")
S["sentinel_null"] = W(INCIDENTS + ",\n" + _station(0, "a"),
                       "SELECT strftime(hour, '%-m/%-d/%y') AS x_date, "
                       "strftime(hour, '%-I:%M') || ' ' || lower(substr(strftime(hour, '%p'), 1, 1)) AS x_time, "
                       + r4("CASE WHEN n < 3 THEN NULL ELSE hi END", "hi_temp") + ", "
                       + r4("CASE WHEN n < 2 THEN NULL ELSE bar END", "bar") + " FROM sta_raw")
S["filter_membership"] = W(INCIDENTS, f"""SELECT uid, type_of_incident IN ({inlist(HAZARDS)}) AS is_hazard,
  NOT coalesce(type_of_incident IN ({inlist(HAZARDS)}), false) AS not_hazard,
  affected_hhs IN (1.0, 2.0, 3.0) AS hh_small, NOT coalesce(affected_hhs IN (1.0, 2.0, 3.0), false) AS hh_not_small
FROM inc_raw""")
S["split_by_null"] = """SELECT CASE WHEN vec_id % 23 = 0 THEN 'no_coordinate'
                 WHEN vec_id % 19 <> 0 THEN 'with_coordinate' ELSE 'neither' END AS part, count(*) AS n
FROM embeddings GROUP BY 1"""
S["merge_periods"] = f"""SELECT o_orderkey AS record_key, CAST(o_orderdate AS DATE) AS date_of_incident,
       {r4('o_totalprice', 'amount')}, NULL::DOUBLE AS quantity FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'
UNION ALL
SELECT l_orderkey, CAST(l_shipdate AS DATE), NULL, {r4('l_quantity', 'quantity')} FROM lineitem"""
S["drop_last_day"] = W(READINGS, f"""SELECT device, ts, {r4('value', 'value')} FROM readings
WHERE ts < (SELECT max(CAST(ts AS DATE)) FROM readings)""")
S["cutoff_by_other"] = """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate <= (SELECT max(o_orderdate) FROM orders)"""
S["calendar_spine"] = f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n_orders, sum(o_totalprice) AS total_price FROM orders GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM o)
SELECT cal.date, n_orders, {r4('total_price', 'total_price')} FROM cal LEFT JOIN o USING (date)"""
S["full_outer_daily"] = """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n_orders FROM orders GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n_shipments FROM lineitem GROUP BY 1)
SELECT coalesce(o.date, s.date) AS date, n_orders, n_shipments FROM o FULL JOIN s ON o.date = s.date"""

# ---------------------------------------------------------------- gauge series
S["bucket_mean"] = W(BUCKET, f"SELECT device, slot, {r4('value', 'value')} FROM b")
S["counter_diff"] = W(BUCKET, f"SELECT device, slot, {r4('interval', 'interval')} FROM c2")
S["reset_flags"] = W(BUCKET, f"SELECT device, slot, '{RESET}' AS quality FROM c2 WHERE raw_interval < 0")
S["dense_grid"] = W(BUCKET, f"SELECT grid.device, grid.slot, {r4('b.value', 'value')} FROM grid LEFT JOIN b USING (device, slot)")
S["grid_left_join"] = W(BUCKET, f"""SELECT grid.device, grid.slot AS time_date, {r4('c2.interval', 'interval')}
FROM grid LEFT JOIN c2 ON grid.device = c2.device AND grid.slot = c2.slot""")
S["rolling_3h"] = W(GRIDDED, f"SELECT device, slot, {r4('interval', 'interval')}, {r4('max_3_hour', 'max_3_hour')} FROM rl")
S["daily_rain_basic"] = W(BUCKET, f"SELECT CAST(slot AS DATE) AS date, device, {r4('sum(interval)', 'interval')} FROM c2 GROUP BY 1, 2")
S["daily_rain"] = W(GRIDDED, f"SELECT date, device, {r4('interval', 'interval')}, {r4('max_3_hr_interval', 'max_3_hr_interval')} FROM daily")
S["hourly_rain"] = W(GRIDDED, f"SELECT device, datehour, {r4('precipitation', 'precipitation')} FROM hourly")
_ht_cols = ([r4(f"precip_{d}", f"precip_{d}") for d in DEVICES]
            + [r4(c, c) for c in STATION_NUMBERS] + [f"st{p}_{m}" for p in "ab" for m in ("wind_dir", "hi_dir")])
S["hourly_weather"] = W(HOURLY_TABLE, f"SELECT datehour, {', '.join(_ht_cols)}, quality_sta, quality_stb FROM ht")
S["satellite_daily"] = W(READINGS, """SELECT CAST(ts AS DATE) AS date,
  round(CAST(round(coalesce(sum(CAST(value * (1 / 0.997) * 60 * 60 * 6 AS DECIMAL(38,9))), 0), 2) AS DOUBLE), 4) AS rain_cfsr
FROM readings GROUP BY 1""")
_ip_cols = [r4(f'"{m}_{h}"', f"{m}_{h}") for m in MEASURES for h in HAZARDS]
S["incident_pivot"] = W(INCIDENTS, f"SELECT date, {', '.join(_ip_cols)} FROM ip")
S["row_totals"] = W(INCIDENTS + """,
cal AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS date),
x AS (SELECT cal.date, ip.* EXCLUDE (date) FROM cal LEFT JOIN ip USING (date)),
t AS (SELECT *, """ + _totals() + " FROM x)",
                    f"SELECT date, {', '.join(_ip_cols)}, "
                    + ", ".join(r4(f"total_{m}", f"total_{m}") for m in TOTALLED) + " FROM t")
S["date_fallback"] = W(INCIDENTS, "SELECT uid, date_of_assessment, date_of_incident FROM inc")
S["parse_mixed_times"] = W(EXPORTS, f"""SELECT device_name, {r4('value', 'value')},
  CASE WHEN date IS NULL THEN try_strptime(time, '%Y-%m-%d %H:%M:%S') ELSE try_strptime(date, '%d/%m/%Y %H:%M') END AS date_time
FROM (SELECT DISTINCT * FROM ex)""")
S["ampm_shift"] = W(INCIDENTS + ",\n" + _station(1, "b"), """SELECT strftime(hour - INTERVAL 12 HOUR, '%-m/%-d/%y') AS x_date,
  strftime(hour - INTERVAL 12 HOUR, '%-I:%M') || ' ' || lower(substr(strftime(hour - INTERVAL 12 HOUR, '%p'), 1, 1)) AS x_time,
  hour AS time_date FROM stb_raw""")
S["ambiguous_dates"] = W(OFFICIAL, "SELECT row_id, date_text, date FROM off")
S["trace_rain"] = W(OFFICIAL, f"SELECT row_id, {r4('rain_official', 'rain_official')}, quality_official FROM off")
S["if_else_null"] = W(READINGS, "SELECT device, ts, CASE WHEN value > 100 THEN 'high' WHEN NOT (value > 100) THEN 'low' END AS level FROM readings")
S["dedup_rows"] = W(EXPORTS, f"SELECT time, date, device_name, {r4('value', 'value')} FROM (SELECT DISTINCT * FROM ex)")
S["union_by_name"] = W(EXPORTS, f"SELECT time, date, device_name, {r4('value', 'value')} FROM ex")
S["distinct_values"] = "SELECT DISTINCT event_type AS device FROM events"
S["unpivot_series"] = W(GRIDDED + ",\ndd AS (SELECT DISTINCT date FROM daily)", f"""SELECT dd.date, d.device, {r4('daily.interval', 'rain')}
FROM dd CROSS JOIN (SELECT unnest([{inlist(DEVICES)}]) AS device) d
LEFT JOIN daily ON daily.date = dd.date AND daily.device = d.device""")
S["pivot_series"] = W(GRIDDED, "SELECT slot, " + ", ".join(
    r4(f"max(interval) FILTER (WHERE device = '{d}')", f"interval_{d}") for d in DEVICES) + " FROM g GROUP BY 1")
S["pivot_multi"] = W(GRIDDED, "SELECT date, " + ", ".join(
    r4(f"max(interval) FILTER (WHERE device = '{d}')", f"rain_{d}") + ", "
    + r4(f"max(max_3_hr_interval) FILTER (WHERE device = '{d}')", f"rain_max_3h_{d}") for d in DEVICES)
    + " FROM daily GROUP BY 1")

# ---------------------------------------------------------------- quality
_ANOM = "CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06') AND (value > 100 OR value < 1)"
S["anomaly_mask"] = W(READINGS, f"""SELECT device, ts,
  CASE WHEN {_ANOM} THEN '{ANOMALY}' END AS quality,
  {r4(f"CASE WHEN {_ANOM} THEN NULL ELSE value END", "value")} FROM readings""")
S["merge_flags"] = W(READINGS + f""",
m AS (SELECT device, ts, time_bucket(INTERVAL 15 MINUTE, ts) AS slot,
             CASE WHEN {_ANOM} THEN '{ANOMALY}' END AS quality,
             CASE WHEN {_ANOM} THEN NULL ELSE value END AS value FROM readings),
b0 AS (SELECT device, slot, {_summed('value', 1)} FROM m WHERE ts IS NOT NULL GROUP BY 1, 2),
b AS (SELECT device, slot, {_mean(1)} AS value FROM b0),
c AS (SELECT device, slot, value - lag(value) OVER (PARTITION BY device ORDER BY slot) AS d FROM b),
u AS (SELECT device, slot, quality FROM m WHERE quality IS NOT NULL
      UNION ALL SELECT device, slot, '{RESET}' FROM c WHERE d < 0)""",
                      "SELECT device, slot, min(quality) AS quality FROM u GROUP BY 1, 2")
_GAP = GRIDDED + f""",
gp AS (SELECT *, coalesce(anomaly, CASE WHEN accumulated IS NOT NULL AND
                 lag(accumulated) OVER (PARTITION BY device ORDER BY slot) IS NULL THEN '{GAP}' END) AS quality
       FROM g)"""
S["gap_flag"] = W(_GAP, f"SELECT device, slot, {r4('accumulated', 'accumulated')}, quality FROM gp")
_MISSING = _GAP + """,
mf AS (SELECT device, slot, accumulated,
              CASE WHEN slot = (SELECT min(slot) FROM gp) THEN NULL ELSE quality END AS q FROM gp),
mf2 AS (SELECT *, CASE WHEN q IS NULL AND accumulated IS NULL THEN 'Missing' ELSE q END AS quality FROM mf)"""
S["missing_flag"] = W(_MISSING, "SELECT device, slot, quality FROM mf2")
S["station_quality"] = W(HOURLY_TABLE, "SELECT datehour, quality_sta, quality_stb FROM ht")
S["official_quality"] = W(OFFICIAL + """,
cal AS (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2020-12-31', INTERVAL 1 DAY)) AS DATE) AS date)""",
                          f"""SELECT cal.date, {r4('off.rain_official', 'rain_official')},
  CASE WHEN off.quality_official = 'Trace' THEN 'Trace' WHEN cal.date < DATE '2020-05-01' THEN '-'
       WHEN off.rain_official IS NULL THEN 'Missing data' END AS quality_official
FROM cal LEFT JOIN off ON cal.date = off.date""")

# ---------------------------------------------------------------- records / weather
S["clean_records"] = W(INCIDENTS, f"""SELECT date_of_incident, type_of_incident,
  {", ".join(r4(f"coalesce({m}, 0)", m) for m in MEASURES)}, camp, camp_other
FROM inc WHERE incident = 'Yes' AND type_of_incident IN ({inlist(PUBLISHED)})""")
_dw_cols = ["sta_hi_temp", "stb_hi_temp", "sta_low_temp", "stb_low_temp", "sta_rain", "sta_rain_rate",
            "stb_rain", "stb_rain_rate", "sta_temp_out", "sta_wind_speed", "stb_temp_out", "stb_wind_speed",
            "stb_bar", "sta_hi_speed", "stb_hi_speed", "stb_hi_solar_rad", "stb_uv_index"]
S["daily_weather"] = W(DAILY_WEATHER, "SELECT date, " + ", ".join(r4(c, c) for c in _dw_cols) + " FROM dw")
_wl = STATION_NUMBERS
S["weather_long"] = W(HOURLY_TABLE,
                      "SELECT datehour, weather_field, round(value, 4) AS value FROM ht "
                      "UNPIVOT INCLUDE NULLS (value FOR weather_field IN (" + ", ".join(_wl) + "))")
S["display_dates"] = W(READINGS, "SELECT device, ts, strftime(ts, '%d/%m/%Y %H:%M') AS ts_text FROM readings")

# ---------------------------------------------------------------- coverage
_BINS = GRIDDED + """,
anchor AS (SELECT date_trunc('minute', min(slot)) AS a FROM rl),
bins AS (SELECT (SELECT a FROM anchor) + to_seconds(CAST(floor(epoch(slot - (SELECT a FROM anchor)) / 28800) * 28800 AS BIGINT)) AS bin_start,
                CAST(slot AS DATE) AS date, device, count(interval) AS count
         FROM rl GROUP BY 1, 2, 3)"""
S["bin_availability"] = W(_BINS, "SELECT bin_start, date, device, count, CASE WHEN count > 0 THEN 'yes' ELSE 'no' END AS available FROM bins")
S["month_coverage"] = W(_BINS + """,
ud AS (SELECT date, device, CASE WHEN count(*) FILTER (WHERE count > 0) > 1 THEN 1 ELSE 0 END AS useable FROM bins GROUP BY 1, 2)""",
                        """SELECT device, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_num, strftime(min(date), '%b') AS month,
  CAST(sum(useable) AS BIGINT) AS count, CAST(max(day(last_day(date))) AS INTEGER) AS number_of_days,
  round(sum(useable) / max(day(last_day(date))) * 100, 4) AS percent
FROM ud GROUP BY 1, 2, 3""")
S["device_completeness"] = W(_BINS + """,
dc AS (SELECT device, date, sum(count) AS count FROM bins GROUP BY 1, 2)""",
                             """SELECT device, CAST(count(*) * 96 AS BIGINT) AS total_data, CAST(sum(count) AS BIGINT) AS available_data,
  round(sum(count) / (count(*) * 96) * 100, 4) AS percent FROM dc GROUP BY 1""")
S["monthly_day_count"] = W(GRIDDED, """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_num, strftime(min(date), '%b') AS month, device,
  count(*) AS day_count FROM daily WHERE interval IS NOT NULL GROUP BY 1, 2, device""")
S["frequency_table"] = W(GRIDDED + """,
cnt AS (SELECT device, interval AS item, count(*) AS count FROM g WHERE interval IS NOT NULL GROUP BY 1, 2),
ft AS (SELECT *, sum(count) OVER (PARTITION BY device) AS total,
              sum(count) OVER (PARTITION BY device ORDER BY count DESC, item ASC ROWS UNBOUNDED PRECEDING) AS cum FROM cnt)""",
                         """SELECT device, round(item, 4) AS item, count, round(count / total * 100, 4) AS percent, CAST(cum AS BIGINT) AS cum_count,
  round(cum / total * 100, 4) AS cum_percent FROM ft""")

# ---------------------------------------------------------------- geo
S["lookup_fallback"] = W(GEO, f"""SELECT point_id, {r4('x', 'x')}, {r4('y', 'y')}, camp,
  coalesce(cmap.new_name, camp) AS camp_name_reported FROM pts LEFT JOIN cmap ON pts.camp = cmap.old_name""")
S["geo_inside"] = W(GEO, """SELECT point_id, count(inside.name) AS n_within,
  CASE WHEN count(inside.name) = 0 THEN 'outside_camp_boundary' ELSE 'inside_camp_boundary' END AS location_status
FROM pts LEFT JOIN inside USING (point_id) GROUP BY 1""")
S["geo_join"] = W(GEO, "SELECT point_id, inside.name AS camp_name_gps FROM pts LEFT JOIN inside USING (point_id)")
S["geo_consistency"] = W(GEO + """,
j AS (SELECT pts.point_id, coalesce(cmap.new_name, camp) AS camp_name_reported, inside.name AS camp_name_gps
      FROM pts LEFT JOIN cmap ON pts.camp = cmap.old_name LEFT JOIN inside USING (point_id)
      WHERE x IS NOT NULL AND y IS NOT NULL)""",
                         """SELECT point_id,
  CASE WHEN count(camp_name_gps) OVER (PARTITION BY point_id) = 0 THEN 'outside_camp_boundary' ELSE 'inside_camp_boundary' END AS location_status,
  camp_name_reported, camp_name_gps, camp_name_reported = camp_name_gps AS camp_consistency FROM j""")

# ---------------------------------------------------------------- published tables
def _official_days(parity, name):
    return f"""{name}_raw AS (
  SELECT DATE '2024-01-01' + CAST(o_orderkey % 36 AS INTEGER) AS date, count(*) / 4.0 AS mm
  FROM orders WHERE o_custkey % 2 = {parity} GROUP BY 1),
{name} AS (SELECT date, CASE WHEN day(date) % 10 = 3 THEN 0.5 ELSE mm END AS rain_{name},
       CASE WHEN day(date) % 10 = 3 THEN 'Trace' END AS trace_{name}
  FROM {name}_raw WHERE day(date) % 10 = 3 OR day(date) % 7 <> 0)"""


def _official_flag(name):
    return (f"CASE WHEN trace_{name} = 'Trace' THEN 'Trace' WHEN t.date < DATE '2024-01-04' THEN '-' "
            f"WHEN rain_{name} IS NULL THEN 'Missing data' END AS quality_{name}")


_HYDRO = GRIDDED + ",\n" + DAILY_WEATHER + """,
rw AS (SELECT date, """ + ", ".join(
    f"max(interval) FILTER (WHERE device = '{d}') AS rain_{d}, "
    f"max(max_3_hr_interval) FILTER (WHERE device = '{d}') AS rain_max_3h_{d}" for d in DEVICES) + """ FROM daily GROUP BY 1),
fj AS (SELECT coalesce(rw.date, ip.date) AS date, rw.* EXCLUDE (date), ip.* EXCLUDE (date) FROM rw FULL JOIN ip ON rw.date = ip.date),
cal AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS date),
x AS (SELECT cal.date, fj.* EXCLUDE (date) FROM cal LEFT JOIN fj USING (date)),
t AS (SELECT *, """ + _totals() + """ FROM x),
sat AS (SELECT CAST(ts AS DATE) AS date,
               CAST(round(coalesce(sum(CAST(value * (1 / 0.997) * 60 * 60 * 6 AS DECIMAL(38,9))), 0), 2) AS DOUBLE) AS rain_cfsr
        FROM readings GROUP BY 1),
""" + _official_days(0, "offa") + ",\n" + _official_days(1, "offb") + """,
chirps AS (SELECT DATE '2024-01-01' + CAST(o_orderkey % 36 AS INTEGER) AS date, round(count(*) / 7.0, 2) AS rain_chirps
           FROM orders GROUP BY 1),
hd AS (SELECT t.*, sat.rain_cfsr, chirps.rain_chirps, rain_offa, rain_offb,
              """ + _official_flag("offa") + ", " + _official_flag("offb") + """, dw.* EXCLUDE (date),
              """ + _station_flag("t.date", "dw.sta_low_temp") + """ AS quality_sta,
              """ + _station_flag("t.date", "dw.stb_hi_temp") + """ AS quality_stb
       FROM t LEFT JOIN sat ON sat.date = t.date LEFT JOIN dw ON dw.date = t.date
       LEFT JOIN offa ON offa.date = t.date LEFT JOIN offb ON offb.date = t.date
       LEFT JOIN chirps ON chirps.date = t.date)"""
_hd_cols = ([r4(f"rain_{d}", f"rain_{d}") + ", " + r4(f"rain_max_3h_{d}", f"rain_max_3h_{d}") for d in DEVICES]
            + [r4(f'"{m}_{h}"', f"{m}_{h}") for m in TOTALLED for h in HAZARDS]
            + [r4(f"rain_{s}", f"rain_{s}") for s in ("offa", "offb", "chirps")] + ["quality_offa", "quality_offb"]
            + [r4(f"total_{m}", f"total_{m}") for m in TOTALLED] + [r4("rain_cfsr", "rain_cfsr")]
            + [r4(c, c) for c in _dw_cols if not c.endswith("_rain_rate")])
S["hydro_daily"] = W(_HYDRO, "SELECT date, " + ", ".join(_hd_cols) + " FROM hd")
S["column_completeness"] = W(_HYDRO, "SELECT " + ", ".join(
    f"round(count(rain_{d}) / count(*) * 100) AS pct_{d}" for d in DEVICES)
    + "".join(f", round(count(rain_{s}) / count(*) * 100) AS pct_{s}" for s in ("cfsr", "chirps", "offa", "offb"))
    + ", round(count(*) FILTER (WHERE quality_sta IS NULL) / count(*) * 100) AS pct_sta"
    + ", round(count(*) FILTER (WHERE quality_stb IS NULL) / count(*) * 100) AS pct_stb FROM hd")
_SUB = _MISSING + """,
sub AS (SELECT mf2.device, mf2.slot, mf2.accumulated, mf2.quality, g.interval FROM mf2 JOIN g USING (device, slot))"""
S["subhourly"] = W(_SUB, "SELECT slot AS date_time, " + ", ".join(
    r4(f"max(accumulated) FILTER (WHERE device = '{d}')", f"cumulative_rain_{d}") + ", "
    + f"max(quality) FILTER (WHERE device = '{d}') AS quality_{d}, "
    + r4(f"max(interval) FILTER (WHERE device = '{d}')", f"rain_{d}") for d in DEVICES) + " FROM sub GROUP BY 1")

# ---------------------------------------------------------------- side tables
_NO_X = GEO + """,
pm AS (SELECT point_id, CASE WHEN point_id % 23 = 0 THEN NULL ELSE x END AS x, CASE WHEN point_id % 19 = 0 THEN NULL ELSE y END AS y FROM pts)"""
S["points_without_coordinate"] = W(_NO_X, f"SELECT point_id, {r4('y', 'y')} FROM pm WHERE x IS NULL")
S["points_with_coordinate"] = W(_NO_X, f"SELECT point_id, {r4('x', 'x')}, {r4('y', 'y')} FROM pm WHERE x IS NOT NULL AND y IS NOT NULL")
S["flagged_slots"] = W(GRIDDED, "SELECT device, slot, anomaly AS quality FROM slots WHERE anomaly IS NOT NULL")

# ---------------------------------------------------------------- one-pass ingest, runs
_INGEST = EXPORTS + f""",
once AS (SELECT DISTINCT * FROM ex),
timed AS (SELECT device_name AS device, value,
  CASE WHEN date IS NULL THEN try_strptime(time, '%Y-%m-%d %H:%M:%S') ELSE try_strptime(date, '%d/%m/%Y %H:%M') END AS ts FROM once),
flagged AS (SELECT *, CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06') AND (value > 100 OR value < 1) AS anom FROM timed)"""
S["ingest_slots"] = W(_INGEST + f""",
summed AS (SELECT device, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, {_summed('value', 1)}, {_summed(_MASKED, 2)},
  min(CASE WHEN anom THEN '{ANOMALY}' END) AS anomaly, count(*) AS readings FROM flagged GROUP BY 1, 2)""",
                      f"""SELECT device, slot, round({_mean(1)}, 4) AS accumulated, round({_mean(2)}, 4) AS value,
  anomaly, readings FROM summed""")
S["reading_counts"] = W(_INGEST, """SELECT count(*) AS readings, count(*) FILTER (WHERE ts IS NULL) AS without_time,
  count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-03' OR CAST(ts AS DATE) > DATE '2024-01-25') AS outside_period FROM timed""")
S["slot_runs"] = W(GRIDDED + """,
known AS (SELECT device, date, slot FROM gd WHERE interval IS NOT NULL),
islands AS (SELECT *, slot - INTERVAL 15 MINUTE * row_number() OVER (PARTITION BY device, date ORDER BY slot) AS island FROM known)""",
                   """SELECT device, date, min(slot) AS first, max(slot) AS last, count(*) AS slots FROM islands GROUP BY device, date, island""")
S["reading_gaps"] = W(GRIDDED + """,
nxt AS (SELECT device, slot, lead(slot) OVER (PARTITION BY device ORDER BY slot) AS after FROM slots WHERE accumulated IS NOT NULL)""",
                      """SELECT device, slot + INTERVAL 15 MINUTE AS gap_first, after - INTERVAL 15 MINUTE AS gap_last,
  CAST(epoch(after - slot) / 900 AS BIGINT) - 1 AS slots FROM nxt WHERE after > slot + INTERVAL 15 MINUTE""")

# ---------------------------------------------------------------- published from files
# gauges as files: the first kind with repeated rows, the later one a row a minute and a
# column a gauge, so a gauge without a reading in that minute has a row without a value
_EXPORTED = """,
early AS (SELECT DISTINCT device, date_trunc('second', ts) AS ts, value FROM readings WHERE ts < TIMESTAMP '2024-01-16'),
late AS (SELECT device, date_trunc('minute', ts) AS ts, max(value) AS value FROM readings WHERE NOT (ts < TIMESTAMP '2024-01-16') GROUP BY 1, 2),
exported AS (SELECT * FROM early UNION ALL
  SELECT d.device, m.ts, late.value FROM (SELECT DISTINCT ts FROM late) m CROSS JOIN (SELECT unnest([""" + inlist(DEVICES) + """]) AS device) d
  LEFT JOIN late ON late.ts = m.ts AND late.device = d.device),
ra AS ("""
S["published_daily"] = W(_HYDRO.replace(",\nra AS (", _EXPORTED, 1).replace("FROM readings WHERE ts IS NOT NULL", "FROM exported WHERE ts IS NOT NULL", 1),
                         "SELECT date, " + ", ".join(_hd_cols) + " FROM hd")

ORACLE_SQL = dict(S)
