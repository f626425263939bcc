"""DuckDB SQL of the registered queries, written from the definitions, not from the DataFrame code."""

from __future__ import annotations

from aeropanel.schema import (
    CATEGORIES,
    CATEGORY_NAMES,
    CONCENTRATION_EDGES,
    INDEX_EDGES,
    INDEX_POLLUTANTS,
    LIMITS,
    MONTHS,
    POLLUTANTS,
    PROFILE_POLLUTANTS,
    SEASONS,
    column_name,
    display_name,
)
from aeropanel.sources.driver_tables import (
    AS_OF,
    BASE_PERIOD,
    CITY,
    CITY_DAY_SQL,
    DAY,
    DIAGNOSED,
    EVENT_PERIOD,
    HOURLY_SQL,
    LATE_TYPE,
    METROS,
    MONTH,
    N_YEARS,
    READINGS_SQL,
    YEAR,
)

TABLES = ["orders", "customer", "nation", "region", "events"]


def _plain(text: str) -> str:
    return text.format(**{t: t for t in TABLES})


def rd(expr: str, digits: int) -> str:
    """Rounding in decimal, half away from zero, as Spark rounds a double; whole numbers need no decimal."""
    if digits == 0:
        return f"round(CAST({expr} AS DOUBLE))"
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def band(expr: str) -> str:
    cases = " ".join(f"WHEN {expr} <= {hi} THEN '{name}'" for _, name, hi, _ in CATEGORIES if hi is not None)
    return f"CASE WHEN {expr} IS NULL THEN NULL {cases} ELSE '{CATEGORY_NAMES[-1]}' END"


def _sub_index(p: str, col: str | None = None) -> str:
    col = col or p
    edges, cases = CONCENTRATION_EDGES[p], []
    for b in range(1, len(edges)):
        line = (f"{INDEX_EDGES[b - 1]}::DOUBLE + ({col} - {edges[b - 1]}) * {INDEX_EDGES[b] - INDEX_EDGES[b - 1]}"
                f" / {edges[b] - edges[b - 1]}")
        cases.append(f"WHEN {col} <= {edges[b]} THEN {line}" if b < len(edges) - 1 else f"ELSE {line}")
    return f"CASE WHEN {col} IS NULL THEN NULL {' '.join(cases)} END"


def index_ctes(source: str, keep: str, out: str) -> str:
    """CTEs that add SI_*, AQI_calc, Dominant and Bucket_calc to `source`; `keep` are the other columns."""
    si = ", ".join(f"{_sub_index(p)} AS SI_{p}" for p in INDEX_POLLUTANTS)
    count = " + ".join(f"(SI_{p} IS NOT NULL)::INT" for p in INDEX_POLLUTANTS)
    top = f"list_max([{', '.join(f'SI_{p}' for p in INDEX_POLLUTANTS)}])"
    first = " ".join(f"WHEN {rd(f'SI_{p}', 0)} = AQI_calc THEN '{display_name(p)}'" for p in INDEX_POLLUTANTS)
    pol = ", ".join(INDEX_POLLUTANTS)
    return f"""
    {out}_si AS (SELECT {keep}, {pol}, {si} FROM {source}),
    {out}_value AS (SELECT *, CASE WHEN {count} >= 3 AND (SI_PM25 IS NOT NULL OR SI_PM10 IS NOT NULL)
                    THEN {rd(top, 0)} END AS AQI_calc FROM {out}_si),
    {out} AS (SELECT *, CASE {first} END AS Dominant, {band('AQI_calc')} AS Bucket_calc FROM {out}_value)"""


RAW = f"raw AS ({_plain(CITY_DAY_SQL)})"
ONE_PER_DAY = f"""{RAW}, one_per_day AS (
    SELECT * EXCLUDE (Region) FROM raw QUALIFY row_number() OVER (PARTITION BY City, Date ORDER BY k) = 1)"""


def _nonneg(cols) -> str:
    return ", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in cols)


CLEAN = f"""{ONE_PER_DAY}, clean AS (
    SELECT * REPLACE ({_nonneg(POLLUTANTS)}),
      CAST(year(Date) AS INT) AS Year, CAST(month(Date) AS INT) AS Month,
      CASE WHEN month(Date) IN (12, 1, 2) THEN 'Winter' WHEN month(Date) BETWEEN 3 AND 5 THEN 'Summer'
           WHEN month(Date) BETWEEN 6 AND 9 THEN 'Monsoon' ELSE 'Post-Monsoon' END AS Season
    FROM one_per_day WHERE AQI > 0 AND AQI <= 1000)"""
DAILY = f"""{ONE_PER_DAY}, typed AS (SELECT * REPLACE ({_nonneg(INDEX_POLLUTANTS)}) FROM one_per_day),
    {index_ctes('typed', 'City, Date, k, AQI, AQI_Bucket', 'daily')}"""
STORED = f"""{DAILY}, stored AS (SELECT City, Date, {', '.join(f'{rd(p, 2)} AS {p}' for p in INDEX_POLLUTANTS)},
      {rd('AQI', 0)} AS AQI, {rd('AQI_calc', 0)} AS stored_calc FROM daily),
    {index_ctes('stored', 'City, Date, AQI, stored_calc', 'again')}"""

STORE_COLS = ", ".join(["City", "Date", *INDEX_POLLUTANTS, "AQI", "AQI_calc", "Bucket_calc", "Dominant"])
IN_BASE = "Date BETWEEN '{}' AND '{}'".format(*BASE_PERIOD)
IN_EVENT = "Date BETWEEN '{}' AND '{}'".format(*EVENT_PERIOD)
PERIOD_MEANS = ", ".join(
    f"{rd(f'avg(CASE WHEN {cond} THEN {c} END)', 1)} AS {c.lower()}_{name}"
    for c in ("AQI", "PM25", "NO2") for name, cond in (("base", IN_BASE), ("event", IN_EVENT)))
COMPARISON = f"""{CLEAN}, means AS (SELECT City, {PERIOD_MEANS} FROM clean GROUP BY City),
    comparison AS (SELECT *, {rd('(aqi_event - aqi_base) / aqi_base * 100', 1)} AS aqi_change_pct
      FROM means WHERE aqi_base IS NOT NULL AND aqi_event IS NOT NULL)"""


def unions(parts) -> str:
    return " UNION ALL ".join(parts)


def _corr_rows(col_expr, target_expr) -> str:
    return unions(f"SELECT '{display_name(c)}' AS pollutant, {rd(f'corr({col_expr(c)}, {target_expr})', 3)} AS corr "
                  "FROM clean" for c in POLLUTANTS)


CORR_SKIP = _corr_rows(lambda c: c, "AQI")
CORR_ZERO = _corr_rows(lambda c: f"coalesce({c}, 0)", "AQI")


def profile_sql() -> dict[str, str]:
    cols = ["City", "Date", *POLLUTANTS, "AQI", "AQI_Bucket"]
    missing = unions(
        f"SELECT '{c}' AS \"column\", {rd(f'100.0 * count(*) FILTER ({c} IS NULL) / count(*)', 2)} AS missing_pct FROM raw"
        for c in cols)
    lost = {"Date": "k % 53 = 0 OR k % 59 = 0", "NO2": "k % 47 = 0", "AQI": "k % 43 = 0"}
    return {
        "null_profile": f"WITH {RAW} {missing}",
        "lost_values": f"WITH {RAW} " + unions(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({lost.get(c, 'false')}) AS lost FROM raw" for c in ["Date", *POLLUTANTS, "AQI"]),
        "overview": f"""WITH {RAW} SELECT count(*) AS "rows", CAST({len(cols)} AS INT) AS cols,
            count(DISTINCT City) AS cities, min(Date) AS start, max(Date) AS "end" FROM raw""",
        "cleaning_funnel": f"""WITH {ONE_PER_DAY}
            SELECT 0::INT AS step, 'raw' AS name, count(*) AS "rows" FROM raw UNION ALL
            SELECT 1, 'deduplicated', count(*) FROM one_per_day UNION ALL
            SELECT 2, 'with_target', count(*) FROM one_per_day WHERE AQI IS NOT NULL UNION ALL
            SELECT 3, 'in_range', count(*) FROM one_per_day WHERE AQI > 0 AND AQI <= 1000""",
    }


def clean_sql() -> dict[str, str]:
    panel = ", ".join(["City", "Date", *POLLUTANTS, "AQI", "AQI_Bucket"])
    return {
        "dates_parsed": f"""WITH {RAW} SELECT {panel} FROM (SELECT * REPLACE (
            CASE WHEN k % 53 = 0 OR k % 59 = 0 THEN NULL ELSE Date END AS Date,
            CASE WHEN k % 47 = 0 OR NO2 < 0 THEN NULL ELSE NO2 END AS NO2, CASE WHEN k % 43 = 0 THEN NULL ELSE AQI END AS AQI) FROM raw)""",
        "one_row_per_city_day": f"WITH {ONE_PER_DAY} SELECT {panel} FROM one_per_day",
        "rows_with_target": f"WITH {RAW} SELECT {panel} FROM raw WHERE AQI IS NOT NULL",
        "target_in_range": f"WITH {RAW} SELECT {panel} FROM raw WHERE AQI > 0 AND AQI <= 1000",
        "negatives_to_null": f"WITH {RAW} SELECT {panel} FROM (SELECT * REPLACE ({_nonneg(POLLUTANTS)}) FROM raw)",
        "calendar_columns": f"""WITH {RAW} SELECT City, Date, CAST(year(Date) AS INT) AS Year,
            CAST(month(Date) AS INT) AS Month FROM raw""",
        "season_column": f"""WITH {RAW} SELECT City, Date, CASE WHEN month(Date) IN (3, 4, 5) THEN 'Summer'
            WHEN month(Date) IN (6, 7, 8, 9) THEN 'Monsoon' WHEN month(Date) IN (10, 11) THEN 'Post-Monsoon'
            ELSE 'Winter' END AS Season FROM raw""",
        "clean_panel": f"WITH {CLEAN} SELECT * EXCLUDE (k) FROM clean",
    }


def trend_sql() -> dict[str, str]:
    full = f"SELECT City FROM clean GROUP BY City HAVING count(DISTINCT Year) = {N_YEARS}"
    shares = """shares AS (SELECT AQI_Bucket, count(*) AS days,
        {} AS pct FROM clean WHERE AQI_Bucket IS NOT NULL GROUP BY AQI_Bucket)""".format(
        rd("count(*) * 100.0 / (SELECT count(*) FROM clean)", 1))
    bands = "(VALUES {}) b(ord, AQI_Bucket)".format(
        ", ".join(f"({o}, '{n}')" for o, n, _, _ in CATEGORIES))
    months = ", ".join(f"{rd(f'avg(AQI) FILTER (Month = {m})', 0)} AS {name}" for m, name in enumerate(MONTHS, 1))
    diag = ", ".join(f"{rd(f'avg({c})', d)} AS {c.lower()}"
                     for c, d in (("AQI", 1), ("PM25", 1), ("PM10", 1), ("CO", 2), ("NO2", 1), ("SO2", 1)))
    overall = ", ".join(
        f"{rd(f'avg({c}) FILTER ({cond})', 1)} AS {c.lower()}_{name}"
        for c in ("AQI", "PM25", "NO2") for name, cond in (("base", IN_BASE), ("event", IN_EVENT)))
    return {
        "city_ranking": f"""WITH {CLEAN} SELECT City, {rd('avg(AQI)', 1)} AS avg_aqi, {rd('avg(PM25)', 1)} AS avg_pm25,
            count(*) AS days FROM clean GROUP BY City""",
        "yearly": f"""WITH {CLEAN} SELECT Year, {rd('avg(AQI)', 1)} AS avg_aqi, count(DISTINCT City) AS cities
            FROM clean GROUP BY Year""",
        "full_coverage": f"WITH {CLEAN} {full}",
        "yearly_fixed": f"""WITH {CLEAN} SELECT Year, {rd('avg(AQI)', 1)} AS avg_aqi FROM clean
            WHERE City IN ({full}) GROUP BY Year""",
        "monthly": f"""WITH {CLEAN} SELECT Month, {rd('avg(AQI)', 1)} AS avg_aqi, {rd('avg(PM25)', 1)} AS avg_pm25
            FROM clean GROUP BY Month""",
        "seasonal": f"WITH {CLEAN} SELECT Season, {rd('avg(AQI)', 1)} AS avg_aqi FROM clean GROUP BY Season",
        "category_share": f"WITH {CLEAN}, {shares} SELECT * FROM shares",
        "ordered_categories": f"""WITH {CLEAN}, {shares} SELECT ord, b.AQI_Bucket, coalesce(days, 0) AS days,
            coalesce(pct, 0.0) AS pct FROM {bands} LEFT JOIN shares USING (AQI_Bucket)""",
        "city_month_matrix": f"""WITH {CLEAN} SELECT City, {months} FROM clean
            WHERE City IN ({quoted(METROS)}) GROUP BY City""",
        "diagnose": f"WITH {CLEAN} SELECT City, {diag} FROM clean WHERE City IN ({quoted(DIAGNOSED)}) GROUP BY City",
        "period_comparison": f"WITH {COMPARISON} SELECT * FROM comparison",
        "period_overall": f"""WITH {COMPARISON} SELECT count(DISTINCT City) AS cities, {overall} FROM clean
            WHERE City IN (SELECT City FROM comparison)""",
        "biggest_drops": f"""WITH {COMPARISON} SELECT City, aqi_change_pct FROM comparison
            ORDER BY aqi_change_pct, City LIMIT 5""",
        "national_mean": f"WITH {CLEAN} SELECT {rd('avg(AQI)', 1)} AS avg_aqi, {rd('avg(PM25)', 1)} AS avg_pm25 FROM clean",
        "corr_with_target": f"WITH {CLEAN} {CORR_SKIP}",
        "corr_with_target_nulls_as_zero": f"WITH {CLEAN} {CORR_ZERO}",
        "corr_matrix": f"WITH {CLEAN} " + unions(
            f"SELECT '{display_name(a)}' AS a, '{display_name(b)}' AS b, {rd(f'corr({a}, {b})', 3)} AS r FROM clean"
            for a in (*POLLUTANTS, "AQI") for b in (*POLLUTANTS, "AQI")),
        "top_drivers": f"""WITH {CLEAN}, c AS ({CORR_SKIP}) SELECT * FROM c WHERE pollutant NOT IN ('NO', 'NOx')
            ORDER BY corr DESC, pollutant LIMIT 5""",
    }


def index_sql() -> dict[str, str]:
    si = ", ".join(f"SI_{p}" for p in INDEX_POLLUTANTS)
    long_form = unions(f"SELECT City, Date, k, '{p}' AS pollutant, {p} AS level, SI_{p} AS sub_index FROM daily "
                       f"WHERE {p} IS NOT NULL" for p in INDEX_POLLUTANTS)
    parts = unions(
        f"SELECT City, Date, '{display_name(p)}' AS pollutant, {p} AS level, SI_{p} AS sub_index, "
        f"coalesce(Dominant = '{display_name(p)}', false) AS is_dominant FROM daily" for p in INDEX_POLLUTANTS)
    every_row = f"""{RAW}, every AS (SELECT City, Date, k, AQI, {_nonneg(INDEX_POLLUTANTS)} FROM raw),
        {index_ctes('every', 'City, Date, k', 'indexed')}"""
    advice = " ".join(f"WHEN Bucket_calc = '{n}' THEN '{t}'" for _, n, _, t in CATEGORIES)
    return {
        "sub_indices": f"WITH {DAILY} SELECT City, Date, {si} FROM daily",
        "sub_index_by_range_join": f"WITH {DAILY} {long_form}",
        "index_values": f"WITH {DAILY} SELECT City, Date, AQI_calc FROM daily",
        "dominant_pollutant": f"WITH {DAILY} SELECT City, Date, AQI_calc, Dominant FROM daily",
        "index_category": f"WITH {DAILY} SELECT City, Date, AQI_calc, Bucket_calc FROM daily",
        "index_of_readings": f"WITH {every_row} SELECT City, Date, k, {si}, AQI_calc, Dominant, Bucket_calc FROM indexed",
        "index_check": f"""WITH {DAILY} SELECT count(*) AS total_days, count(AQI_calc) AS calculated_days,
            count(AQI) AS recorded_days, count(*) FILTER (AQI IS NULL AND AQI_calc IS NOT NULL) AS gaps_filled,
            count(*) FILTER (AQI IS NOT NULL AND AQI_calc IS NOT NULL) AS both_days,
            {rd('avg(abs(AQI - AQI_calc))', 1)} AS mae,
            {rd('avg(CASE WHEN AQI IS NOT NULL AND AQI_calc IS NOT NULL THEN CASE WHEN AQI_Bucket = Bucket_calc THEN 1.0 '
                'ELSE 0.0 END END) * 100', 1)} AS bucket_match_pct,
            {rd('corr(AQI, AQI_calc)', 3)} AS corr FROM daily""",
        "dominant_share": f"""WITH {DAILY} SELECT Dominant, count(*) AS days,
            {rd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
            FROM daily WHERE Dominant IS NOT NULL GROUP BY Dominant""",
        "daily_output": f"WITH {DAILY} SELECT {STORE_COLS} FROM daily",
        "gaps_filled": f"WITH {DAILY} SELECT {STORE_COLS} FROM daily WHERE AQI IS NULL AND AQI_calc IS NOT NULL",
        "recorded_vs_calculated": f"""WITH {DAILY}, placed AS (SELECT AQI, AQI_calc, count(*) OVER () AS n,
              row_number() OVER (ORDER BY md5('7|' || City || '|' || strftime(Date, '%Y-%m-%d'))) AS place
              FROM daily WHERE AQI IS NOT NULL AND AQI_calc IS NOT NULL)
            SELECT AQI, AQI_calc FROM placed WHERE place <= floor(n * 0.4 + 0.5)""",
        "reconcile_tables": f"WITH {STORED}, " + """
            ours AS (SELECT City, Date, AQI, stored_calc AS AQI_calc, true AS here FROM stored WHERE day(Date) <> 9),
            theirs AS (SELECT City, Date, CASE WHEN day(Date) <> 5 THEN AQI END AS AQI,
              stored_calc + CASE WHEN day(Date) = 7 THEN 2.0 ELSE 0.0 END AS AQI_calc, true AS here FROM stored WHERE day(Date) <> 3),
            sides AS (SELECT o.here AS o_here, t.here AS t_here, o.AQI AS o_AQI, t.AQI AS t_AQI, o.AQI_calc AS o_AQI_calc,
              t.AQI_calc AS t_AQI_calc FROM ours o FULL JOIN theirs t
              ON o.City IS NOT DISTINCT FROM t.City AND o.Date IS NOT DISTINCT FROM t.Date)""" + " UNION ALL ".join(f"""
            SELECT '{c}' AS "column", count(*) AS total, count(*) FILTER (t_here IS NULL) AS only_ours, count(*) FILTER (o_here IS NULL) AS only_theirs,
              count(*) FILTER (o_here AND t_here AND o_{c} IS NOT DISTINCT FROM t_{c}) AS equal,
              count(*) FILTER (o_here AND t_here AND (o_{c} IS NULL) <> (t_{c} IS NULL)) AS one_missing,
              count(*) FILTER (o_here AND t_here AND o_{c} <> t_{c}) AS different, max(abs(o_{c} - t_{c})) AS worst FROM sides"""
            for c in ("AQI", "AQI_calc")),
        "reconcile": f"""WITH {STORED} SELECT count(*) AS total,
            count(*) FILTER (AQI_calc IS NOT DISTINCT FROM stored_calc) AS "match",
            count(stored_calc) AS calc, count(*) FILTER (AQI IS NULL AND stored_calc IS NOT NULL) AS filled,
            count(*) FILTER (AQI IS NOT NULL AND stored_calc IS NOT NULL) AS "both",
            count(*) FILTER ({band('AQI')} = {band('stored_calc')}) AS same FROM again""",
        "index_breakdown": f"WITH {DAILY} {parts}",
        "index_advice": f"""WITH {DAILY} SELECT City, Date, AQI_calc, coalesce(Bucket_calc, 'No AQI') AS category,
            CASE {advice} ELSE '' END AS advice FROM daily""",
    }


HOURS = f"hours AS ({_plain(HOURLY_SQL)})"
FEED = {"pm2_5": "PM25", "pm10": "PM10", "nitrogen_dioxide": "NO2", "sulphur_dioxide": "SO2",
        "carbon_monoxide": "CO", "ozone": "O3"}
DAY_LONG, SHORT = ["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide"], ["carbon_monoxide", "ozone"]


def rolling_ctes(dense: str) -> str:
    """Means over rows of a table `dense` (station, time, n, readings) without gaps."""
    m24 = ", ".join(f"CASE WHEN count({c}) OVER d >= 16 THEN avg({c}) OVER d END AS mean24_{c}" for c in DAY_LONG)
    m8 = ", ".join(f"CASE WHEN n >= 8 AND count({c}) OVER e >= 6 THEN avg({c}) OVER e END AS mean8_{c}" for c in SHORT)
    x8 = ", ".join(f"max(mean8_{c}) OVER (PARTITION BY station ORDER BY time ROWS 16 PRECEDING) AS max8_{c}"
                   for c in SHORT)
    levels = ", ".join(f"{rd(f'mean24_{c}', 1)} AS {FEED[c]}" for c in DAY_LONG)
    return f"""{dense}, means AS (SELECT *, {m24}, {m8} FROM dense
        WINDOW d AS (PARTITION BY station ORDER BY time ROWS 23 PRECEDING),
               e AS (PARTITION BY station ORDER BY time ROWS 7 PRECEDING)),
      highest AS (SELECT *, {x8} FROM means),
      levels AS (SELECT * EXCLUDE (pm10), {levels}, {rd('max8_carbon_monoxide * 0.001', 2)} AS CO, {rd('max8_ozone', 1)} AS O3,
        NULL::DOUBLE AS NH3 FROM highest)"""


FEED_COLS = ", ".join(FEED)
DENSE = f"""{HOURS}, spans AS (SELECT station, min(time) AS f, max(time) AS l FROM hours GROUP BY station),
    spine AS (SELECT station, unnest(generate_series(f, l, INTERVAL 1 HOUR)) AS time FROM spans),
    dense AS (SELECT spine.station, spine.time, {FEED_COLS},
        row_number() OVER (PARTITION BY spine.station ORDER BY spine.time) AS n
      FROM spine LEFT JOIN hours USING (station, time))"""
ROLLING = f"""{rolling_ctes(DENSE)}, whole AS (SELECT * FROM levels WHERE n >= 24),
    {index_ctes('whole', 'station, time, pm2_5', 'rolling')}"""
INDEXED = ", ".join(["station", "time", *INDEX_POLLUTANTS, "AQI_calc", "Dominant", "Bucket_calc"])
LATEST = f"""{ROLLING}, ends AS (SELECT station, max(time) AS end_time FROM dense
      WHERE pm2_5 IS NOT NULL AND time <= TIMESTAMP '{AS_OF}' GROUP BY station),
    recent AS (SELECT rolling.*, end_time FROM rolling JOIN ends USING (station)
      WHERE time <= end_time AND time > end_time - INTERVAL 24 HOUR)"""


def hourly_sql() -> dict[str, str]:
    utc_hour = "date_trunc('hour', ts)"
    return {
        "local_hour": f"""SELECT event_id, {utc_hour} AS utc_hour,
            date_trunc('hour', ts + INTERVAL 330 MINUTE) AS kolkata_hour FROM events""",
        "hourly_arrays_flattened": f"WITH {HOURS} SELECT station, time, {FEED_COLS} FROM hours",
        "dense_hours": f"WITH {DENSE} SELECT station, time, {FEED_COLS} FROM dense",
        "mean24": f"WITH {rolling_ctes(DENSE)} SELECT station, time, "
                  + ", ".join(f"{rd(f'mean24_{c}', 1)} AS {c}" for c in DAY_LONG) + " FROM highest",
        "mean8": f"WITH {rolling_ctes(DENSE)} SELECT station, time, "
                 + ", ".join(f"mean8_{c}" for c in SHORT) + " FROM highest",
        "max8": f"WITH {rolling_ctes(DENSE)} SELECT station, time, "
                + ", ".join(f"max8_{c}" for c in SHORT) + " FROM highest",
        "rolling_index": f"WITH {ROLLING} SELECT {INDEXED} FROM rolling",
        "latest_index": f"WITH {LATEST} SELECT {INDEXED}, {', '.join(f'SI_{p}' for p in INDEX_POLLUTANTS)} FROM recent WHERE time = end_time",
        "trend24": f"WITH {LATEST} SELECT {INDEXED} FROM recent",
        "live_ranking": f"""WITH {LATEST} SELECT CAST(row_number() OVER (ORDER BY AQI_calc DESC, station) AS INT) AS "rank",
            station, time, AQI_calc, Dominant FROM recent WHERE time = end_time AND AQI_calc IS NOT NULL""",
    }


def stream_sql() -> dict[str, str]:
    """The watermark is 2 hours behind the newest reading; an hour is sent when its end is not after it."""
    mark = "(SELECT max(ts) - INTERVAL 2 HOUR FROM events)"
    early_mark = f"(SELECT max(ts) - INTERVAL 2 HOUR FROM events WHERE event_type <> '{LATE_TYPE}')"
    closed = f"time + INTERVAL 1 HOUR <= {mark}"
    kept = f"""(SELECT * FROM events WHERE event_type <> '{LATE_TYPE}'
        OR date_trunc('hour', ts) + INTERVAL 1 HOUR > {early_mark})"""
    rolling = ROLLING.replace(HOURS, f"all_{HOURS}, hours AS (SELECT * FROM all_hours WHERE {closed})", 1)
    return {
        "stream_hourly": f"WITH {HOURS} SELECT station, time, {FEED_COLS} FROM hours WHERE {closed}",
        "stream_rolling_index": f"WITH {rolling} SELECT {INDEXED} FROM rolling",
        "stream_late_count": f"""SELECT count(DISTINCT (user_id % 8, date_trunc('hour', ts))) AS late_station_hours FROM events
            WHERE event_type = '{LATE_TYPE}' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= {early_mark}""",
        "stream_late_rows": f"""WITH hours AS ({HOURLY_SQL.format(events=kept)})
            SELECT station, time, {FEED_COLS} FROM hours WHERE {closed}""",
        "stream_late_rows_set": READINGS_SQL.format(events="events") + f"""
            WHERE event_type = '{LATE_TYPE}' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= {early_mark}""",
        "stream_hours_on_time": f"""WITH hours AS ({HOURLY_SQL.format(events=kept)})
            SELECT station, time, {FEED_COLS} FROM hours
            WHERE time + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM {kept})""",
    }


def city_sql() -> dict[str, str]:
    states = """states AS (SELECT n_name AS City, 'STATE_' || n_regionkey AS State FROM nation WHERE n_regionkey <> 4)"""
    regions = "regions AS (SELECT r_name AS Region, n_name AS City FROM nation JOIN region ON n_regionkey = r_regionkey)"
    rank = 'CAST(row_number() OVER (ORDER BY avg(AQI) DESC, City) AS INT) AS "rank"'
    monthly = unions(f"SELECT City, {m}::INT AS Month, {rd(f'avg(AQI) FILTER (Month = {m})', 0)} AS value "
                     "FROM clean GROUP BY City" for m in range(1, 13))
    season = unions(f"SELECT City, {i}::INT AS slot, {rd(f'avg(AQI) FILTER (Season = {chr(39)}{s}{chr(39)})', 0)} AS value "
                    "FROM clean GROUP BY City" for i, s in enumerate(SEASONS, 1))
    levels = unions(f"SELECT City, '{display_name(p)}' AS pollutant, {rd(f'avg({p})', 2 if p == 'CO' else 1)} AS mean "
                    "FROM clean GROUP BY City" for p in PROFILE_POLLUTANTS)
    shares = unions(
        f"SELECT City, {o}::INT AS ord, '{n}' AS AQI_Bucket, "
        f"coalesce({rd(f'count(*) FILTER (AQI_Bucket = {chr(39)}{n}{chr(39)}) * 100.0 / count(AQI_Bucket)', 1)}, 0.0) AS pct "
        "FROM clean GROUP BY City" for o, n, _, _ in CATEGORIES)
    nice = "strftime({}, '%-d %b %Y')".format
    bad = quoted(["Poor", "Very Poor", "Severe"])
    total = rd("count(*) * 100.0 / (SELECT count(*) FROM clean)", 1)
    limits = ", ".join(f"('{p}', {limit}::DOUBLE, '{unit}')" for p, limit, unit in LIMITS)
    changes = unions(
        f"SELECT '{display_name(c)}' AS measure, before, after, {rd('(after - before) / before * 100', 0)} AS change_pct "
        f"FROM (SELECT {rd(f'avg({c}) FILTER ({IN_BASE})', 1)} AS before, {rd(f'avg({c}) FILTER ({IN_EVENT})', 1)} AS after "
        "FROM clean WHERE City IN (SELECT City FROM comparison))" for c in ("AQI", "PM25", "NO2"))
    return {
        "city_rank": f"WITH {CLEAN} SELECT City, {rank} FROM clean GROUP BY City",
        "city_rank_with_state": f"""WITH {CLEAN}, {states}, r AS (SELECT City, {rank} FROM clean GROUP BY City)
            SELECT City, "rank", coalesce(State, '') AS State FROM r LEFT JOIN states USING (City)""",
        "city_base": f"""WITH {CLEAN} SELECT City, {rd('avg(AQI)', 1)} AS avg, {rd('avg(PM25)', 1)} AS pm25,
            count(*) AS days, min(Date) AS first, max(Date) AS last FROM clean GROUP BY City""",
        "city_display_dates": f"""WITH {CLEAN} SELECT City, {nice('min(Date)')} AS first, {nice('max(Date)')} AS last
            FROM clean GROUP BY City""",
        "city_monthly_array": f"WITH {CLEAN} {monthly}",
        "city_season_array": f"WITH {CLEAN} {season}",
        "city_pollutants": f"WITH {CLEAN} {levels}",
        "city_category_share": f"WITH {CLEAN} {shares}",
        "city_yearly": f"WITH {CLEAN} SELECT City, Year, {rd('avg(AQI)', 0)} AS mean FROM clean GROUP BY City, Year",
        "city_extremes": f"""WITH {CLEAN}, w AS (SELECT City, Date AS worst_day, AQI AS worst_aqi FROM clean
              QUALIFY row_number() OVER (PARTITION BY City ORDER BY AQI DESC, Date) = 1)
            SELECT w.*, best_aqi FROM w JOIN (SELECT City, min(AQI) AS best_aqi FROM clean GROUP BY City) USING (City)""",
        "city_period": f"""WITH {COMPARISON}, all_cities AS (SELECT DISTINCT City FROM clean)
            SELECT City, c.City IS NOT NULL AS known, aqi_base, aqi_event, pm25_base, pm25_event, no2_base, no2_event,
              aqi_change_pct AS change_pct FROM all_cities LEFT JOIN comparison c USING (City)""",
        "region_rollup": f"""WITH {CLEAN}, {regions}, m AS (SELECT City, {rd('avg(AQI)', 1)} AS a FROM clean GROUP BY City)
            SELECT Region, count(*) AS cities, {rd('avg(a)', 1)} AS avg FROM m JOIN regions USING (City) GROUP BY Region""",
        "poor_or_worse": f"""WITH {CLEAN}, s AS (SELECT AQI_Bucket, {total} AS pct FROM clean GROUP BY AQI_Bucket)
            SELECT {rd('sum(pct)', 1)} AS poor_or_worse_pct FROM s WHERE AQI_Bucket IN ({bad})""",
        "city_poor_or_worse": f"""WITH {CLEAN}, s AS ({shares}) SELECT City, {rd('sum(pct)', 1)} AS poor_or_worse_pct
            FROM s WHERE AQI_Bucket IN ({bad}) GROUP BY City""",
        "extreme_months": f"""WITH {CLEAN}, months AS (SELECT Month, {rd('avg(AQI)', 1)} AS v FROM clean GROUP BY Month)
            SELECT (SELECT Month FROM months ORDER BY v DESC, Month LIMIT 1) AS worst_month,
                   (SELECT Month FROM months ORDER BY v, Month LIMIT 1) AS cleanest_month""",
        "city_extreme_months": f"""WITH {CLEAN}, months AS (SELECT City, Month, {rd('avg(AQI)', 0)} AS v
              FROM clean GROUP BY City, Month),
            o AS (SELECT *, row_number() OVER (PARTITION BY City ORDER BY v DESC, Month) AS hi,
                  row_number() OVER (PARTITION BY City ORDER BY v, Month) AS lo FROM months)
            SELECT City, max(Month) FILTER (hi = 1) AS worst_month, max(Month) FILTER (lo = 1) AS cleanest_month
            FROM o GROUP BY City""",
        "limit_exceedance": f"""WITH {CLEAN}, levels AS ({levels}), limits(pollutant, "limit", unit) AS (VALUES {limits})
            SELECT City, pollutant, mean, "limit", unit, mean / "limit" AS ratio,
              coalesce(mean > "limit", false) AS over FROM levels JOIN limits USING (pollutant)""",
        "period_changes": f"WITH {COMPARISON} {changes}",
    }


def day_sql() -> dict[str, str]:
    year, month = MONTH
    spine = """spine AS (SELECT unnest(range(1, 13))::INT AS Month),
        d AS (SELECT CAST(month(Date) AS INT) AS Month, day(Date) AS dom, {} AS v FROM daily
              WHERE City = '%s' AND year(Date) = %d)""" % (CITY, YEAR)
    days = ", ".join(f"max(v) FILTER (dom = {i}) AS d{i}" for i in range(1, 32))
    names = quoted(MONTHS)

    def calendar(value: str) -> str:
        return f"""WITH {DAILY}, {spine.format(value)} SELECT Month, [{names}][Month] AS name, {days}
            FROM spine LEFT JOIN d USING (Month) GROUP BY Month"""

    grid = ", ".join(f"max(AQI_calc) FILTER (day(Date) = {i}) AS d{i}" for i in range(1, 31))
    on_day = f"Date = DATE '{DAY}'"
    counted = """y AS (SELECT City, CAST(year(Date) AS INT) AS Year, count(AQI_calc) AS days FROM daily GROUP BY ALL)"""
    return {
        "busiest_date": f"""WITH {DAILY} SELECT Date, count(AQI_calc) AS cities FROM daily GROUP BY Date
            ORDER BY cities DESC, Date DESC LIMIT 1""",
        "day_snapshot": f"""WITH {STORED}, c AS (SELECT DISTINCT City FROM daily), d AS (SELECT * FROM daily WHERE {on_day}),
            s AS (SELECT c.City, AQI_calc, AQI, Bucket_calc, Dominant, d.City IS NOT NULL AS has_row
                  FROM c LEFT JOIN d ON c.City = d.City),
            p AS (SELECT *, CAST(row_number() OVER (ORDER BY AQI_calc IS NULL, AQI_calc DESC, City) AS INT) AS place FROM s)
            SELECT p.* EXCLUDE (place), CASE WHEN AQI_calc IS NOT NULL THEN place END AS "rank", recalculated,
              CASE WHEN has_row THEN recalculated IS NOT DISTINCT FROM stored_calc END AS "match"
            FROM p LEFT JOIN (SELECT City AS again_city, AQI_calc AS recalculated, stored_calc FROM again WHERE {on_day}) a
              ON again_city = p.City""",
        "day_summary": f"""WITH {STORED}, d AS (SELECT * FROM daily WHERE {on_day} AND AQI_calc IS NOT NULL),
            s AS (SELECT City, AQI_calc, row_number() OVER (ORDER BY AQI_calc DESC, City) AS n,
                  count(*) OVER () AS total FROM d)
            SELECT count(*) AS reporting, {rd('avg(AQI_calc)', 0)} AS mean,
              max(City) FILTER (n = 1) AS worst_city, max(AQI_calc) FILTER (n = 1) AS worst_aqi,
              max(City) FILTER (n = total) AS cleanest_city, max(AQI_calc) FILTER (n = total) AS cleanest_aqi,
              count(*) FILTER (AQI_calc > 200) AS poor_or_worse,
              (SELECT count(*) FROM again WHERE {on_day} AND stored_calc IS NOT NULL
                AND AQI_calc IS NOT DISTINCT FROM stored_calc) AS reconciled FROM s""",
        "month_grid": f"""WITH {DAILY}, c AS (SELECT DISTINCT City FROM daily),
            d AS (SELECT City, Date, AQI_calc FROM daily WHERE year(Date) = {year} AND month(Date) = {month})
            SELECT City, {grid} FROM c LEFT JOIN d USING (City) GROUP BY City""",
        "year_calendar": calendar("AQI_calc"),
        "year_calendar_recorded": calendar("AQI"),
        "city_year_days": f"WITH {DAILY}, {counted} SELECT * FROM y WHERE days > 0",
        "fullest_year": f"""WITH {DAILY}, {counted} SELECT City, Year, days FROM y WHERE days > 0
            QUALIFY row_number() OVER (PARTITION BY City ORDER BY days DESC, Year DESC) = 1""",
        "city_year_stats": f"""WITH {STORED}, o AS (SELECT *, CAST(year(Date) AS INT) AS Year,
              row_number() OVER (PARTITION BY City, year(Date) ORDER BY stored_calc DESC NULLS LAST, Date) AS hi,
              row_number() OVER (PARTITION BY City, year(Date) ORDER BY stored_calc NULLS LAST, Date) AS lo FROM again)
            SELECT City, Year, count(*) AS "rows", count(stored_calc) AS days, {rd('avg(stored_calc)', 0)} AS mean,
              max(stored_calc) FILTER (hi = 1) AS worst_aqi,
              max(Date) FILTER (hi = 1 AND stored_calc IS NOT NULL) AS worst_day,
              max(stored_calc) FILTER (lo = 1) AS cleanest_aqi,
              max(Date) FILTER (lo = 1 AND stored_calc IS NOT NULL) AS cleanest_day,
              count(*) FILTER (AQI_calc IS NOT DISTINCT FROM stored_calc) AS reconciled FROM o GROUP BY City, Year""",
        "city_day_lookup": f"WITH {DAILY} SELECT {STORE_COLS} FROM daily WHERE City = '{CITY}' AND {on_day}",
        "city_day_lookup_stored": f"WITH {DAILY} SELECT {STORE_COLS} FROM daily WHERE City = '{CITY}' AND {on_day}",
    }


def file_sql() -> dict[str, str]:
    panel = ", ".join(["City", "Date", *POLLUTANTS, "AQI", "AQI_Bucket"])
    rows = f"WITH {RAW} SELECT {panel} FROM raw"
    stored = f"WITH {DAILY} SELECT {STORE_COLS} FROM daily"
    day = ", ".join(f"{rd(p, 2)} AS {p}" for p in INDEX_POLLUTANTS)
    return {
        "daily_csv_read": rows,
        "daily_csv_read_inferred": rows,
        "normalized_columns": rows,
        "city_ranking_sql": trend_sql()["city_ranking"],
        "clean_parquet": clean_sql()["clean_panel"],
        "daily_by_city_parquet": stored,
        "daily_by_year_parquet": stored,
        "overview_of_feeds": profile_sql()["overview"],
        "yearly_of_feeds": trend_sql()["yearly"],
        "city_base_of_feeds": city_sql()["city_base"],
        "city_ranking_of_feeds": trend_sql()["city_ranking"],
        "full_coverage_of_feeds": trend_sql()["full_coverage"],
        "one_city_parquet": f"{stored} WHERE City = '{CITY}'",
        "daily_csv_export": f"WITH {DAILY} SELECT {STORE_COLS.replace(' AQI,', ' AQI AS AQI_recorded,')} FROM daily",
        "city_documents": f"""WITH {DAILY} SELECT City, strftime(Date, '%Y-%m-%d') AS date, {day},
            {rd('AQI', 0)} AS recorded, {rd('AQI_calc', 0)} AS calculated FROM daily""",
        "ml_frame": f"WITH {CLEAN} SELECT City, Date, {', '.join(POLLUTANTS)}, AQI FROM clean",
    }


def document_sql() -> dict[str, str]:
    """Nested documents, one column per value."""
    mean = lambda c, cond, d: rd(f"avg({c}) FILTER ({cond})", d)
    shown = lambda cond: rd(mean("AQI", cond, 1), 0)
    nice = "strftime({}, '%-d %b %Y')".format
    share = lambda n, total: rd(f"count(*) FILTER (AQI_Bucket = '{n}') * 100.0 / nullif({total}, 0)", 1)
    months = ", ".join(f"{shown(f'Month = {m}')} AS month_{m}" for m in range(1, 13))
    seasons = ", ".join(f"{shown(f'Season = {quoted([s])}')} AS season_{i}" for i, s in enumerate(SEASONS, 1))
    buckets = ", ".join(f"{share(n, 'count(*)')} AS bucket_{i}" for i, n in enumerate(CATEGORY_NAMES, 1))
    overall = ", ".join(f"{mean(c, cond, 1)} AS {c.lower()}_{name}"
                        for c in ("AQI", "PM25", "NO2") for name, cond in (("base", IN_BASE), ("event", IN_EVENT)))
    city_months = ", ".join(f"{mean('AQI', f'Month = {m}', 0)} AS month_{m}" for m in range(1, 13))
    city_seasons = ", ".join(f"{mean('AQI', f'Season = {quoted([s])}', 0)} AS season_{i}" for i, s in enumerate(SEASONS, 1))
    city_buckets = ", ".join(f"coalesce({share(n, 'count(AQI_Bucket)')}, 0.0) AS bucket_{i}" for i, n in enumerate(CATEGORY_NAMES, 1))
    levels = ", ".join(f"{rd(f'avg({p})', 2 if p == 'CO' else 1)} AS mean_{p}" for p in PROFILE_POLLUTANTS)
    periods = ", ".join(f"CASE WHEN c.City IS NOT NULL THEN c.{m}_{n} END AS {m}_{n}" for m in ("aqi", "pm25", "no2") for n in ("base", "event"))
    check = index_sql()["index_check"].partition("SELECT count(*)")[2]
    return {
        "overview_values": f"""WITH {COMPARISON},
            regions AS (SELECT r_name AS Region, n_name AS City FROM nation JOIN region ON n_regionkey = r_regionkey),
            corrs AS ({CORR_SKIP}), m AS (SELECT City, {rd('avg(AQI)', 1)} AS a FROM clean GROUP BY City),
            by_region AS (SELECT Region, count(*) AS cities, {rd('avg(a)', 1)} AS avg FROM m JOIN regions USING (City) GROUP BY Region),
            source AS (SELECT count(*) AS records, count(DISTINCT City) AS cities, {nice('min(Date)')} AS start,
              {nice('max(Date)')} AS "end" FROM raw),
            panel AS (SELECT count(*) AS clean_records, {rd('avg(AQI)', 1)} AS avg_aqi, {rd('avg(PM25)', 1)} AS avg_pm25,
              {months}, {seasons}, {buckets} FROM clean),
            period AS (SELECT count(DISTINCT City) AS compared, {overall} FROM clean WHERE City IN (SELECT City FROM comparison)),
            drops AS (SELECT City AS drop_city, aqi_change_pct AS drop_pct FROM comparison ORDER BY aqi_change_pct, City LIMIT 1),
            top AS (SELECT pollutant AS top_pollutant, corr AS top_corr FROM corrs ORDER BY corr DESC, pollutant DESC LIMIT 1),
            first_region AS (SELECT Region AS top_region, avg AS top_region_avg, cities AS top_region_cities FROM by_region
              ORDER BY avg DESC, Region DESC LIMIT 1)
            SELECT *, (SELECT count(*) FROM corrs)::INT AS correlated FROM source, panel, period, drops, top, first_region""",
        "dashboard_values": f"""WITH {DAILY}, checked AS (SELECT count(*){check}),
            shares AS (SELECT Dominant, count(*) AS days, {rd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
              FROM daily WHERE Dominant IS NOT NULL GROUP BY Dominant),
            most AS (SELECT Dominant AS most_dominant, days AS most_days, pct AS most_pct FROM shares ORDER BY days DESC, Dominant DESC LIMIT 1)
            SELECT (SELECT count(*) FROM raw) AS records, checked.*, (SELECT count(*) FROM shares)::INT AS dominants, most.* FROM checked, most""",
        "city_profile_values": f"""WITH {COMPARISON},
            states AS (SELECT n_name AS City, 'STATE_' || n_regionkey AS State FROM nation WHERE n_regionkey <> 4),
            base AS (SELECT City, {rd('avg(AQI)', 1)} AS avg, {rd('avg(PM25)', 1)} AS pm25, count(*) AS days,
              {nice('min(Date)')} AS first, {nice('max(Date)')} AS last,
              CAST(row_number() OVER (ORDER BY avg(AQI) DESC, City) AS INT) AS "rank",
              {city_months}, {city_seasons}, {levels}, {city_buckets}, CAST(max(AQI) AS INT) AS worst_aqi,
              CAST(min(AQI) AS INT) AS best_aqi FROM clean GROUP BY City),
            worst AS (SELECT City, {nice('Date')} AS worst_day FROM clean
              QUALIFY row_number() OVER (PARTITION BY City ORDER BY AQI DESC, Date) = 1),
            years AS (SELECT City, Year, {rd('avg(AQI)', 0)} AS mean FROM clean GROUP BY City, Year),
            yearly AS (SELECT City, count(*)::INT AS years, max(Year) AS last_year, arg_max(mean, Year) AS last_mean FROM years GROUP BY City)
            SELECT base.*, coalesce(State, '') AS state, worst_day, yearly.* EXCLUDE (City), {periods},
              CASE WHEN c.City IS NOT NULL THEN c.aqi_change_pct END AS change_pct
            FROM base JOIN worst USING (City) JOIN yearly USING (City) LEFT JOIN states USING (City)
            LEFT JOIN comparison c ON c.City = base.City""",
    }


def model_sql() -> dict[str, str]:
    """The split, and metrics of a prediction that SQL can make; fitted models are beyond it."""
    slot = "('0x' || substr(md5(City || '|' || strftime(Date, '%Y-%m-%d')), 1, 8))::BIGINT % 100"
    parts = f"{CLEAN}, parts AS (SELECT *, {slot} < 80 AS train FROM clean)"
    return {
        "train_test_split": f"""WITH {parts} SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, count(*) AS "rows"
            FROM parts GROUP BY 1""",
        "imputer_medians": " UNION ALL ".join(
            f"SELECT * FROM (WITH {parts} SELECT '{p}' AS pollutant, median({p}) AS median FROM parts WHERE train)" for p in POLLUTANTS),
        "imputed_features": f"""WITH {parts}, known AS (SELECT {', '.join(f'median({p}) AS m_{p}' for p in POLLUTANTS)} FROM parts WHERE train)
            SELECT City, Date, {', '.join(f'coalesce({p}, m_{p}) AS {p}_imp' for p in POLLUTANTS)} FROM parts, known WHERE train""",
        "linear_certificate": f"""WITH {parts}, known AS (SELECT {', '.join(f'median({p}) AS m_{p}' for p in POLLUTANTS)} FROM parts WHERE train),
            filled AS (SELECT {', '.join(f'coalesce({p}, m_{p}) AS {p}_imp' for p in POLLUTANTS)} FROM parts, known WHERE train)
            """ + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS \"rows\", sum({v}) AS total, 0.0::DOUBLE AS cosine FROM filled"
                                    for c, v in [*((f"{p}_imp", f"{p}_imp") for p in POLLUTANTS), ("1", "1.0::DOUBLE")]),
        "actual_vs_baseline": f"""WITH {parts},
            means AS (SELECT City, {rd('avg(AQI)', 6)} AS prediction FROM parts WHERE train GROUP BY City),
            placed AS (SELECT AQI, prediction, row_number() OVER (ORDER BY md5('1|' || City || '|' || strftime(Date, '%Y-%m-%d'))) AS place,
              count(*) OVER () AS n FROM parts JOIN means USING (City) WHERE NOT train)
            SELECT AQI, prediction FROM placed WHERE place <= floor(n * 0.5 + 0.5)""",
        "baseline_metrics": f"""WITH {parts}, means AS (SELECT City, avg(AQI) AS prediction FROM parts WHERE train GROUP BY City),
            scored AS (SELECT AQI, prediction FROM parts JOIN means USING (City) WHERE NOT train)
            SELECT {rd('sqrt(avg((prediction - AQI) * (prediction - AQI)))', 3)} AS "RMSE", {rd('avg(abs(prediction - AQI))', 3)} AS "MAE",
              {rd('1 - sum((prediction - AQI) * (prediction - AQI)) / (var_pop(AQI) * count(*))', 3)} AS "R2" FROM scored""",
    }


def all_sql() -> dict[str, str]:
    return (profile_sql() | clean_sql() | trend_sql() | index_sql() | hourly_sql() | stream_sql() | city_sql()
            | day_sql() | file_sql() | document_sql() | model_sql())
