"""The registered queries as plain SQL over the provided tables, for an independent check."""

from __future__ import annotations

_VIEWS = """
WITH keyed AS (
  SELECT event_id, user_id, ts, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 4 + 1 AS spot,
         (event_id * 7 + user_id * 3) % 79 AS raw_x,
         CAST(floor(value) AS BIGINT) % 53 AS raw_y
  FROM events),
dated AS (
  SELECT 'sh001' AS shopcode,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
         CAST(year(ts) AS INTEGER) AS dt_year, CAST(month(ts) AS INTEGER) AS dt_month, CAST(day(ts) AS INTEGER) AS dt_day,
         CAST(hour(ts) AS INTEGER) AS dt_hour, CAST(minute(ts) AS INTEGER) AS dt_min, CAST(second(ts) AS INTEGER) AS dt_sec,
         CAST(floor(epoch(ts)) AS INTEGER) AS time_stamp,
         'm' || user_id AS mac,
         '10.0.0.' || (user_id % 200) AS ipAddr,
         'L' || spot AS locID, 'F' || spot AS locName,
         CAST(floor(raw_x / 13.1::DOUBLE) AS INTEGER) AS posX,
         CAST(floor(raw_y / 13.1::DOUBLE) AS INTEGER) AS posY,
         raw_x, raw_y, strftime(ts, '%Y%m%d') AS p_dt
  FROM keyed),
folded AS (
  SELECT * REPLACE ('2024-01-15 ' || substr(date_time, 12) AS date_time,
                    2024 AS dt_year, 1 AS dt_month, 15 AS dt_day,
                    CAST(1705276800 + dt_hour * 3600 + dt_min * 60 + dt_sec AS INTEGER) AS time_stamp)
  FROM dated),
ping AS (
  SELECT shopcode, date_time, dt_year, dt_month, dt_day, dt_hour, dt_min, dt_sec, time_stamp,
         mac, ipAddr, locID, locName, posX, posY
  FROM folded),
shop AS (
  SELECT CAST((p_partkey % 35 - p_partkey % 5) / 5 AS INTEGER) AS posx,
         CAST(p_partkey % 5 AS INTEGER) AS posy,
         'F' || CAST((p_partkey - p_partkey % 35) / 35 + 1 AS INTEGER) AS floor,
         CASE p_partkey % 10 WHEN 0 THEN '走道' WHEN 1 THEN '过道' ELSE p_brand END AS name,
         CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE p_type END AS type
  FROM part WHERE p_partkey % 10 <> 2),
listed AS (SELECT 'm' || c_custkey AS mac FROM customer WHERE c_custkey % 20 = 0),
enriched AS (
  SELECT a.*, b.name, b.type
  FROM ping a LEFT JOIN shop b ON a.posX = b.posx AND a.posY = b.posy AND a.locName = b.floor),
clean AS (SELECT * FROM enriched a WHERE NOT EXISTS (SELECT 1 FROM listed c WHERE c.mac = a.mac)),
dw AS (SELECT * FROM clean WHERE dt_hour >= 9 AND dt_hour < 23),
rt AS (SELECT * FROM clean),
mac_dwell AS (SELECT mac, CAST(max(time_stamp) - min(time_stamp) AS BIGINT) AS stay FROM dw GROUP BY mac),
minute_flow AS (
  SELECT CAST(dt_hour AS BIGINT) AS dt_hour, CAST(dt_min AS BIGINT) AS dt_min,
         count(mac) AS all_flow, count(DISTINCT mac) AS all_customer
  FROM rt GROUP BY ALL),
today_flow AS (
  SELECT m.*, CAST(t.stay_time AS DOUBLE) / t.total_mac / 60.0::DOUBLE AS stay_min
  FROM minute_flow m, (SELECT CAST(sum(stay) AS BIGINT) AS stay_time, count(mac) AS total_mac FROM mac_dwell) t),
today_total AS (
  SELECT count(mac) AS all_customer, CAST(CAST(sum(stay) AS BIGINT) // count(mac) AS DOUBLE) / 60.0::DOUBLE AS all_stay
  FROM mac_dwell),
rt_top_shops AS (
  SELECT name AS shop, count(DISTINCT mac) AS flow FROM rt WHERE name <> '走道'
  GROUP BY name ORDER BY flow DESC, shop LIMIT 10),
day_shop_rank AS (
  SELECT name AS shop, count(DISTINCT mac) AS flow FROM dw WHERE name <> '走道' GROUP BY name),
day_top_category AS (
  SELECT type AS catalog, count(DISTINCT mac) AS total FROM dw WHERE type IS NOT NULL AND name <> '走道'
  GROUP BY type ORDER BY total DESC, catalog LIMIT 10),
rt_top_category AS (
  SELECT coalesce(type, '走道') AS catalog, total
  FROM (SELECT type, count(mac) AS total FROM rt WHERE name <> '走道' GROUP BY type)
  ORDER BY total DESC, coalesce(type, '走道'), type IS NULL LIMIT 10),
floor_dwell AS (
  SELECT locName, count(mac) AS total_mac,
         CAST(sum(stay) AS DOUBLE) / 60.0::DOUBLE / count(mac) AS stay_min
  FROM (SELECT locName, mac, max(time_stamp) - min(time_stamp) AS stay FROM dw GROUP BY locName, mac) GROUP BY locName),
floor_shop AS (
  SELECT locName, name, count(DISTINCT mac) AS flow FROM dw
  WHERE name <> '走道' AND name <> '过道' GROUP BY locName, name),
floor_shop_rank AS (
  SELECT * FROM (
    SELECT locName, name, flow, row_number() OVER (PARTITION BY locName ORDER BY flow DESC, name) AS rank FROM floor_shop)
  WHERE rank <= 3),
rt_floor_flow AS (
  SELECT a.locName AS floor, uv, stay_min AS stay, name AS shop, flow
  FROM (SELECT locName, count(DISTINCT mac) AS uv FROM rt GROUP BY locName) a
  JOIN floor_dwell b ON a.locName = b.locName JOIN floor_shop_rank c ON b.locName = c.locName),
floor_minute_flow AS (
  SELECT locName, CAST(dt_hour AS BIGINT) AS dt_hour, CAST(dt_min AS BIGINT) AS dt_min,
         count(DISTINCT CASE WHEN name IS NOT NULL AND type IS NOT NULL
               THEN struct_pack(a := shopcode, b := date_time, c := dt_year, d := dt_month, e := dt_day, f := dt_sec,
                                g := time_stamp, h := mac, i := ipAddr, j := locID, k := posX, l := posY,
                                m := name, n := type) END) AS cnt
  FROM dw GROUP BY ALL),
heat_map AS (
  SELECT locName AS floor, CAST(posX AS BIGINT) AS x, CAST(posY AS BIGINT) AS y, count(DISTINCT mac) AS cnt
  FROM dw GROUP BY ALL HAVING count(DISTINCT mac) > 5),
steps AS (
  SELECT mac, date_time, lag(name) OVER path AS from_name, first_value(name) OVER path AS anchor, name AS to_name
  FROM dw WHERE name IS NOT NULL WINDOW path AS (PARTITION BY mac ORDER BY date_time, name)),
links AS (
  SELECT mac, date_time, from_name, to_name, 1 AS times FROM steps WHERE lower(from_name) <> lower(to_name))
"""

_TAILS = {
    "parse_pings": "SELECT * FROM ping",
    "grid_snap": "SELECT posX, posY, count(*) AS pings FROM ping GROUP BY posX, posY",
    "date_key_parts": """
        SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
               strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, strftime(ts, '%S') AS second,
               strftime(ts, '%Y%m') AS year_month, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%Y/%Y%m/%Y%m%d') AS path
        FROM events""",
    "enrich_shop": "SELECT * FROM enriched",
    "exclude_blacklist": "SELECT * FROM ping a WHERE NOT EXISTS (SELECT 1 FROM listed c WHERE c.mac = a.mac)",
    "wash_day": "SELECT * FROM dw",
    "batch_counts": """
        SELECT (SELECT count(*) FROM ping) AS raw_rows, (SELECT count(*) FROM rt) AS clean_rows""",
    "minute_flow": "SELECT * FROM minute_flow",
    "mac_dwell": "SELECT * FROM mac_dwell",
    "today_flow": "SELECT * REPLACE (round(stay_min, 6) AS stay_min) FROM today_flow ORDER BY dt_hour, dt_min",
    "today_total": "SELECT all_customer, round(all_stay, 6) AS all_stay FROM today_total",
    "rt_top_shops": "SELECT * FROM rt_top_shops",
    "day_shop_rank": "SELECT * FROM day_shop_rank ORDER BY flow DESC, shop",
    "day_shop_trailing": """
        SELECT name AS shop, count(DISTINCT mac) AS flow FROM dw
        WHERE name <> '走道' AND date_time > '2024-01-15 14:50:00' AND date_time <= '2024-01-15 15:00:00' GROUP BY name""",
    "day_top_category": "SELECT * FROM day_top_category",
    "rt_top_category": "SELECT * FROM rt_top_category",
    "floor_dwell": "SELECT locName, total_mac, round(stay_min, 6) AS stay_min FROM floor_dwell",
    "floor_shop_rank": "SELECT * FROM floor_shop_rank",
    "rt_floor_flow": "SELECT * REPLACE (round(stay, 6) AS stay) FROM rt_floor_flow",
    "floor_minute_flow": "SELECT * FROM floor_minute_flow",
    "heat_map": "SELECT * FROM heat_map",
    "brand_link_consecutive": "SELECT * FROM links",
    "brand_link_anchor": """
        SELECT mac, date_time, anchor AS from_name, to_name, 1 AS times FROM steps WHERE lower(anchor) <> lower(to_name)""",
    "brand_link_matrix": """
        SELECT a.from_name, a.to_name, a.times, b.total
        FROM (SELECT from_name, to_name, count(*) AS times FROM links GROUP BY ALL) a
        LEFT JOIN (SELECT from_name, count(*) AS total FROM links GROUP BY ALL) b ON a.from_name = b.from_name""",
}


_STORED = "count(*) AS pings, count(DISTINCT mac) AS macs, CAST(sum(time_stamp) AS BIGINT) AS seconds"

_TAILS |= {
    "scan_day": f"SELECT p_dt, {_STORED} FROM dated WHERE p_dt = '20240115' GROUP BY p_dt",
    "text_scan": """
        SELECT 'spot=' || locName AS directory, count(*) AS lines,
               CAST(sum(length(line)) AS BIGINT) AS chars
        FROM (SELECT locName, concat_ws(',', shopcode, date_time, mac, ipAddr, locID, locName, raw_x, raw_y) AS line
              FROM folded)
        GROUP BY locName""",
    "sink_ods_append": f"""
        SELECT p_dt, {_STORED} FROM (
          SELECT '20240115' AS p_dt, * FROM ping UNION ALL SELECT '20240116', * FROM ping WHERE dt_hour < 12)
        GROUP BY p_dt""",
    "sink_dw_overwrite": f"""
        SELECT p_dt, {_STORED} FROM (SELECT '20240115' AS p_dt, * FROM dw UNION ALL SELECT '20240116', * FROM clean)
        GROUP BY p_dt""",
    "late_data_partition": """
        SELECT '20240131' AS p_dt, p_dt AS event_date, count(*) AS pings FROM dated GROUP BY dated.p_dt""",
    "brand_link_backfill": """
        , dated_dw AS (
          SELECT a.p_dt, a.mac, a.date_time, b.name
          FROM dated a JOIN shop b ON a.posX = b.posx AND a.posY = b.posy AND a.locName = b.floor
          WHERE a.dt_hour >= 9 AND a.dt_hour < 23 AND NOT EXISTS (SELECT 1 FROM listed c WHERE c.mac = a.mac)),
        dated_steps AS (
          SELECT p_dt, mac, date_time, lag(name) OVER (PARTITION BY p_dt, mac ORDER BY date_time, name) AS from_name,
                 name AS to_name
          FROM dated_dw)
        SELECT mac, date_time, from_name, to_name, 1 AS times, p_dt FROM dated_steps
        WHERE lower(from_name) <> lower(to_name)""",
    "stream_minute_flow": """
        SELECT CAST(dt_hour AS BIGINT) AS dt_hour, CAST(dt_min AS BIGINT) AS dt_min,
               count(mac) AS all_flow, count(DISTINCT mac) AS all_customer
        FROM clean GROUP BY dt_hour, dt_min""",
}

# Per metric: the view its rows come from, its value keys as SQL, and its hour and minute.
_PADDED = ("'23'", "'30'")
_DOCUMENTS = {
    "today_flow": ("today_flow", {"count": "all_customer", "staty": "round(stay_min, 6)"}, _PADDED),
    "today_total": ("today_total", {"all_customer": "all_customer", "all_stay": "round(all_stay, 6)"}, _PADDED),
    "rt_max_shop": ("rt_top_shops", {"shop": "shop", "flow": "flow"}, _PADDED),
    "day_max_shop": ("day_shop_rank", {"shop": "shop", "flow": "flow"}, _PADDED),
    "rt_floor_flow": (
        "rt_floor_flow",
        {"floor": "floor", "uv": "uv", "stay": "round(stay, 6)", "shop": "shop", "flow": "flow"},
        _PADDED,
    ),
    "day_catalog": ("day_top_category", {"catalog": "catalog", "total": "total"}, _PADDED),
    "rt_catalog": ("rt_top_category", {"catalog": "catalog", "total": "total"}, _PADDED),
    "floor_day_flow": ("floor_minute_flow", {"floor": "locName", "count": "cnt"}, ("dt_hour", "dt_min")),
    "heat_map": ("heat_map", {"floor": "floor", "x": "x", "y": "y", "count": "cnt"}, _PADDED),
    "brand_link": (f"({_TAILS['brand_link_matrix']})", {c: c for c in ("from_name", "to_name", "times", "total")}, _PADDED),
}


def _entries(bi_name: str, documents: dict[str, tuple] = _DOCUMENTS) -> str:
    table, values, (hour, minute) = documents[bi_name]
    return " UNION ALL ".join(
        f"""SELECT 'sh001' AS mall_id, '20240115' AS p_dt, '2024' AS dt_year, '01' AS dt_month, '15' AS dt_day,
                   CAST({hour} AS VARCHAR) AS dt_hour, CAST({minute} AS VARCHAR) AS dt_min,
                   '{bi_name}' AS bi_name, '{key}' AS key, CAST({sql} AS VARCHAR) AS value FROM {table}"""
        for key, sql in values.items()
    )


_WINDOW = "(SELECT * FROM dw WHERE date_time > '2024-01-15 {}' AND date_time <= '2024-01-15 15:00:00')"
_AT_THREE = ("'15'", "'00'")
_TRAILING = {
    "trailing_shop": (
        f"(SELECT name AS shop, count(DISTINCT mac) AS flow FROM {_WINDOW.format('14:50:00')} WHERE name <> '走道' GROUP BY name)",
        {"shop": "shop", "flow": "flow"},
        _AT_THREE,
    ),
    "trailing_floor": (
        f"(SELECT locName AS floor, count(DISTINCT mac) AS uv FROM {_WINDOW.format('14:50:00')} GROUP BY locName)",
        {"floor": "floor", "uv": "uv"},
        _AT_THREE,
    ),
    "trailing_catalog": (
        f"""(SELECT type AS catalog, count(DISTINCT mac) AS total FROM {_WINDOW.format('14:00:00')}
             WHERE type IS NOT NULL AND name <> '走道' GROUP BY type ORDER BY total DESC, catalog LIMIT 10)""",
        {"catalog": "catalog", "total": "total"},
        _AT_THREE,
    ),
}

_TAILS["stream_trailing"] = " UNION ALL ".join(_entries(name, _TRAILING) for name in _TRAILING)

_TAILS["stream_ledger"] = """
    SELECT kind, messages FROM (
      SELECT 'taken' AS kind, count(*) AS messages FROM ping UNION ALL SELECT 'landed', count(*) FROM ping
      UNION ALL VALUES ('batches', 4), ('origins', 8), ('breaks', 0), ('missed', 0))"""

_DAY = ("today_total", "day_max_shop", "day_catalog", "floor_day_flow", "heat_map", "brand_link")

_TAILS |= {
    "metric_documents": " UNION ALL ".join(_entries(name) for name in _DOCUMENTS),
    "sink_metric_replace": _entries("day_max_shop"),
    "sink_metric_append": _entries("today_flow"),
    "stream_day_metrics": f"""
        SELECT bi_name, key, value FROM ({" UNION ALL ".join(_entries(name) for name in _DAY)})
        UNION ALL
        SELECT 'brand_link', from_name || '>' || to_name, CAST(count(*) AS VARCHAR) FROM links GROUP BY from_name, to_name
        UNION ALL
        SELECT 'status', unnest(['batch_counts', {", ".join(f"'{name}'" for name in _DOCUMENTS)}]), '2'""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _VIEWS + tail for name, tail in _TAILS.items()}
