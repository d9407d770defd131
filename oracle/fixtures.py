"""DuckDB CTEs deriving the raw sources from the driver's ``events`` view.

Mirrors playlake.sources.fixtures in SQL (same expressions, DuckDB dialect).
Each function returns CTE text for one part of the data: ``part`` is '' for the
whole table, '_p1' and '_p2' for the events before and from SPLIT on.
"""

from playlake.sources.seed import EVENT_SOURCES

# the days of the table: the first, the one after the last, and the split 19 thirtieths in
START = "(SELECT min(ts)::DATE FROM events)"
END = "(SELECT max(ts)::DATE + 1 FROM events)"
SPLIT = "(SELECT (min(ts)::DATE + CAST((max(ts)::DATE + 1 - min(ts)::DATE) * 19 // 30 AS INTEGER))::TIMESTAMP FROM events)"


def base(q, part: str = "") -> None:
    cond = {"": "TRUE", "_p1": f"ts < {SPLIT}", "_p2": f"ts >= {SPLIT}", "_hot": "TRUE"}[part]
    rows = "events" if part != "_hot" else (
        "(SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)")
    q.add(f"ev_base{part}", f"""
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id // 3 AS dn
  FROM {rows} WHERE {cond}""")


def raw_events(qq, part: str = "") -> None:
    base(qq, part)
    q = "'\"'"

    def js(e: str) -> str:
        return f"{q} || ({e}) || {q}"

    props = " || ".join([
        "'{\"adid\":'", js("CASE WHEN dn % 6 = 4 THEN 'g' || dn ELSE '00000000-0000-0000-0000-000000000000' END"),
        "',\"af_id\":'", js("CASE WHEN dn % 3 = 0 THEN 'af' || dn ELSE '' END"),
        "',\"app_version\":'", js("'1.' || (day(ts) // 10)"),
        "',\"city\":'", js("'city' || (k % 7)"),
        "',\"country\":'", js("CASE WHEN k % 5 = 0 THEN ' ' ELSE 'C' || (k % 4) END"),
        "','",
        "CASE WHEN event_type = 'signup' THEN '\"date_of_birth\":\"1990-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || '\",' ELSE '' END",
        "'\"device_brand\":'", js("'b' || (dn % 4)"),
        "',\"device_id\":'", js("' d' || dn || ' '"),
        "',\"device_model\":{\"nested\":' || dn || '}'",
        "',\"ftue_step\":'", js("CASE WHEN k % 20 = 1 THEN 'territory' ELSE 'none' END"),
        "',\"ftue_value\":'", js("'T' || (k % 3)"),
        "',\"idfa\":\"0000-0000\"'",
        "',\"idfv\":'", js("CASE WHEN dn % 6 = 1 THEN 'v' || dn ELSE '' END"),
        "',\"language\":null'",
        "',\"os_version\":' || CASE WHEN day(ts) >= 15 THEN '15' ELSE '14' END",
        "',\"platform\":'", js("CASE WHEN k % 10 = 0 THEN ' ' ELSE '' END || CASE WHEN dn % 2 = 0 THEN 'Android' ELSE 'iOS' END || CASE WHEN k % 10 = 0 THEN ' ' ELSE '' END"),
        "',\"territory\":'", js("'R' || (k % 3)"),
        "',\"user_id\":'", js("CASE WHEN event_type = 'view' OR dn % 10 = 3 THEN '' ELSE 'u' || user_id END"),
        "'}'",
    ])
    name = ("CASE event_type WHEN 'click' THEN 'Screen View' WHEN 'view' THEN 'App Opened' "
            "WHEN 'signup' THEN 'Registration Completed' WHEN 'purchase' THEN 'Prize Won' ELSE 'Unmapped Event' END")
    idp = ("CASE WHEN event_id % 97 = 0 AND event_id % 50 <> 0 THEN '' "
           "ELSE '\"event_id\":\"e' || event_id || '\",' END")
    qq.add(f"raw_rows{part}", f"""
  SELECT event_id, ts, user_id, event_type, value, k, dn FROM ev_base{part}
  UNION ALL
  SELECT event_id, ts - INTERVAL 1 SECOND, user_id, event_type, value, k, dn FROM ev_base{part} WHERE event_id % 50 = 0""")
    qq.add(f"raw_events{part}", f"""
  SELECT ts AS publish_time,
         '{{' || {idp} || '"event_name":"' || {name} || '","properties":' || {props}
           || ',"timestamp":' || (epoch_us(ts) // 1000) || '}}' AS data
  FROM raw_rows{part}""")


def mmp(q, part: str = "") -> None:
    base(q, part)
    q.add(f"mmp{part}", f"""
  SELECT k % 4 = 3 AS is_organic,
         CAST(ts - to_hours(k) AS VARCHAR) AS installtime,
         CAST(ts AS VARCHAR) AS eventtime,
         CASE k % 4 WHEN 0 THEN 'Facebook Ads' WHEN 1 THEN 'googleadwords_int' WHEN 2 THEN 'unityads_int' ELSE '' END AS mediasource,
         CASE WHEN k % 7 = 0 THEN NULL ELSE 'ch' || (k % 2) END AS channel,
         CASE WHEN k % 11 = 0 THEN NULL ELSE 'c' || (k % 5) END AS campaign,
         CASE WHEN k % 13 = 0 THEN NULL ELSE 'a' || (k % 3) END AS adset,
         'ad' || (k % 6) AS ad, 'video' AS adtype,
         'af' || dn AS appsflyerid, 'g' || dn AS advertisingid, CAST(NULL AS VARCHAR) AS idfa, 'v' || dn AS idfv,
         CASE WHEN dn % 2 = 0 THEN 'Android' ELSE 'iOS' END AS platform,
         ts AS extraction_date
  FROM ev_base{part} WHERE event_type = 'signup'""")


def ads(q) -> None:
    base(q, "")
    q.add("insights", """
  SELECT CAST(ts AS DATE) AS DateStart,
         CASE WHEN k % 17 = 0 THEN NULL ELSE 'c' || (k % 5) END AS CampaignName,
         'a' || (k % 3) AS AdSetName, CAST(k AS BIGINT) AS Clicks, CAST(10 * k AS BIGINT) AS Impressions,
         CAST(value AS DECIMAL(18,6)) AS Spend, CASE WHEN k % 2 = 0 THEN CAST(k AS BIGINT) END AS Reach
  FROM ev_base WHERE event_type = 'click'""")
    q.add("gstats", """
  SELECT ts AS partition_time, CAST(k % 4 AS BIGINT) AS ad_group_id, CAST(k % 6 AS BIGINT) AS campaign_id,
         CAST(k AS BIGINT) AS metrics_clicks, CAST(20 * k AS BIGINT) AS metrics_impressions,
         CAST(round(value * 1000000) AS BIGINT) AS metrics_cost_micros
  FROM ev_base WHERE event_type = 'error'""")
    q.add("gadgroups", """
  SELECT CAST(k % 3 AS BIGINT) AS ad_group_id,
         'a' || (k % 3) || CASE WHEN day(ts) < 25 THEN '_old' ELSE '' END AS ad_group_name, ts AS partition_time,
         CASE WHEN k % 11 <> 0 THEN CAST(k % 6 AS BIGINT) END AS campaign_id
  FROM ev_base WHERE event_type = 'view'""")
    q.add("gcampaigns", """
  SELECT CAST(k % 5 AS BIGINT) AS campaign_id,
         'c' || (k % 5) || CASE WHEN day(ts) < 25 THEN '_old' ELSE '' END AS campaign_name, ts AS partition_time
  FROM ev_base WHERE event_type = 'purchase'""")


def seed(q) -> None:
    rows = ", ".join(f"('{n}', '{s}')" for n, s in EVENT_SOURCES)
    q.add("seed", f"SELECT * FROM (VALUES {rows}) AS t(event_name, event_source)")
