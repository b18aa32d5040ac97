"""The same fixtures F1–F9 as DuckDB SQL CTE bodies, for the oracle queries in ``oracle_sql()``.

Written independently of the Spark derivation (plain windows, no chunking) so that the oracle also checks the
balanced operators.
"""

from __future__ import annotations

from snapmetrics.sources.fixture_exprs import LISTING_MORE

F1_SNAPSHOTS = """
snapshots AS (
  SELECT
    event_id AS snapshot_id,
    's' || CAST(user_id % 5 AS VARCHAR) AS site,
    'https://s' || CAST(user_id % 5 AS VARCHAR) || '.example.bg/a/' || CAST(user_id AS VARCHAR) AS link,
    't' || CAST(user_id AS VARCHAR) AS title,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN '' ELSE event_type || ' - k' || CAST(k % 7 AS VARCHAR) END AS tags,
    event_type AS category,
    CAST(SUM(v) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS views,
    CAST(SUM(k) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS comments,
    strftime(MIN(ts) OVER (PARTITION BY user_id), '%Y-%m-%d %H:%M:%S') AS created_timestamp,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS visited_timestamp
  FROM (
    SELECT event_id, ts, user_id, event_type,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS v
    FROM events
  ) e
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"

F5_COMPANIES = """
companies AS (
  SELECT n_name AS symbol, 'Company ' || CAST(n_nationkey AS VARCHAR) AS name,
    CAST(n_nationkey + 1 AS DOUBLE) AS weight,
    '{' || concat_ws(', ',
      CASE WHEN n_nationkey % 12 <> 0 THEN '"sector": "' || r_name || '"' END,
      CASE WHEN n_nationkey % 9 <> 0 THEN '"marketCap": ' ||
        CAST(CAST(n_nationkey + 1 AS BIGINT) * 1000000000 + CAST(n_nationkey AS BIGINT) * 12345678 AS VARCHAR) END,
      '"shortName": "S' || CAST(n_nationkey AS VARCHAR) || '"',
      '"longName": "Long ' || n_name || '"',
      '"longBusinessSummary": "Summary of ' || n_name || '"') || '}' AS details
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

F5_PRICES = """
prices AS (
  SELECT n_name AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS at_date,
    CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS volume,
    arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS at_open,
    arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS at_close,
    arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS at_close_adj,
    max(o_totalprice) AS high, min(o_totalprice) AS low
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2
)"""

_MW = "['януари','февруари','март','април','май','юни','юли','август','септември','октомври','ноември','декември']"
_MWORD = (
    f"CASE (pk // 12) % 3 WHEN 0 THEN {_MW}[m] WHEN 1 THEN substr({_MW}[m], 1, 3)"
    f" ELSE upper(substr({_MW}[m], 1, 1)) || substr({_MW}[m], 2, 2) || '.' END"
)

F3_BASE = """
lbase AS (
  SELECT p_partkey AS pk, p_size AS sz,
    CAST(p_partkey % 400 + 50 AS VARCHAR) || ' ' || lpad(CAST(p_size * 17 % 1000 AS VARCHAR), 3, '0') AS n_sp,
    CASE p_partkey % 4 WHEN 0 THEN 'www.listings-a.bg' WHEN 1 THEN 'www.etuovi.com' WHEN 2 THEN 'www.vuokraovi.com'
      ELSE 'www.listings-b.bg' END AS host,
    CASE p_partkey % 6 WHEN 0 THEN ' 1-стаен апартамент' WHEN 1 THEN '2-стаен апартамент'
      WHEN 2 THEN '3-СТАЕН апартамент ' WHEN 3 THEN '4-стаен апартамент' WHEN 4 THEN 'Мезонет' ELSE 'Къща' END AS type_raw,
    CASE p_partkey % 3 WHEN 0 THEN 'гр. София, Лозенец / близо до център' WHEN 1 THEN 'Софийска област, Банкя'
      ELSE 'България, с. Герман ' || CAST(p_partkey % 10 AS VARCHAR) END AS place_raw,
    CAST(p_partkey % 28 + 1 AS INTEGER) AS d, CAST(p_partkey % 12 + 1 AS INTEGER) AS m,
    CAST(2019 + p_partkey % 2 AS INTEGER) AS y,
    lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') AS hh, lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') AS mi
  FROM part
)"""

F3_LISTINGS = F3_BASE + """,
listings AS (
  SELECT pk, d, m, y, hh, mi, sz, n_sp,
    'https://' || host || '/offer/' || CAST(pk % 500 AS VARCHAR) AS link,
    CAST(pk AS VARCHAR) AS id, type_raw AS type, 'София' AS city, place_raw AS place,
    CASE WHEN pk % 5 = 0 THEN 'Друг адрес' ELSE 'София, ' || place_raw || ', бл. ' || CAST(pk AS VARCHAR) END AS address,
    CASE pk % 2 WHEN 0 THEN 'True' ELSE 'False' END AS is_for_sale,
    CASE pk % 5 WHEN 0 THEN 'при запитване' WHEN 1 THEN n_sp || ' лв.' WHEN 2 THEN n_sp || ' EUR'
      WHEN 3 THEN ' ' || n_sp ELSE n_sp || ' лв. без ДДС' END AS price,
    CASE pk % 3 WHEN 0 THEN CAST(pk % 900 + 100 AS VARCHAR) || '.5 лв./кв.м'
      WHEN 1 THEN CAST(pk % 900 + 100 AS VARCHAR) || ' EUR/кв.м'
      ELSE CAST(pk % 900 + 100 AS VARCHAR) || ' ЛВ/кв.м' END AS price_sqm,
    CAST(sz AS VARCHAR) || ' кв.м' AS area,
    CASE pk % 4 WHEN 0 THEN 'партер' WHEN 1 THEN ' Сутерен' WHEN 2 THEN CAST(pk % 8 + 1 AS VARCHAR) || ' от 8'
      ELSE NULL END AS floor,
    '"{""rooms"": ' || CAST(pk % 5 AS VARCHAR) || ', ""lift"": ""' || CASE WHEN pk % 2 = 0 THEN 'да' ELSE 'не' END
      || '""}"' AS details,
    CASE WHEN pk % 5 = 0 THEN 'n/a' ELSE 'Строителство ' || CAST(1950 + pk % 70 AS VARCHAR) || ' г.' END AS year,
    CAST(pk % 1000 AS VARCHAR) || ' пъти' AS views,
    'Продава ' || type_raw || '   София' AS title,
    CASE pk % 4 WHEN 0 THEN CAST(d AS VARCHAR) || ' ' || MWORD || ' ' || CAST(y AS VARCHAR) || ', ' || hh || ':' || mi
      WHEN 1 THEN hh || ':' || mi || ', ' || CAST(d AS VARCHAR) || ' ' || MWORD || ' ' || CAST(y % 100 AS VARCHAR)
      WHEN 2 THEN hh || ':' || mi || ' на ' || CAST(d AS VARCHAR) || ' ' || MWORD || ', ' || CAST(y AS VARCHAR) || ' год.'
      ELSE lpad(CAST(d AS VARCHAR), 2, '0') || '.' || lpad(CAST(m AS VARCHAR), 2, '0') || '.' || CAST(y AS VARCHAR)
        || ' ' || hh || ':' || mi END AS date_text,
    '23,' || lpad(CAST(pk % 1000 AS VARCHAR), 3, '0') AS lon,
    '42,' || lpad(CAST(pk * 7 % 1000 AS VARCHAR), 3, '0') AS lat,
    '2020-07-' || CAST(10 + pk % 10 AS VARCHAR) AS measurement_day,
    '07' || CAST(10 + pk % 10 AS VARCHAR) || '_listings.tsv' AS file_name,
    CAST(pk % 900 + 100 AS VARCHAR) || ' ' || lpad(CAST(pk % 1000 AS VARCHAR), 3, '0') || ',' ||
      lpad(CAST(pk % 100 AS VARCHAR), 2, '0') || ' €' AS price_eu,
    'Hoitovastike ' || CAST(pk % 300 AS VARCHAR) || ',' || lpad(CAST(pk % 100 AS VARCHAR), 2, '0') ||
      ' € / kk Rahoitusvastike ' || CAST(pk % 90 AS VARCHAR) || ',50 € / kk' AS fees,
    CASE pk % 3 WHEN 0 THEN 'Цена: ' || n_sp || ' BGN' WHEN 1 THEN 'Цена: ' || n_sp || ' EUR'
      ELSE 'Цена при запитване' END AS price_alt,
    MORE
  FROM lbase
)""".replace("MWORD", _MWORD).replace("MORE", ",\n    ".join(LISTING_MORE))
