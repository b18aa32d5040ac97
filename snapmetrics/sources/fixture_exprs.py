"""Fixture projections F6–F8 as SQL expressions valid in both Spark SQL and DuckDB.

They only render test input text from integer columns; the operators under test are written separately in each
engine (DataFrame API in Spark, SQL in the oracle).
"""

from __future__ import annotations

# F6 gazetteer: one settlement per nation (row order = nation key); the source page title as the crawler saw it.
GAZETTEER = [
    "n_name AS name",
    "'Община ' || n_name AS mun",
    "r_name AS region",
    "CASE WHEN n_nationkey % 2 = 0 THEN 'с' ELSE 'гр' END AS settlement_type",
    "CAST(n_nationkey AS DOUBLE) + 0.5 AS lon",
    "CAST(n_regionkey AS DOUBLE) + 0.25 AS lat",
    "n_nationkey AS gorder",
    "'https://places.example/settlement/' || CAST(n_nationkey AS STRING) AS link",
    "n_name || ' - област ' || CASE WHEN n_nationkey = 3 THEN 'София (столица)' ELSE r_name END || ', община '"
    " || CASE WHEN n_nationkey = 3 THEN 'Столична' ELSE n_name END || ', ЕКАТТЕ '"
    " || lpad(CAST(n_nationkey * 37 % 100000 AS STRING), 5, '0') AS title",
    "'<script>var p = {\"longitude\": ' || CAST(n_nationkey AS STRING) || '.5, \"latitude\": '"
    " || CAST(n_regionkey AS STRING) || '.25};</script>' AS page_text",
]

# F6 records: customer places inside the customer's region; some name two nations, some none.
PLACE_RECORDS = [
    "c_custkey AS rid",
    "lower(r_name) AS region",
    "CASE WHEN c_custkey % 11 = 0 THEN 'обл. х, без име, кв. ' || CAST(c_custkey AS STRING)"
    " WHEN c_custkey % 7 = 0 THEN 'обл. х, NATION_' || CAST((c_nationkey + 5) % 25 AS STRING) || ' и ' || n_name"
    " || ', кв. ' || CAST(c_custkey AS STRING)"
    " ELSE 'обл. х, ' || n_name || ', кв. ' || CAST(c_custkey AS STRING) END AS place",
]

# Court cities used to render tender meta text.
_COURT = (
    "CASE c_nationkey % 5 WHEN 0 THEN 'Окръжен съд: Окръжен съд Пловдив' WHEN 1 THEN 'Окръжен съд: Окръжен съд Стара Загора'"
    " WHEN 2 THEN 'Окръжен съд: Окръжен съд Велико Търново' WHEN 3 THEN 'Окръжен съд: Софийски окръжен съд'"
    " ELSE 'Окръжен съд: Софийски градски съд' END"
)

# F7 court tenders (customer): coordinates (nation, nation / 2) so clusters exceed 10 rows.
COURT_TENDERS = [
    "c_custkey AS page_id",
    "'https://sales.example/item' || CAST(c_custkey AS STRING) || '.html' AS link",
    "CAST(c_nationkey AS DOUBLE) AS lon",
    "CAST(c_nationkey AS DOUBLE) / 2 AS lat",
    "'Начална цена:  ' || CAST(CAST(floor(c_acctbal) AS BIGINT) + 10000 AS STRING) || '.00 лв.' AS price_text",
    "' - ' || CAST(c_custkey % 200 + 20 AS STRING) || ' кв.м., гр. Град  ' || n_name"
    " || CASE c_custkey % 5 WHEN 0 THEN chr(10) WHEN 1 THEN chr(13) || chr(10) WHEN 2 THEN chr(9) ELSE '-  ' END"
    " || 'кв. ' || CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 7 = 0 THEN chr(10) ELSE '-' END AS area_and_place",
    f"{_COURT} || ' ЧСИ: Иван Петров-Иванов Срок: от 01.02.2020 до '"
    " || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') || '.' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0')"
    " || '.' || CAST(2019 + c_custkey % 4 AS STRING) || ' Обявяване на: 04.03.2020 10:00' AS meta",
    "CASE c_custkey % 4 WHEN 0 THEN '1/' || CAST(c_custkey % 9 + 2 AS STRING) || ' ид. части от поземлен имот'"
    " WHEN 1 THEN ' ' || CAST(c_custkey % 5 + 1 AS STRING) || '/' || CAST(c_custkey % 7 + 6 AS STRING) || ' от имот'"
    " WHEN 2 THEN 'Самостоятелен обект в сграда' ELSE 'Идеална част от апартамент' END AS description",
    "CASE c_custkey % 3 WHEN 0 THEN 'Апартамент' WHEN 1 THEN 'Къща' ELSE 'Парцел' END AS type",
    "'2021-' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')"
    " AS period_end",
    "'2020-02-01' AS period_start",
    "CAST(floor(c_acctbal) AS BIGINT) + 10000 AS price",
    "CAST(c_custkey % 200 + 20 AS STRING) AS area",
    "'гр. Град ' || n_name AS place",
    "lower(r_name) AS court_short",
]

# F7 tax tenders (supplier): mostly distinct coordinates.
TAX_TENDERS = [
    "s_suppkey AS page_id",
    "'https://tax.example/tender/' || CAST(s_suppkey AS STRING) AS link",
    "CAST(s_nationkey AS DOUBLE) + CAST(s_suppkey % 4 AS DOUBLE) / 10 AS lon",
    "CAST(s_nationkey AS DOUBLE) / 2 AS lat",
    "CAST(floor(s_acctbal) AS BIGINT) + 500 AS price",
    "CAST(s_suppkey % 90 + 10 AS STRING) AS area",
    "'ул. ' || CAST(s_suppkey AS STRING) || ', ' || n_name AS address",
    "lower(r_name) AS region",
    "CASE s_suppkey % 2 WHEN 0 THEN 'Земеделска земя' ELSE 'Жилище' END AS type",
    "'2021-' || lpad(CAST(s_suppkey % 12 + 1 AS STRING), 2, '0') || '-15' AS period_end",
    "'2020-05-01' AS period_start",
    "CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE '1/2' END AS ideal_parts",
]

# F8 store documents (supplier + up to 3 parts each as services).
STORE_BASE = [
    "s_suppkey AS store_id",
    "s_name AS store_name",
    "CASE s_suppkey % 2 WHEN 0 THEN 'Supercenter' ELSE 'Neighborhood Market' END AS store_type",
    "s_suppkey % 3 = 0 AS is_open_24h",
    "CAST(s_nationkey AS DOUBLE) - 100 + CAST(s_suppkey % 1000 AS DOUBLE) / 1000 AS lon",
    "CAST(s_nationkey AS DOUBLE) + 30 + CAST(s_suppkey % 500 AS DOUBLE) / 1000 AS lat",
    "'20' || lpad(CAST(s_suppkey % 20 AS STRING), 2, '0') || '-0' || CAST(s_suppkey % 9 + 1 AS STRING) || '-15' AS opening_date",
    "lpad(CAST(s_suppkey * 7 % 100000 AS STRING), 5, '0') AS postal_code",
    "CAST(s_suppkey AS STRING) || ' Main St' AS street_address",
    "'City ' || CAST(s_nationkey AS STRING) AS city",
    "'ST' || CAST(s_nationkey % 50 AS STRING) AS state",
    "'US' AS country",
    "s_suppkey % 4 = 1 AS can_order_custom_cakes_online",
    "s_suppkey % 10 = 0 AS no_address",
    "s_suppkey % 7 = 0 AS no_services",
]

# F4 attribute lists (part; ``ARR(`` is the engine's array constructor): alternating key/value list (odd length every 17th part) and its Python-repr text.
ATTRIBUTES = [
    "p_partkey AS id",
    "CASE WHEN p_partkey % 17 = 0"
    " THEN ARR('Квадратура', CAST(p_size AS STRING), 'Етаж', CAST(p_partkey % 8 + 1 AS STRING), 'Екстра')"
    " ELSE ARR('Квадратура', CAST(p_size AS STRING), 'Етаж', CAST(p_partkey % 8 + 1 AS STRING)) END AS items",
    "'{''Квадратура'': ''' || CAST(p_size AS STRING) || ''', ''Етаж'': ''' || CAST(p_partkey % 8 + 1 AS STRING)"
    " || '''}' AS details_repr",
]

# F3 extras (part): scraped snippets for the per-source text rules (labels, counters, authors, coordinates, rent).
LISTING_EXTRAS = [
    "p_partkey AS id",
    "CASE WHEN p_partkey % 3 = 0 THEN 'Лозенец ' || CAST(p_partkey AS STRING) || ' (публикувана 30.12.2019)'"
    " ELSE 'Център ' || CAST(p_partkey AS STRING) END AS title_text",
    "CASE p_partkey % 4 WHEN 0 THEN 'Тристаен (В процес на строителство)' WHEN 1 THEN 'Нови апартаменти'"
    " WHEN 2 THEN 'Мезонет (Предварителни продажби)' ELSE 'Двустаен' END AS type_text",
    "CASE WHEN p_partkey % 2 = 0 THEN 'Ново' ELSE '' END AS label_text",
    "CAST(p_partkey % 50 AS STRING) || ' коментара | прочетена ' || CAST(p_partkey * 3 AS STRING) AS meta_line",
    "CAST(p_partkey % 900 AS STRING) || ' пъти' AS views_text",
    "CASE WHEN p_partkey % 2 = 0 THEN '10:21 27 декември 2019 Автор: Иван Петров ' ELSE '10:21 27 декември 2019' END"
    " AS author_meta",
    "CASE WHEN p_partkey % 3 = 1 THEN 'Новини;Мария Иванова' ELSE 'Новини' END AS info",
    "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '23.' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || ',42.'"
    " || lpad(CAST(p_partkey * 7 % 1000 AS STRING), 3, '0') END AS mapn",
    "'{''lat'': 42.' || lpad(CAST(p_partkey * 7919 % 100000000 AS STRING), 8, '0') || ', ''lng'': 23.'"
    " || lpad(CAST(p_partkey * 104729 % 10000000 AS STRING), 7, '0') || '}' AS coord_dict",
    "CASE WHEN p_partkey % 4 = 0 THEN '1 ' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || ',50 €/kk'"
    " WHEN p_partkey % 4 = 1 THEN CAST(p_partkey % 2000 + 300 AS STRING) || ' €/kk' ELSE 'Hinta sopimuksen mukaan' END"
    " AS rent_price",
    "' ' || CAST(p_partkey % 5000 AS STRING) || '.00 лв. депозит' AS deposit_text",
    "ARR('Ново', 'Преглеждания на сайта', CASE WHEN p_partkey % 2 = 0 THEN 'Гараж' ELSE 'Добави в любими' END,"
    " 'Асансьор') AS label_list",
    "CASE WHEN p_partkey % 7 = 0 THEN 'aoi: 123 abc' ELSE 'aoi: Спорт, Футбол ' || CAST(p_partkey AS STRING)"
    " || ' abc Лига' END AS tag_blob",
    "'a' || chr(7) || 'b' || chr(92) || 'c' || CAST(p_partkey AS STRING) AS noisy",
    "'Текст ' || CAST(p_partkey AS STRING) || ' Tweet още' AS cut_text",
    "'Продава гр. София' || CASE p_partkey % 3 WHEN 0 THEN ' - Лозенец ' WHEN 1 THEN ', Център ' ELSE '-' END ||"
    " CASE WHEN p_partkey % 5 = 0 THEN 'По договаряне' ELSE CAST(p_partkey AS STRING) || ' EUR' END AS city_title",
    "ARR('стая', CAST(p_partkey AS STRING)) AS pair_values",
]

# F3, further columns of a staged listing (over ``pk`` and ``n_sp``): labels, availability, description, a date, the price as
# one source shows it (no-break thousands, per-m² prices, ranges, rents, prices on request), and a fee with a leading total.
_NB = "replace(n_sp, ' ', '\u00a0')"
LISTING_MORE = [
    "CASE pk % 3 WHEN 0 THEN 'ново строителство, тухла' WHEN 1 THEN '' ELSE NULL END AS labels",
    "CASE pk % 4 WHEN 0 THEN 'веднага' WHEN 1 THEN '01.0' || CAST(1 + pk % 9 AS STRING) || '.2021' ELSE NULL END AS available_from",
    "'Описание ' || CAST(pk AS STRING) || ', изглед' AS description",
    "'2020-06-' || CAST(10 + pk % 20 AS STRING) AS date",
    f"CASE pk % 8 WHEN 0 THEN {_NB} || ' лв.' WHEN 1 THEN 'Цена при запитване' WHEN 2 THEN CAST(100 + pk % 900 AS STRING) || ' EUR на кв.м' "
    f"WHEN 3 THEN {_NB} || ' – ' || {_NB} || ' EUR' WHEN 4 THEN CAST(100 + pk % 900 AS STRING) || ' лв. на кв.м' "
    "WHEN 5 THEN 'Наем € ' || CAST(100 + pk % 900 AS STRING) || '/месец' WHEN 6 THEN 'Цена по запитване' ELSE n_sp || ' EUR без ДДС' END AS price_site",
    "CAST(pk % 400 AS STRING) || ',20 € / kk (Hoitovastike ' || CAST(pk % 300 AS STRING) || ',15 € / kk)' AS fees_total",
]
