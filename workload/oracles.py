"""DuckDB SQL with the same result as each registered query, written independently of it."""

from __future__ import annotations

import re

D = "DATE '2024-01-31'"
# The lists, limits, ranks and product groups below must equal the library's defaults.
TRUSTED = (
    "('api_azsgo','api_azsopti','api_yandex_fuel','api_benzuber','api_yandex_other','manual_app','manual_manual',"
    "'manual_ppr','manual_gazprom','api_licard','api_gpn','api_lukoil','api_sng')"
)
UNTRUSTED = "('api_ppr','api_rncard','manual_other','manual_phone','api_fuelup')"
REPLACEABLE = "('api_ppr','api_rncard','api_yandex_other','api_fuelup')"
REPLACING = (
    "('api_azsgo','api_benzuber','api_yandex_fuel','api_azsopti','api_licard','api_gpn','api_lukoil','api_sng')"
)
AUTOMATIC = "('api_yandex_fuel','api_azsgo','api_benzuber','api_azsopti','api_licard')"
OTHER = "('api_yandex_other','api_rncard','api_ppr')"
MANUAL = (
    "('manual_app','manual_gazprom','manual_gpn','manual_manual','manual_other','manual_phone','manual_ppr')"
)
DIESEL = "(176, 181, 182, 183, 184)"
ACTIVE = "('Действующая', 'Реконструкция', 'Ведомственная')"

CTES: dict[str, str] = {}

# --- fixture views ---------------------------------------------------------------------

CTES["obs_raw"] = """
SELECT station_id, product_id, source, price, show_in_report, age_days FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id, product_id, source
                              ORDER BY price, show_in_report, ln, pk, age_days) AS rn FROM (
  SELECT l_orderkey AS station_id,
   CASE l_partkey % 12 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 41 WHEN 4 THEN 173 WHEN 5 THEN 174
        WHEN 6 THEN 176 WHEN 7 THEN 177 WHEN 8 THEN 181 WHEN 9 THEN 182 WHEN 10 THEN 178 ELSE 999 END AS product_id,
   CASE (l_orderkey + CASE WHEN l_linenumber <= 3 THEN 0 ELSE 5 END) % 10
        WHEN 0 THEN 'api_ppr' WHEN 1 THEN 'api_yandex_fuel' WHEN 2 THEN 'api_rncard' WHEN 3 THEN 'api_azsgo'
        WHEN 4 THEN 'manual_app' WHEN 5 THEN 'api_gpn' WHEN 6 THEN 'api_benzuber' WHEN 7 THEN 'api_azsopti'
        WHEN 8 THEN 'manual_phone' ELSE 'api_yandex_other' END AS source,
   l_linenumber AS ln, l_partkey AS pk,
   CASE WHEN l_partkey % 12 = 10 THEN CAST(9 + l_suppkey % 5 AS DOUBLE)
        WHEN l_suppkey % 20 = 0 THEN CAST(5 AS DOUBLE)
        ELSE CAST(520 + (l_suppkey % 4) * 60 AS DOUBLE) / 10 END AS price,
   CASE WHEN l_orderkey % 4 = 0 THEN 'f' WHEN l_linenumber <= 3 AND l_partkey % 5 <> 0 THEN 't'
        WHEN l_linenumber > 3 AND l_orderkey % 11 = 0 THEN 't' ELSE 'f' END AS show_in_report,
   CASE WHEN l_quantity <= 35 THEN 0 ELSE CAST(l_partkey % 28 AS INT) END AS age_days
  FROM lineitem)) WHERE rn = 1"""
CTES["obs"] = f"""
SELECT station_id, CAST(product_id AS BIGINT) AS product_id, source, price, show_in_report, age_days,
 CAST({D} - age_days AS DATE) AS date_upd,
 CAST(CAST({D} - age_days AS DATE) AS TIMESTAMP) + INTERVAL 10 HOURS AS updated_at,
 CAST(0 AS BIGINT) AS updated_by_id FROM obs_raw"""
CTES["full"] = f"""
SELECT station_id, product_id, source, price, show_in_report, CAST({D} - age_days AS DATE) AS date_upd,
 CAST(CAST({D} - age_days AS DATE) AS TIMESTAMP) + INTERVAL 10 HOURS AS updated_at, CAST(0 AS BIGINT) AS updated_by_id FROM (
 SELECT l_orderkey AS station_id,
  CAST([2, 3, 4, 41, 42, 133, 139, 156, 173, 174, 175, 176, 177, 178, 179, 181, 182, 183, 184, 189, 204, 308, 332, 999,
   1000][(l_orderkey * 3 + l_linenumber // 2) % 25 + 1] AS BIGINT) AS product_id,
  ['api_azsopti', 'api_benzuber', 'api_fuelup', 'api_gpn', 'api_licard', 'api_lukoil', 'api_ppr', 'api_rncard', 'api_sng',
   'api_yandex_fuel', 'api_yandex_other', 'manual_app', 'manual_gazprom', 'manual_manual', 'manual_other', 'manual_phone',
   'manual_ppr', 'api_azsgo', 'api_unranked'][(l_orderkey + CASE WHEN l_linenumber <= 4 THEN 0 ELSE 5 END) % 19 + 1] AS source,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN CAST(60 AS DOUBLE)
       ELSE CAST(200 + l_suppkey * 7 % 100 * 10 AS DOUBLE) / 10 END AS price,
  CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 'f' WHEN l_partkey % 4 <> 0 THEN 't' ELSE 'f' END AS show_in_report,
  CASE WHEN l_quantity <= 25 THEN 0 ELSE CAST(l_partkey % 70 AS INT) END AS age_days FROM lineitem)"""
CTES["fullsnap"] = """
SELECT station_id, product_id, price, source, CASE WHEN show_in_report = 't' THEN 't' ELSE 'f' END AS show_in_report, date_upd FROM full_"""
CTES["full_"] = CTES.pop("full")
CTES["lim"] = """
SELECT * FROM (VALUES (2,46.55,97), (3,40.05,97), (4,50.5,97), (41,50.5,97), (42,33,85), (173,50.5,97),
 (174,46.55,97), (175,40.5,97), (176,46,110), (139,40.1,95), (177,46,110), (184,46,110), (178,10,40), (179,11,45),
 (181,46.1,110), (182,46.1,110), (183,46.1,110), (189,45.1,75), (204,45.1,70), (133,45.1,70), (156,45.1,60),
 (308,25,50), (332,20,80)) AS t(product_id, lo, hi)"""
CTES["rnk"] = """
SELECT * FROM (VALUES ('api_gpn',1), ('api_azsopti',2), ('api_benzuber',3), ('api_yandex_fuel',4), ('api_licard',5),
 ('api_lukoil',6), ('api_sng',7), ('api_rncard',10), ('api_fuelup',11), ('api_ppr',12), ('manual_manual',13),
 ('manual_app',14), ('manual_phone',15), ('manual_ppr',16), ('manual_gazprom',17), ('manual_other',18),
 ('api_yandex_other',19)) AS t(source, rate)"""
CTES["grp"] = """
SELECT * FROM (VALUES (2,'a'), (174,'a'), (3,'b'), (175,'b'), (4,'c'), (41,'c'), (173,'c'), (176,'d'), (177,'d'),
 (181,'d'), (182,'d'), (183,'d'), (204,'d')) AS t(product_id, fuel)"""
CTES["link"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE o_orderkey + 2 END AS station_id,
 CASE o_custkey % 5 WHEN 0 THEN 'client' WHEN 1 THEN 'demo' WHEN 2 THEN 'trial' WHEN 3 THEN 'lead'
      ELSE 'archived' END AS status,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey + 1 END AS competitor_station_id
FROM orders WHERE o_orderkey % 5 = 0"""
CTES["client"] = "SELECT id, station_id, competitor_station_id FROM link WHERE status IN ('client', 'demo', 'trial')"
CTES["protected"] = """
SELECT competitor_station_id AS station_id FROM client WHERE competitor_station_id IS NOT NULL
UNION SELECT station_id FROM client"""
CTES["geo"] = """
SELECT c_custkey AS id, c_mktsegment AS owner_type,
 CASE c_custkey % 9 WHEN 0 THEN 'АЗС' WHEN 1 THEN 'АЗК' WHEN 2 THEN 'АГЗС' WHEN 3 THEN 'АГНКС' WHEN 4 THEN 'МАГЗС'
      WHEN 5 THEN 'КриоАЗС' WHEN 6 THEN 'МАЗК' WHEN 7 THEN 'МАЗС' ELSE 'Нефтебаза' END AS type,
 CASE c_custkey % 8 WHEN 0 THEN 'Реконструкция' WHEN 1 THEN 'Ведомственная' WHEN 2 THEN 'Закрыта'
      ELSE 'Действующая' END AS status_gs,
 CAST(c_custkey AS VARCHAR) AS owner_number, c_nationkey AS brand_id,
 CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 25 END AS affiliation_id, c_nationkey % 5 AS region_id,
 CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'M-' || CAST(c_custkey % 12 AS VARCHAR) END AS road_number,
 CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 900 END AS road_km,
 CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Нет_данных' WHEN 2 THEN '' ELSE 'Левая' END AS side,
 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'City' || CAST(c_custkey % 40 AS VARCHAR) END AS city,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '' END AS locality,
 CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'Main st' END AS street,
 CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(c_custkey % 50 AS VARCHAR) END AS building,
 CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN '' ELSE
  CAST(41 + (c_custkey * 7919 % 30000) // 1000 AS VARCHAR) || '.' ||
  lpad(CAST(c_custkey * 7919 % 1000 AS VARCHAR), 3, '0') || ', ' ||
  CAST(20 + (c_custkey * 104729 % 160000) // 1000 AS VARCHAR) || '.' ||
  lpad(CAST(c_custkey * 104729 % 1000 AS VARCHAR), 3, '0') END AS gps_var
FROM customer"""
CTES["pts"] = f"""
SELECT id, CAST(trim(split_part(gps_var, ',', 1)) AS DOUBLE) AS lat, CAST(trim(split_part(gps_var, ',', 2)) AS DOUBLE) AS lon
FROM geo WHERE status_gs IN {ACTIVE} AND gps_var <> ''"""
CTES["addr"] = """
SELECT id, CASE WHEN right(a, 1) = ',' THEN left(a, length(a) - 1) ELSE a END AS address FROM (
 SELECT id, trim(
  CASE WHEN coalesce(road_number, '') = '' THEN '' ELSE road_number || ', ' END ||
  CASE WHEN road_km IS NULL THEN '' ELSE CAST(road_km AS VARCHAR) || ' км, ' END ||
  CASE WHEN coalesce(side, '') IN ('', 'Нет_данных') THEN '' ELSE side || ', ' END ||
  CASE WHEN coalesce(city, '') = '' THEN '' ELSE city || ', ' END ||
  CASE WHEN coalesce(locality, '') = '' THEN '' ELSE locality || ', ' END ||
  CASE WHEN coalesce(street, '') = '' THEN '' ELSE street || ', ' END ||
  coalesce(building, '')) AS a FROM geo)"""
CTES["type_class"] = """
SELECT * FROM (VALUES ('АЗС', 1), ('АЗК', 1), ('АГЗС', 2), ('АГНКС', 2), ('МАГЗС', 2), ('КриоАЗС', 2), ('МАЗК', 3),
 ('МАЗС', 3)) AS t(named, class)"""
CTES["cls"] = """
SELECT id, type, coalesce(class, 0) AS class FROM geo LEFT JOIN type_class ON named = type"""
CTES["dir"] = f"""
SELECT geo.id AS id_parcon, owner_type AS type_1, geo.type AS type_azs, class AS "check", b1.n_name AS brand,
 b2.n_name AS affilation, owner_number AS number, status_gs AS status, r_name AS region, address, gps_var AS gps
FROM geo JOIN cls ON cls.id = geo.id JOIN addr ON addr.id = geo.id
LEFT JOIN nation b1 ON b1.n_nationkey = brand_id LEFT JOIN nation b2 ON b2.n_nationkey = affiliation_id
LEFT JOIN region ON r_regionkey = region_id WHERE status_gs IN {ACTIVE}"""
CTES["ranked"] = """
SELECT point1, point2, km, ROW_NUMBER() OVER (PARTITION BY point1 ORDER BY km, point2) AS rank FROM (
 SELECT p.id AS point1, q.id AS point2,
  round(2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians(q.lat) - radians(p.lat)) / 2), 2) +
   cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin((radians(q.lon) - radians(p.lon)) / 2), 2)))), 6) AS km
 FROM pts p CROSS JOIN pts q)"""
CTES["near"] = "SELECT * FROM ranked WHERE rank <= 5"
CTES["classed"] = """
SELECT point1, point2, rank, a.class AS client_check, b.class AS comp_check
FROM near JOIN cls a ON a.id = point1 JOIN cls b ON b.id = point2
WHERE (a.class = 1 AND b.class IN (1, 3)) OR (a.class = 2 AND b.class IN (2, 3)) OR (a.class = 3 AND b.class IN (1, 2, 3))"""
CTES["source_class"] = "\nUNION ALL ".join(
    f"SELECT unnest({names.replace('(', '[').replace(')', ']')}) AS named, {number} AS class"
    for number, names in enumerate((MANUAL, AUTOMATIC, OTHER))
)
CTES["psrc"] = f"""
SELECT DISTINCT o_custkey AS parcon_id, source, class AS type_source
FROM obs JOIN orders ON o_orderkey = station_id JOIN source_class ON named = source WHERE date_upd = {D}"""
CTES["bestclass"] = """
SELECT parcon_id, type_source, source_count FROM (
 SELECT parcon_id, type_source, count(*) AS source_count,
  ROW_NUMBER() OVER (PARTITION BY parcon_id ORDER BY type_source) AS rn FROM psrc GROUP BY parcon_id, type_source)
WHERE rn = 1"""
CTES["reg"] = """
SELECT CAST(c_custkey AS VARCHAR) AS itn, c_custkey AS n, c_custkey % 11 <> 0 AS found, c_name AS name,
 c_custkey % 3 = 0 AS person, c_mktsegment AS address,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1600000000000 + c_custkey * 86400123 END AS millis FROM customer"""
CTES["payloads"] = """
SELECT itn, CASE WHEN NOT found THEN '[]' ELSE '[{"value":"' || name || '","data":{"type":"' ||
 CASE WHEN person THEN 'INDIVIDUAL' ELSE 'LEGAL' END || '",' ||
 CASE WHEN person THEN '"fio":{"surname":"S' || itn || '","name":"N"' ||
   CASE WHEN n % 2 = 0 THEN ',"patronymic":"P"' ELSE '' END || '}'
  ELSE '"management":{"name":"Dir ' || itn || '"}' END ||
 ',"address":{"unrestricted_value":"' || address || '"},"phones":null,"state":{"status":"' ||
 CASE n % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'LIQUIDATING' WHEN 2 THEN 'LIQUIDATED' WHEN 3 THEN 'BANKRUPT'
  ELSE 'REORGANIZING' END || '"' ||
 CASE WHEN millis IS NULL THEN '' ELSE ',"actuality_date":' || CAST(millis AS VARCHAR) END ||
 '},"okved":"' || CAST(n % 99 AS VARCHAR) || '"}}]' END AS payload FROM reg"""
CTES["latest"] = """
SELECT reg.*, n % 13 = 0 AS broken, n % 10 = 0 AS again, CASE WHEN n % 10 = 0 THEN payload WHEN n % 13 = 0 THEN '[{"broken"' ELSE
 '[{"data":{"phones":' || CASE n % 6 WHEN 0 THEN 'null' WHEN 1 THEN '[]' WHEN 2 THEN '["+7 1", "+7 2"]'
  WHEN 3 THEN '[{"value":"+7 3","kind":"work"},{"value":null},null,{"value":"+7 4"}]' WHEN 4 THEN '"+7 5"' ELSE '[7]' END ||
 CASE n % 4 WHEN 0 THEN '' WHEN 1 THEN ',"emails":[{"value":"a@b.c"},"d@e.f"]' ELSE ',"emails":["only@one.x"]' END ||
 ',"okved":' || CASE n % 2 WHEN 0 THEN '["1.1","1.2"]' ELSE '"2"' END ||
 ',"kpp":' || CASE n % 3 WHEN 0 THEN '["k1"]' WHEN 1 THEN '770101' ELSE 'null' END || '},"value":"later"}]' END AS payload
FROM reg JOIN payloads USING (itn)"""
CTES["ids"] = "SELECT CAST(o_custkey + o_orderkey % 3 * 1000 AS VARCHAR) AS itn FROM orders"
CTES["company"] = """
SELECT i.itn, CASE WHEN found THEN name ELSE '' END AS name,
 CASE WHEN NOT coalesce(found, false) THEN NULL WHEN person THEN 'ИП' ELSE 'ЮЛ' END AS type,
 CASE WHEN found THEN address ELSE '' END AS address,
 CASE WHEN found THEN NULL ELSE '' END AS phone, '' AS email,
 CASE WHEN NOT coalesce(found, false) THEN NULL ELSE
  CASE n % 5 WHEN 0 THEN 'действующая' WHEN 1 THEN 'ликвидируется' WHEN 2 THEN 'ликвидирована' WHEN 3 THEN 'банкротство'
   ELSE 'В процессе присоединения' END END AS status_itn,
 CASE WHEN found THEN strftime(TIMESTAMP '1970-01-01' + to_seconds(millis // 1000), '%Y-%m-%d %H:%M:%S') END AS updated_date,
 CASE WHEN found THEN CAST(n % 99 AS VARCHAR) ELSE '' END AS okved, '' AS kpp,
 CASE WHEN NOT coalesce(found, false) THEN '' WHEN person AND n % 2 = 0 THEN 'S' || i.itn || ' N P'
  WHEN person THEN 'S' || i.itn || ' N' ELSE 'Dir ' || i.itn END AS full_name_director
FROM (SELECT DISTINCT itn FROM ids) i LEFT JOIN reg ON reg.itn = i.itn"""


# --- rules over a snapshot -------------------------------------------------------------


def rule_ctes(snap: str, x: str) -> None:
    """CTEs of all rules over snapshot ``snap``; their names end in ``x``."""

    def change(rule, flag, body, source="source", product="NULL", start="NULL", end="NULL", only="NULL"):
        def as_date(d):
            return "CAST(NULL AS DATE)" if d == "NULL" else f"CAST({d} AS DATE)"

        CTES[f"{rule}{x}"] = (
            f"SELECT '{rule}' AS rule, station_id, CAST({source} AS VARCHAR) AS source, "
            f"CAST({product} AS BIGINT) AS product_id, {as_date(start)} AS from_date, {as_date(end)} AS to_date, "
            f"CAST({only} AS VARCHAR) AS only_flag, '{flag}' AS new_flag FROM {body}"
        )

    for name, sources, days in (("trusted", TRUSTED, 6), ("untrusted", UNTRUSTED, 16)):
        CTES[f"exp_{name}{x}"] = f"""
SELECT DISTINCT station_id, source FROM {snap}
WHERE source IN {sources} AND show_in_report = 't' AND date_upd < {D} - {days}"""
        change(f"off_expired_{name}", "f", f"exp_{name}{x}", end=f"{D} - {days}")

    CTES[f"dark{x}"] = f"""
SELECT DISTINCT station_id FROM {snap} a WHERE show_in_report = 'f' AND price > 0 AND date_upd = {D}
AND NOT EXISTS (SELECT 1 FROM {snap} b WHERE b.station_id = a.station_id AND b.show_in_report = 't')"""
    CTES[f"firstprice{x}"] = f"""
SELECT station_id, source, product_id, min(price) AS fp FROM {snap} GROUP BY station_id, source, product_id"""
    CTES[f"verdict{x}"] = f"""
SELECT s.station_id, s.source, s.product_id, s.date_upd, s.show_in_report,
 coalesce(fp <= coalesce(lo, 35) OR fp >= coalesce(hi, 110), false) AS bad_open,
 coalesce(fp BETWEEN coalesce(lo, 35) AND coalesce(hi, 110), false) AS ok_closed
FROM {snap} s JOIN firstprice{x} f ON f.station_id = s.station_id AND f.source = s.source AND f.product_id = s.product_id
LEFT JOIN lim ON lim.product_id = s.product_id"""
    CTES[f"quality{x}"] = f"""
SELECT station_id, source, total, count_fuel, bad,
 CASE WHEN CAST(bad AS DOUBLE) / total > 0.3 THEN 'err' ELSE 'OK' END AS "check",
 CASE WHEN bad > 0 AND CAST(bad AS DOUBLE) / total <= 0.3 THEN bad END AS count_err FROM (
 SELECT station_id, source, count(*) AS total, count(*) FILTER (WHERE date_upd = {D}) AS count_fuel,
  count(*) FILTER (WHERE bad_open) AS bad FROM verdict{x} GROUP BY station_id, source)"""
    CTES[f"cand{x}"] = f"""
SELECT q.station_id, q.source, {D} AS date_upd, count_fuel, total, bad, "check", count_err,
 count(*) OVER (PARTITION BY q.station_id) AS amount, rate
FROM quality{x} q JOIN dark{x} d ON d.station_id = q.station_id LEFT JOIN rnk ON rnk.source = q.source
WHERE count_fuel > 0"""
    CTES[f"scored{x}"] = f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY rate NULLS LAST, source) AS rn
 FROM cand{x}) WHERE rn = 1"""
    for name, sources, days in (("trusted", TRUSTED, 0), ("untrusted", UNTRUSTED, 14)):
        change(
            f"on_new_{name}",
            "t",
            f"scored{x} WHERE \"check\" = 'OK' AND count_err IS NULL AND source IN {sources}",
            start=f"{D} - {days}",
            end=f"{D} + 1",
        )
        change(
            f"on_partial_{name}",
            "t",
            f"(SELECT DISTINCT v.station_id, v.source, v.product_id FROM verdict{x} v JOIN scored{x} c "
            f"ON c.station_id = v.station_id AND c.source = v.source "
            f"WHERE c.count_err IS NOT NULL AND c.source IN {sources} AND ok_closed)",
            product="product_id",
            start=f"{D} - {days}",
            end=f"{D} + 1",
        )

    CTES[f"shown{x}"] = f"""
SELECT station_id, source, n, count(*) OVER (PARTITION BY station_id) AS sources FROM (
 SELECT station_id, source, count(*) AS n FROM {snap} WHERE show_in_report = 't' GROUP BY station_id, source)"""
    CTES[f"fresh{x}"] = f"""
SELECT station_id, source, count(*) AS n FROM {snap}
WHERE show_in_report = 'f' AND price > 0 AND date_upd = {D} GROUP BY station_id, source"""
    CTES[f"base{x}"] = f"""
SELECT s.station_id, s.source, s.n AS count_fuel_true, f.n AS count_fuel_false
FROM shown{x} s JOIN fresh{x} f ON f.station_id = s.station_id AND f.source = s.source WHERE s.sources = 1"""
    CTES[f"newprod{x}"] = f"""
SELECT DISTINCT station_id, source, product_id FROM {snap} WHERE show_in_report = 'f'
AND ((source IN {TRUSTED} AND date_upd = {D}) OR (source NOT IN {TRUSTED} AND date_upd > {D} - 8))"""
    CTES[f"newprice{x}"] = f"""
SELECT station_id, source, product_id, min(price) AS price FROM {snap}
WHERE (source IN {TRUSTED} AND date_upd = {D}) OR (source NOT IN {TRUSTED} AND date_upd > {D} - 16)
GROUP BY station_id, source, product_id"""
    CTES[f"shownprice{x}"] = f"""
SELECT station_id, source, product_id, min(price) AS price FROM {snap}
WHERE show_in_report = 't' AND date_upd = {D} GROUP BY station_id, source, product_id"""
    CTES[f"dup{x}"] = f"""
SELECT p.station_id, p.source, p.product_id, p.price AS new_price FROM newprod{x} n
JOIN newprice{x} p ON p.station_id = n.station_id AND p.source = n.source AND p.product_id = n.product_id
WHERE EXISTS (SELECT 1 FROM shownprice{x} t JOIN grp g1 ON g1.product_id = t.product_id
 JOIN grp g2 ON g2.fuel = g1.fuel WHERE g2.product_id = p.product_id AND t.product_id <> p.product_id
 AND t.station_id = p.station_id AND t.source = p.source AND t.price = p.price)"""
    CTES[f"inrep{x}"] = f"""
SELECT DISTINCT n.station_id, n.source, n.product_id FROM newprod{x} n
JOIN base{x} b ON b.station_id = n.station_id AND b.source = n.source
JOIN verdict{x} v ON v.station_id = n.station_id AND v.source = n.source AND v.product_id = n.product_id
WHERE v.ok_closed AND NOT EXISTS (SELECT 1 FROM dup{x} d WHERE d.station_id = n.station_id
 AND d.source = n.source AND d.product_id = n.product_id)"""
    change(
        "on_in_report_new",
        "t",
        f"inrep{x}",
        product="product_id",
        start=f"CASE WHEN source IN {TRUSTED} THEN {D} ELSE {D} - 7 END",
        end=f"{D} + 1",
    )
    change(
        "off_stale_in_report",
        "f",
        f"(SELECT DISTINCT s.station_id, s.source, s.product_id FROM {snap} s JOIN base{x} b "
        f"ON b.station_id = s.station_id AND b.source = s.source WHERE s.source NOT IN {UNTRUSTED} "
        f"AND s.show_in_report = 't' AND s.date_upd < {D})",
        product="product_id",
    )

    CTES[f"swap{x}"] = f"""
SELECT station_id, old_source, new_source, rate FROM (
 SELECT s.station_id, s.source AS old_source, f.source AS new_source, rate,
  ROW_NUMBER() OVER (PARTITION BY s.station_id ORDER BY rate NULLS LAST, f.source) AS rn
 FROM shown{x} s JOIN fresh{x} f ON f.station_id = s.station_id LEFT JOIN rnk ON rnk.source = f.source
 WHERE s.sources = 1 AND s.source IN {REPLACEABLE} AND f.source IN {REPLACING}) WHERE rn = 1"""
    change("off_replaced_source", "f", f"swap{x}", source="old_source")
    change(
        "on_replacing_source",
        "t",
        f"(SELECT DISTINCT v.station_id, v.source, v.product_id FROM verdict{x} v JOIN swap{x} w "
        f"ON w.station_id = v.station_id AND w.new_source = v.source "
        f"WHERE v.show_in_report = 'f' AND v.date_upd = {D} AND v.ok_closed)",
        product="product_id",
        start=D,
        end=f"{D} + 1",
    )
    CTES[f"race{x}"] = f"""
SELECT b.station_id, b.n AS rival_rows, y.n AS shown_rows,
 (SELECT count(*) FROM verdict{x} v WHERE v.station_id = b.station_id AND v.source = 'api_benzuber' AND v.bad_open)
  AS rival_bad
FROM (SELECT station_id, count(*) AS n FROM {snap} WHERE source = 'api_benzuber' AND show_in_report = 'f'
 AND date_upd = {D} GROUP BY station_id) b
JOIN (SELECT station_id, count(*) AS n FROM {snap} WHERE source = 'api_yandex_fuel' AND show_in_report = 't'
 GROUP BY station_id) y ON y.station_id = b.station_id WHERE b.n >= y.n"""
    change("off_yandex_for_benzuber", "f", f"race{x} WHERE rival_bad = 0", source="'api_yandex_fuel'")
    change(
        "on_benzuber", "t", f"race{x} WHERE rival_bad = 0", source="'api_benzuber'", start=D, end=f"{D} + 1"
    )
    CTES[f"bounds{x}"] = f"""
SELECT DISTINCT station_id, source, product_id FROM {snap}
WHERE show_in_report = 't' AND (price < 11 OR price > 110)"""
    change("off_out_of_bounds", "f", f"bounds{x}", product="product_id")
    CTES[f"diesel{x}"] = f"""
SELECT station_id, product_id, date_upd, n AS count_diesel FROM (
 SELECT station_id, product_id, date_upd, count(*) OVER (PARTITION BY station_id) AS n, count(price) OVER (PARTITION BY station_id) AS priced,
  min(price) OVER (PARTITION BY station_id) AS cheapest, max(price) OVER (PARTITION BY station_id) AS dearest,
  ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY date_upd, product_id) AS rn
 FROM {snap} WHERE show_in_report = 't' AND product_id IN {DIESEL})
WHERE n > 1 AND rn = 1 AND (priced = 0 OR (priced = n AND cheapest = dearest))"""
    change("off_old_diesel", "f", f"diesel{x}", source="NULL", product="product_id", only="'t'")


STAGE_RULES = (
    ("off_expired_trusted", "off_expired_untrusted"),
    (
        "on_new_trusted",
        "on_new_untrusted",
        "on_partial_trusted",
        "on_partial_untrusted",
        "off_replaced_source",
        "on_replacing_source",
        "off_yandex_for_benzuber",
        "on_benzuber",
        "off_out_of_bounds",
    ),
    ("on_in_report_new", "off_stale_in_report"),
    ("off_old_diesel",),
)


def union_rules(rules, x: str) -> str:
    return "\nUNION ALL ".join(f"SELECT {n} AS pos, c.* FROM {rule}{x} c" for n, rule in enumerate(rules))


def update_ctes(before: str, changes: str, after: str) -> None:
    """``after`` is table ``before`` with the last matching change of every row; rows that agree in what decides share it."""
    when = (
        "(c.from_date IS NULL OR t.updated_at >= c.from_date) AND (c.to_date IS NULL OR t.updated_at < c.to_date) "
        "AND (c.only_flag IS NULL OR c.only_flag = t.show_in_report)"
    )
    key = ("station_id", "product_id", "source", "updated_at", "show_in_report")
    grains = {
        "c.product_id IS NULL": ("station_id", "source"),
        "true": ("station_id", "source", "product_id"),
        "c.source IS NULL": ("station_id", "product_id"),
    }
    hits = "\nUNION ALL ".join(
        f"SELECT {', '.join(f't.{k}' for k in key)}, c.pos, c.new_flag FROM {before} t JOIN {changes} c "
        f"ON {' AND '.join(f'c.{k} = t.{k}' for k in grain)} WHERE {test} AND {when}"
        for test, grain in grains.items()
    )
    CTES[f"{after}_hits"] = f"SELECT {', '.join(key)}, arg_max(new_flag, pos) AS flag FROM ({hits}) GROUP BY ALL"
    same = " AND ".join(f"h.{k} IS NOT DISTINCT FROM t.{k}" for k in key)
    CTES[after] = f"""
SELECT t.station_id, t.product_id, t.source, t.price, coalesce(h.flag, t.show_in_report) AS show_in_report, t.date_upd, t.updated_at,
 CASE WHEN h.flag IS NOT NULL THEN CAST(1 AS BIGINT) ELSE t.updated_by_id END AS updated_by_id
FROM {before} t LEFT JOIN {after}_hits h ON {same}"""


CTES["scope"] = """
SELECT o_orderkey AS station_id FROM orders WHERE o_orderkey % 100 <= 85
EXCEPT SELECT station_id FROM protected"""
CTES["oldest"] = f"SELECT * FROM (VALUES ('t', {D} - 60), ('f', {D} - 21)) AS t(flag, oldest)"


def extract_sql(table: str) -> str:
    return f"""
SELECT station_id, product_id, price, source, flag AS show_in_report, date_upd
FROM {table} JOIN scope USING (station_id) JOIN oldest ON flag = show_in_report AND updated_at > oldest"""


def both_ways(table: str, snap: str, x: str) -> None:
    """All rules on the initial table and what it is after them, and the staged run."""
    rule_ctes(snap, x)
    CTES[f"everything{x}"] = union_rules([r for stage in STAGE_RULES for r in stage], x)
    CTES[f"first_rules{x}"] = f"SELECT * FROM everything{x} WHERE rule <> 'off_old_diesel'"
    CTES[f"last_rule{x}"] = f"SELECT * FROM everything{x} WHERE rule = 'off_old_diesel'"
    update_ctes(table, f"first_rules{x}", f"applied_most{x}")
    update_ctes(f"applied_most{x}", f"last_rule{x}", f"applied{x}")
    before = table
    # every stage works on the table the one before left
    for n, rules in enumerate(STAGE_RULES, 1):
        CTES[f"snap{n}{x}"] = extract_sql(before)
        rule_ctes(f"snap{n}{x}", f"_s{n}{x}")
        CTES[f"changes{n}{x}"] = union_rules(rules, f"_s{n}{x}")
        update_ctes(before, f"changes{n}{x}", f"table{n}{x}")
        before = f"table{n}{x}"


both_ways("obs", "obs", "")
both_ways("full_", "fullsnap", "_full")

_NAMES = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_][a-z_0-9]*)")


def sql(body: str) -> str:
    """``body`` behind a WITH clause of the CTEs it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in needed)
    return f"WITH {ctes}\n{body}" if needed else body


CTES["lines"] = """
SELECT rule, station_id, 'station_id = ' || station_id
 || CASE WHEN source IS NULL THEN '' ELSE ' and source = ''' || source || '''' END
 || CASE WHEN product_id IS NULL THEN '' ELSE ' and product_id = ' || product_id END
 || CASE WHEN from_date IS NULL THEN '' ELSE ' and updated_at >= ' || from_date END
 || CASE WHEN to_date IS NULL THEN '' ELSE ' and updated_at < ' || to_date END
 || CASE WHEN only_flag IS NULL THEN '' ELSE ' and show_in_report = ''' || only_flag || '''' END AS line FROM everything"""
CHANGE_COLUMNS = "rule, station_id, source, product_id, from_date, to_date, only_flag, new_flag"
BODIES = {
    "scan_directory": f"SELECT id AS gs_id, owner_type, type, status_gs, owner_number FROM geo WHERE status_gs IN {ACTIVE}",
    "scan_prices": "SELECT station_id, product_id, price, source, show_in_report, date_upd FROM obs",
    "dim_limits": """SELECT o.product_id, CAST(coalesce(lo, 35) AS DOUBLE) AS lo, CAST(coalesce(hi, 110) AS DOUBLE) AS hi,
 count(*) AS n FROM obs o LEFT JOIN lim ON lim.product_id = o.product_id GROUP BY 1, 2, 3""",
    "id_list": "SELECT itn, count(*) AS lines FROM ids GROUP BY itn",
    "client_stations": "SELECT id, station_id FROM client",
    "competitor_stations": """SELECT DISTINCT competitor_station_id AS station_id FROM client
 WHERE competitor_station_id IS NOT NULL""",
    "protected_union": "SELECT station_id FROM protected",
    "exclude_protected": """SELECT station_id, product_id, source FROM obs o
 WHERE NOT EXISTS (SELECT 1 FROM protected p WHERE p.station_id = o.station_id)""",
    "recency_filter": """SELECT station_id, product_id, source, show_in_report FROM obs
 WHERE (show_in_report = 't' AND age_days <= 60) OR (show_in_report = 'f' AND age_days <= 21)""",
    "price_extract": extract_sql("obs"),
    "interval_checks": """SELECT s.station_id, s.source, s.product_id,
 price <= coalesce(lo, 35) OR price >= coalesce(hi, 110) AS fails_open,
 price BETWEEN coalesce(lo, 35) AND coalesce(hi, 110) AS passes_closed
 FROM obs s LEFT JOIN lim ON lim.product_id = s.product_id""",
    "limit_check": "SELECT station_id, source, total, count_fuel, bad FROM quality",
    "source_quality": 'SELECT station_id, source, total, bad, "check", count_err FROM quality',
    "count_fuel": """SELECT station_id, source, date_upd, count_fuel,
 CAST(sum(count_fuel) OVER (PARTITION BY station_id, source) AS BIGINT) AS total FROM (
 SELECT station_id, source, date_upd, count(*) AS count_fuel FROM obs GROUP BY station_id, source, date_upd)""",
    "sources_per_station": """SELECT station_id, count(DISTINCT source) AS count_source FROM obs
 WHERE show_in_report = 't' GROUP BY station_id""",
    "single_source_stations": """SELECT station_id, sources AS count_source, source, n AS count_fuel_true
 FROM shown WHERE sources = 1""",
    "dark_stations": "SELECT station_id FROM dark",
    "rank_lookup": """SELECT o.source, count(*) AS n, max(rate) AS rate FROM obs o
 LEFT JOIN rnk ON rnk.source = o.source GROUP BY o.source""",
    "scalar_dates": f"""SELECT station_id, product_id, source, date_upd, CAST(date_upd - 6 AS DATE) AS six_days_before,
 CAST(date_upd + 1 AS DATE) AS next_day, age_days, age_days = 0 AS in_day,
 (show_in_report = 't' AND updated_at > {D} - 60) OR (show_in_report = 'f' AND updated_at > {D} - 21) AS recent FROM obs""",
    "expired_sources": "SELECT station_id, source FROM exp_trusted",
    "source_candidates": "SELECT * FROM cand",
    "score_new_sources": 'SELECT station_id, source, date_upd, count_fuel, "check", count_err, amount, rate FROM scored',
    "best_source": "SELECT station_id, source, rate FROM scored",
    "in_report_new_products": "SELECT * FROM base",
    "equivalent_product_dup": "SELECT * FROM dup",
    "source_replacement": "SELECT * FROM swap",
    "coalesce_update": f"""SELECT station_id, CASE WHEN everything_shown > 1 THEN everything_shown ELSE own END AS count_source FROM (
 SELECT station_id, count(*) FILTER (WHERE source IN {REPLACEABLE}) AS own, count(*) AS everything_shown
 FROM shown GROUP BY station_id) WHERE own > 0""",
    "count_race": "SELECT * FROM race",
    "out_of_bounds": "SELECT * FROM bounds",
    "diesel_duplicates": "SELECT * FROM diesel",
    "report_lines": "SELECT rule, line FROM lines",
    "report_text": """SELECT rule, station_id, CAST(place // 3 AS INTEGER) AS part, count(*) AS changes,
 string_agg(line, '; ' ORDER BY place) AS text FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY rule, station_id ORDER BY line) - 1 AS place FROM lines)
 GROUP BY rule, station_id, place // 3""",
    "apply_changes": "SELECT station_id, product_id, source, show_in_report, updated_by_id FROM applied",
    "apply_no_changes": "SELECT station_id, product_id, source, show_in_report, updated_by_id FROM obs",
    "price_visibility": "SELECT station_id, product_id, source, price, show_in_report, updated_by_id FROM table4",
    "full_limits": """SELECT product_id, price, lo, hi, n, coalesce(price <= lo OR price >= hi, false) AS fails,
 coalesce(price BETWEEN lo AND hi, false) AS passes FROM (
 SELECT s.product_id, price, CAST(coalesce(lo, 35) AS DOUBLE) AS lo, CAST(coalesce(hi, 110) AS DOUBLE) AS hi, count(*) AS n
 FROM fullsnap s LEFT JOIN lim ON lim.product_id = s.product_id GROUP BY ALL)""",
    "full_ranks": """SELECT s.source, count(*) AS n, max(rate) AS rate, max(coalesce(class, 0)) AS class FROM fullsnap s
 LEFT JOIN rnk ON rnk.source = s.source LEFT JOIN source_class ON named = s.source GROUP BY s.source""",
    "full_extract": extract_sql("full_"),
    "full_rules": f"SELECT {CHANGE_COLUMNS} FROM everything_full",
    "full_applied": "SELECT station_id, product_id, source, price, CAST(updated_at AS DATE) AS day, show_in_report, updated_by_id FROM applied_full",
    "full_applied_by_outcome": "SELECT station_id, product_id, source, price, CAST(updated_at AS DATE) AS day, show_in_report, updated_by_id FROM applied_full",
    "full_visibility": "SELECT station_id, product_id, source, price, CAST(updated_at AS DATE) AS day, show_in_report, updated_by_id FROM table4_full",
    "parse_gps": """SELECT id AS gs_id, trim(split_part(gps_var, ',', 1)) AS lat_text,
 trim(split_part(gps_var, ',', -1)) AS lon_text FROM geo""",
    "try_number": """SELECT id AS gs_id, TRY_CAST(trim(split_part(gps_var, ',', 1)) AS DOUBLE) AS lat,
 CAST(owner_number AS BIGINT) AS number, TRY_CAST(owner_type AS BIGINT) AS no_number FROM geo""",
    "scalar_text": """SELECT id AS gs_id, CAST(length(trim(gps_var)) AS INTEGER) AS gps_length, left(gps_var, 2) AS first_two,
 right(gps_var, 2) AS last_two, split_part(gps_var, '.', 1) AS whole_degrees,
 'km ' || CAST(CAST(round(CAST(road_km AS DOUBLE) / 7, 0) AS BIGINT) AS VARCHAR) AS km_text FROM geo""",
    "address_text": "SELECT id AS gs_id, address FROM addr",
    "station_class": "SELECT id AS gs_id, type, class AS station_class FROM cls",
    "station_points": "SELECT id, lat, lon FROM pts",
    "station_directory": "SELECT * FROM dir",
    "haversine": """SELECT p.id, q.id AS next_id, round(2 * 6371 * asin(sqrt(least(1.0,
 pow(sin((radians(q.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) *
 pow(sin((radians(q.lon) - radians(p.lon)) / 2), 2)))), 6) AS km FROM pts p JOIN pts q ON q.id = p.id + 1""",
    "knn_pairs": 'SELECT point1, point2, CAST(rank AS INTEGER) AS rank, km AS "dist, km" FROM near',
    "knn_long": 'SELECT point1, point2, CAST(rank - 1 AS INTEGER) AS position, km AS "dist, km" FROM near WHERE rank <= 3',
    "class_compatible": "SELECT point1, point2, client_check, comp_check FROM classed",
    "competitor_sequence": """SELECT point1, point2,
 CAST(ROW_NUMBER() OVER (PARTITION BY point1 ORDER BY rank) - 1 AS INTEGER) AS sequence FROM classed""",
    "competitor_enrich": """SELECT n.point1, n.point2, CAST(n.rank AS INTEGER) AS rank, km AS "dist, km",
 c.id_parcon AS comp_id_parcon, c.type_1 AS comp_type_1, c.type_azs AS comp_type_azs, c."check" AS comp_check,
 c.brand AS comp_brand, c.affilation AS comp_affilation, c.number AS comp_number, c.status AS comp_status,
 c.region AS comp_region, c.address AS comp_address, c.gps AS comp_gps, o.brand AS client_brand,
 o.region AS client_region, o.type_azs AS client_type_azs, o."check" AS client_check,
 CAST(ROW_NUMBER() OVER (PARTITION BY n.point1 ORDER BY n.rank) - 1 AS INTEGER) AS sequence
 FROM near n JOIN classed x ON x.point1 = n.point1 AND x.point2 = n.point2
 JOIN dir c ON c.id_parcon = n.point2 JOIN dir o ON o.id_parcon = n.point1""",
    "competitor_price_sources": "SELECT * FROM psrc",
    "best_price_class": "SELECT * FROM bestclass",
    "nearest_competitors": """SELECT n.point1, o.brand AS brand_client, o.region AS region_client, km AS "dist, km",
 c.id_parcon, c.type_1, c.type_azs, c."check", c.brand, c.affilation, c.number, c.status, c.region, c.address, c.gps,
 type_source FROM near n JOIN classed x ON x.point1 = n.point1 AND x.point2 = n.point2
 JOIN dir c ON c.id_parcon = n.point2 JOIN dir o ON o.id_parcon = n.point1
 LEFT JOIN bestclass b ON b.parcon_id = c.id_parcon""",
    "registry_lookup": """SELECT i.itn, payload FROM (SELECT DISTINCT itn FROM ids) i
 LEFT JOIN payloads p ON p.itn = i.itn""",
    "registry_flatten": "SELECT * FROM company",
    "registry_sink": "SELECT itn, name, type, status_itn FROM company",
    "table_sink": 'SELECT * FROM dir WHERE "check" > 0',
    "scan_points": """SELECT CASE WHEN good THEN c_custkey END AS id,
 CASE WHEN good THEN c_custkey % 90 + 0.25::DOUBLE END AS lat, CASE WHEN good THEN -(c_custkey % 180 + 0.5::DOUBLE) END AS lon,
 CASE c_custkey % 20 WHEN 0 THEN 'x' || c_custkey || ';1.5;2.5' WHEN 1 THEN c_custkey || ';1.5' WHEN 2 THEN c_custkey || ';1.5;2.5;3.5'
  WHEN 3 THEN c_custkey || ';north;2.5' WHEN 4 THEN c_custkey || ';;2.5' WHEN 5 THEN c_custkey || ';NaN;2.5'
  WHEN 6 THEN c_custkey || ';91.5;2.5' WHEN 7 THEN c_custkey || ';1.5;-181.25' END AS broken
 FROM (SELECT c_custkey, c_custkey % 20 >= 8 AS good FROM customer)""",
    "point_counts": f"""SELECT count(*) AS located, count(*) FILTER (WHERE bad) AS malformed, count(*) FILTER (WHERE NOT bad) AS kept
 FROM (SELECT id % 7 = 0 OR id % 11 = 0 OR id % 13 = 0 AS bad, * FROM geo)
 WHERE status_gs IN {ACTIVE} AND (bad OR gps_var <> '')""",
    "registry_last": """SELECT i.itn, payload FROM (SELECT DISTINCT itn FROM ids) i LEFT JOIN latest l ON l.itn = i.itn""",
    "registry_contacts": """SELECT i.itn,
 CASE WHEN l.itn IS NULL THEN '' WHEN again THEN CASE WHEN found THEN name ELSE '' END WHEN broken THEN '' ELSE 'later' END AS name,
 CASE WHEN l.itn IS NULL THEN '' WHEN again THEN CASE WHEN NOT found THEN '' END WHEN broken THEN '' ELSE
  CASE n % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '+7 1, +7 2' WHEN 3 THEN '+7 3, +7 4' WHEN 4 THEN '+7 5' ELSE '7' END
  END AS phone,
 CASE WHEN l.itn IS NULL OR again OR broken OR n % 4 = 0 THEN '' WHEN n % 4 = 1 THEN 'a@b.c, d@e.f' ELSE 'only@one.x' END AS email,
 CASE WHEN l.itn IS NULL THEN '' WHEN again THEN CASE WHEN found THEN CAST(n % 99 AS VARCHAR) ELSE '' END WHEN broken THEN ''
  WHEN n % 2 = 0 THEN '1.1, 1.2' ELSE '2' END AS okved,
 CASE WHEN l.itn IS NULL OR again OR broken THEN '' WHEN n % 3 = 0 THEN 'k1' WHEN n % 3 = 1 THEN '770101' END AS kpp
 FROM (SELECT DISTINCT itn FROM ids) i LEFT JOIN latest l ON l.itn = i.itn""",
    "registry_counts": """SELECT count(*) AS ids, count(*) FILTER (WHERE l.itn IS NULL) AS missing,
 count(*) FILTER (WHERE NOT again AND broken) AS malformed,
 count(*) FILTER (WHERE l.itn IS NOT NULL AND CASE WHEN again THEN found ELSE NOT broken END) AS named
 FROM (SELECT DISTINCT itn FROM ids) i LEFT JOIN latest l ON l.itn = i.itn""",
    "json_path_default": """SELECT itn, CASE WHEN found THEN name ELSE '' END AS name,
 CASE WHEN found THEN NULL ELSE '' END AS phones, 'none' AS emails,
 CASE WHEN found AND person AND n % 2 = 0 THEN 'P' ELSE '' END AS patronymic,
 CASE WHEN found THEN CAST(millis AS VARCHAR) END AS millis FROM reg""",
    "epoch_text": """SELECT id, millis, CASE kind WHEN 3 THEN CASE WHEN millis = '0' THEN '0' ELSE '' END WHEN 5 THEN ''
  WHEN 4 THEN strftime(TIMESTAMP '1970-01-01' - to_seconds((1500 + id) // 1000), '%Y-%m-%d %H:%M:%S')
  WHEN 6 THEN strftime(TIMESTAMP '1970-01-01' + to_seconds(ms // 1000), '%Y-%m-%d %H:%M:%S')
  WHEN 7 THEN strftime(TIMESTAMP '1970-01-01' + to_seconds(ms // 1000), '%Y-%m-%d %H:%M:%S')
  ELSE millis END AS updated FROM (
 SELECT c_custkey AS id, c_custkey % 8 AS kind, 1600000000000 + c_custkey * 86400123 AS ms,
  CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN CAST(c_custkey % 1000 AS VARCHAR)
   WHEN 4 THEN CAST(-1500 - c_custkey AS VARCHAR) WHEN 5 THEN 'x' || c_custkey || '000'
   ELSE CAST(1600000000000 + c_custkey * 86400123 AS VARCHAR) END AS millis FROM customer)""",
    "director_name": """SELECT itn, CASE WHEN NOT found THEN '' WHEN person AND n % 2 = 0 THEN 'S' || itn || ' N P'
 WHEN person THEN 'S' || itn || ' N' ELSE 'Dir ' || itn END AS director FROM reg""",
    "code_translate": """SELECT itn, CASE WHEN NOT found THEN NULL WHEN person THEN 'ИП' ELSE 'ЮЛ' END AS type,
 CASE WHEN NOT found THEN NULL ELSE CASE n % 5 WHEN 0 THEN 'действующая' WHEN 1 THEN 'ликвидируется'
  WHEN 2 THEN 'ликвидирована' WHEN 3 THEN 'банкротство' ELSE 'В процессе присоединения' END END AS status FROM reg""",
}
for _stage in STAGE_RULES:
    for _rule in _stage:
        BODIES[_rule] = f"SELECT {CHANGE_COLUMNS} FROM {_rule}"

ORACLES = {name: sql(body) for name, body in BODIES.items()}
