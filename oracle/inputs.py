"""Domain inputs as SQL over the star-schema test tables: sessions, payments, chargers, users, lookups."""

from __future__ import annotations

INPUTS = {
    "fx_city_map": """
SELECT * FROM (VALUES ('Zuerich','Zurich'),('Zürich','Zurich'),('Zurich','Zurich'),('Sankt Gallen','St. Gallen'),('St Gallen','St. Gallen'),('St. Gallen','St. Gallen'),('Basel','Basel'),('Bern','Bern'),('Geneva','Geneva'),('Genève','Geneva'),('Geneve','Geneva'),('Lausanne','Lausanne'),('Winterthur','Winterthur'),('Lucerne','Lucerne'),('Luzern','Lucerne'),('Lugano','Lugano')) t(city_name_raw, city_name_standardized)
""",
    "fx_users": """
SELECT 'U' || lpad(CAST(c_custkey AS STRING), 8, '0') AS user_id, c_name AS name,
 lower(replace(c_name, '#', '.')) || CASE WHEN c_custkey % 211 = 0 THEN '' ELSE '@example.ch' END AS email,
 CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'subscriber' WHEN c_mktsegment = 'FURNITURE' THEN 'trial' ELSE 'guest' END AS tier,
 DATE '1995-01-01' + CAST(c_custkey % 2400 AS INT) AS created_on FROM customer
""",
    "fx_chargers": """
SELECT 'C' || lpad(CAST(s_suppkey AS STRING), 8, '0') AS charger_id,
 CASE s_suppkey % 12 WHEN 0 THEN 'Zuerich' WHEN 1 THEN 'Zürich' WHEN 2 THEN ' ZURICH ' WHEN 3 THEN 'Sankt Gallen' WHEN 4 THEN 'St Gallen' WHEN 5 THEN 'Basel' WHEN 6 THEN 'Genève' WHEN 7 THEN 'Luzern' WHEN 8 THEN 'Lugano' WHEN 9 THEN 'Chur' WHEN 10 THEN 'Bern' ELSE 'Lausanne' END AS city,
 CASE WHEN s_suppkey % 7 = 3 THEN NULL WHEN s_suppkey % 9 = 4 THEN CAST(52.5 AS DOUBLE) ELSE CAST(46 AS DOUBLE) + CAST(s_suppkey % 100 AS DOUBLE) / 64 END AS latitude,
 CASE WHEN s_suppkey % 7 = 3 THEN NULL ELSE CAST(6 AS DOUBLE) + CAST(s_suppkey % 100 AS DOUBLE) / 32 END AS longitude,
 DATE '1995-01-01' + CAST((s_suppkey * 37) % 2000 AS INT) AS installed_on FROM supplier
""",
    "fx_transactions": """
SELECT 'S' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS session_id,
 'U' || lpad(CAST(o_custkey AS STRING), 8, '0') AS user_id,
 'C' || lpad(CAST(l_suppkey AS STRING), 8, '0') AS charger_id,
 start_time,
 CASE WHEN failed THEN NULL WHEN o_orderkey % 29 = 0 THEN start_time - INTERVAL '30' MINUTE
      WHEN o_orderkey % 31 = 0 THEN start_time + INTERVAL '2000' MINUTE
      ELSE start_time + CAST(10 + l_quantity AS INT) * INTERVAL '1' MINUTE END AS end_time,
 CAST(CASE WHEN o_orderkey % 37 = 0 THEN -l_quantity WHEN o_orderkey % 41 = 0 THEN l_quantity * 40
      WHEN o_orderkey % 67 = 0 THEN NULL ELSE l_quantity * 1.25 END AS DECIMAL(10,4)) AS kwh_consumed,
 CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'card' WHEN o_orderpriority = '3-MEDIUM' THEN 'RFID' ELSE 'app_wallet' END AS payment_method,
 CASE WHEN failed THEN 'failed' ELSE 'completed' END AS status
FROM (SELECT o.*, l.l_suppkey, CAST(l.l_quantity AS DOUBLE) AS l_quantity, (o.o_orderstatus = 'F' AND o.o_orderkey % 3 = 0) AS failed,
        o.o_orderdate + CAST(o.o_orderkey % 1440 AS INT) * INTERVAL '1' MINUTE AS start_time
      FROM orders o LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice) AS rn FROM lineitem) x WHERE rn = 1) l ON o.o_orderkey = l.l_orderkey) b
""",
    "fx_payments": """
SELECT 'P' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS payment_id, 'S' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS session_id,
 'U' || lpad(CAST(CASE WHEN o_orderkey % 61 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING), 8, '0') AS user_id,
 CAST(CASE WHEN o_orderkey % 43 = 0 THEN -5 WHEN o_orderkey % 47 = 0 THEN 0 WHEN o_orderkey % 53 = 0 THEN NULL
      WHEN o_orderkey % 59 = 0 THEN 100 + o_orderkey % 900 ELSE 5 + (o_orderkey * 13) % 20 END AS DECIMAL(10,2)) AS amount, 'CHF' AS currency
FROM orders WHERE o_orderkey % 23 <> 0 AND NOT (o_orderstatus = 'F' AND o_orderkey % 3 = 0)
""",
    "fx_places": """
SELECT place, city AS place_city, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM (VALUES ('Zurich','Zurich',47.37,8.54),('Dübendorf','Zurich',47.40,8.62),('Schlieren','Zurich',47.40,8.45),('Winterthur','Winterthur',47.50,8.72),('Basel','Basel',47.56,7.59),('Riehen','Basel',47.58,7.65),('Bern','Bern',46.95,7.45),('Ostermundigen','Bern',46.96,7.49),('Geneva','Geneva',46.20,6.15),('Carouge','Geneva',46.18,6.14),('Lausanne','Lausanne',46.52,6.63),('Renens','Lausanne',46.54,6.59),('Lucerne','Lucerne',47.05,8.31),('Emmen','Lucerne',47.08,8.30),('Lugano','Lugano',46.00,8.95),('Paradiso','Lugano',45.99,8.94),('St. Gallen','St. Gallen',47.42,9.37),('Gossau','St. Gallen',47.42,9.25)) t(place, city, lat, lon)
""",
}
