"""The same queries as SQL for DuckDB."""

ORACLES: dict[str, str] = {}

ORACLES["full_scan"] = "SELECT * FROM orders"

ORACLES["column_scan"] = "SELECT o_orderkey, o_custkey, o_orderdate FROM orders"

ORACLES["read_table"] = """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 25
"""

ORACLES["row_count"] = "SELECT count(*) AS cnt FROM lineitem"

ORACLES["paged_scan"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS row_num FROM orders
) a WHERE row_num BETWEEN 2001 AND 3000
"""

ORACLES["page_assignment"] = """
SELECT o_orderkey, row_num, CAST((row_num - 1) // 1000 AS BIGINT) + 1 AS page_no FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS row_num
  FROM orders) a
"""

ORACLES["range_row_number"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row_num
FROM lineitem
"""

ORACLES["page_plan"] = """
SELECT CAST((row_num - 1) // 1000 AS BIGINT) + 1 AS page_no, min(row_num) AS first_row, max(row_num) AS last_row,
  count(*) AS n_rows
FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders) a GROUP BY 1
"""

ORACLES["append_pages"] = "SELECT * FROM events"

ORACLES["json_pages"] = """
SELECT event_id, user_id, event_type, CAST(NULL AS VARCHAR) AS missing_key FROM events
"""

ORACLES["feed_retries"] = ORACLES["json_pages"]

ORACLES["json_pages_status"] = """
SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) // 500 AS INTEGER) + 1 AS page_no, event_id, user_id,
  event_type, CAST(NULL AS VARCHAR) AS missing_key
FROM events
"""

ORACLES["strict_columns"] = "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events"

ORACLES["rejected_pages"] = """
SELECT page_no FROM (
  SELECT CAST((rn - 1) // 100 AS INTEGER) + 1 AS page_no, rn, event_type
  FROM (SELECT event_type, row_number() OVER (ORDER BY event_id) AS rn FROM events) a) b
WHERE (rn - 1) % 100 = 0 AND event_type IN ('error', 'view')
"""

ORACLES["xml_pages"] = """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
  CASE WHEN p_size > 40 THEN NULL ELSE p_type END AS p_type, CAST(NULL AS VARCHAR) AS p_extra
FROM part
"""

ORACLES["category_union"] = """
SELECT event_id, event_type, 'click' AS category FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type, 'view' FROM events WHERE event_type = 'view'
"""

ORACLES["category_scan"] = """
SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'signup')
"""

ORACLES["strip_nul"] = "SELECT c_custkey, c_acctbal, concat(c_name, c_mktsegment) AS label FROM customer"

ORACLES["blank_to_null"] = """
SELECT p_partkey, nullif(CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END, '') AS p_brand FROM part
"""

ORACLES["fixed_columns"] = """
SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS no_such_key FROM events
"""

ORACLES["decrypt_columns"] = "SELECT c_custkey, c_name AS dec_tel, c_mktsegment AS dec_hand FROM customer"

ORACLES["decrypt_columns_try"] = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS dec_tel FROM customer
"""

ORACLES["kst_date"] = """
SELECT event_id, CAST(ts + INTERVAL '9' HOUR AS DATE) AS kst_date, ts + INTERVAL '9' HOUR AS kst_time FROM events
"""

ORACLES["unit_extract"] = """
SELECT p_partkey,
  CASE WHEN p_retailprice >= 950 THEN nullif(regexp_extract(addr, '([0-9]+)동', 1), '') END AS building_dong,
  CASE WHEN p_retailprice >= 950 THEN nullif(regexp_extract(addr, '([0-9]+)호', 1), '') END AS building_ho
FROM (SELECT p_partkey, p_retailprice, CASE WHEN p_size % 4 = 0 THEN p_name
  ELSE concat(p_name, ' ', CAST(p_size AS VARCHAR), '동 ', CAST(p_partkey AS VARCHAR), '호') END AS addr FROM part) t
"""

ORACLES["unresolved_keys"] = """
SELECT DISTINCT c.c_custkey FROM customer c
LEFT JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000) r
  ON r.o_custkey = c.c_custkey
WHERE r.o_custkey IS NULL AND c.c_custkey IS NOT NULL
"""

ORACLES["unresolved_keys_text"] = """
WITH owner AS (
  SELECT CASE WHEN p_size = 1 THEN '' ELSE concat_ws(' ', p_name, p_type, p_brand) END AS legacy_addr
  FROM lineitem JOIN part ON p_partkey = l_partkey),
known AS (SELECT concat_ws(' ', p_name, p_type, p_brand) AS legacy_address FROM part WHERE p_size > 10)
SELECT DISTINCT legacy_addr FROM owner LEFT JOIN known ON legacy_address = legacy_addr
WHERE legacy_address IS NULL AND legacy_addr <> ''
"""

_PART_DICT = """
addr AS (SELECT p_partkey, concat(p_name, ' ', p_type, ' ', p_brand) AS legacy_address FROM part),
dict AS (SELECT keyword, count(*) AS total_count FROM (
    SELECT concat(p_name, ' ', p_type) AS keyword FROM part WHERE p_retailprice >= 950
    UNION ALL SELECT split_part(p_name, ' ', 1) FROM part WHERE p_size <= 3) k GROUP BY keyword),
pre AS (SELECT a.p_partkey, t.n, array_to_string(list_slice(string_split(a.legacy_address, ' '), 1, t.n), ' ') AS keyword
  FROM addr a, LATERAL (SELECT unnest(range(1, len(string_split(a.legacy_address, ' ')) + 1)) AS n) t),
hit AS (SELECT p.p_partkey, arg_max(p.keyword, p.n) AS keyword, max(p.n) AS n_tokens,
    arg_max(d.total_count, p.n) AS total_count
  FROM pre p JOIN dict d ON d.keyword = p.keyword GROUP BY p.p_partkey)
"""

ORACLES["longest_prefix"] = f"""
WITH {_PART_DICT}
SELECT a.p_partkey, a.legacy_address, m.keyword, m.n_tokens, m.total_count
FROM addr a LEFT JOIN hit m ON m.p_partkey = a.p_partkey
"""

ORACLES["longest_prefix_repeated"] = f"""
WITH {_PART_DICT}
SELECT a.p_partkey, l.l_orderkey, l.l_linenumber, a.legacy_address, m.keyword, m.n_tokens, m.total_count
FROM lineitem l JOIN addr a ON a.p_partkey = l.l_partkey LEFT JOIN hit m ON m.p_partkey = a.p_partkey
"""

ORACLES["negative_markers"] = """
SELECT concat(p_name, ' ', p_type, ' ', p_brand) AS legacy_address, p_partkey FROM part
WHERE concat(p_name, ' ', p_type) NOT IN (SELECT concat(p_name, ' ', p_type) FROM part WHERE p_size > 30)
"""

_GEOCODER = """
addr AS (SELECT *, concat(p_name, ' ', p_type, ' ', p_size, '동 ', p_partkey, '호') AS legacy_address FROM part),
geo AS (SELECT p_name, p_type, CAST(count(*) AS INTEGER) AS n, min(p_size) AS s, min(p_brand) AS b
  FROM part GROUP BY p_name, p_type HAVING min(p_brand) <> 'Brand#2')
"""

ORACLES["resolve_address"] = f"""
WITH {_GEOCODER}
SELECT row_number() OVER (ORDER BY a.legacy_address)
    + (SELECT coalesce(max(p_partkey), 0) FROM part WHERE p_size = 7) AS seq,
  a.legacy_address, g.n AS accuracy,
  CASE WHEN g.n IS NOT NULL THEN g.s = 1 END AS road_address_tf,
  CASE WHEN g.s = 1 THEN concat('road ', a.p_name) WHEN g.s = 2 THEN concat('lot ', a.p_name) END AS address_name,
  CASE WHEN g.s <= 2 THEN a.p_type END AS region_1depth_name,
  CASE WHEN g.s = 2 THEN g.b END AS region_2depth_name,
  CASE WHEN g.s = 1 THEN g.b END AS region_3depth_name,
  CASE WHEN g.s = 2 THEN 'h' END AS region_3depth_h_name,
  CASE WHEN g.s = 1 AND g.b <> 'Brand#1' THEN g.b END AS building_name,
  CASE WHEN g.s = 1 AND g.b <> 'Brand#1' THEN CAST(a.p_size AS VARCHAR) END AS building_dong,
  CASE WHEN g.s = 1 AND g.b <> 'Brand#1' THEN CAST(a.p_partkey AS VARCHAR) END AS building_ho,
  CASE WHEN g.s = 1 THEN '04524' END AS zone_no,
  CASE WHEN g.s <= 2 THEN CAST(g.s AS VARCHAR) END AS x,
  CASE WHEN g.s = 1 THEN '37.5' END AS y,
  TIMESTAMP '2024-01-05 03:00:00' AS register_dt
FROM addr a LEFT JOIN geo g ON g.p_name = a.p_name AND g.p_type = a.p_type WHERE a.p_size <> 7
"""

ORACLES["retry_markers"] = f"""
WITH {_GEOCODER}
SELECT a.p_partkey AS seq, a.legacy_address, g.n AS accuracy, g.s = 1 AS road_address_tf,
  CASE WHEN g.s = 1 THEN concat('road ', a.p_name) WHEN g.s = 2 THEN concat('lot ', a.p_name) END AS address_name
FROM addr a JOIN geo g ON g.p_name = a.p_name AND g.p_type = a.p_type WHERE a.p_size = 7
"""

ORACLES["mark_surrogate"] = """
SELECT o.o_orderkey, c.c_custkey AS addr_seq FROM orders o
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') c ON c.c_custkey = o.o_custkey
"""

ORACLES["upsert_by_key"] = """
WITH u AS (SELECT *, o_custkey + 100 AS custkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t WHERE rn = 1)
SELECT coalesce(c.c_custkey, u.custkey) AS custkey,
  CASE WHEN u.o_custkey IS NOT NULL THEN u.o_orderstatus ELSE c.c_mktsegment END AS state,
  CASE WHEN u.o_custkey IS NOT NULL THEN u.o_totalprice ELSE c.c_acctbal END AS amount
FROM customer c FULL JOIN u ON u.custkey = c.c_custkey
"""

ORACLES["daily_refresh"] = """
WITH newest AS (
  SELECT *, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS incoming FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY incoming DESC, ts DESC, event_id DESC) AS rn
  FROM newest)
SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type, value
FROM ranked WHERE rn = 1
"""

ORACLES["reverse_sync"] = """
WITH both_sides AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT o_orderkey, 'X', CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderdate - INTERVAL 1 DAY
    ELSE o_orderdate + INTERVAL 1 DAY END
  FROM orders WHERE o_orderstatus <> 'O')
SELECT o_orderkey, o_orderstatus, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS rn FROM both_sides) t
WHERE rn = 1
"""

_DELTA = """
src AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders),
tgt AS (SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
"""

ORACLES["publish_delta"] = f"""
WITH {_DELTA}
SELECT s.o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'insert'
  WHEN t.o_orderstatus IS DISTINCT FROM s.o_orderstatus THEN 'update' ELSE 'same' END AS action
FROM src s LEFT JOIN tgt t ON t.o_orderkey = s.o_orderkey
"""

ORACLES["publish_apply"] = f"""
WITH {_DELTA} SELECT o_orderkey, o_orderstatus FROM src
"""

ORACLES["publish_children"] = """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
"""

ORACLES["delete_unmatched"] = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
"""

ORACLES["unmatched_rows"] = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
"""

ORACLES["code_master"] = """
SELECT n_nationkey AS major_cd, n_name AS major_nm, s_suppkey AS minor_cd, s_name AS minor_nm
FROM nation JOIN supplier ON s_nationkey = n_nationkey
"""

ORACLES["extend_contract"] = """
SELECT o.o_orderkey, o.o_custkey, a.n_lines, a.max_qty FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_quantity) AS max_qty FROM lineitem
  GROUP BY l_orderkey) a ON a.l_orderkey = o.o_orderkey
"""

ORACLES["extend_contract_newest"] = """
SELECT c.c_custkey, c.c_name, n.o_orderdate, n.o_orderkey, n.o_totalprice FROM customer c
LEFT JOIN (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) t
  WHERE rn = 1) n ON n.o_custkey = c.c_custkey
"""

ORACLES["conform_union"] = """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nationkey
FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, s_nationkey FROM supplier
"""

ORACLES["ledger_upsert"] = """
SELECT CAST(user_id AS VARCHAR) AS dag_id, completion_date, completion_datetime, event_id FROM (
  SELECT user_id, CAST(ts AS DATE) AS completion_date, ts AS completion_datetime, event_id,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1
"""

ORACLES["readiness"] = """
WITH dep AS (SELECT DISTINCT event_type AS tobe, user_id AS asis FROM events),
log AS (SELECT DISTINCT user_id AS asis FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'),
targets AS (SELECT tobe FROM dep UNION SELECT concat('user_', user_id) FROM events)
SELECT t.tobe AS tobe_dag, count(d.asis) AS target_cnt, count(l.asis) AS check_cnt,
  count(d.asis) > 0 AND count(d.asis) = count(l.asis) AS ready
FROM targets t LEFT JOIN dep d ON d.tobe = t.tobe LEFT JOIN log l ON l.asis = d.asis GROUP BY t.tobe
"""

ORACLES["snapshot"] = """
SELECT *, 20240101 AS logging_dt FROM customer
UNION ALL SELECT *, 20240102 FROM customer WHERE c_acctbal > 5000
"""

ORACLES["partition_plan"] = """
SELECT 'lv1' AS schema_nm, table_nm, strftime(d, '%Y%m%d') AS suffix, CAST(d AS DATE) AS from_date,
  CAST(d + INTERVAL 1 DAY AS DATE) AS to_date
FROM (SELECT concat('part_', p_partkey) AS table_nm,
  unnest(generate_series(CAST(DATE '2024-02-08' - p_size AS TIMESTAMP), TIMESTAMP '2024-02-14', INTERVAL 1 DAY)) AS d
  FROM part WHERE p_type <> 'SMALL') t
"""

ORACLES["expired_partitions"] = """
SELECT part_name, right(part_name, 8) AS suffix
FROM (SELECT DISTINCT concat('orders_', strftime(o_orderdate, '%Y%m%d')) AS part_name FROM orders) t
WHERE right(part_name, 8) < '19991231'
"""

ORACLES["expired_of_managed"] = """
SELECT schema_nm, table_nm, part_name, right(part_name, 8) AS suffix FROM (
  SELECT DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'lv2' ELSE 'lv1' END AS schema_nm,
    concat('lines_', l_returnflag) AS table_nm, CAST(l_shipdate AS DATE) AS d,
    concat('lines_', l_returnflag, '_', strftime(l_shipdate, '%Y%m%d')) AS part_name,
    CASE l_returnflag WHEN 'A' THEN 100 WHEN 'N' THEN 1000 ELSE 2000 END
      + CASE WHEN l_linenumber % 2 = 0 THEN 500 ELSE 0 END AS keep
  FROM lineitem) t
WHERE d < DATE '2000-01-11' - (keep + 1)
"""

ORACLES["drop_expired"] = """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS logging_dt FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-09'
"""

ORACLES["list_partitions"] = "SELECT DISTINCT CAST(ts AS DATE) AS logging_date FROM events"

_CUSTOMERS = """
cust AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, concat(c_mktsegment, ' ', c_nationkey) AS place,
  concat(c_mktsegment, ' ', c_nationkey, ' ', c_name) AS legacy_addr FROM customer),
places AS (SELECT DISTINCT place FROM cust WHERE c_acctbal > 9000),
early AS (SELECT legacy_addr, row_number() OVER (ORDER BY legacy_addr) AS seq
  FROM (SELECT DISTINCT legacy_addr FROM cust WHERE c_acctbal > 0) e),
late AS (SELECT legacy_addr, row_number() OVER (ORDER BY legacy_addr) + (SELECT coalesce(max(seq), 0) FROM early) AS seq
  FROM (SELECT DISTINCT legacy_addr FROM cust WHERE legacy_addr NOT IN (SELECT legacy_addr FROM early)) e),
master AS (SELECT * FROM early UNION ALL SELECT * FROM late)
"""

# the orders of customers without credit went on the first date and nothing brings them back
ORACLES["customer_chain"] = f"""
WITH {_CUSTOMERS},
opportunity AS (SELECT o_custkey, count(*) AS n_orders FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, c.c_acctbal, p.place AS address_name, m.seq AS addr_seq, o.n_orders
FROM cust c JOIN master m ON m.legacy_addr = c.legacy_addr LEFT JOIN places p ON p.place = c.place
LEFT JOIN opportunity o ON o.o_custkey = c.c_custkey
"""

ORACLES["snapshot_chain"] = f"""
WITH {_CUSTOMERS},
found AS (SELECT m.seq, m.legacy_addr, m.legacy_addr IN (SELECT legacy_addr FROM early) AS is_early,
    c.place IN (SELECT place FROM places) AS hit
  FROM master m JOIN (SELECT DISTINCT legacy_addr, place FROM cust) c ON c.legacy_addr = m.legacy_addr)
SELECT 20240103 AS logging_dt, count(*) AS n_addresses, count(*) FILTER (hit) AS n_found, max(seq) AS top_seq
FROM found WHERE is_early
UNION ALL
SELECT 20240104, count(*), count(*) FILTER (hit), max(seq) FROM found
"""

ORACLES["institution_chain"] = """
WITH inst AS (
  SELECT 'care_center' AS kind, s_name AS name, concat('nation ', s_nationkey) AS addr, CAST(NULL AS VARCHAR) AS tel FROM supplier
  UNION ALL SELECT 'welfare_center', s_name, '', CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'school', c_name, c_mktsegment, NULL FROM customer
  UNION ALL SELECT 'town_hall', o_orderpriority, concat('order ', o_orderkey), '-' FROM orders
  UNION ALL SELECT 'hospital', p_name, concat(p_name, ' ', p_type), NULL FROM part),
master AS (SELECT addr, row_number() OVER (ORDER BY addr) AS seq FROM (SELECT DISTINCT addr FROM inst WHERE addr <> '') a)
SELECT DISTINCT i.kind, i.name, i.addr, i.tel, CASE WHEN i.kind = 'town_hall' THEN '-' END AS lat,
  CASE WHEN i.kind = 'town_hall' THEN '-' END AS lon, m.seq AS addr_seq
FROM inst i LEFT JOIN master m ON m.addr = i.addr
"""

ORACLES["contract_chain"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice, n_lines, max_qty FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_orderkey) a
  ON l_orderkey = o_orderkey
"""

ORACLES["lounge_chain"] = """
SELECT c_custkey, c_name, c_nationkey AS org, c_nationkey % 5 AS grp FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
  AND c_nationkey % 5 IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 4)
"""

ORACLES["maintain_partitions"] = """
SELECT schema_nm, event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS logging_dt
FROM events, (VALUES ('lv1', DATE '2024-01-19'), ('lv2', DATE '2024-01-09'), ('hc', DATE '2000-01-01')) r (schema_nm, first_day)
WHERE CAST(ts AS DATE) >= first_day
"""

ORACLES["replace_after_failure"] = "SELECT * FROM orders"

ORACLES["delete_unmatched_parents"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
  AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 5)
  AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)
"""

ORACLES["refresh_with_deletes"] = """
SELECT 'account' AS kind, c_custkey AS id FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT 'opportunity', o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0
"""

ORACLES["paged_scan_once"] = ORACLES["paged_scan"]

ORACLES["page_index"] = """
SELECT CAST(1 AS BIGINT) AS first_row, count(*) AS last_row, count(*) AS n_rows, count(*) AS n_stored FROM orders
"""

ORACLES["range_row_number_ranges"] = ORACLES["range_row_number"]

ORACLES["feed_rejects"] = """
SELECT page_no, 1 AS attempt, first_type = 'error' AS is_cut, n_rows FROM (
  SELECT CAST((rn - 1) // 100 AS INTEGER) + 1 AS page_no, arg_min(event_type, rn) AS first_type, count(*) AS n_rows
  FROM (SELECT event_type, row_number() OVER (ORDER BY event_id) AS rn FROM events) a GROUP BY 1) b
WHERE first_type IN ('error', 'view')
"""

ORACLES["geocoder_answers"] = """
WITH g AS (
  SELECT p_name, concat(p_name, ' ', p_type, ' unit') AS legacy_address, min(p_brand) AS b, max(p_size) AS s
  FROM part GROUP BY p_name, p_type
)
SELECT row_number() OVER (ORDER BY legacy_address) AS seq, legacy_address, CASE WHEN s <= 40 THEN 1 END AS accuracy,
  CASE WHEN s <= 40 THEN concat('road ', p_name) END AS address_name, CASE WHEN s <= 40 THEN b END AS building_name
FROM g WHERE b <> 'Brand#1'
"""
