"""The queries' results as SQL over the base tables."""

from __future__ import annotations

_AT = "o_orderdate + to_seconds(o_orderkey % 86400)"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
_DETAIL_ID = """l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus)"""

# Derived inputs, in step with the testbed.
INPUTS = f"""
province AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, 'CN-' || n_nationkey AS iso_code, n_name AS name,
         '10' || n_nationkey AS area_code, CAST(n_regionkey AS VARCHAR) AS region_id FROM nation),
known_region AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS region_name FROM region
  WHERE r_name <> 'MIDDLE EAST'),
all_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey, lower(c_name) AS login_name,
         c_name AS nick_name, CAST(NULL AS VARCHAR) AS passwd, c_name AS name,
         '139' || c_custkey AS phone_num, 'user' || c_custkey || '@example.com' AS email,
         CAST(NULL AS VARCHAR) AS head_img, c_mktsegment AS user_level,
         DATE '1940-01-01' + CAST((c_custkey * 37) % 29000 AS INTEGER) AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         '2019-01-01 00:00:00' AS create_time, CAST(NULL AS VARCHAR) AS operate_time
  FROM customer),
aged_users AS (
  SELECT *, date_diff('day', birthday, DATE '2024-01-01') // 365 AS age FROM all_users),
known_user AS (
  SELECT *, CASE WHEN age < 18 THEN '小于18' WHEN age < 28 THEN '18-28' WHEN age < 45 THEN '28-45'
                 WHEN age < 60 THEN '45-60' ELSE '60以上' END AS age_group
  FROM aged_users WHERE user_level <> 'MACHINERY'),
sku AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey // 4 AS VARCHAR) AS spu_id,
         p_retailprice AS price, p_name AS sku_name, p_type || ' ' || p_name AS sku_desc,
         CAST(p_size AS DOUBLE) / 10 AS weight, regexp_extract(p_brand, '(\\d+)', 1) AS tm_id,
         CAST(p_size AS VARCHAR) AS category3_id, '2021-07-03 08:05:00' AS create_time,
         p_partkey, p_brand, p_type, p_size FROM part),
trademark AS (SELECT DISTINCT tm_id, p_brand AS tm_name FROM sku WHERE p_brand <> 'Brand#7'),
category3 AS (
  SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'category3 ' || p_size AS name,
         CAST(p_size % 10 AS VARCHAR) AS category2_id FROM part WHERE p_size <> 13),
category2 AS (
  SELECT DISTINCT CAST(p_size % 10 AS VARCHAR) AS id, 'category2 ' || p_size % 10 AS name,
         CAST((p_size % 10) % 3 AS VARCHAR) AS category1_id FROM part WHERE p_size % 10 <> 5),
category1 AS (
  SELECT DISTINCT CAST((p_size % 10) % 3 AS VARCHAR) AS id, 'category1 ' || (p_size % 10) % 3 AS name
  FROM part),
spu AS (
  SELECT DISTINCT spu_id AS id, 'spu_' || spu_id AS spu_name FROM sku WHERE p_type <> 'PROMO'),
line AS (
  SELECT {_DETAIL_ID} AS id, l_orderkey AS order_id, l_partkey AS sku_id, l_linenumber,
         CAST(l_quantity AS BIGINT) AS sku_num, 'sku ' || l_partkey AS sku_name,
         p_retailprice AS sku_price, CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT) AS amount,
         l_returnflag, l_linestatus
  FROM lineitem JOIN part ON p_partkey = l_partkey),
totals AS (SELECT order_id, CAST(sum(amount) AS BIGINT) AS original FROM line GROUP BY order_id),
source_order AS (
  SELECT o.*, o_orderkey % 27 AS province_id, strftime({_AT}, {_TEXT}) AS create_time,
         strftime({_AT} + to_seconds(900), {_TEXT}) AS expire_time,
         CASE WHEN o_orderstatus <> 'O' THEN strftime({_AT} + to_seconds(60), {_TEXT}) END AS operate_time,
         CAST(round(o_totalprice * 100) AS BIGINT) AS final, coalesce(original, 0) AS original
  FROM orders o LEFT JOIN totals ON order_id = o_orderkey),
order_info AS (
  SELECT o_orderkey AS id, province_id, o_orderstatus AS order_status, o_custkey AS user_id,
         o_totalprice AS final_total_amount,
         CAST(greatest(original - final, 0) AS DOUBLE) / 100 AS benefit_reduce_amount,
         CAST(original AS DOUBLE) / 100 AS original_total_amount,
         CAST(greatest(final - original, 0) AS DOUBLE) / 100 AS feight_fee,
         expire_time, create_time, operate_time, substr(create_time, 1, 10) AS create_date,
         substr(create_time, 12, 2) AS create_hour, original, final
  FROM source_order),
first_order AS (
  SELECT id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                  THEN '1' ELSE '0' END AS if_first_order FROM order_info),
event AS (
  SELECT event_id, 'mid_' || user_id AS mid,
         CASE WHEN (event_type = 'view' AND value < 30) OR (event_type = 'click' AND value < 14)
              THEN '' ELSE 'uid_' || user_id END AS uid,
         event_type AS ar, CASE WHEN event_type = 'purchase' THEN '' ELSE 'web' END AS ch,
         '4.2.0' AS vc, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hr,
         strftime(ts, '%M') AS mi, epoch_us(ts) // 1000 AS ts
  FROM events
  WHERE NOT ((event_type = 'error' AND value >= 20) OR (event_type = 'click' AND value < 12)
             OR (event_type = 'signup' AND value < 20) OR (event_type = 'purchase' AND value < 10))),
change AS (
  SELECT 'order_info' AS tab, o_orderkey AS id, o_custkey AS user_id, CAST(NULL AS VARCHAR) AS name,
         o_totalprice AS final_total_amount,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'insert'
              WHEN o_orderpriority = '2-HIGH' THEN 'update'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'bootstrap-insert'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'bootstrap-start'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'bootstrap-complete'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'delete'
              WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'F' THEN 'insert' END AS kind
  FROM orders
  UNION ALL SELECT 'user_info', c_custkey, NULL, c_name, NULL, 'insert' FROM customer
  UNION ALL SELECT 'sku_info', p_partkey, NULL, p_name, NULL, 'update' FROM part),
kept_change AS (
  SELECT * FROM change WHERE coalesce(kind, '') NOT IN ('bootstrap-start', 'bootstrap-complete')),
pair AS (
  SELECT o_orderkey AS order_id, id AS order_detail_id, o_orderkey // 3 AS order_batch,
         (o_orderkey + 2 * l_linenumber) // 3 AS detail_batch
  FROM orders JOIN line ON order_id = o_orderkey),
line_once AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY sku_id, sku_num) AS n FROM line) WHERE n = 1)
"""


def _split(lines: str) -> str:
    """Each line's share of its order's payment, in cents up to the last step."""
    return f"""(
  SELECT *, CAST(CASE WHEN run = original AND amount > 0 THEN final - before
                      WHEN run = original THEN 0 ELSE share END AS DOUBLE) / 100 AS final_detail_amount
  FROM (
    SELECT *, sum(amount) OVER w AS run, coalesce(sum(share) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING), 0) AS before
    FROM (
      SELECT d.order_id, d.id AS order_detail_id, d.sku_num, d.sku_price, d.amount, i.original, i.final,
             CASE WHEN d.l_linenumber <= 3 THEN 1 ELSE 2 END AS batch,
             CAST((CAST(d.amount AS HUGEINT) * i.final) // nullif(i.original, 0) AS BIGINT) AS share
      FROM {lines} d JOIN order_info i ON i.id = d.order_id)
    WINDOW w AS (PARTITION BY order_id ORDER BY order_detail_id, sku_num)))"""


_WIDE_INFO = """i.order_status, i.create_time, i.user_id, i.benefit_reduce_amount,
  i.original_total_amount, i.feight_fee, i.final_total_amount"""

_PLAIN_WIDE = """
SELECT d.id AS order_detail_id, i.id AS order_id, i.order_status, i.create_time, i.user_id, d.sku_id, d.sku_price,
  d.sku_num, d.sku_name, i.benefit_reduce_amount, i.original_total_amount, i.feight_fee, i.final_total_amount,
  CAST(0 AS DOUBLE) AS final_detail_amount, CAST(NULL AS VARCHAR) AS if_first_order,
  CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_area_code,
  CAST(NULL AS VARCHAR) AS user_age_group, CAST(NULL AS VARCHAR) AS user_gender,
  i.create_date AS dt, CAST(0 AS BIGINT) AS spu_id, CAST(0 AS BIGINT) AS tm_id,
  CAST(0 AS BIGINT) AS category3_id, CAST(NULL AS VARCHAR) AS spu_name,
  CAST(NULL AS VARCHAR) AS tm_name, CAST(NULL AS VARCHAR) AS category3_name
FROM {lines} d JOIN order_info i ON i.id = d.order_id"""

_NULL_ENRICHMENT = """CAST(NULL AS VARCHAR) AS if_first_order, CAST(NULL AS VARCHAR) AS province_name,
  CAST(NULL AS VARCHAR) AS province_area_code, CAST(NULL AS VARCHAR) AS user_age_group,
  CAST(NULL AS VARCHAR) AS user_gender"""


def _latest_per_part(id_: str, columns: str) -> str:
    return f"""SELECT id, {columns} FROM (
      SELECT *, {id_} AS id, row_number() OVER (PARTITION BY {id_} ORDER BY p_partkey DESC) AS n FROM part)
    WHERE n = 1"""


_TYPED_ORDER = """id, province_id, order_status, user_id, final_total_amount, benefit_reduce_amount,
  original_total_amount, feight_fee, expire_time, create_time, operate_time, create_date, create_hour"""

BODIES = {
    "cdc_maxwell_filter": 'SELECT CAST(id AS VARCHAR) AS id, tab AS "table", kind AS type FROM kept_change',
    "cdc_maxwell_route": """SELECT 'ODS_T_' || upper(tab) AS topic, CAST(id AS VARCHAR) AS key, id, TRUE AS id_is_number,
      CAST(user_id AS VARCHAR) AS user_id, name, final_total_amount FROM kept_change""",
    "cdc_canal_route": """
      SELECT 'ODS_ORDER_DETAIL' AS topic, 'ORDER_DETAIL' || sign * id AS key, FALSE AS id_is_number, sign * id AS id, order_id,
             sku_id, sign * sku_num AS sku_num
      FROM line JOIN (SELECT CAST(1 AS BIGINT) AS sign UNION ALL SELECT -1)
        ON sign = 1 OR l_returnflag = 'R'
      WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F')""",
    "cdc_select_table": """SELECT 'ODS_T_USER_INFO' AS topic, CAST(c_custkey AS VARCHAR) AS key,
      TRUE AS id_is_number, c_custkey AS id, c_name AS name FROM customer""",
    "log_valid_filter": "SELECT event_id FROM event",
    "log_project_defaults": "SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM event",
    "dau_first_visit": """SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS n FROM event) WHERE n = 1""",
    "dau_first_visit_incremental": """SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts,
        CASE WHEN hr < '12' THEN 1 ELSE 2 END AS batch FROM (
      SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY hr >= '12', ts, event_id) AS n FROM event)
      WHERE n = 1""",
    "dim_category1": _latest_per_part("CAST((p_size % 10) % 3 AS VARCHAR)",
                                      "'category1 at ' || p_partkey AS name"),
    "dim_category2": _latest_per_part(
        "CAST(p_size % 10 AS VARCHAR)",
        "'category2 at ' || p_partkey AS name, CAST((p_size % 10) % 3 AS VARCHAR) AS category1_id"),
    "dim_category3": _latest_per_part(
        "CAST(p_size AS VARCHAR)",
        "'category3 at ' || p_partkey AS name, CAST(p_size % 10 AS VARCHAR) AS category2_id"),
    "dim_spu": _latest_per_part(
        "CAST(p_partkey // 4 AS VARCHAR)",
        """'spu_' || p_partkey // 4 AS spu_name, p_name AS description,
           CAST(p_size AS VARCHAR) AS category3_id, regexp_extract(p_brand, '(\\d+)', 1) AS tm_id"""),
    "dim_user": """SELECT id, login_name, nick_name, passwd, name, phone_num, email, head_img, user_level,
      CAST(birthday AS VARCHAR) AS birthday, gender, create_time, operate_time FROM all_users""",
    "dim_upsert_latest": """SELECT id, user_level, CAST("offset" AS VARCHAR) AS version FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed DESC NULLS LAST, "offset" DESC NULLS LAST) AS n
      FROM (SELECT id, user_level, NULL AS changed, CAST(NULL AS BIGINT) AS "offset" FROM all_users
            UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderpriority, o_orderdate, o_orderkey FROM orders))
      WHERE n = 1""",
    "keyed_dim_scan": """SELECT id, name FROM known_user
      WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders)""",
    "dim_province_region": """SELECT p.id, iso_code, name, area_code, region_id, region_name
      FROM province p LEFT JOIN known_region r ON r.id = p.region_id""",
    "dim_sku_flatten": """SELECT s.id, s.spu_id, price, sku_name, sku_desc, weight, s.tm_id, tm_name,
      s.category3_id, c3.category2_id, c2.category1_id, c3.name AS category3_name, c2.name AS category2_name,
      c1.name AS category1_name, spu_name, create_time
      FROM sku s LEFT JOIN trademark t ON t.tm_id = s.tm_id LEFT JOIN category3 c3 ON c3.id = s.category3_id
      LEFT JOIN category2 c2 ON c2.id = c3.category2_id LEFT JOIN category1 c1 ON c1.id = c2.category1_id
      LEFT JOIN spu u ON u.id = s.spu_id""",
    "order_info_parse": f"SELECT {_TYPED_ORDER}, {_NULL_ENRICHMENT} FROM order_info",
    "order_detail_parse": """SELECT id, order_id, sku_id, CAST(0 AS DOUBLE) AS sku_price, sku_num, sku_name,
      CAST(0 AS BIGINT) AS spu_id, CAST(0 AS BIGINT) AS tm_id, CAST(0 AS BIGINT) AS category3_id,
      CAST(NULL AS VARCHAR) AS spu_name, CAST(NULL AS VARCHAR) AS tm_name,
      CAST(NULL AS VARCHAR) AS category3_name FROM line""",
    "order_time_parts": "SELECT id, create_date, create_hour FROM order_info",
    "order_first_flag": """SELECT id, user_id, if_first_order
      FROM order_info JOIN first_order USING (id)""",
    "order_first_flag_incremental": """SELECT CASE WHEN create_time < '1998-04-01' THEN 1 ELSE 2 END AS batch,
      id, user_id, if_first_order FROM order_info JOIN first_order USING (id)""",
    "user_state_upsert": """SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed,
      CASE WHEN min(create_time) < '1998-04-01' THEN 1 ELSE 2 END AS batch FROM order_info GROUP BY user_id""",
    "order_province_enrich": """SELECT o.id, p.name AS province_name, p.area_code AS province_area_code
      FROM order_info o LEFT JOIN province p ON p.id = CAST(o.province_id AS VARCHAR)""",
    "user_age": "SELECT id, age FROM aged_users",
    "order_user_enrich": """SELECT o.id, gender AS user_gender, age_group AS user_age_group
      FROM order_info o LEFT JOIN known_user u ON u.c_custkey = o.user_id""",
    "detail_sku_enrich": """SELECT d.id, order_id, sku_id, coalesce(price, 0) AS sku_price, sku_num,
      d.sku_name, coalesce(CAST(spu_id AS BIGINT), 0) AS spu_id, coalesce(CAST(tm_id AS BIGINT), 0) AS tm_id,
      coalesce(CAST(category3_id AS BIGINT), 0) AS category3_id, 'spu_' || spu_id AS spu_name,
      p_brand AS tm_name, 'category3 ' || category3_id AS category3_name
      FROM line d LEFT JOIN (SELECT * FROM sku WHERE p_type <> 'ECONOMY') s ON s.p_partkey = d.sku_id""",
    "wide_window_join_raw": f"""
      SELECT order_id, order_detail_id, strftime(TIMESTAMP '2024-01-01' + to_seconds(3 * start), {_TEXT})
             AS window_start
      FROM (SELECT *, unnest([order_batch, order_batch - 1]) AS start FROM pair)
      WHERE start IN (detail_batch, detail_batch - 1)""",
    "wide_join": _PLAIN_WIDE.format(lines="line_once") + """
      WHERE d.id IN (SELECT order_detail_id FROM pair WHERE abs(order_batch - detail_batch) <= 1)""",
    "wide_dedup": _PLAIN_WIDE.format(lines="""(
        SELECT * REPLACE (order_id * 10 + l_linenumber AS id) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, l_linenumber ORDER BY sku_id, sku_num) AS n FROM line)
        WHERE n = 1)"""),
    "amount_split": "SELECT order_id, order_detail_id, sku_num, sku_price, final_detail_amount FROM " + _split("line"),
    "amount_split_incremental": """
      SELECT batch, order_id, order_detail_id, sku_num, sku_price, final_detail_amount FROM """ + _split("line"),
    "sink_json_records": f"""SELECT {', '.join('o.' + c.strip() for c in _TYPED_ORDER.split(','))},
      CAST(NULL AS VARCHAR) AS if_first_order, p.name AS province_name, p.area_code AS province_area_code,
      CAST(NULL AS VARCHAR) AS user_age_group, CAST(NULL AS VARCHAR) AS user_gender,
      'DWD_ORDER_INFO' AS topic, CAST(o.id AS VARCHAR) AS key
      FROM order_info o LEFT JOIN province p ON p.id = CAST(o.province_id AS VARCHAR)""",
    "dws_order_wide": f"""
      SELECT d.id AS order_detail_id, d.order_id, {_WIDE_INFO}, d.sku_id, d.sku_price, d.sku_num, d.sku_name,
        final_detail_amount, if_first_order, p.name AS province_name, p.area_code AS province_area_code,
        u.age_group AS user_age_group, u.gender AS user_gender, i.create_date AS dt,
        CAST(s.spu_id AS BIGINT) AS spu_id, CAST(s.tm_id AS BIGINT) AS tm_id,
        CAST(s.category3_id AS BIGINT) AS category3_id, 'spu_' || s.spu_id AS spu_name,
        s.p_brand AS tm_name, 'category3 ' || s.category3_id AS category3_name
      FROM line_once d JOIN order_info i ON i.id = d.order_id JOIN first_order f ON f.id = i.id
      JOIN {_split("line_once")} x ON x.order_detail_id = d.id JOIN sku s ON s.p_partkey = d.sku_id
      LEFT JOIN province p ON p.id = CAST(i.province_id AS VARCHAR)
      LEFT JOIN known_user u ON u.c_custkey = i.user_id""",
    "stream_dau": "SELECT DISTINCT dt, mid FROM event",
    "stream_order_info": f"""SELECT {', '.join('o.' + c.strip() for c in _TYPED_ORDER.split(','))},
      if_first_order, p.name AS province_name, p.area_code AS province_area_code,
      u.age_group AS user_age_group, u.gender AS user_gender
      FROM order_info o JOIN first_order f ON f.id = o.id
      LEFT JOIN province p ON p.id = CAST(o.province_id AS VARCHAR)
      LEFT JOIN known_user u ON u.c_custkey = o.user_id""",
    "stream_late_lines": """SELECT order_id, id, sku_id, sku_num, sku_price FROM line_once
      WHERE order_id IN (SELECT o_orderkey FROM orders) AND 2 * l_linenumber > 3""",
}
BODIES["stream_dim_published"] = f"""SELECT * FROM ({BODIES["dim_spu"]})
      WHERE id IN (SELECT CAST(p_partkey // 4 AS VARCHAR) FROM part WHERE p_size <= 5)"""
# Queries that end with the rows of another.
TWINS = {"order_user_bucketed": "order_user_enrich",
         "stream_cdc_route": "cdc_maxwell_route", "stream_wide_join": "wide_join", "stream_resume": "cdc_maxwell_route",
         "stream_dim_upsert": "dim_spu", "stream_order_wide": "dws_order_wide"}


def oracle_sql() -> dict[str, str]:
    bodies = {**BODIES, **{name: BODIES[twin] for name, twin in TWINS.items()}}
    return {name: f"WITH {INPUTS} {body}" for name, body in bodies.items()}
