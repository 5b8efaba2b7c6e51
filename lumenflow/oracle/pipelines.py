"""SQL oracles of the CDC, table-write and load pipelines."""

from __future__ import annotations

from lumenflow.sources import bindings as B

# Consumed by offset, partitions side by side; k = 4 and 5 are ordinary messages.
_MESSAGES = """
msg AS (
  SELECT event_id AS "offset", CAST(user_id % 2 AS INTEGER) AS "partition", user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type = 'signup' THEN 'c'
              WHEN event_type IN ('purchase', 'click') THEN 'u'
              WHEN event_type = 'view' THEN 'r'
              WHEN event_type = 'error' THEN 'd' END AS op0
  FROM events
),
parsed AS (
  SELECT "offset", "partition", k,
         CASE WHEN k IN (0, 3) THEN NULL ELSE op0 END AS op,
         CASE WHEN k IN (0, 3) THEN 'malformed'
              WHEN op0 IS NULL OR op0 NOT IN ('c', 'u') THEN 'skipped'
              WHEN k = 1 THEN 'malformed'
              ELSE 'accepted' END AS status,
         CASE WHEN k = 2 THEN NULL ELSE user_id END AS id,
         CASE WHEN k = 2 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN k IN (2, 6) THEN NULL ELSE value END AS value
  FROM msg
),
acc AS (SELECT * FROM parsed WHERE status = 'accepted')"""

_LATEST = """
SELECT id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY "offset" DESC, "partition" DESC) AS rn FROM {src}
) WHERE rn = 1"""


def _runs(keys: int) -> str:
    """Successive bounded runs over the whole topic.  Partitions advance together by their
    distance from their first offset; a run that starts at place s ends at the ``keys``-th
    message from there on whose key last occurred before s."""
    return f""",
firsts AS (SELECT "partition", min("offset") AS lo FROM parsed GROUP BY 1),
line AS (SELECT acc.*, row_number() OVER (ORDER BY "offset" - lo, "partition") AS i FROM acc JOIN firsts USING ("partition")),
linked AS (SELECT *, coalesce(lag(i) OVER (PARTITION BY id ORDER BY i), 0) AS before FROM line),
run AS (
  SELECT 0 AS run, 1::BIGINT AS s
  UNION ALL
  SELECT run + 1, list_sort(list(i))[{keys}] + 1 FROM run JOIN linked ON i >= s AND before < s
  GROUP BY run, s HAVING count(*) >= {keys}
),
bounds AS (SELECT run, s, coalesce(lead(s) OVER (ORDER BY run), 9223372036854775807) AS e FROM run)
SELECT id, event_type, value, run FROM (
  SELECT id, event_type, value, run, row_number() OVER (PARTITION BY run, id ORDER BY i DESC) AS rn
  FROM linked JOIN bounds ON i >= s AND i < e
) WHERE rn = 1"""


def _cdc(body: str) -> str:
    return "WITH " + _MESSAGES.strip() + body


def more_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["cdc_reject_split"] = _cdc('\nSELECT "partition", "offset", op, status FROM parsed')
    q["cdc_latest_by_key"] = _cdc(_LATEST.format(src="acc"))
    q["cdc_stream_latest"] = q["cdc_latest_by_key"]
    q["cdc_field_report"] = _cdc("""
SELECT fault, count(*) AS messages FROM acc, (VALUES ('note: unknown'), ('value: type')) f(fault)
WHERE k = 6 GROUP BY fault""")
    q["cdc_drift_export"] = _cdc("""
SELECT id, event_type, value, k <> 2 AND (k = 6 OR value IS NOT NULL) AS has_value, CASE WHEN k = 6 THEN 'x' END AS note FROM (
  SELECT * REPLACE (coalesce(k, -1) AS k), row_number() OVER (PARTITION BY id ORDER BY "offset" DESC, "partition" DESC) AS rn FROM acc
) WHERE rn = 1""")
    q["cdc_bounded_runs"] = _cdc(_runs(B.CDC_BATCH_KEYS)).replace("WITH ", "WITH RECURSIVE ", 1)
    q["cdc_key_bounded_batch"] = _cdc(f""",
firsts AS (
  SELECT id, "offset", "partition" FROM (
    SELECT id, "offset", "partition", row_number() OVER (PARTITION BY id ORDER BY "offset", "partition") AS rn FROM acc
  ) WHERE rn = 1
),
ranked AS (SELECT *, row_number() OVER (ORDER BY "offset", "partition") AS pos FROM firsts),
cut AS (SELECT "offset", "partition" FROM ranked WHERE pos = {B.CDC_BATCH_KEYS}),
bounded AS (
  SELECT a.* FROM acc a
  WHERE NOT EXISTS (SELECT 1 FROM cut)
     OR EXISTS (SELECT 1 FROM cut c WHERE a."offset" < c."offset" OR (a."offset" = c."offset" AND a."partition" <= c."partition"))
)""" + _LATEST.format(src="bounded"))
    q["csv_export_roundtrip"] = _cdc(
        "\nSELECT CAST(id AS INTEGER) AS id, event_type, value FROM ("
        + _LATEST.format(src="acc") + ") t")

    cust = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

    def staging(where: str) -> str:
        return f"""WITH rows AS (SELECT {cust} FROM customer WHERE {where}),
staging AS (
  SELECT CASE WHEN c_acctbal > {B.STAGING_NOKEY_ACCTBAL} AND c_acctbal <= {B.STAGING_REPEAT_ACCTBAL}
              THEN NULL ELSE c_custkey END AS c_custkey,
         c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM rows
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 2, c_mktsegment FROM rows
  WHERE c_acctbal > {B.STAGING_REPEAT_ACCTBAL}
)"""

    q["upsert_existing"] = staging(f"c_acctbal >= {B.STAGING_MIN_ACCTBAL}") + f""",
target AS (SELECT {cust} FROM customer WHERE c_acctbal < {B.TARGET_MAX_ACCTBAL})
SELECT * REPLACE (CAST(c_custkey AS DOUBLE) AS c_custkey) FROM (
  SELECT * FROM target t
  WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.c_custkey = t.c_custkey)
  UNION ALL SELECT * FROM staging)"""
    q["upsert_merge_on_read"] = q["upsert_concurrent"] = q["upsert_existing"]
    q["upsert_first_load"] = staging("true") + """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM staging"""
    q["csv_scan_delimited"] = f"SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
    q["bulk_load_parquet"] = "SELECT * FROM events"
    q["bulk_load_csv"] = "SELECT * FROM events"
    q["bulk_load_stats"] = "SELECT count(*) AS rows, true AS no_empty_part, true AS as_reported FROM lineitem"
    q.update(_functions())
    q.update(_address())
    return q


_ADDR = f"""
seg AS (
  SELECT n.n_regionkey, n.n_nationkey, d.c_mktsegment,
         dense_rank() OVER (PARTITION BY n.n_regionkey, n.n_nationkey ORDER BY d.c_mktsegment) AS d
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) d
  JOIN nation n ON d.c_nationkey = n.n_nationkey
),
region_flat AS (
  SELECT printf('%02d', r.r_regionkey) AS province_code,
         upper(CASE r.r_regionkey {' '.join(f"WHEN {k} THEN '{v}'" for k, v in B.DOC_PROVINCE_NAMES.items())}
               ELSE r.r_name END) AS province_name,
         printf('%02d', r.r_regionkey) || printf('%02d', n.n_nationkey) AS city_code,
         upper(n.n_name) AS city_name,
         printf('%02d', r.r_regionkey) || printf('%02d', n.n_nationkey) || printf('%02d', s.d) AS district_code,
         upper(c.c_mktsegment) AS district_name,
         printf('%02d', r.r_regionkey) || printf('%02d', n.n_nationkey) || printf('%02d', s.d)
           || printf('%06d', c.c_custkey) AS subdistrict_code,
         upper(c.c_name) AS subdistrict_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN seg s ON s.n_nationkey = n.n_nationkey AND s.c_mktsegment = c.c_mktsegment
  WHERE n.n_regionkey <> {B.DROPPED_LEVEL2_REGION}
),
master AS (
  SELECT CASE WHEN c.c_custkey % {B.MASTER_NO_ID_EVERY} = 0 THEN NULL
              WHEN c.c_custkey % {B.MASTER_SAME_ID_EVERY} = 0 THEN c.c_custkey + 99999 ELSE c.c_custkey + 100000 END AS URBAN_ID, r.r_name AS PROVINCE_NAME, n.n_name AS DISTRICT_NAME,
         c.c_mktsegment AS SUBDISTRICT_NAME,
         CASE WHEN c.c_acctbal < {B.MASTER_NO_HASH_BELOW} THEN replace(c.c_name, '#', '')
              WHEN c.c_acctbal > {B.MASTER_OLD_ABOVE} THEN c.c_name || ' (Old)'
              ELSE c.c_name END AS URBAN_NAME,
         'ISLAND ' || CAST(r.r_regionkey AS VARCHAR) AS ISLAND_NAME,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'KOTA' ELSE 'KABUPATEN' END AS TYPE_LABEL,
         printf('%05d', (c.c_custkey * 7) % 100000) AS POSTAL_CODE,
         'SC' || CAST(c.c_custkey AS VARCHAR) AS CODE_SICEPAT,
         CASE WHEN c.c_acctbal > 5000 THEN 'YES' ELSE 'NO' END AS IS_COD_SICEPAT,
         'D' || CAST(c.c_nationkey AS VARCHAR) || '-' || CAST(c.c_custkey AS VARCHAR) AS CODE_JNE_DESTINATION,
         'J' || CAST(c.c_custkey AS VARCHAR) AS CODE_JNE,
         'O' || CAST(c.c_nationkey AS VARCHAR) AS CODE_JNE_ORIGIN,
         'T' || CAST(c.c_custkey AS VARCHAR) AS CODE_TIKI
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_acctbal >= {B.MASTER_ABSENT_BELOW}
),
mnames AS (
  SELECT URBAN_ID, upper(coalesce(PROVINCE_NAME, 'NAN')) AS m_province, upper(coalesce(DISTRICT_NAME, 'NAN')) AS m_city,
         upper(coalesce(SUBDISTRICT_NAME, 'NAN')) AS m_district, upper(coalesce(URBAN_NAME, 'NAN')) AS m_subdistrict
  FROM master WHERE URBAN_ID IS NOT NULL
),
mapped AS (
  SELECT l.subdistrict_code, m.URBAN_ID FROM region_flat l JOIN mnames m
    ON l.province_name IS NOT DISTINCT FROM m.m_province AND l.city_name IS NOT DISTINCT FROM m.m_city
   AND l.district_name IS NOT DISTINCT FROM m.m_district AND l.subdistrict_name IS NOT DISTINCT FROM m.m_subdistrict
),
left_only AS (
  SELECT * FROM region_flat l WHERE NOT EXISTS (SELECT 1 FROM mnames m
    WHERE l.province_name IS NOT DISTINCT FROM m.m_province AND l.city_name IS NOT DISTINCT FROM m.m_city
      AND l.district_name IS NOT DISTINCT FROM m.m_district AND l.subdistrict_name IS NOT DISTINCT FROM m.m_subdistrict)
),
master_only AS (
  SELECT * FROM mnames m WHERE NOT EXISTS (SELECT 1 FROM region_flat l
    WHERE l.province_name IS NOT DISTINCT FROM m.m_province AND l.city_name IS NOT DISTINCT FROM m.m_city
      AND l.district_name IS NOT DISTINCT FROM m.m_district AND l.subdistrict_name IS NOT DISTINCT FROM m.m_subdistrict)
),
blocks AS (
  SELECT DISTINCT l.province_name, m.m_province AS block
  FROM (SELECT DISTINCT province_name FROM left_only) l, (SELECT DISTINCT m_province FROM master_only) m
  WHERE CASE WHEN l.province_name = 'ASIA PACIFIC' THEN substring(m.m_province, 1, 1) = 'A'
             WHEN l.province_name = 'EUROPA' THEN m.m_province = 'EUROPE'
             ELSE m.m_province = l.province_name END
),
lo AS (
  SELECT l.subdistrict_code, b.block,
         l.province_name || '_' || l.city_name || '_' || l.district_name || '_' || l.subdistrict_name AS a
  FROM left_only l JOIN blocks b ON l.province_name = b.province_name
),
mo AS (
  SELECT URBAN_ID, m_province, m_city, m_district,
         regexp_replace(m_subdistrict, '\\([^)]*\\)', '', 'g') AS m_sub_clean FROM master_only
),
pairs AS (
  SELECT lo.subdistrict_code, mo.URBAN_ID, mo.m_province, mo.m_city, mo.m_district, mo.m_sub_clean,
         round(jaro_winkler_similarity(lo.a, mo.m_province || '_' || mo.m_city || '_' || mo.m_district || '_' || mo.m_sub_clean), 9) AS score
  FROM lo JOIN mo ON mo.m_province = lo.block
),
best AS (
  SELECT subdistrict_code AS subdistrict_a, URBAN_ID AS subdistrict_b, score AS similarity_score FROM (
    SELECT *, row_number() OVER (PARTITION BY subdistrict_code
                                 ORDER BY score DESC, m_province, m_city, m_district, m_sub_clean, URBAN_ID) AS rn
    FROM pairs) WHERE rn = 1 AND score > 0
),
merged AS (
  SELECT f.province_code, f.province_name, m.ISLAND_NAME, f.city_code, f.city_name, m.TYPE_LABEL,
         f.district_code, f.district_name, f.subdistrict_code, m.URBAN_ID, f.subdistrict_name, m.POSTAL_CODE,
         m.CODE_SICEPAT, m.IS_COD_SICEPAT, m.CODE_JNE_DESTINATION, m.CODE_JNE, m.CODE_JNE_ORIGIN, m.CODE_TIKI,
         CAST(1.0 AS DOUBLE) AS similarity_score
  FROM mapped p JOIN region_flat f ON p.subdistrict_code = f.subdistrict_code JOIN master m ON p.URBAN_ID = m.URBAN_ID
  UNION ALL
  SELECT f.province_code, f.province_name, m.ISLAND_NAME, f.city_code, f.city_name, m.TYPE_LABEL,
         f.district_code, f.district_name, f.subdistrict_code, m.URBAN_ID, f.subdistrict_name, m.POSTAL_CODE,
         m.CODE_SICEPAT, m.IS_COD_SICEPAT, m.CODE_JNE_DESTINATION, m.CODE_JNE, m.CODE_JNE_ORIGIN, m.CODE_TIKI,
         b.similarity_score
  FROM best b JOIN region_flat f ON b.subdistrict_a = f.subdistrict_code JOIN master m ON b.subdistrict_b = m.URBAN_ID
)"""


def _address() -> dict[str, str]:
    w = "WITH " + _ADDR.strip() + "\n"
    q: dict[str, str] = {}
    q["hierarchy_flatten"] = w + "SELECT * FROM region_flat"
    q["exact_match_split"] = w + (
        "SELECT 'mapped' AS side, subdistrict_code, URBAN_ID FROM mapped "
        "UNION ALL SELECT 'left_only', subdistrict_code, CAST(NULL AS BIGINT) FROM left_only "
        "UNION ALL SELECT 'master_only', CAST(NULL AS VARCHAR), URBAN_ID FROM master_only")
    q["block_alias_join"] = w + (
        "SELECT b.province_name, b.block, l.left_rows, m.master_rows FROM blocks b "
        "JOIN (SELECT province_name, count(*) AS left_rows FROM left_only GROUP BY 1) l ON b.province_name = l.province_name "
        "JOIN (SELECT m_province, count(*) AS master_rows FROM master_only GROUP BY 1) m ON b.block = m.m_province")
    q["jaro_winkler_score"] = w + (
        "SELECT f.subdistrict_code, m.URBAN_ID, round(jaro_winkler_similarity("
        "f.province_name || '_' || f.city_name || '_' || f.district_name || '_' || f.subdistrict_name, "
        "m.m_province || '_' || m.m_city || '_' || m.m_district || '_' || "
        "regexp_replace(m.m_subdistrict, '\\([^)]*\\)', '', 'g')), 9) AS similarity_score "
        "FROM region_flat f JOIN mnames m ON CAST(substring(f.subdistrict_code, 7) AS BIGINT) + 100000 = m.URBAN_ID")
    q["fuzzy_best_match"] = w + "SELECT * FROM best"
    q["region_export"] = q["hierarchy_flatten"]
    # a row without a subdistrict name can't be mapped (no master name is missing)
    q["address_unmatched"] = w.replace("upper(c.c_name) AS subdistrict_name",
                                       "CASE WHEN c.c_custkey % 50 <> 0 THEN upper(c.c_name) END AS subdistrict_name") + (
        "SELECT l.subdistrict_code, CASE WHEN l.subdistrict_name IS NULL THEN 'missing name' ELSE 'no candidate' END AS reason "
        "FROM left_only l WHERE l.subdistrict_code NOT IN (SELECT subdistrict_a FROM best)")
    q["address_merge"] = w + "SELECT * FROM merged"
    q["address_match_pipeline"] = q["address_merge"]
    return q


def _functions() -> dict[str, str]:
    q: dict[str, str] = {}
    q["fn_concat_key"] = (
        "SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) || strftime(l_shipdate, '%Y-%m') AS pos_month_key, "
        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END || l_linestatus AS flag_status_key FROM lineitem")
    q["fn_month_start"] = (
        "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS month_year, "
        "CAST(strftime(l_shipdate, '%Y-%m') || '-01' AS DATE) AS month_year_date FROM lineitem")
    q["fn_month_label"] = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_year FROM orders"
    q["fn_month_shift"] = (
        "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before, "
        "CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS quarter_after, "
        "strftime(date_trunc('month', CAST(o_orderdate AS DATE)) - INTERVAL 1 MONTH, '%Y-%m') AS previous_month "
        "FROM orders")
    d = "CAST(o_orderdate AS DATE)"
    n = f"({d} + INTERVAL 3 MONTH)"
    q["fn_quarter_label"] = (
        f"SELECT o_orderkey, CAST(year({d}) AS VARCHAR) || '-' || CAST(quarter({d}) AS VARCHAR) AS quarter_real, "
        f"CAST(year({n}) AS VARCHAR) || '-' || CAST(quarter({n}) AS VARCHAR) AS quarter_next FROM orders")
    q["fn_clean_name"] = (
        "SELECT p_partkey, regexp_replace(upper(coalesce(CASE WHEN p_size <= 48 THEN "
        "p_name || ' (' || p_brand || ') ' || p_type END, 'NONE')), '\\([^)]*\\)', '', 'g') AS clean_name FROM part")
    q["name_prefix_ilike"] = (
        "SELECT c_custkey, c_mktsegment ILIKE 'auto_%' AS auto_prefixed, "
        "c_mktsegment ILIKE 'ho_se%' AS house_prefixed, c_name ILIKE 'customer#%' AS name_prefixed FROM customer")
    return q
