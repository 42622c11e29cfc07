"""Independent DuckDB formulations of every registered query.

Each string runs on the driver's parquet views (``orders``, ``lineitem``, ...)
and must produce the same multiset of rows, under the same column names, as
the Spark query registered under the same key. The SQL is written directly
from the operator semantics, not generated from the Spark code.
"""

from __future__ import annotations

# -- shared building blocks -------------------------------------------------

ACTIVITY_CTE = """
returned_by_order AS (
    SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS returned_qty
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
),
per_entity AS (
    SELECT c.c_name AS entity, year(o.o_orderdate) AS year,
        sum(CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) END) AS billed,
        max(CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate END) AS billed_last,
        sum(r.returned_qty) AS returned_qty,
        max(CASE WHEN r.returned_qty IS NOT NULL THEN o.o_orderdate END) AS returned_last,
        count(*) FILTER (WHERE o.o_orderstatus = 'O') AS order_count,
        max(CASE WHEN o.o_orderstatus = 'O' THEN o.o_orderdate END) AS open_last
    FROM orders o
    LEFT JOIN returned_by_order r ON o.o_orderkey = r.l_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY c.c_name, year(o.o_orderdate)
),
activity_base AS (
    SELECT 'billed' AS dataset, entity, year, 'billed' AS metric, CAST(billed AS DOUBLE) AS value,
           'currency' AS unit, 'orders' AS source_name,
           'https://data.example.org/orders/billed' AS source_url, billed_last AS last_date
    FROM per_entity WHERE billed IS NOT NULL
    UNION ALL
    SELECT 'returned', entity, year, 'returned_qty', CAST(returned_qty AS DOUBLE), 'items', 'lineitem',
           'https://data.example.org/lineitem/returned', returned_last
    FROM per_entity WHERE returned_qty IS NOT NULL
    UNION ALL
    SELECT 'open_orders', entity, year, 'order_count', CAST(order_count AS DOUBLE), 'count', 'orders',
           'https://data.example.org/orders/open', open_last
    FROM per_entity WHERE order_count > 0
),
activity AS (
    SELECT a.dataset, a.entity, CAST(a.year AS INTEGER) AS year, a.metric, a.value, a.unit,
        CASE WHEN p1.value <> 0
             THEN round_even((100.0 * (a.value - p1.value)) / p1.value * 100.0, 0) / 100.0 END
             AS yoy_change_pct,
        CASE WHEN p5.value <> 0
             THEN round_even((100.0 * (a.value - p5.value)) / p5.value * 100.0, 0) / 100.0 END
             AS five_year_change_pct,
        a.source_name, a.source_url,
        strftime(a.last_date, '%Y-%m-%d') AS source_last_updated,
        'CC-BY-4.0' AS licence, '2026-07-24' AS snapshot_retrieved_at
    FROM activity_base a
    LEFT JOIN activity_base p1
        ON p1.metric = a.metric AND p1.entity = a.entity AND p1.year = a.year - 1
    LEFT JOIN activity_base p5
        ON p5.metric = a.metric AND p5.entity = a.entity AND p5.year = a.year - 5
)"""


def with_activity(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([ACTIVITY_CTE.strip(), *extra_ctes])
    return f"WITH {ctes}\n{body}"


ACTIVITY_LONG = with_activity(
    "SELECT dataset, entity, year, metric, value, unit, yoy_change_pct, five_year_change_pct,\n"
    "       source_name, source_url, source_last_updated, licence, snapshot_retrieved_at\n"
    "FROM activity"
)

ENTITY_KEY_SQL = (
    "substr(sha1(lower(trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '_'))), 1, 12)"
)
LAKE_KEY_SQL = "sha256(lower(regexp_replace(trim({x}), '[^A-Za-z0-9]+', '_', 'g')))"

SILVER_CTE = f"""silver AS (
    SELECT *, dataset AS source_file, {ENTITY_KEY_SQL.format(x='entity')} AS entity_key
    FROM activity
)"""

FACT_CTE = """fact AS (
    SELECT entity_key, entity, year, metric, value, unit, yoy_change_pct, five_year_change_pct
    FROM silver
)"""

STG_CTE = """stg AS (
    SELECT entity_key, trim(entity) AS entity, CAST(year AS INTEGER) AS year, metric,
           CAST(value AS DOUBLE) AS value, unit,
           CAST(yoy_change_pct AS DOUBLE) AS yoy_change_pct,
           CAST(five_year_change_pct AS DOUBLE) AS five_year_change_pct
    FROM fact
)"""

# reference year per metric, score weights and column stems of the activity mart
REF_CTE = """ref AS (
    SELECT * FROM silver
    WHERE (metric = 'billed' AND year = 2000) OR (metric = 'returned_qty' AND year = 2000)
       OR (metric = 'order_count' AND year = 1999)
)"""

DIM_CTE = """dim AS (
    SELECT entity_key, entity FROM (
        SELECT entity_key, entity, row_number() OVER (
            PARTITION BY entity_key
            ORDER BY CASE metric WHEN 'billed' THEN 0 WHEN 'returned_qty' THEN 1 ELSE 2 END, entity
        ) AS rn
        FROM ref
    ) WHERE rn = 1
)"""


def _slice(prefix: str, metric: str, value_col: str) -> str:
    return f"""m_{prefix} AS (
    SELECT entity_key, year AS {prefix}_year, value AS {value_col},
           yoy_change_pct AS {prefix}_yoy_pct, five_year_change_pct AS {prefix}_five_year_pct
    FROM ref WHERE metric = '{metric}'
)"""


def _prior(value: str, pct: str) -> str:
    return (f"CASE WHEN 1 + {pct} / 100.0 = 0 THEN {value} "
            f"ELSE {value} / (1 + {pct} / 100.0) END")


def _scaled(i: int) -> str:
    return f"CASE WHEN hi{i} - lo{i} = 0 THEN 0.0 ELSE (l{i} - lo{i}) / (hi{i} - lo{i}) END"


MART_CTES = [
    SILVER_CTE,
    REF_CTE,
    DIM_CTE,
    _slice("billed", "billed", "billed_2000"),
    _slice("returned_qty", "returned_qty", "returned_qty_2000"),
    _slice("order_count", "order_count", "order_count_1999"),
    """wide AS (
    SELECT d.entity_key, d.entity,
           b.billed_year, coalesce(b.billed_2000, 0.0) AS billed_2000,
           b.billed_yoy_pct, b.billed_five_year_pct,
           r.returned_qty_year, coalesce(r.returned_qty_2000, 0.0) AS returned_qty_2000,
           r.returned_qty_yoy_pct, r.returned_qty_five_year_pct,
           c.order_count_year, coalesce(c.order_count_1999, 0.0) AS order_count_1999,
           c.order_count_yoy_pct, c.order_count_five_year_pct
    FROM dim d
    LEFT JOIN m_billed b ON b.entity_key = d.entity_key
    LEFT JOIN m_returned_qty r ON r.entity_key = d.entity_key
    LEFT JOIN m_order_count c ON c.entity_key = d.entity_key
)""",
    f"""measures AS (
    SELECT *,
        {_prior('billed_2000', 'billed_yoy_pct')} AS billed_1999_estimated,
        {_prior('returned_qty_2000', 'returned_qty_yoy_pct')} AS returned_qty_1999_estimated,
        {_prior('billed_2000', 'billed_five_year_pct')} AS billed_1995_estimated,
        {_prior('returned_qty_2000', 'returned_qty_five_year_pct')} AS returned_qty_1995_estimated,
        CASE WHEN order_count_1999 > 0 THEN billed_2000 / order_count_1999 END AS billed_per_order,
        CASE WHEN order_count_1999 > 0 THEN returned_qty_2000 / order_count_1999 END
            AS returned_qty_per_order,
        CASE WHEN billed_yoy_pct IS NULL AND returned_qty_yoy_pct IS NULL THEN NULL
             ELSE (coalesce(billed_yoy_pct, 0.0) + coalesce(returned_qty_yoy_pct, 0.0))
                  / (CAST(billed_yoy_pct IS NOT NULL AS INTEGER)
                     + CAST(returned_qty_yoy_pct IS NOT NULL AS INTEGER)) END AS combined_yoy_pct,
        ln(1 + greatest(coalesce(billed_2000, 0.0), 0.0)) AS l1,
        ln(1 + greatest(coalesce(returned_qty_2000, 0.0), 0.0)) AS l2,
        ln(1 + greatest(coalesce(order_count_1999, 0.0), 0.0)) AS l3
    FROM wide
)""",
    """extrema AS (
    SELECT min(l1) AS lo1, max(l1) AS hi1, min(l2) AS lo2, max(l2) AS hi2,
           min(l3) AS lo3, max(l3) AS hi3
    FROM measures
)""",
    f"""mart AS (
    SELECT entity_key, entity,
        billed_year, billed_2000, billed_yoy_pct, billed_five_year_pct,
        returned_qty_year, returned_qty_2000, returned_qty_yoy_pct, returned_qty_five_year_pct,
        order_count_year, order_count_1999, order_count_yoy_pct, order_count_five_year_pct,
        billed_1999_estimated, returned_qty_1999_estimated,
        billed_1995_estimated, returned_qty_1995_estimated,
        billed_per_order, returned_qty_per_order, combined_yoy_pct,
        CASE WHEN combined_yoy_pct IS NULL THEN 'Not comparable'
             WHEN combined_yoy_pct <= -5 THEN 'Declining'
             WHEN combined_yoy_pct <= 5 THEN 'Stable'
             ELSE 'Expanding' END AS activity_class,
        round_even((45 * {_scaled(1)} + 35 * {_scaled(2)} + 20 * {_scaled(3)}) * 100.0, 0) / 100.0
            AS activity_score
    FROM measures CROSS JOIN extrema
)""",
]


def with_mart(body: str, *extra: str) -> str:
    return with_activity(body, *MART_CTES, *extra)


MART_SQL = with_mart("SELECT * FROM mart")


def humanize(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1e9 THEN printf('%.2f', {x} / 1e9) || 'B' "
        f"WHEN {x} >= 1e6 THEN printf('%.2f', {x} / 1e6) || 'M' "
        f"WHEN {x} >= 1e3 THEN printf('%.1f', {x} / 1e3) || 'K' "
        f"ELSE format('{{:,.0f}}', {x}) END"
    )


BY_METRIC_CTE = """by_metric AS (
    SELECT entity_key, entity, activity_score, 'billed' AS metric,
           CAST(billed_2000 AS DOUBLE) AS value, billed_yoy_pct AS yoy_pct,
           billed_five_year_pct AS five_year_pct FROM mart
    UNION ALL
    SELECT entity_key, entity, activity_score, 'returned_qty', CAST(returned_qty_2000 AS DOUBLE),
           returned_qty_yoy_pct, returned_qty_five_year_pct FROM mart
    UNION ALL
    SELECT entity_key, entity, activity_score, 'order_count', CAST(order_count_1999 AS DOUBLE),
           order_count_yoy_pct, order_count_five_year_pct FROM mart
)"""

LIST_ORDER = "activity_score DESC NULLS LAST, entity ASC NULLS LAST, entity_key ASC NULLS LAST"


def _top_by_metric(k: int) -> str:
    return f"""top_metric AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY metric ORDER BY value DESC NULLS LAST, {LIST_ORDER}) AS position
        FROM by_metric
    ) WHERE position <= {k}
)"""


REPORT_COLUMNS = ["dataset", "check_name", "status", "failed_rows", "severity"]


def _written(name: str, table: str, columns: list[str]) -> str:
    """Rows and digest of what an output must hold: 48 bits of each line's MD5, added up."""
    line = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns) + ")"
    return (f"(SELECT count(*) FROM {table}) AS {name}_rows, (SELECT coalesce(CAST(sum(CAST('0x' || substr(md5({line}), 1, 12) AS BIGINT)) "
            f"AS VARCHAR), '0') FROM {table}) AS {name}_digest")


def _top1(value_col: str) -> str:
    return (f"(SELECT entity FROM mart ORDER BY {value_col} DESC NULLS LAST, {LIST_ORDER} "
            f"LIMIT 1)")


def _order_free_avg(c: str) -> str:
    """Mean over whole parts and two parts of 40 bits below the point, each summed in whole numbers."""
    part = "CAST(1099511627776 AS DOUBLE)"
    below = f"(({c} - trunc({c})) * {part})"
    second = f"trunc(({below} - trunc({below})) * {part})"
    whole, one, two = (f"CAST(sum(CAST({x} AS HUGEINT)) AS DOUBLE)" for x in (f"trunc({c})", f"trunc({below})", second))
    return f"CASE WHEN count({c}) > 0 THEN ({whole} + ({one} / {part} + {two} / ({part} * {part}))) / count({c}) END"


def _check(dataset: str, table: str, name: str, failed: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, "
            f"CAST(({failed}) AS BIGINT) AS failed_rows FROM {table}")


def _dup(dataset: str, table: str, name: str, keys: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS failed_rows "
            f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})")


def _report(checks: list[str]) -> str:
    union = "\n    UNION ALL ".join(checks)
    return f"""SELECT dataset, check_name,
       CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       failed_rows, 'ERROR' AS severity
FROM ({union})"""


def _any_null(cols: list[str]) -> str:
    return "count(*) FILTER (WHERE " + " OR ".join(f"{c} IS NULL" for c in cols) + ")"


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate", "ship_year"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority", "order_year"]

DQ_REPORT_BODY = _report([
    _check("lineitem", "li", "required_fields_not_null", _any_null(LINEITEM_COLS)),
    _dup("lineitem", "li", "orderkey_linenumber_unique", "l_orderkey, l_linenumber"),
    _check("lineitem", "li", "quantity_non_negative",
           "count(*) FILTER (WHERE coalesce(TRY_CAST(l_quantity AS DOUBLE) < 0, false))"),
    _check("lineitem", "li", "ship_year_in_range",
           "count(*) FILTER (WHERE NOT coalesce(TRY_CAST(ship_year AS DOUBLE) "
           "BETWEEN 1992 AND 1998, false))"),
    _check("pages", "pages", "required_fields_not_null", _any_null(["page_id", "url", "html"])),
    _dup("pages", "pages", "page_id_unique", "page_id"),
    _check("pages", "pages", "url_is_https",
           "count(*) FILTER (WHERE NOT coalesce(starts_with(CAST(url AS VARCHAR), 'https://'), "
           "false))"),
    _check("pages", "pages", "html_present",
           "count(*) FILTER (WHERE coalesce(trim(html) = '', false))"),
    _check("orders", "o", "required_fields_not_null", _any_null(ORDERS_COLS)),
    _dup("orders", "o", "orderkey_unique", "o_orderkey"),
    _check("orders", "o", "totalprice_non_negative",
           "count(*) FILTER (WHERE coalesce(TRY_CAST(o_totalprice AS DOUBLE) < 0, false))"),
    _check("orders", "o", "order_year_in_range",
           "count(*) FILTER (WHERE NOT coalesce(TRY_CAST(order_year AS DOUBLE) "
           "BETWEEN 2000 AND 2100, false))"),
    _dup("customer", "customer", "custkey_unique", "c_custkey"),
    _check("customer", "customer", "acctbal_non_negative",
           "count(*) FILTER (WHERE coalesce(TRY_CAST(c_acctbal AS DOUBLE) < 0, false))"),
    _check("customer", "customer", "name_present",
           "count(*) FILTER (WHERE coalesce(trim(c_name) = '', false))"),
])
DQ_CTES = ("WITH li AS (SELECT *, year(l_shipdate) AS ship_year FROM lineitem),\n"
           "o AS (SELECT *, year(o_orderdate) AS order_year FROM orders),\n")
DQ_REPORT = DQ_CTES + "report AS (" + DQ_REPORT_BODY + ")\nSELECT * FROM report"

ACTIVITY_QUALITY = with_activity(
    "SELECT * FROM report",
    "report AS (" + _report(
        [
            part
            for ds in ("billed", "returned", "open_orders")
            for part in (
                _check(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                       "required_fields_not_null",
                       _any_null(["entity", "year", "metric", "value", "unit",
                                  "source_name", "source_url",
                                  "source_last_updated", "licence", "snapshot_retrieved_at"])),
                _dup(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                     "municipality_year_unique", "entity, year, metric"),
                _check(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                       "value_non_negative",
                       "count(*) FILTER (WHERE coalesce(TRY_CAST(value AS DOUBLE) < 0, false))"),
                _check(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                       "year_in_expected_range",
                       "count(*) FILTER (WHERE NOT coalesce(TRY_CAST(year AS DOUBLE) "
                       "BETWEEN 1990 AND 2100, false))"),
                _check(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                       "source_url_is_https",
                       "count(*) FILTER (WHERE NOT coalesce(starts_with(source_url, 'https://'), "
                       "false))"),
                _check(ds, f"(SELECT * FROM activity WHERE dataset = '{ds}')",
                       "licence_present",
                       "count(*) FILTER (WHERE coalesce(trim(licence) = '', false))"),
            )
        ]
    ) + ")",
)

LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]


def _dedup(order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ("
            f"PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) "
            f"WHERE rn = 1")


UPSERT_CTES = """WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
             o_orderdate, o_orderpriority, true AS from_s
      FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "activity_long": ACTIVITY_LONG,
        "activity_quality": ACTIVITY_QUALITY,
        "silver_activity": with_activity(
            "SELECT dataset, entity, year, metric, value, unit, yoy_change_pct,\n"
            "       five_year_change_pct, source_name, source_url, source_last_updated, licence,\n"
            "       snapshot_retrieved_at, source_file, entity_key FROM silver",
            SILVER_CTE,
        ),
        "stg_activity": with_activity("SELECT * FROM stg", SILVER_CTE, FACT_CTE, STG_CTE),
        "metric_summary": with_activity(
            f"""SELECT metric, year, count(*) AS source_records,
       count(DISTINCT entity_key) AS entities,
       CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS snapshot_total,
       {_order_free_avg('yoy_change_pct')} AS average_yoy_change_pct,
       {_order_free_avg('five_year_change_pct')} AS average_five_year_change_pct
FROM stg GROUP BY metric, year""",
            SILVER_CTE, FACT_CTE, STG_CTE,
        ),
        "entity_rankings": with_activity(
            """SELECT entity_key, entity, metric, year, value, yoy_change_pct,
       dense_rank() OVER (PARTITION BY metric ORDER BY value DESC) AS snapshot_rank
FROM stg""",
            SILVER_CTE, FACT_CTE, STG_CTE,
        ),
        "model_tests": with_activity(
            _report([
                _check("stg", "stg", "not_null_entity_key",
                       "count(*) FILTER (WHERE entity_key IS NULL)"),
                _check("stg", "stg", "not_null_metric", "count(*) FILTER (WHERE metric IS NULL)"),
                _check("stg", "stg", "accepted_values_metric",
                       "count(*) FILTER (WHERE metric IS NOT NULL AND metric NOT IN "
                       "('billed', 'returned_qty', 'order_count'))"),
                _check("stg", "stg", "not_null_value", "count(*) FILTER (WHERE value IS NULL)"),
                _check("metric_summary", "(SELECT metric FROM stg GROUP BY metric, year)",
                       "not_null_metric", "count(*) FILTER (WHERE metric IS NULL)"),
                _check("rankings",
                       "(SELECT dense_rank() OVER (PARTITION BY metric ORDER BY value DESC) AS r "
                       "FROM stg)", "not_null_snapshot_rank",
                       "count(*) FILTER (WHERE r IS NULL)"),
            ]),
            SILVER_CTE, FACT_CTE, STG_CTE,
        ),
        "dim_entity": with_activity("SELECT * FROM dim", SILVER_CTE, REF_CTE, DIM_CTE),
        "fact_activity": with_activity("SELECT * FROM fact", SILVER_CTE, FACT_CTE),
        "mart_entity_summary": MART_SQL,
        "mart_entity_summary_agg": MART_SQL,
        "gated_run": MART_SQL,
        "lineitem_measures": """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END AS unit_price,
       CASE WHEN 1 + (l_tax * 100) / 100.0 = 0 THEN l_extendedprice
            ELSE l_extendedprice / (1 + (l_tax * 100) / 100.0) END AS price_before_tax,
       CASE WHEN l_discount IS NULL AND l_tax IS NULL THEN NULL
            ELSE (coalesce(l_discount, 0.0) + coalesce(l_tax, 0.0))
                 / (CAST(l_discount IS NOT NULL AS INTEGER) + CAST(l_tax IS NOT NULL AS INTEGER))
            END AS mean_rate,
       CASE WHEN (l_discount - 0.05) * 100 IS NULL THEN 'Not comparable'
            WHEN (l_discount - 0.05) * 100 <= -5 THEN 'Declining'
            WHEN (l_discount - 0.05) * 100 <= 5 THEN 'Stable'
            ELSE 'Expanding' END AS discount_class
FROM lineitem""",
        "entity_keys": f"""WITH names AS (
    SELECT 'customer' AS source, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'documents', doc_id, text FROM documents
    UNION ALL SELECT 'pages', page_id, url FROM pages
)
SELECT source, id, {ENTITY_KEY_SQL.format(x='name')} AS entity_key,
       {LAKE_KEY_SQL.format(x='name')} AS lake_key
FROM names""",
        "normalize_identifier": """SELECT 'part' AS source, p_partkey AS id,
       nullif(regexp_replace(upper(trim(p_brand)), '[^A-Z0-9]', '', 'g'), '') AS identifier
FROM part
UNION ALL
SELECT 'customer', c_custkey,
       nullif(regexp_replace(upper(trim(c_name)), '[^A-Z0-9]', '', 'g'), '')
FROM customer""",
        "record_hash": """SELECT 'nation' AS source, CAST(n_nationkey AS BIGINT) AS id,
       sha256(concat_ws('|', coalesce(CAST(n_name AS VARCHAR), 'nan'),
                        coalesce(CAST(n_nationkey AS VARCHAR), 'nan'),
                        coalesce(CAST(n_regionkey AS VARCHAR), 'nan'))) AS record_hash
FROM nation
UNION ALL
SELECT 'part', p_partkey,
       sha256(concat_ws('|', coalesce(p_brand, 'nan'), coalesce(p_name, 'nan'),
                        coalesce(CAST(p_partkey AS VARCHAR), 'nan'),
                        coalesce(CAST(p_size AS VARCHAR), 'nan'), coalesce(p_type, 'nan')))
FROM part""",
        "casts_strict_lenient": """SELECT 'part' AS source, p_partkey AS id,
       CAST(regexp_replace(p_brand, '^Brand#', '') AS INTEGER) AS as_int_strict,
       TRY_CAST(p_brand AS INTEGER) AS as_int_lenient,
       CAST(NULL AS VARCHAR) AS date_text, CAST(NULL AS DATE) AS as_date
FROM part
UNION ALL
SELECT 'orders', o_orderkey, CAST(CAST(o_custkey AS VARCHAR) AS INTEGER),
       TRY_CAST(o_orderpriority AS INTEGER),
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), CAST(o_orderdate AS DATE)
FROM orders
UNION ALL
SELECT 'events', event_id, NULL, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), NULL, NULL
FROM events""",
        "lake_silver_filter": """WITH v AS (
    SELECT c_custkey AS id, c_name AS entity, c_acctbal + 0.0 AS value, '2024-01-01' AS day FROM customer
    UNION ALL SELECT c_custkey, c_name, c_acctbal - 5000.0, '2024-06-01' FROM customer)
SELECT id, entity, value, day AS ingested_at_utc, 'customer' AS source_file, CAST(day AS DATE) AS source_last_updated
FROM v WHERE value >= 0
QUALIFY row_number() OVER (PARTITION BY id ORDER BY day DESC) = 1""",
        "dedup_keep_last": _dedup(", ".join(f"{c} DESC" for c in ["l_shipdate", *LI_REST])),
        "dedup_keep_first": _dedup(", ".join(f"{c} ASC" for c in ["l_shipdate", *LI_REST])),
        "dedup_keep_any": _dedup(", ".join(f"{c} ASC" for c in [*LI_REST, "l_shipdate"])),
        "dq_report": DQ_REPORT,
        "dq_gate_status": DQ_CTES + "report AS (" + DQ_REPORT_BODY + """)
SELECT count(*) AS quality_checks,
       count(*) FILTER (WHERE status = 'FAIL') AS quality_failures,
       count(*) FILTER (WHERE status = 'FAIL' AND severity = 'ERROR') AS blocking_failures
FROM report""",
        "dq_not_null_accepted": _report([
            _check("orders", "orders", "not_null_o_orderkey",
                   "count(*) FILTER (WHERE o_orderkey IS NULL)"),
            _check("orders", "orders", "not_null_o_orderstatus",
                   "count(*) FILTER (WHERE o_orderstatus IS NULL)"),
            _check("orders", "orders", "accepted_values_o_orderstatus",
                   "count(*) FILTER (WHERE o_orderstatus IS NOT NULL "
                   "AND o_orderstatus NOT IN ('F', 'O'))"),
            _check("events", "events", "not_null_event_id",
                   "count(*) FILTER (WHERE event_id IS NULL)"),
            _check("events", "events", "not_null_event_type",
                   "count(*) FILTER (WHERE event_type IS NULL)"),
            _check("events", "events", "accepted_values_event_type",
                   "count(*) FILTER (WHERE event_type IS NOT NULL "
                   "AND event_type NOT IN ('click', 'view', 'purchase'))"),
        ]),
        "metric_domain": with_activity(
            """SELECT dataset, expected_metric, other_values, present,
       other_values = 0 AND present > 0 AS ok
FROM (
    SELECT a.dataset, e.expected_metric,
           count(*) FILTER (WHERE a.metric <> e.expected_metric) AS other_values,
           count(a.metric) AS present
    FROM activity a JOIN expected e ON e.dataset = a.dataset
    GROUP BY a.dataset, e.expected_metric
)""",
            "expected(dataset, expected_metric) AS (VALUES ('billed', 'billed'), "
            "('returned', 'returned_qty'), ('open_orders', 'order_count'))",
        ),
        "merge_upsert": UPSERT_CTES + """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.from_s THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.from_s THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.from_s THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.from_s THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.from_s THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
        "merge_schema_evolution": UPSERT_CTES + """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.from_s THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.from_s THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderpriority AS o_orderpriority,
       s.o_orderstatus AS o_orderstatus
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
        "topk_by_metric": with_mart(
            "SELECT metric, position, entity_key, entity, value, yoy_pct, five_year_pct "
            "FROM top_metric", BY_METRIC_CTE, _top_by_metric(10)),
        "top1_labels": with_mart(
            f"SELECT {_top1('billed_2000')} AS top_billed_entity, "
            f"{_top1('returned_qty_2000')} AS top_returned_qty_entity, "
            f"{_top1('order_count_1999')} AS top_order_count_entity"),
        "momentum_extremes": with_mart(
            f"""SELECT list, position, entity_key, entity, value, {humanize('value')} || '%' AS label
FROM (
    SELECT *, row_number() OVER (PARTITION BY list ORDER BY v DESC NULLS LAST, {LIST_ORDER})
              AS position
    FROM (
        SELECT 'growth' AS list, entity_key, entity, activity_score,
               combined_yoy_pct AS value, combined_yoy_pct AS v
        FROM mart WHERE combined_yoy_pct IS NOT NULL
        UNION ALL
        SELECT 'decline', entity_key, entity, activity_score, combined_yoy_pct, -combined_yoy_pct
        FROM mart WHERE combined_yoy_pct IS NOT NULL
    )
) WHERE position <= 3"""),
        "findings_extract": with_mart(
            f"""SELECT 'top_' || metric AS section, position, entity, {humanize('value')} AS label
FROM top_metric
UNION ALL
SELECT list, position, entity, {humanize('value')} || '%'
FROM (
    SELECT *, row_number() OVER (PARTITION BY list ORDER BY v DESC NULLS LAST, {LIST_ORDER})
              AS position
    FROM (
        SELECT 'growth' AS list, entity_key, entity, activity_score,
               combined_yoy_pct AS value, combined_yoy_pct AS v
        FROM mart WHERE combined_yoy_pct IS NOT NULL
        UNION ALL
        SELECT 'decline', entity_key, entity, activity_score, combined_yoy_pct, -combined_yoy_pct
        FROM mart WHERE combined_yoy_pct IS NOT NULL
    )
) WHERE position <= 3
UNION ALL
SELECT 'total_' || metric, CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), {humanize('total')}
FROM (SELECT metric, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total
      FROM by_metric GROUP BY metric)""", BY_METRIC_CTE, _top_by_metric(3)),
        "momentum_ranking": with_mart(
            "SELECT entity_key, entity, combined_yoy_pct, activity_class, "
            "row_number() OVER (ORDER BY combined_yoy_pct, entity, entity_key) AS position FROM mart "
            "WHERE combined_yoy_pct IS NOT NULL"),
        "dashboard_filters": with_mart(" UNION ALL ".join(
            f"SELECT '{name}' AS filter, entity_key, entity, activity_class, combined_yoy_pct FROM mart WHERE {cond}"
            for name, cond in (
                ("expanding", "activity_class = 'Expanding'"),
                ("billed_and_returned", "billed_2000 IS NOT NULL AND returned_qty_2000 IS NOT NULL"),
                ("decline", "combined_yoy_pct < 0"),
                ("unknown", "combined_yoy_pct IS NULL"),
                ("names", "entity IN ('Customer#000000001', 'Customer#000000002')"),
                ("together", "activity_class IN ('Stable', 'Expanding') AND order_count_1999 IS NOT NULL "
                             "AND combined_yoy_pct > 0")))),
        "ordered_outputs": with_mart(f"""SELECT 'silver' AS table_name, entity_key, metric,
       CAST(year AS VARCHAR) AS year, row_number() OVER (ORDER BY entity, year, metric) AS position FROM silver
UNION ALL SELECT 'dimension', entity_key, NULL, NULL, row_number() OVER (ORDER BY entity, entity_key) FROM dim
UNION ALL SELECT 'fact', entity_key, metric, CAST(year AS VARCHAR),
       row_number() OVER (ORDER BY metric, value DESC, entity_key, year) FROM fact
UNION ALL SELECT 'mart', entity_key, NULL, NULL, row_number() OVER (ORDER BY {LIST_ORDER}) FROM mart""", FACT_CTE),
        "mart_head": with_mart(
            f"""SELECT position, entity_key, entity,
       format('{{:,.0f}}', billed_2000) AS billed_2000_text,
       format('{{:,.0f}}', returned_qty_2000) AS returned_qty_2000_text,
       format('{{:,.0f}}', order_count_1999) AS order_count_1999_text,
       printf('%.2f', combined_yoy_pct) AS combined_yoy_pct_text,
       printf('%.2f', activity_score) AS activity_score_text
FROM (SELECT *, row_number() OVER (ORDER BY {LIST_ORDER}) AS position FROM mart)
WHERE position <= 20"""),
        "dashboard_bars": with_mart(
            f"""SELECT metric, position, entity_key, entity, value,
       greatest(1.0, 100.0 * value / greatest(max(value) OVER (PARTITION BY metric), 1.0))
           AS width_pct,
       {humanize('value')} AS label
FROM top_metric""", BY_METRIC_CTE, _top_by_metric(8)),
        "serving_topn": with_mart(
            "SELECT entity, billed_2000, returned_qty_2000, order_count_1999 FROM mart "
            f"ORDER BY {LIST_ORDER} LIMIT 10"),
        "metric_extract": with_activity("SELECT * FROM fact WHERE metric = 'billed'",
                                        SILVER_CTE, FACT_CTE),
        "snapshot_metrics": with_mart(
            f"""SELECT
    (SELECT count(*) FROM fact) AS source_records,
    (SELECT count(*) FILTER (WHERE metric = 'billed') FROM fact) AS billed_records,
    (SELECT count(*) FILTER (WHERE metric = 'returned_qty') FROM fact) AS returned_qty_records,
    (SELECT count(*) FILTER (WHERE metric = 'order_count') FROM fact) AS order_count_records,
    (SELECT count(DISTINCT entity_key) FROM mart) AS entities,
    (SELECT CAST(sum(CAST(billed_2000 AS DECIMAL(38,6))) AS DOUBLE) FROM mart) AS snapshot_billed,
    (SELECT CAST(sum(CAST(returned_qty_2000 AS DECIMAL(38,6))) AS DOUBLE) FROM mart)
        AS snapshot_returned_qty,
    (SELECT CAST(sum(CAST(order_count_1999 AS DECIMAL(38,6))) AS DOUBLE) FROM mart)
        AS snapshot_order_count,
    {_top1('billed_2000')} AS top_billed_entity,
    {_top1('returned_qty_2000')} AS top_returned_qty_entity,
    {_top1('order_count_1999')} AS top_order_count_entity,
    CAST(18 AS BIGINT) AS quality_checks,
    CAST(0 AS BIGINT) AS quality_failures""", FACT_CTE),
        "table_row_counts": "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
            for t in ("region nation customer supplier part orders lineitem events documents "
                      "embeddings pages benchmark labels conversations").split()
        ),
        "bronze_lineage": """WITH rows AS (
    SELECT 'part' AS dataset, CAST(p_partkey AS VARCHAR) AS id, 'part' AS metric,
           '  "' || p_name || '", ' || p_type || ' ' AS label FROM part
    UNION ALL
    SELECT 'order', CAST(o_orderkey AS VARCHAR), 'order', o_orderstatus || ',"' || o_orderpriority FROM orders)
SELECT *, sha256(id || '|' || label || '|' || metric) AS record_hash, true AS file_named, true AS ingested
FROM rows""",
        "file_discovery": """SELECT event_type, CAST(event_id % 4 AS INTEGER) AS part, true AS has_bytes,
       count(*) AS rows, min(event_id) AS first_event
FROM events GROUP BY event_type, event_id % 4""",
        "lake_counts": with_activity("""SELECT count(*) AS bronze_rows,
       count(*) FILTER (WHERE value >= 0) AS silver_rows, count(*) FILTER (WHERE value >= 0) AS export_rows
FROM activity"""),
        "lake_run": with_activity(
            f"""SELECT dataset, entity, year, metric, value, unit, yoy_change_pct,
       five_year_change_pct, source_name, source_url,
       CAST(source_last_updated AS DATE) AS source_last_updated, licence,
       CAST(snapshot_retrieved_at AS DATE) AS snapshot_retrieved_at,
       dataset AS source_file, {LAKE_KEY_SQL.format(x='entity')} AS lake_key
FROM activity WHERE value >= 0"""),
        "run_manifest": with_mart(
            f"""SELECT 'dim_entity,fct_activity,mart_entity_summary' AS gold_tables,
       'data_quality_report,fact_by_metric,mart_entity_summary' AS extract_tables,
       'data_quality_report,summary_metrics,top_by_metric' AS result_files,
       (SELECT count(*) FROM dim) AS dim_entity_rows,
       (SELECT count(*) FROM fact) AS fct_activity_rows,
       (SELECT count(*) FROM mart) AS mart_entity_summary_rows,
       {_written('report', 'checks', REPORT_COLUMNS)}, {_written('report_copy', 'checks', REPORT_COLUMNS)},
       {_written('top_lists', 'top_metric', ['metric', 'position', 'entity_key'])},
       {_written('fact_extracts', 'fact', ['metric', 'year', 'entity_key'])},
       CAST(18 AS BIGINT) AS quality_checks, CAST(0 AS BIGINT) AS quality_failures""",
            FACT_CTE, BY_METRIC_CTE, _top_by_metric(10), f"checks AS ({ACTIVITY_QUALITY})"),
        "incremental_ingest": """SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'click' THEN value + 1.0 ELSE value END AS value, props
FROM events""",
        "humanize_volume": f"""WITH g AS (
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(*) AS orders
    FROM orders GROUP BY o_orderstatus, year(o_orderdate)
    UNION ALL
    SELECT 'ALL', CAST(NULL AS INTEGER),
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), count(*)
    FROM orders
)
SELECT o_orderstatus, year, total, orders, {humanize('total')} AS total_label,
       {humanize('CAST(orders AS DOUBLE)')} AS orders_label
FROM g""",
    }
    # these return by another way what a query above returns directly
    for name, same in (("csv_staging", "stg_activity"), ("materialized_summary", "metric_summary"),
                       ("metrics_document", "snapshot_metrics")):
        sql[name] = sql[same]
    return sql
