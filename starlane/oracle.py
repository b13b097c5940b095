"""The reference answers as SQL for DuckDB, over the same parquet tables."""

from __future__ import annotations

import re

# Derived delivery tables, in order of dependence.
FIXTURES: dict[str, str] = {
    "fx_cities": """
        SELECT CAST(r_regionkey AS BIGINT) AS city_id, r_name AS city_name, 'Testland' AS country, 'UTC'
        AS timezone
        FROM region
    """,
    "fx_regions": """
        SELECT CAST(n_nationkey AS BIGINT) AS region_id, n_name AS region_name, CAST(n_regionkey AS
        BIGINT) AS city_id, CAST(10 + n_nationkey * 0.5 AS DOUBLE) AS delivery_base_fee
        FROM nation
    """,
    "fx_segments": """
        SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) AS BIGINT) AS segment_id, c_mktsegment AS
        segment_name, CAST(length(c_mktsegment) AS DOUBLE) AS discount_pct, c_mktsegment = 'BUILDING' AS
        priority_support
        FROM (SELECT DISTINCT c_mktsegment
        FROM customer) s
    """,
    "fx_teams": """
        SELECT CAST(r_regionkey AS BIGINT) AS team_id, concat('Team ', r_name) AS team_name
        FROM region
    """,
    "fx_agents": """
        SELECT CAST(n_nationkey AS BIGINT) AS agent_id, concat('Agent ', replace(n_name, '_', '-')) AS
        agent_name, concat('agent.', CAST(n_nationkey AS STRING), '@desk.example') AS agent_email,
        concat('011', lpad(CAST(n_nationkey AS STRING), 8, '0')) AS agent_phone, CASE WHEN n_nationkey %
        12 = 11 THEN NULL ELSE CAST(n_regionkey AS BIGINT) END AS team_id, CASE n_nationkey % 3 WHEN 0
        THEN 'Junior' WHEN 1 THEN 'Mid' ELSE 'Senior' END AS skill_level
        FROM nation
    """,
    "fx_channels": """
        SELECT CAST(v AS BIGINT) AS channel_id, n AS channel_name
        FROM (VALUES (1, 'app'), (2, 'chat'), (3, 'phone'), (4, 'email')) AS t(v, n)
    """,
    "fx_priorities": """
        SELECT CAST(v AS BIGINT) AS priority_id, c AS priority_code, n AS priority_name, CAST(f AS
        BIGINT) AS sla_first_response_min, CAST(r AS BIGINT) AS sla_resolution_min
        FROM (VALUES (1, 'P1', 'Critical', 60, 720), (2, 'P2', 'High', 240, 1440), (3, 'P3', 'Medium',
        480, 2880)) AS t(v, c, n, f, r)
    """,
    "fx_reason_categories": """
        SELECT DISTINCT CAST(r_regionkey % 3 + 1 AS BIGINT) AS reason_category_id,
            concat('Category ', CAST(r_regionkey % 3 + 1 AS STRING)) AS category_name
        FROM region
    """,
    "fx_reasons": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS reason_id, r_name AS reason_name,
            CAST(r_regionkey % 3 + 1 AS BIGINT) AS reason_category_id,
            CAST(length(r_name) AS STRING) AS severity_level,
            CAST(r_regionkey AS DOUBLE) * 0.25 AS typical_refund_pct
        FROM region
    """,
    "fx_customers_raw": """
        SELECT CAST(c_custkey AS STRING) AS customer_id, concat('Cust', substr('ABCDEFGHIJ',
        CAST(c_custkey % 10 + 1 AS INT), 1), ' El-', c_mktsegment) AS full_name, CASE WHEN c_custkey %
        20 = 7 THEN 'notanemail' WHEN c_custkey % 20 = 8 THEN NULL ELSE concat('user.', CAST(c_custkey
        AS STRING), '@mail.example') END AS email, CASE WHEN c_custkey % 25 = 3 THEN 'N/A' ELSE
        concat('010', lpad(CAST(c_custkey AS STRING), 8, '0')) END AS phone, CASE WHEN c_custkey % 40 =
        11 THEN NULL WHEN c_custkey % 40 = 12 THEN 'bad' ELSE concat(CAST(c_nationkey AS STRING), '.0')
        END AS region_id, CAST(s.segment_id AS STRING) AS segment_id, CASE WHEN c_custkey % 30 = 5 THEN
        'invalid' ELSE '2024-01-15' END AS signup_date
        FROM customer c JOIN fx_segments s ON c.c_mktsegment = s.segment_name
    """,
    "fx_drivers": """
        SELECT s_suppkey AS driver_id, concat('Driver ', CAST(s_suppkey AS STRING)) AS driver_name,
        concat('012', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS driver_phone, concat('2',
        lpad(CAST(s_suppkey AS STRING), 13, '0')) AS national_id, CAST(s_nationkey AS BIGINT) AS
        region_id, s_acctbal > 0 AS is_active
        FROM supplier
    """,
    "fx_restaurants": """
        SELECT p_partkey AS restaurant_id, concat(p_name, ' ', p_brand) AS restaurant_name, CAST(p_size
        % 25 AS BIGINT) AS region_id, CAST(p_size % 10 AS BIGINT) AS category_id, p_type AS price_tier
        FROM part
    """,
    "fx_lines": """
        SELECT l_orderkey, min(l_partkey) AS restaurant_id, min(l_suppkey) AS driver_id,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount,
        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS delivery_fee, max(l_shipdate) AS ship
        FROM lineitem GROUP BY l_orderkey
    """,
    "fx_orders_base": """
        SELECT CAST(o_orderkey AS STRING) AS order_id, CASE WHEN o_orderkey % 50 = 9 THEN o_custkey +
        90000000 ELSE o_custkey END AS customer_id, CASE WHEN o_orderkey % 70 = 6 THEN l.restaurant_id +
        90000000 ELSE l.restaurant_id END AS restaurant_id, l.driver_id AS driver_id, CAST(c.c_nationkey
        AS BIGINT) AS region_id, l.order_amount, l.delivery_fee, CAST(o_orderkey % 5 * 5 AS DOUBLE) AS
        discount_amount, o_totalprice AS total_amount, CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN
        'O' THEN 'Cancelled' ELSE 'Refunded' END AS order_status, o_orderpriority AS payment_method,
        o_orderdate AS order_created_at, CASE WHEN l.ship > o_orderdate THEN l.ship END AS delivered_at
        FROM orders o LEFT JOIN fx_lines l ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON
        o.o_custkey = c.c_custkey
    """,
    "fx_orders": """
        SELECT *
        FROM fx_orders_base
        UNION ALL SELECT *
        FROM fx_orders_base
        WHERE CAST(order_id AS BIGINT) % 45 = 4
    """,
    "fx_ev": """
        SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS
        BIGINT) AS k, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type, min(CASE WHEN
        event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS
        BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_purchase
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
    "fx_tickets": """
        SELECT concat('T', CAST(e.event_id AS STRING)) AS ticket_id, CAST(o.order_id AS STRING) AS
        order_id, e.user_id AS customer_id, o.driver_id, o.restaurant_id, CASE WHEN e.k = 99 THEN NULL
        ELSE e.k % 25 END AS agent_id, e.k % 5 + 1 AS reason_id, e.k % 4 + 1 AS priority_id, e.k % 4 + 1
        AS channel_id, CASE WHEN e.next_type = 'error' THEN 'Reopened' WHEN e.next_purchase IS NULL THEN
        'Open' ELSE 'Resolved' END AS status, CASE WHEN e.k < 40 THEN e.value END AS refund_amount, e.ts
        AS created_at, e.next_ts AS first_response_at, e.next_purchase AS resolved_at
        FROM fx_ev e LEFT JOIN (SELECT c, CAST(m AS STRING) AS order_id, l.driver_id, l.restaurant_id
        FROM (SELECT o_custkey AS c, max(o_orderkey) AS m
        FROM orders GROUP BY o_custkey) x LEFT JOIN fx_lines l ON x.m = l.l_orderkey) o ON e.user_id =
        o.c
        WHERE e.event_type = 'error'
    """,
    "fx_ticket_events": """
        SELECT CAST(event_id AS STRING) AS event_id, 'T' || CAST(max(CASE WHEN event_type = 'error' THEN
        event_id END) OVER w AS STRING) AS ticket_id, user_id % 25 AS agent_id, ts AS event_ts,
        lag(event_type) OVER w AS old_status, event_type AS new_status, props AS notes
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
}

_EMAIL = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
_PHONE = r"^\+?[0-9\s\-\(\)]{7,20}$"


def _type_bad(column: str, sql_type: str) -> str:
    return f"({column} IS NOT NULL AND TRY_CAST({column} AS {sql_type}) IS NULL)"


def _format_bad(column: str, pattern: str) -> str:
    return f"({column} IS NOT NULL AND NOT regexp_matches({column}, '{pattern}'))"


def _failing(conditions: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in conditions.items())
    return f"concat_ws(', ', {cases})"


_CUSTOMER_TYPES = {
    "customer_id": "BIGINT",
    "region_id": "BIGINT",
    "segment_id": "BIGINT",
    "signup_date": "DATE",
}
_CUSTOMER_COLUMNS = [
    "customer_id", "full_name", "email", "phone", "region_id", "segment_id", "signup_date"
]
_TYPED = ", ".join(
    f"TRY_CAST({c} AS {_CUSTOMER_TYPES[c]}) AS {c}" if c in _CUSTOMER_TYPES else c
    for c in _CUSTOMER_COLUMNS
)
_TYPE_FAILED = _failing({c: _type_bad(c, t) for c, t in _CUSTOMER_TYPES.items()})
_FORMAT_FAILED = _failing(
    {"email": _format_bad("email", _EMAIL), "phone": _format_bad("phone", _PHONE)}
)
_NULL_FAILED = _failing(
    {c: f"{c} IS NULL" for c in ("customer_id", "region_id", "segment_id")}
)

_ORDER_COLUMNS = (
    "order_id, customer_id, restaurant_id, driver_id, region_id, order_amount, "
    "delivery_fee, discount_amount, total_amount, order_status, payment_method, "
    "order_created_at, delivered_at"
)
_ORDER_METRICS = """
    order_amount + delivery_fee - discount_amount AS net_revenue,
    date_diff('microsecond', order_created_at, delivered_at) / 1e6 / 60.0
        AS delivery_duration_min,
    CAST(strftime(order_created_at, '%Y%m%d') AS INTEGER) AS order_date_id,
    CAST(strftime(delivered_at, '%Y%m%d') AS INTEGER) AS delivered_date_id
"""
_ORDER_NULL = (
    "(order_id IS NULL OR customer_id IS NULL OR restaurant_id IS NULL "
    "OR driver_id IS NULL OR region_id IS NULL)"
)


def _ticket_metrics(first: str, resolve: str) -> str:
    return f"""
    date_diff('microsecond', created_at, first_response_at) / 1e6 / 60.0
        AS first_response_min,
    date_diff('microsecond', created_at, resolved_at) / 1e6 / 60.0 AS resolution_min,
    COALESCE(date_diff('microsecond', created_at, first_response_at) / 1e6 / 60.0
        > {first}, false) AS is_sla_first_breached,
    COALESCE(date_diff('microsecond', created_at, resolved_at) / 1e6 / 60.0
        > {resolve}, false) AS is_sla_resolution_breached,
    COALESCE(status = 'Reopened', false) AS is_reopened,
    COALESCE(refund_amount, 0.0) AS revenue_impact,
    CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
    CAST(strftime(first_response_at, '%Y%m%d') AS INTEGER) AS first_response_date_id,
    CAST(strftime(resolved_at, '%Y%m%d') AS INTEGER) AS resolved_date_id
"""


def _first_missing(customers: str) -> str:
    """Orders with the first of their references that is missing."""
    return f"""
        SELECT o.*,
            CASE WHEN c.customer_id IS NULL THEN 1 WHEN r.restaurant_id IS NULL THEN 2
                WHEN d.driver_id IS NULL THEN 3 WHEN g.region_id IS NULL THEN 4 END AS miss
        FROM fx_orders o
        LEFT JOIN (SELECT DISTINCT customer_id FROM {customers}) c
            ON o.customer_id = c.customer_id
        LEFT JOIN fx_restaurants r ON o.restaurant_id = r.restaurant_id
        LEFT JOIN fx_drivers d ON o.driver_id = d.driver_id
        LEFT JOIN fx_regions g ON o.region_id = g.region_id
    """


# References of tickets in the order in which they are checked: column, dimension, its table here.
_TICKET_REFERENCES = (
    ("agent_id", "agents", "fx_agents"),
    ("customer_id", "customers", "customers"),
    ("restaurant_id", "restaurants", "fx_restaurants"),
    ("driver_id", "drivers", "fx_drivers"),
    ("reason_id", "reasons", "fx_reasons"),
    ("channel_id", "channels", "fx_channels"),
    ("priority_id", "priorities", "fx_priorities"),
)


def _ticket_misses(pick) -> str:
    cases = " ".join(
        f"WHEN {c} IS NULL OR {c} NOT IN (SELECT {c} FROM {table}) THEN {pick(c, dim)}"
        for c, dim, table in _TICKET_REFERENCES
    )
    return f"CASE {cases} END"


_LOADED_TICKETS = f"""
    SELECT ticket_id FROM fx_tickets
    WHERE order_id IS NOT NULL AND {_ticket_misses(lambda c, dim: f"'{dim}'")} IS NULL
"""

_MISSING_NAMES = """
    CASE miss WHEN 1 THEN 'customer_id' WHEN 2 THEN 'restaurant_id'
        WHEN 3 THEN 'driver_id' WHEN 4 THEN 'region_id' END AS fk_column,
    CAST(CASE miss WHEN 1 THEN customer_id WHEN 2 THEN restaurant_id
        WHEN 3 THEN driver_id WHEN 4 THEN region_id END AS VARCHAR) AS fk_value,
    CASE miss WHEN 1 THEN 'customers' WHEN 2 THEN 'restaurants'
        WHEN 3 THEN 'drivers' WHEN 4 THEN 'regions' END AS dim_name
"""


def _retried(runs: int) -> str:
    """State of each parked order after so many runs with all customers at hand."""
    found = "fk_value IN (SELECT CAST(customer_id AS VARCHAR) FROM customers)"
    waits = "dim_name = 'customers' AND fk_value IS NOT NULL"
    return f"""
        SELECT event_id, fk_value, dim_name,
            CASE WHEN {waits} AND NOT {found} THEN {runs} ELSE 0 END AS retry_count,
            CASE WHEN {waits} AND {found} THEN 'RESOLVED'
                WHEN {waits} THEN '{'DEAD' if runs >= 5 else 'RETRYING'}'
                ELSE 'PENDING' END AS status
        FROM registered
    """


# Tables shared by several answers.
_SHARED: dict[str, str] = {
    "flagged": f"""
        SELECT *, {_TYPE_FAILED} AS type_failed, {_FORMAT_FAILED} AS format_failed,
            {_NULL_FAILED} AS null_failed
        FROM fx_customers_raw
    """,
    "customers": f"""
        SELECT {_TYPED} FROM flagged
        WHERE type_failed = '' AND format_failed = '' AND null_failed = ''
    """,
    "first_customers": """
        SELECT * FROM customers WHERE segment_id NOT IN
            (SELECT segment_id FROM fx_segments WHERE segment_name = 'BUILDING')
    """,
    "enriched_tickets": """
        SELECT t.*, p.sla_first_response_min, p.sla_resolution_min, c.channel_name
        FROM fx_tickets t
        LEFT JOIN fx_priorities p ON t.priority_id = p.priority_id
        LEFT JOIN fx_channels c ON t.channel_id = c.channel_id
    """,
    "gold_tickets": f"""
        SELECT *, 'b-1' AS batch_id,
            {_ticket_metrics('sla_first_response_min', 'sla_resolution_min')}
        FROM enriched_tickets
    """,
    "gold_regions": """
        SELECT r.*, c.city_name, c.country, c.timezone
        FROM fx_regions r LEFT JOIN fx_cities c ON r.city_id = c.city_id
    """,
    "gold_reasons": """
        SELECT r.*, c.category_name AS reason_category_name
        FROM fx_reasons r LEFT JOIN fx_reason_categories c
            ON r.reason_category_id = c.reason_category_id
    """,
    "ranked": _first_missing("customers"),
    "first_ranked": _first_missing("first_customers"),
    "charged": """
        SELECT * FROM (
            SELECT *, min(miss) OVER (PARTITION BY order_id) AS key_miss FROM first_ranked
        ) WHERE miss = key_miss
    """,
    "registered": f"""
        SELECT DISTINCT order_id AS event_id, {_MISSING_NAMES} FROM charged
    """,
    "valid_orders": f"""
        SELECT {_ORDER_COLUMNS} FROM ranked o WHERE NOT {_ORDER_NULL}
            AND NOT EXISTS (SELECT 1 FROM ranked b WHERE b.order_id = o.order_id
                AND b.miss IS NOT NULL AND NOT
                (b.order_id IS NULL OR b.customer_id IS NULL OR b.restaurant_id IS NULL
                OR b.driver_id IS NULL OR b.region_id IS NULL))
    """,
    "loaded_orders": f"""
        SELECT DISTINCT {_ORDER_COLUMNS}, {_ORDER_METRICS} FROM valid_orders
    """,
    "stored_orders": "SELECT * FROM fx_orders_base WHERE order_status = 'Delivered'",
    "order_counts": f"""
        SELECT n_all AS total_records, n_kept - n_clean AS duplicates, n_orphan AS orphans,
            n_null AS null_records, n_null + n_orphan AS quarantined_records,
            n_clean AS clean_records, CAST(1 AS BIGINT) AS files_processed,
            CAST(0 AS BIGINT) AS files_failed,
            100.0::DOUBLE * (n_kept - n_clean) / n_all AS duplicate_rate,
            100.0::DOUBLE * n_orphan / n_all AS orphan_rate,
            100.0::DOUBLE * n_null / n_all AS null_rate,
            100.0::DOUBLE AS file_success_rate
        FROM (SELECT
            (SELECT count(*) FROM fx_orders) AS n_all,
            (SELECT count(*) FROM fx_orders WHERE {_ORDER_NULL}) AS n_null,
            (SELECT count(*) FROM ranked WHERE NOT {_ORDER_NULL} AND miss IS NOT NULL)
                AS n_orphan,
            (SELECT count(*) FROM valid_orders) AS n_kept,
            (SELECT count(*) FROM loaded_orders) AS n_clean)
    """,
    "ticket_nulls": """
        SELECT * FROM (VALUES
            ('ticket_id', true, false), ('order_id', false, true), ('agent_id', false, true),
            ('customer_id', false, true), ('driver_id', false, true),
            ('restaurant_id', false, true), ('reason_id', false, true),
            ('priority_id', false, true), ('channel_id', false, true)
        ) AS t(column_name, is_primary_key, is_foreign_key)
        JOIN (UNPIVOT (SELECT
            count(*) FILTER (WHERE ticket_id IS NULL) AS ticket_id,
            count(*) FILTER (WHERE order_id IS NULL) AS order_id,
            count(*) FILTER (WHERE agent_id IS NULL) AS agent_id,
            count(*) FILTER (WHERE customer_id IS NULL) AS customer_id,
            count(*) FILTER (WHERE driver_id IS NULL) AS driver_id,
            count(*) FILTER (WHERE restaurant_id IS NULL) AS restaurant_id,
            count(*) FILTER (WHERE reason_id IS NULL) AS reason_id,
            count(*) FILTER (WHERE priority_id IS NULL) AS priority_id,
            count(*) FILTER (WHERE channel_id IS NULL) AS channel_id
            FROM fx_tickets) ON COLUMNS(*) INTO NAME column_name VALUE null_count)
        USING (column_name)
    """,
    "customer_errors": f"""
        SELECT CASE
                WHEN type_failed <> '' THEN customer_id
                WHEN format_failed <> '' THEN 'customers:' || customer_id
                ELSE customer_id END AS event_id,
            CASE WHEN type_failed <> '' THEN 'TYPE_MISMATCH'
                WHEN format_failed <> '' THEN 'FORMAT_ERROR'
                ELSE 'NULL_REQUIRED_COLUMN' END AS error_type,
            CASE WHEN type_failed <> '' THEN 'multiple'
                WHEN format_failed <> '' THEN format_failed ELSE null_failed END
                AS error_column,
            {', '.join(_CUSTOMER_COLUMNS)}
        FROM flagged WHERE type_failed <> '' OR format_failed <> '' OR null_failed <> ''
    """,
}

_WITH = {**FIXTURES, **_SHARED}


def _answer(body: str) -> str:
    """``body`` preceded by just the tables it needs, in order of dependence."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in words & set(_WITH) - needed:
            needed.add(name)
            texts.append(_WITH[name])
    tables = ",\n".join(f"{n} AS ({q.strip()})" for n, q in _WITH.items() if n in needed)
    return f"WITH {tables}\n{body.strip()}" if tables else body.strip()


_PASSED = "type_failed = '' AND format_failed = ''"


def _mask(column: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({column}, '{pattern}', '{replacement}', 'g') AS {column}"


_MASK_PHONE = (r"(\+?\d{2})\d+(\d{3})", r"\1*******\2")
_MASK_EMAIL = (r"(^.)(.*)(@.*)", r"\1*******\3")
_MASK_WORD = (r"(\w)\w+", r"\1***")
_MASK_PAIR = (r"(\w)\w+\s(\w)\w+", r"\1*** \2***")

_MEASURES = (
    "ticket_id, first_response_min, resolution_min, is_sla_first_breached, "
    "is_sla_resolution_breached, is_reopened, revenue_impact, created_date_id, "
    "first_response_date_id, resolved_date_id"
)

_CUSTOMER_LOAD = """
    SELECT count(*) AS total_records, 0 AS duplicates, 0 AS orphans,
        count(*) FILTER (WHERE type_failed = '' AND format_failed = ''
            AND null_failed <> '') AS null_records,
        count(*) FILTER (WHERE type_failed <> '' OR format_failed <> ''
            OR null_failed <> '') AS quarantined_records,
        count(*) FILTER (WHERE type_failed = '' AND format_failed = ''
            AND null_failed = '') AS clean_records,
        1 AS files_processed, 0 AS files_failed, 0.0 AS duplicate_rate, 0.0 AS orphan_rate
    FROM flagged
"""

_BODIES: dict[str, str] = {
    "scan_csv": "SELECT * FROM fx_customers_raw",
    "scan_json": "SELECT * FROM fx_orders",
    "scan_json_split": "SELECT * FROM fx_orders",
    "scan_json_keyed": "SELECT * FROM fx_restaurants",
    "coerce_dates": """
        SELECT customer_id, signup_date, TRY_CAST(signup_date AS DATE) AS as_date,
            TRY_CAST(signup_date AS TIMESTAMP) AS as_timestamp FROM fx_customers_raw
    """,
    "scan_dispatch": """
        SELECT *, n_rows = 0 AS is_empty FROM (
            SELECT 'customers' AS table_name, true AS supported,
                (SELECT count(*) FROM fx_customers_raw) AS n_rows
            UNION ALL SELECT 'regions', true, (SELECT count(*) FROM fx_regions)
            UNION ALL SELECT 'segments', true, (SELECT count(*) FROM fx_segments)
            UNION ALL SELECT 'drivers', true, (SELECT count(*) FROM fx_drivers)
            UNION ALL SELECT 'teams', true, 0
            UNION ALL SELECT 'nation', true, (SELECT count(*) FROM nation)
            UNION ALL SELECT 'restaurants', true, (SELECT count(*) FROM fx_restaurants)
            UNION ALL SELECT 'cities', false, NULL)
    """,
    "gate_filename": """
        SELECT * FROM (VALUES ('customers', true), ('regions', true), ('segments', true),
            ('drivers', true), ('teams', true), ('nation', false), ('restaurants', true))
            AS t(table_name, accepted)
    """,
    "gate_columns": """
        SELECT 'customers' AS table_name, true AS passed, '' AS reason,
            (SELECT count(*) FROM fx_customers_raw) AS n_rows
        UNION ALL SELECT 'regions', true, '', (SELECT count(*) FROM fx_regions)
        UNION ALL SELECT 'segments', false, 'column count 5, expected 4',
            (SELECT count(*) FROM fx_segments)
        UNION ALL SELECT 'drivers', false, 'column count 6, expected 15',
            (SELECT count(*) FROM fx_drivers)
        UNION ALL SELECT 'teams', true, '', 0
        UNION ALL SELECT 'restaurants', false, 'column count 5, expected 10',
            (SELECT count(*) FROM fx_restaurants)
    """,
    "gate_schema": """
        SELECT 'customers' AS table_name, '' AS reason,
            (SELECT count(*) FROM flagged WHERE type_failed = '') AS clean_rows,
            (SELECT count(*) FROM flagged WHERE type_failed <> '') AS bad_rows
        UNION ALL SELECT 'regions', '', (SELECT count(*) FROM fx_regions), 0
        UNION ALL SELECT 'segments', 'column count 5, expected 4', NULL, NULL
        UNION ALL SELECT 'drivers', 'column count 6, expected 15', NULL, NULL
        UNION ALL SELECT 'teams', '', 0, 0
        UNION ALL SELECT 'nation', 'unknown table', NULL, NULL
        UNION ALL SELECT 'restaurants', 'column count 5, expected 10', NULL, NULL
        UNION ALL SELECT 'cities', 'unsupported format', NULL, NULL
    """,
    "route_files": """
        SELECT 'ticket_events' AS table_name, strftime(ts, '%Y-%m-%d') AS run_date,
            strftime(ts, '%H') AS run_hour, count(*) AS n_rows
        FROM events GROUP BY ALL
    """,
    "new_files_by_hash": """
        SELECT * FROM (VALUES ('customers', false), ('customers_resent', false),
            ('regions', true)) AS t(dataset, is_new)
    """,
    "gate_type_bad": """
        SELECT * EXCLUDE (type_failed, format_failed, null_failed),
            type_failed AS failed_columns FROM flagged WHERE type_failed <> ''
    """,
    "gate_type_clean": f"SELECT {_TYPED} FROM flagged WHERE type_failed = ''",
    "failure_reasons": """
        SELECT customer_id, type_failed, format_failed, null_failed FROM flagged
    """,
    "gate_format_bad": """
        SELECT 'customers:' || CAST(CAST(customer_id AS BIGINT) AS VARCHAR) AS event_id,
            'customers' AS table_name, 'b-1' AS batch_id, 'FORMAT_ERROR' AS error_type,
            format_failed AS error_column, CAST(NULL AS VARCHAR) AS fk_table,
            true AS retryable
        FROM flagged WHERE type_failed = '' AND format_failed <> ''
    """,
    "gate_format_clean": f"SELECT {_TYPED} FROM flagged WHERE {_PASSED}",
    "gate_null_bad": f"""
        SELECT customer_id AS event_id, 'customers' AS table_name, 'b-1' AS batch_id,
            'NULL_REQUIRED_COLUMN' AS error_type, null_failed AS error_column,
            CAST(NULL AS VARCHAR) AS fk_table, false AS retryable
        FROM flagged WHERE {_PASSED} AND null_failed <> ''
    """,
    "gate_null_clean": "SELECT * FROM customers",
    "preview": f"""
        SELECT {_TYPED} FROM flagged WHERE type_failed = ''
        ORDER BY CAST(customer_id AS BIGINT) LIMIT 5
    """,
    "gate_partition_check": f"""
        SELECT 'TYPE_MISMATCH' AS check_name, count(*) AS input_rows,
            count(*) FILTER (WHERE type_failed <> '') AS bad_rows,
            count(*) FILTER (WHERE type_failed = '') AS good_rows FROM flagged
        UNION ALL SELECT 'FORMAT_ERROR', count(*),
            count(*) FILTER (WHERE format_failed <> ''),
            count(*) FILTER (WHERE format_failed = '') FROM flagged WHERE type_failed = ''
        UNION ALL SELECT 'NULL_REQUIRED_COLUMN', count(*),
            count(*) FILTER (WHERE null_failed <> ''),
            count(*) FILTER (WHERE null_failed = '') FROM flagged WHERE {_PASSED}
    """,
    "quarantine_all": f"""
        SELECT event_id, 'customers' AS table_name, 'b-1' AS batch_id, error_type,
            error_column, CAST(NULL AS VARCHAR) AS fk_table,
            error_type = 'FORMAT_ERROR' AS retryable FROM customer_errors
        UNION ALL
        SELECT order_id, 'orders', 'b-1', 'NULL_REQUIRED_COLUMN',
            {_failing({c: f'{c} IS NULL' for c in
                       ('order_id', 'customer_id', 'restaurant_id', 'driver_id', 'region_id')})},
            NULL, false FROM fx_orders WHERE {_ORDER_NULL}
        UNION ALL
        SELECT order_id, 'orders', 'b-1', 'FK_MISSING', fk_column, dim_name, true FROM (
            SELECT order_id, {_MISSING_NAMES} FROM ranked
            WHERE NOT {_ORDER_NULL} AND miss IS NOT NULL)
    """,
    "error_payload": f"""
        SELECT event_id, CAST(json_object(
            'row', json_object({', '.join(f"'{c}', {c}" for c in _CUSTOMER_COLUMNS)}),
            'error_type', error_type, 'error_column', error_column,
            'fk_table', NULL, 'table_name', 'customers') AS VARCHAR) AS raw_payload
        FROM customer_errors
    """,
    "load_dim_overwrite": "SELECT * FROM customers",
    "load_fact_append": """
        SELECT *, CASE WHEN order_status = 'Delivered' THEN 'b-1' ELSE 'b-2' END AS batch_id
        FROM fx_orders_base
    """,
    "load_fact_atomic": """
        SELECT state, n_rows, n_delivered FROM (
            SELECT count(*) FILTER (WHERE order_status = 'Delivered') AS d,
                count(*) FILTER (WHERE order_status IS DISTINCT FROM 'Delivered' AND order_status IS NOT NULL) AS o
            FROM fx_orders_base) AS n,
        LATERAL (SELECT * FROM (VALUES ('before', n.d, n.d), ('written', n.d, n.d),
            ('committed', n.o, CAST(0 AS BIGINT))) AS v(state, n_rows, n_delivered))
    """,
    "fact_after_new_column": """
        SELECT * REPLACE (
            CASE WHEN order_status = 'Delivered' THEN floor(order_amount) ELSE order_amount END AS order_amount,
            CASE WHEN order_status = 'Delivered' THEN NULL ELSE payment_method END AS payment_method),
            CASE WHEN order_status = 'Delivered' THEN 'b-1' ELSE 'b-2' END AS batch_id
        FROM fx_orders_base
    """,
    "fact_after_compaction": """
        SELECT * EXCLUDE (place),
            CASE place WHEN 1 THEN 'b-3' ELSE 'b-' || CAST(place AS VARCHAR) END AS batch_id
        FROM (SELECT *, CAST(regexp_extract(order_id, '(\\d+)', 1) AS BIGINT) % 4 AS place FROM stored_orders)
        WHERE place <> 3
    """,
    "dedup_pruned_history": """
        SELECT DISTINCT * FROM fx_orders
        WHERE order_id NOT IN (SELECT order_id FROM stored_orders)
    """,
    "declared_table_load": """
        WITH rows AS (
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey, l_quantity, l_shipdate,
                l_suppkey IN (SELECT s_suppkey FROM supplier WHERE regexp_full_match(s_name, '.*[0-8]')) AS known
            FROM lineitem)
        SELECT * EXCLUDE (rn, known) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_shipdate NULLS FIRST) AS rn FROM rows
            WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM rows WHERE NOT known))
        WHERE rn = 1
    """,
    "catalog_targets": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS kind, '{k}_{t}' AS target, "
        f"(SELECT count(*) FROM {v}) AS n_rows"
        for t, k, v in [
            ("cities", "dim", "fx_cities"),
            ("regions", "dim", "fx_regions"),
            ("segments", "dim", "fx_segments"),
            ("teams", "dim", "fx_teams"),
            ("agents", "dim", "fx_agents"),
            ("channels", "dim", "fx_channels"),
            ("priorities", "dim", "fx_priorities"),
            ("reason_categories", "dim", "fx_reason_categories"),
            ("reasons", "dim", "fx_reasons"),
            ("customers", "dim", "fx_customers_raw"),
            ("drivers", "dim", "fx_drivers"),
            ("restaurants", "dim", "fx_restaurants"),
            ("orders", "fact", "fx_orders"),
            ("tickets", "fact", "fx_tickets"),
            ("ticket_events", "fact", "fx_ticket_events"),
            ("nation", "dim", "nation"),
        ]
    ),
    "load_drops": """
        SELECT 'customers' AS table_name, 'loaded' AS outcome,
            (SELECT count(*) FROM customers) AS loaded_rows
        UNION ALL SELECT 'regions', 'loaded', (SELECT count(*) FROM fx_regions)
        UNION ALL SELECT 'segments', 'column count 5, expected 4', NULL
        UNION ALL SELECT 'drivers', 'column count 6, expected 15', NULL
        UNION ALL SELECT 'teams', 'empty', NULL
        UNION ALL SELECT 'nation', 'unknown table', NULL
        UNION ALL SELECT 'restaurants', 'column count 5, expected 10', NULL
        UNION ALL SELECT 'cities', 'unsupported format', NULL
    """,
    "nan_to_null": "SELECT ticket_id, refund_amount FROM fx_tickets",
    "orphans_orders": """
        SELECT o.order_id, o.customer_id FROM fx_orders o
        LEFT JOIN customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL
    """,
    "orphan_first_fk": f"""
        SELECT order_id, {_MISSING_NAMES} FROM ranked WHERE miss IS NOT NULL
    """,
    "orphans_removed": f"""
        SELECT {_ORDER_COLUMNS} FROM ranked WHERE order_id NOT IN
            (SELECT order_id FROM ranked WHERE miss IS NOT NULL)
    """,
    "dedup_against_gold": """
        SELECT DISTINCT * FROM fx_orders
        WHERE order_id NOT IN (SELECT order_id FROM stored_orders)
    """,
    "dedup_within_batch": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST
            ) AS rn FROM lineitem) WHERE rn = 1
    """,
    "duplicates_found": """
        SELECT * FROM fx_orders WHERE order_id IN (SELECT order_id FROM stored_orders)
    """,
    "duplicate_summary": """
        SELECT count(*) AS total_records_checked,
            count(*) FILTER (WHERE hit) AS duplicates_found,
            count(*) FILTER (WHERE NOT hit) AS new_records,
            CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / count(*) AS duplicate_rate
        FROM (SELECT order_id IN (SELECT order_id FROM stored_orders) AS hit FROM fx_orders)
    """,
    "enrich_customers": """
        SELECT c.*, s.segment_name, s.discount_pct FROM customers c
        LEFT JOIN fx_segments s ON c.segment_id = s.segment_id
    """,
    "enrich_regions": "SELECT * FROM gold_regions",
    "enrich_agents": """
        SELECT a.*, t.team_name FROM fx_agents a
        LEFT JOIN fx_teams t ON a.team_id = t.team_id
    """,
    "enrich_reasons": "SELECT * FROM gold_reasons",
    "enrich_tickets": "SELECT * FROM enriched_tickets",
    "enrich_missing_dim": """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS channel_name) FROM enriched_tickets
    """,
    "audit_inject": """
        SELECT order_id, 'b-1' AS batch_id, true AS has_time FROM fx_orders_base
    """,
    "metrics_orders": f"SELECT order_id, {_ORDER_METRICS} FROM fx_orders",
    "metrics_tickets": f"SELECT {_MEASURES} FROM gold_tickets",
    "metrics_tickets_default_sla": f"""
        SELECT ticket_id, {_ticket_metrics('1', '15')} FROM fx_tickets
    """,
    "gold_tickets": "SELECT * FROM gold_tickets",
    "gold_orders": f"""
        SELECT DISTINCT *, 'b-1' AS batch_id, {_ORDER_METRICS} FROM fx_orders
    """,
    "custom_stage": """
        SELECT order_id, order_amount + delivery_fee - discount_amount AS net_revenue,
            CASE WHEN order_amount > 0 THEN delivery_fee / order_amount END AS fee_share
        FROM fx_orders_base
    """,
    "kpi_total_tickets": "SELECT count(*) AS total_tickets FROM gold_tickets",
    "kpi_sla_breach_rate": """
        SELECT CAST(ROUND(SUM(CASE WHEN is_sla_first_breached THEN 1 ELSE 0 END) * 100.0
                / COUNT(*), 2) AS DOUBLE) AS first_response_breach_rate,
            CAST(ROUND(SUM(CASE WHEN is_sla_resolution_breached THEN 1 ELSE 0 END) * 100.0
                / COUNT(*), 2) AS DOUBLE) AS resolution_breach_rate
        FROM gold_tickets
    """,
    "kpi_avg_times": """
        SELECT ROUND(AVG(first_response_min), 2) AS avg_first_response_time_min,
            ROUND(AVG(resolution_min), 2) AS avg_resolution_time_min FROM gold_tickets
    """,
    "kpi_reopen_rate": """
        SELECT CAST(ROUND(SUM(CASE WHEN is_reopened THEN 1 ELSE 0 END) * 100.0
            / COUNT(*), 2) AS DOUBLE) AS reopen_rate_pct FROM gold_tickets
    """,
    "kpi_refund_revenue": """
        SELECT CAST(SUM(CAST(refund_amount AS DECIMAL(28,8))) AS DOUBLE)
                AS total_refund_amount,
            CAST(SUM(CAST(revenue_impact AS DECIMAL(28,8))) AS DOUBLE)
                AS total_revenue_impact
        FROM gold_tickets
    """,
    "kpi_tickets_by_city_region": """
        SELECT r.city_name, r.region_name, COUNT(t.ticket_id) AS ticket_count
        FROM gold_tickets t
        LEFT JOIN fx_orders_base o ON t.order_id = o.order_id
        LEFT JOIN gold_regions r ON o.region_id = r.region_id
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2
    """,
    "kpi_tickets_by_restaurant": """
        SELECT r.restaurant_name, COUNT(t.ticket_id) AS ticket_count FROM gold_tickets t
        LEFT JOIN fx_restaurants r ON t.restaurant_id = r.restaurant_id
        GROUP BY 1 ORDER BY 2 DESC, 1
    """,
    "kpi_tickets_by_driver": """
        SELECT d.driver_name, COUNT(t.ticket_id) AS ticket_count FROM gold_tickets t
        LEFT JOIN fx_drivers d ON t.driver_id = d.driver_id
        GROUP BY 1 ORDER BY 2 DESC, 1
    """,
    "kpi_complaint_rate": """
        SELECT (SELECT COUNT(*) FROM gold_tickets) * CAST(1000.0 AS DOUBLE)
            / (SELECT COUNT(*) FROM fx_orders_base) AS complaint_rate_per_1000_orders
    """,
    "kpi_loss_by_reason_category": """
        SELECT r.reason_category_name,
            CAST(SUM(CAST(t.revenue_impact AS DECIMAL(28,8))) AS DOUBLE) AS total_loss
        FROM gold_tickets t LEFT JOIN gold_reasons r ON t.reason_id = r.reason_id
        GROUP BY 1 ORDER BY 2 DESC, 1
    """,
    "pii_customer": f"""
        SELECT customer_id, {_mask('full_name', *_MASK_PAIR)}, {_mask('email', *_MASK_EMAIL)},
            {_mask('phone', *_MASK_PHONE)}, region_id, segment_id, signup_date,
            CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS TIMESTAMP) AS created_at,
            CAST(NULL AS TIMESTAMP) AS updated_at FROM customers
    """,
    "pii_from_store": f"""
        SELECT customer_id, {_mask('full_name', *_MASK_PAIR)}, {_mask('email', *_MASK_EMAIL)},
            {_mask('phone', *_MASK_PHONE)}, region_id, segment_id, signup_date,
            CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS TIMESTAMP) AS created_at,
            CAST(NULL AS TIMESTAMP) AS updated_at FROM customers
    """,
    "pii_driver": f"""
        SELECT driver_id, {_mask('driver_name', *_MASK_WORD)},
            {_mask('driver_phone', *_MASK_PHONE)}, md5(national_id) AS national_id,
            region_id, CAST(NULL AS VARCHAR) AS shift, CAST(NULL AS VARCHAR) AS vehicle_type,
            CAST(NULL AS DATE) AS hire_date, CAST(NULL AS DOUBLE) AS rating_avg,
            CAST(NULL AS DOUBLE) AS on_time_rate, CAST(NULL AS DOUBLE) AS cancel_rate,
            CAST(NULL AS BIGINT) AS completed_deliveries, is_active,
            CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
        FROM fx_drivers
    """,
    "pii_agent": f"""
        SELECT agent_id, {_mask('agent_name', *_MASK_WORD)},
            {_mask('agent_email', *_MASK_EMAIL)}, {_mask('agent_phone', *_MASK_PHONE)},
            team_id, skill_level, CAST(NULL AS DATE) AS hire_date,
            CAST(NULL AS DOUBLE) AS avg_handle_time_min, CAST(NULL AS DOUBLE) AS resolution_rate,
            CAST(NULL AS DOUBLE) AS csat_score, CAST(NULL AS BOOLEAN) AS is_active,
            CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
        FROM fx_agents
    """,
    "reconciliation_register": """
        SELECT *, CAST(0 AS INTEGER) AS retry_count, 'PENDING' AS status FROM registered
    """,
    "retry_pending": """
        SELECT event_id, fk_column, fk_value, CAST(0 AS INTEGER) AS retry_count,
            'PENDING' AS status
        FROM registered WHERE dim_name = 'customers' AND fk_value IS NOT NULL
    """,
    "retry_outcomes": f"""
        SELECT event_id, CAST(retry_count AS INTEGER) AS retry_count, status
        FROM ({_retried(1)}) WHERE status <> 'PENDING'
    """,
    "replay_union": f"""
        SELECT {_ORDER_COLUMNS} FROM first_ranked WHERE order_id NOT IN
            (SELECT order_id FROM first_ranked WHERE miss IS NOT NULL)
        UNION ALL
        SELECT {_ORDER_COLUMNS} FROM charged WHERE order_id IN
            (SELECT event_id FROM ({_retried(1)}) WHERE status = 'RESOLVED')
    """,
    "reconciliation_latest": f"""
        SELECT event_id, dim_name, CAST(retry_count AS INTEGER) AS retry_count, status
        FROM ({_retried(2)})
    """,
    "reconciliation_compacted": f"""
        SELECT event_id, dim_name, CAST(retry_count AS INTEGER) AS retry_count, status
        FROM ({_retried(2)})
    """,
    "retry_dead_letter": f"""
        SELECT event_id, fk_value, CAST(retry_count AS INTEGER) AS retry_count, status
        FROM ({_retried(5)}) WHERE status = 'DEAD'
    """,
    "late_dimension_replay": "SELECT * FROM loaded_orders",
    "stream_ingest_orders": "SELECT * FROM loaded_orders",
    "stream_settled_files": "SELECT * FROM loaded_orders",
    "stream_equals_batch": """
        SELECT count(*) AS streamed_rows, CAST(0 AS BIGINT) AS differing_rows
        FROM loaded_orders
    """,
    "stream_restart_idempotent": "SELECT * FROM loaded_orders",
    "stream_gate_files": "SELECT * FROM loaded_orders",
    "load_tickets": f"""
        SELECT ticket_id, order_id, customer_id, agent_id, priority_id, channel_name
        FROM gold_tickets WHERE ticket_id IN ({_LOADED_TICKETS})
    """,
    "load_ticket_events": """
        SELECT event_id, ticket_id, agent_id, event_ts, new_status FROM fx_ticket_events
        WHERE event_id IS NOT NULL AND ticket_id IS NOT NULL AND event_ts IS NOT NULL
            AND agent_id IN (SELECT agent_id FROM fx_agents)
    """,
    "orphan_first_fk_tickets": f"""
        SELECT ticket_id, fk_column, fk_value, dim_name FROM (
            SELECT ticket_id, {_ticket_misses(lambda c, dim: f"'{c}'")} AS fk_column,
                {_ticket_misses(lambda c, dim: f"CAST({c} AS VARCHAR)")} AS fk_value,
                {_ticket_misses(lambda c, dim: f"'{dim}'")} AS dim_name FROM fx_tickets)
        WHERE fk_column IS NOT NULL
    """,
    "kpi_from_store": f"""
        SELECT CAST(ROUND(SUM(CASE WHEN is_sla_first_breached THEN 1 ELSE 0 END) * 100.0
                / COUNT(*), 2) AS DOUBLE) AS first_response_breach_rate,
            CAST(ROUND(SUM(CASE WHEN is_sla_resolution_breached THEN 1 ELSE 0 END) * 100.0
                / COUNT(*), 2) AS DOUBLE) AS resolution_breach_rate
        FROM gold_tickets WHERE ticket_id IN ({_LOADED_TICKETS})
    """,
    "repeat_after_dimension": "SELECT * FROM loaded_orders",
    "repeat_numeric_batch": "SELECT *, '007' AS batch_id FROM loaded_orders",
    "quality_summary": "SELECT * FROM order_counts",
    "quality_metrics_long": """
        SELECT 'b-1' AS batch_id, metric_name, metric_value FROM (
            UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM order_counts)
            ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)
    """,
    "null_profile": """
        SELECT 'tickets' AS table_name, column_name, null_count,
            CAST(null_count AS DOUBLE) / (SELECT count(*) FROM fx_tickets) * 100.0::DOUBLE
                AS null_percentage,
            is_primary_key, is_foreign_key, true AS is_required
        FROM ticket_nulls
    """,
    "null_summary": """
        SELECT count(*) AS total_records, count(*) FILTER (WHERE bad) AS null_records,
            count(*) FILTER (WHERE NOT bad) AS clean_records,
            CAST(count(*) FILTER (WHERE bad) AS DOUBLE) / count(*) AS null_rate
        FROM (SELECT ticket_id IS NULL OR order_id IS NULL OR agent_id IS NULL
            OR customer_id IS NULL OR driver_id IS NULL OR restaurant_id IS NULL
            OR reason_id IS NULL OR priority_id IS NULL OR channel_id IS NULL AS bad
            FROM fx_tickets)
    """,
    "ref_integrity_rate": """
        SELECT 'orders' AS table_name, count(*) AS total_records,
            count(*) FILTER (WHERE miss IS NULL) AS valid_records,
            CAST(count(*) FILTER (WHERE miss IS NULL) AS DOUBLE) / count(*) * 100.0::DOUBLE
                AS referential_integrity_rate
        FROM ranked
    """,
    "sla_consistency": f"""
        SELECT count(*) FILTER (WHERE same) AS consistent_count, count(*) AS total_count,
            CAST(count(*) FILTER (WHERE same) AS DOUBLE) / count(*) * 100.0::DOUBLE
                AS sla_consistency_rate
        FROM (SELECT a.is_sla_first_breached = b.is_sla_first_breached
                AND a.is_sla_resolution_breached = b.is_sla_resolution_breached AS same
            FROM (SELECT ticket_id, {_ticket_metrics('1', '15')} FROM fx_tickets) a
            JOIN gold_tickets b ON a.ticket_id = b.ticket_id)
    """,
    "quality_breaches": """
        SELECT * FROM (
            SELECT 'tickets.' || column_name AS subject, 'null_percentage' AS metric,
                CAST(null_count AS DOUBLE) / (SELECT count(*) FROM fx_tickets)
                    * 100.0::DOUBLE AS value, 5.0::DOUBLE AS threshold FROM ticket_nulls
            UNION ALL SELECT 'orders', 'orphan_percentage', orphan_rate, 2.0
                FROM order_counts
            UNION ALL SELECT 'orders', 'duplicate_percentage', duplicate_rate, 1.0
                FROM order_counts
            UNION ALL SELECT 'orders', 'duplicate_rate', duplicate_rate / 100.0, 0.10
                FROM order_counts)
        WHERE value > threshold
    """,
    "quality_latency": """
        SELECT table_name, CAST(sum(date_diff('microsecond', started_at, ended_at)) AS DOUBLE)
            / 1e6::DOUBLE / count(started_at) AS avg_processing_latency_seconds
        FROM (SELECT user_id, event_type AS table_name, min(ts) AS started_at, max(ts) AS ended_at
              FROM events GROUP BY 1, 2)
        GROUP BY table_name
    """,
    "quality_report": f"""
        SELECT 'customers' AS table_name, metric_name, metric_value,
            CAST(NULL AS VARCHAR) AS metric_details FROM (
            UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM (SELECT *,
                CAST(null_records AS DOUBLE) / total_records * 100.0::DOUBLE AS null_rate,
                100.0 AS file_success_rate FROM ({_CUSTOMER_LOAD})))
            ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)
        UNION ALL
        SELECT 'customers', 'null_percentages', NULL,
            '{{"customers":{{"customer_id":0.0,"region_id":'
            || CAST(CAST(count(*) FILTER (WHERE region_id IS NULL) AS DOUBLE) / count(*)
                * 100.0::DOUBLE AS VARCHAR) || ',"segment_id":0.0}}}}'
        FROM fx_customers_raw
    """,
}



def _long(report: str, body: str, values: list[str], names: list[str]) -> str:
    group = f"CAST(to_json([{', '.join(names)}]) AS VARCHAR)" if names else "CAST(NULL AS VARCHAR)"
    return " UNION ALL ".join(
        f"SELECT '{report if names else value}' AS kpi, {group} AS name, CAST({value} AS DOUBLE) AS value"
        f" FROM ({_BODIES[body]})"
        for value in values
    )


_BODIES["kpi_incremental"] = " UNION ALL ".join(
    [
        _long("total_tickets", "kpi_total_tickets", ["total_tickets"], []),
        _long("sla", "kpi_sla_breach_rate", ["first_response_breach_rate", "resolution_breach_rate"], []),
        _long("times", "kpi_avg_times", ["avg_first_response_time_min", "avg_resolution_time_min"], []),
        _long("reopened", "kpi_reopen_rate", ["reopen_rate_pct"], []),
        _long("money", "kpi_refund_revenue", ["total_refund_amount", "total_revenue_impact"], []),
        _long("tickets_by_city_region", "kpi_tickets_by_city_region", ["ticket_count"], ["city_name", "region_name"]),
        _long("tickets_by_restaurant", "kpi_tickets_by_restaurant", ["ticket_count"], ["restaurant_name"]),
        _long("tickets_by_driver", "kpi_tickets_by_driver", ["ticket_count"], ["driver_name"]),
        _long("complaints", "kpi_complaint_rate", ["complaint_rate_per_1000_orders"], []),
        _long("loss_by_reason_category", "kpi_loss_by_reason_category", ["total_loss"], ["reason_category_name"]),
    ]
)

ORACLES: dict[str, str] = {name: _answer(body) for name, body in _BODIES.items()}
