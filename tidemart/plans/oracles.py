"""DuckDB SQL giving the same rows as the registered queries, from the same tables.

The SQL is written from the operators' definitions, not from the DataFrame code: payloads are
built as text and read back with DuckDB's own JSON functions.
"""

from __future__ import annotations

from tidemart.sources.adapters import FIRST_LISTED_PRODUCT, REDELIVERY_OFFSET, TOPIC

AMOUNT = "DECIMAL(28, 6)"

SILVER = """
numbered AS (
    SELECT event_id AS n, ts AS event_time, user_id AS u, value,
           json_extract_string(props, '$.k') AS k,
           CASE event_type WHEN 'signup' THEN 'home_view' WHEN 'view' THEN 'product_view'
                WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'checkout_start'
                WHEN 'purchase' THEN 'purchase' END AS event_type
    FROM events
),
full_silver AS (
    SELECT 'evt-' || n AS event_id, 'user-' || u AS user_id,
           'session-' || u || '-' || strftime(event_time - INTERVAL 12 HOUR, '%Y%m%d') AS session_id,
           event_type, event_time, event_time + INTERVAL 1 SECOND AS ingest_time,
           'sku-' || k AS product_id,
           CASE WHEN event_type = 'purchase' THEN 'order-' || (n // 2) END AS order_id,
           CASE WHEN event_type = 'purchase' OR n % 50 = 0 THEN value END AS order_amount,
           CASE n % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
           CASE n % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_search' WHEN 2 THEN 'email'
                ELSE 'social' END AS traffic_source,
           CASE n % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE'
                ELSE 'SG' END AS country_code,
           CAST(1 AS INTEGER) AS schema_version, CAST(event_time AS DATE) AS event_date, n, value
    FROM numbered
),
silver AS (SELECT * EXCLUDE (n, value) FROM full_silver)
"""

PRODUCTS = f"""
products AS (
    SELECT 'sku-' || (p_partkey + {FIRST_LISTED_PRODUCT}) AS product_id, lower(p_type) AS category,
           CASE WHEN p_size <= 15 THEN 'low' WHEN p_size <= 35 THEN 'medium' ELSE 'high' END
               AS price_band
    FROM part
)
"""


def _member(name: str, value: str) -> str:
    return f"""'"{name}":' || coalesce({value}, 'null')"""


def _text(expression: str) -> str:
    return f"""'"' || ({expression}) || '"'"""


def _iso(column: str) -> str:
    return _text(f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'")


_MEMBERS = ", ".join(
    [
        f"CASE WHEN r <> 13 THEN {_member('event_id', _text('event_id'))} END",
        _member("user_id", f"CASE WHEN r <> 1 THEN {_text('user_id')} END"),
        _member("session_id", _text("session_id")),
        _member(
            "event_type",
            _text(
                "CASE WHEN r = 2 THEN 'signup_bonus' WHEN r IN (6, 7, 8, 14) THEN 'purchase' "
                "ELSE event_type END"
            ),
        ),
        _member(
            "event_time", f"CASE WHEN r = 3 THEN {_text(chr(39) + 'not-a-time' + chr(39))} "
            f"ELSE {_iso('event_time')} END"
        ),
        _member("ingest_time", f"CASE WHEN r <> 9 THEN {_iso('sent_time')} END"),
        _member("product_id", _text("product_id")),
        _member(
            "order_id",
            "CASE WHEN r = 6 THEN NULL WHEN r IN (7, 8) THEN " + _text("'order-' || (n // 2)")
            + " WHEN r = 14 THEN '\"\"' ELSE " + _text("order_id") + " END",
        ),
        _member(
            "order_amount",
            "CASE WHEN r IN (6, 14) THEN CAST(value AS VARCHAR) WHEN r = 7 THEN '0' "
            "WHEN r = 8 THEN '\"abc\"' ELSE CAST(order_amount AS VARCHAR) END",
        ),
        _member("device_type", "CASE WHEN r = 5 THEN '\"   \"' ELSE " + _text("device_type") + " END"),
        _member("traffic_source", _text("traffic_source")),
        _member("country_code", _text("country_code")),
        _member("schema_version", "CASE WHEN r = 4 THEN '0' WHEN r = 15 THEN '\"1\"' ELSE '1' END"),
    ]
)

BRONZE = f"""{SILVER},
sent AS (
    SELECT *, n % 100 AS r, delay, ingest_time + delay * INTERVAL 1 SECOND AS sent_time
    FROM (SELECT *, unnest(CASE WHEN n % 100 IN (10, 11, 12) THEN [0, 5] ELSE [0] END) AS delay
          FROM full_silver)
),
bronze AS (
    SELECT event_id AS kafka_key,
           CASE WHEN r = 0 THEN '{{"event_id": "evt-'
                ELSE '{{' || concat_ws(',', {_MEMBERS}) || '}}' END AS raw_payload,
           '{TOPIC}' AS topic, CAST(n % 3 AS INTEGER) AS "partition",
           CAST(n // 3 + CASE WHEN delay > 0 THEN {REDELIVERY_OFFSET} ELSE 0 END AS BIGINT)
               AS "offset",
           sent_time AS kafka_timestamp, CAST(sent_time AS DATE) AS event_date
    FROM sent
)
"""

TEXT_FIELDS = (
    "event_id", "user_id", "session_id", "event_type", "product_id", "device_type",
    "traffic_source", "country_code",
)
REQUIRED = (
    "event_id", "user_id", "session_id", "event_type", "event_time", "ingest_time", "product_id",
    "device_type", "traffic_source", "country_code", "schema_version",
)
FIELDS = (
    "event_id", "user_id", "session_id", "event_type", "event_time", "ingest_time", "product_id",
    "order_id", "order_amount", "device_type", "traffic_source", "country_code", "schema_version",
)
STAGES = ("home_view", "product_view", "add_to_cart", "checkout_start", "purchase")
ALLOWED = ", ".join(f"'{stage}'" for stage in STAGES)
SHOWN_ALLOWED = ", ".join(f"''{stage}''" for stage in sorted(STAGES))
COORDINATES = 'raw_payload, topic, "partition", "offset", kafka_timestamp'
_FIELD_LIST = ", ".join(FIELDS)

# Every field as text (t_), its JSON type where the rules ask for it (j_).
OPENED = f"""{BRONZE},
docs AS (
    SELECT *, CASE WHEN json_valid(raw_payload) THEN raw_payload END AS doc FROM bronze
),
opened AS (
    SELECT * EXCLUDE (event_date),
           {", ".join(f"json_extract_string(doc, '$.{f}') AS t_{f}" for f in FIELDS)},
           json_type(doc, '$.order_amount') AS j_amount,
           json_type(doc, '$.schema_version') AS j_version,
           TRY_CAST(replace(json_extract_string(doc, '$.event_time'), '+00:00', '') AS TIMESTAMP)
               AS v_event_time,
           TRY_CAST(replace(json_extract_string(doc, '$.ingest_time'), '+00:00', '') AS TIMESTAMP)
               AS v_ingest_time
    FROM docs
)
"""

_TYPED = {
    "event_time": "v_event_time",
    "ingest_time": "v_ingest_time",
    "order_amount": "CASE WHEN j_amount <> 'VARCHAR' THEN TRY_CAST(t_order_amount AS DOUBLE) END",
    "schema_version": "CASE WHEN j_version <> 'VARCHAR' THEN TRY_CAST(t_schema_version AS INTEGER) END",
}

PARSED = f"""{OPENED},
parsed AS (
    SELECT {COORDINATES}, {", ".join(f"{_TYPED.get(f, f't_{f}')} AS {f}" for f in FIELDS)}
    FROM opened
)
"""

STREAM_RULES = f"""{PARSED},
judged AS (
    SELECT *, concat_ws('|',
        CASE WHEN event_id IS NULL THEN 'malformed_json' END,
        {", ".join(f"CASE WHEN {f} IS NULL THEN '{f}_missing' END" for f in REQUIRED)},
        CASE WHEN event_type NOT IN ({ALLOWED}) THEN 'invalid_event_type' END,
        CASE WHEN event_type = 'purchase'
              AND (order_id IS NULL OR order_amount IS NULL OR order_amount <= 0)
             THEN 'purchase_missing_order_fields' END) AS validation_errors,
        coalesce(CAST(event_time AS DATE), CAST(kafka_timestamp AS DATE)) AS event_date
    FROM parsed
)
"""


def _bad_time(field: str) -> str:
    return (
        f"CASE WHEN t_{field} IS NOT NULL AND v_{field} IS NULL THEN '{field} is invalid: "
        f"Invalid isoformat string: ''' || t_{field} || '''' END"
    )


CONTRACT_RULES = f"""{OPENED},
judged AS (
    SELECT {COORDINATES},
        t_event_id AS event_id, t_user_id AS user_id, t_session_id AS session_id,
        t_event_type AS event_type, v_event_time AS event_time, v_ingest_time AS ingest_time,
        t_product_id AS product_id, nullif(t_order_id, '') AS order_id,
        TRY_CAST(t_order_amount AS DOUBLE) AS order_amount, t_device_type AS device_type,
        t_traffic_source AS traffic_source, t_country_code AS country_code,
        TRY_CAST(t_schema_version AS INTEGER) AS schema_version,
        CASE WHEN doc IS NULL THEN 'malformed_json' ELSE concat_ws('|',
            {", ".join(f"CASE WHEN coalesce(trim(t_{f}), '') = '' THEN '{f} is required' END" for f in REQUIRED)},
            CASE WHEN t_event_type <> '' AND t_event_type NOT IN ({ALLOWED})
                 THEN 'event_type must be one of [{SHOWN_ALLOWED}]' END,
            {_bad_time("event_time")},
            {_bad_time("ingest_time")},
            CASE WHEN t_schema_version IS NULL THEN NULL
                 WHEN TRY_CAST(t_schema_version AS INTEGER) IS NULL
                 THEN 'schema_version must be an integer'
                 WHEN TRY_CAST(t_schema_version AS INTEGER) < 1
                 THEN 'schema_version must be >= 1' END,
            CASE WHEN t_event_type = 'purchase' AND coalesce(t_order_id, '') = ''
                 THEN 'order_id is required for purchase events' END,
            CASE WHEN t_event_type <> 'purchase' THEN NULL
                 WHEN t_order_amount IS NULL OR TRY_CAST(t_order_amount AS DOUBLE) <= 0
                 THEN 'order_amount must be > 0 for purchase events'
                 WHEN TRY_CAST(t_order_amount AS DOUBLE) IS NULL
                 THEN 'order_amount must be numeric for purchase events' END) END
            AS validation_errors,
        coalesce(CAST(v_event_time AS DATE), CAST(kafka_timestamp AS DATE)) AS event_date
    FROM opened
)
"""

COERCED = f"""{CONTRACT_RULES},
coerced AS (
    SELECT {_FIELD_LIST}, "partition", "offset", event_date
    FROM judged WHERE validation_errors = ''
),
latest AS (
    SELECT * FROM coerced
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_time DESC, "offset" DESC) = 1
)
"""


def _money(expression: str) -> str:
    return f"CAST(round(sum({expression}), 2) AS DOUBLE)"


_ANY_AMOUNT = f"coalesce(CAST(order_amount AS {AMOUNT}), 0)"
_PURCHASE_AMOUNT = (
    f"CASE WHEN event_type = 'purchase' THEN CAST(order_amount AS {AMOUNT}) ELSE 0 END"
)


def _daily_kpis(source: str) -> str:
    return f"""
    SELECT event_date, count(DISTINCT user_id) AS daily_active_users, count(*) AS total_events,
           count(DISTINCT session_id) AS total_sessions,
           count(DISTINCT CASE WHEN event_type = 'purchase' THEN order_id END) AS total_orders,
           {_money(_PURCHASE_AMOUNT)} AS total_revenue,
           count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchase_users
    FROM {source} GROUP BY event_date"""


def _rate(base: str) -> str:
    # Exact half-up rounding to four places in whole numbers.
    return (
        f"CASE WHEN {base} = 0 THEN 0.0::DOUBLE "
        f"ELSE ((20000 * purchase_users + {base}) // (2 * {base})) / 10000 END"
    )


def _funnel(source: str) -> str:
    return f"""
    SELECT *, {_rate("product_view_users")} AS product_view_to_purchase_rate,
           {_rate("add_to_cart_users")} AS add_to_cart_to_purchase_rate,
           {_rate("checkout_start_users")} AS checkout_to_purchase_rate
    FROM (SELECT event_date, {", ".join(
        f"count(DISTINCT CASE WHEN event_type = '{s}' THEN user_id END) AS {s}_users"
        for s in STAGES)}
          FROM {source} GROUP BY event_date)"""


def _sessions(source: str) -> str:
    return f"""
    SELECT event_date, session_id, user_id, min(event_time) AS session_start_time,
           max(event_time) AS session_end_time, count(*) AS event_count,
           count(*) FILTER (event_type = 'purchase') AS purchase_count,
           {_money(_ANY_AMOUNT)} AS total_revenue,
           CAST(floor(epoch(max(event_time))) - floor(epoch(min(event_time))) AS BIGINT)
               AS session_duration_seconds
    FROM {source} GROUP BY event_date, session_id, user_id"""


def _product_days(source: str) -> str:
    return f"""
    SELECT event_date, product_id, category, price_band,
           count(*) FILTER (event_type = 'product_view') AS views,
           count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
           count(*) FILTER (event_type = 'purchase') AS purchases,
           {_money(_ANY_AMOUNT)} AS revenue
    FROM {source} LEFT JOIN products USING (product_id)
    GROUP BY event_date, product_id, category, price_band"""


def _marts(source: str) -> str:
    return f"""
daily_kpis AS ({_daily_kpis(source)}),
conversion_funnel AS ({_funnel(source)}),
session_metrics AS ({_sessions(source)}),
product_daily_metrics AS ({_product_days(source)})
"""


MARTS = f"{SILVER}, {PRODUCTS}, {_marts('silver')}"
# The marts of the feed's valid events, the latest row of each.
FEED_MARTS = f"{COERCED}, {PRODUCTS}, {_marts('latest')}"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _check(name: str, passed: str, details: str) -> str:
    return f"SELECT '{name}' AS check_name, {passed} AS passed, '{details}' AS details"


# Names and texts of the checks.
_CHECK_KPIS = _check(
    "daily_kpis_not_empty",
    "EXISTS (SELECT 1 FROM daily_kpis)",
    "analytics.daily_kpis must contain at least one row",
)
_CHECK_REVENUE = _check(
    "non_negative_revenue",
    "NOT EXISTS (SELECT 1 FROM daily_kpis WHERE total_revenue < 0)",
    "analytics.daily_kpis.total_revenue must be non-negative",
)
_CHECK_PRODUCTS = _check(
    "product_metrics_not_empty",
    "EXISTS (SELECT 1 FROM product_daily_metrics)",
    "analytics.product_daily_metrics must contain at least one row",
)


def _check_ids(source: str) -> str:
    return _check(
        "no_duplicate_event_ids",
        f"NOT EXISTS (SELECT event_id FROM {source} GROUP BY event_id HAVING count(*) > 1)",
        "staging.user_events_silver must not contain duplicate event_id values",
    )


def check_texts(silver: str) -> list[str]:
    """The four checks as SQL, in order; both engines read them."""
    return [_CHECK_KPIS, _check_ids(silver), _CHECK_REVENUE, _CHECK_PRODUCTS]


# Contracts: column -> type, in table order; columns that may be null end in '?'.
_CONTRACTS = {
    "user_events_silver": (
        "silver",
        {f + ("?" if f in ("order_id", "order_amount") else ""): "" for f in FIELDS}
        | {"order_amount?": "DECIMAL(12, 2)", "schema_version": "INTEGER", "event_date": ""},
        ("event_id",),
    ),
    "daily_kpis": (
        "daily_kpis",
        {
            "event_date": "", "daily_active_users": "INTEGER", "total_events": "INTEGER",
            "total_sessions": "INTEGER", "total_orders": "INTEGER",
            "total_revenue": "DECIMAL(12, 2)", "purchase_users": "INTEGER",
        },
        ("event_date",),
    ),
    "conversion_funnel": (
        "conversion_funnel",
        {"event_date": ""}
        | {f"{s}_users": "INTEGER" for s in STAGES}
        | {
            "product_view_to_purchase_rate": "DECIMAL(10, 4)",
            "add_to_cart_to_purchase_rate": "DECIMAL(10, 4)",
            "checkout_to_purchase_rate": "DECIMAL(10, 4)",
        },
        ("event_date",),
    ),
    "session_metrics": (
        "session_metrics",
        {
            "event_date": "", "session_id": "", "user_id": "", "session_start_time": "",
            "session_end_time": "", "event_count": "INTEGER", "purchase_count": "INTEGER",
            "total_revenue": "DECIMAL(12, 2)", "session_duration_seconds": "INTEGER",
        },
        ("event_date", "session_id"),
    ),
    "product_daily_metrics": (
        "product_daily_metrics",
        {
            "event_date": "", "product_id": "", "category?": "", "price_band?": "",
            "views": "INTEGER", "add_to_carts": "INTEGER", "purchases": "INTEGER",
            "revenue": "DECIMAL(12, 2)",
        },
        ("event_date", "product_id"),
    ),
}


def _conformed(table: str, ctes: str = MARTS, silver: str = "silver") -> str:
    source, columns, _ = _CONTRACTS[table]
    source = silver if source == "silver" else source
    shown = []
    for label, dtype in columns.items():
        name = label.rstrip("?")
        value = f"CAST({name} AS {dtype})" if dtype else name
        if dtype.startswith("DECIMAL"):
            value = f"CAST({value} AS VARCHAR)"
        shown.append(f"{value} AS {name}")
    return _with(ctes, f"SELECT {', '.join(shown)} FROM {source}")


def _breaches() -> str:
    parts = []
    for table, (source, columns, key) in _CONTRACTS.items():
        for label, dtype in columns.items():
            name = label.rstrip("?")
            rules = {}
            if not label.endswith("?"):
                rules[f"not_null:{name}"] = f"{name} IS NULL"
            if dtype:
                rules[f"fits:{name}"] = (
                    f"{name} IS NOT NULL AND TRY_CAST({name} AS {dtype}) IS NULL"
                )
            parts += [
                f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
                f"count(*) FILTER ({test}) AS breaches FROM {source}"
                for rule, test in rules.items()
            ]
        parts.append(
            f"SELECT '{table}', 'unique:{','.join(key)}', "
            f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) "
            f"FROM (SELECT count(*) AS c FROM {source} GROUP BY {', '.join(key)})"
        )
    return _with(MARTS, " UNION ALL ".join(parts))


_SILVER_ROW = f"{_FIELD_LIST}, event_date"
_LATE = "minute(kafka_timestamp) BETWEEN 30 AND 35"
_ARRIVALS = f"""{COERCED},
arrivals AS (SELECT c.event_id, c.event_time, {_LATE} AS is_late
             FROM coerced c JOIN bronze b USING ("partition", "offset")),
mark AS (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 15 MINUTE AS reached
         FROM arrivals WHERE NOT is_late)
"""

ORACLES: dict[str, str] = {
    "topic_source": _with(
        BRONZE,
        'SELECT kafka_key AS "key", raw_payload AS value, topic, "partition", "offset", '
        'kafka_timestamp AS "timestamp" FROM bronze',
    ),
    "silver_scan": _with(SILVER, "SELECT * FROM silver"),
    "product_dim_scan": _with(PRODUCTS, "SELECT * FROM products"),
    "event_json_array_scan": _with(
        SILVER,
        f"SELECT {_FIELD_LIST} FROM silver UNION ALL "
        f"SELECT {_FIELD_LIST} FROM silver WHERE minute(event_time) < 30",
    ),
    "bronze_projection": _with(BRONZE, "SELECT * FROM bronze"),
    "bronze_sink": _with(BRONZE, "SELECT * FROM bronze"),
    "parse_payload": _with(PARSED, "SELECT * FROM parsed"),
    "event_date_fallback": _with(
        STREAM_RULES, 'SELECT "partition", "offset", event_date FROM judged'
    ),
    "validate_stream_rules": _with(
        STREAM_RULES, 'SELECT "partition", "offset", event_id, validation_errors FROM judged'
    ),
    "validate_contract_rules": _with(
        CONTRACT_RULES, 'SELECT "partition", "offset", event_id, validation_errors FROM judged'
    ),
    "coerce_events": _with(COERCED, "SELECT * EXCLUDE (event_date) FROM coerced"),
    "route_quarantine": _with(STREAM_RULES, "SELECT * FROM judged WHERE validation_errors <> ''"),
    "quarantine_sink": _with(CONTRACT_RULES, "SELECT * FROM judged WHERE validation_errors <> ''"),
    "route_valid": _with(
        STREAM_RULES, f"SELECT {_SILVER_ROW} FROM judged WHERE validation_errors = ''"
    ),
    "topic_encode": _with(
        SILVER,
        f"SELECT {_FIELD_LIST} FROM silver",
    ),
    "topic_sink": _with(
        SILVER,
        f"SELECT {_FIELD_LIST} FROM silver",
    ),
    "event_json_array_split": _with(
        SILVER,
        f"SELECT {_FIELD_LIST} FROM silver",
    ),
    "product_left_join": _with(
        f"{SILVER}, {PRODUCTS}", "SELECT * FROM silver LEFT JOIN products USING (product_id)"
    ),
    **{
        name: _with(MARTS, f"SELECT * FROM {name}")
        for name in (
            "daily_kpis", "conversion_funnel", "session_metrics", "product_daily_metrics",
        )
    },
    "daily_kpis_merged": _with(MARTS, "SELECT * FROM daily_kpis"),
    "daily_kpis_from_raw": _with(
        COERCED,
        "SELECT event_date, count(DISTINCT user_id) AS daily_active_users, "
        "count(*) AS total_events, count(DISTINCT session_id) AS total_sessions, "
        "count(DISTINCT nullif(order_id, '')) AS total_orders, "
        f"{_money(_ANY_AMOUNT)} AS total_revenue FROM latest GROUP BY event_date",
    ),
    "session_metrics_from_raw": _with(
        COERCED,
        "SELECT session_id, arg_min(user_id, (event_time, user_id)) AS user_id, "
        "CAST(min(event_time) AS DATE) AS event_date, "
        "CAST(epoch_us(max(event_time)) - epoch_us(min(event_time)) AS BIGINT) // 1000000 "
        "AS session_duration_seconds, count(*) AS event_count, "
        "count(*) FILTER (event_type = 'purchase') AS purchase_count, "
        f"{_money(_ANY_AMOUNT)} AS total_revenue FROM latest GROUP BY session_id",
    ),
    "data_quality_report": _with(
        CONTRACT_RULES,
        "SELECT count(*) AS total_events, "
        "count(*) FILTER (validation_errors = '') AS valid_events, "
        "count(*) FILTER (validation_errors <> '') AS invalid_events, "
        "count(event_id) - count(DISTINCT event_id) AS duplicate_event_ids, "
        "CAST(sum(len(list_filter(string_split(validation_errors, '|'), "
        "lambda e: starts_with(e, 'event_type')))) AS BIGINT) AS invalid_event_types, "
        "CAST(sum(len(list_filter(string_split(validation_errors, '|'), "
        "lambda e: suffix(e, 'is required')))) AS BIGINT) AS missing_required_fields "
        "FROM judged",
    ),
    "batch_dedup_any": _with(
        COERCED, 'SELECT * EXCLUDE (event_date, ingest_time, "partition", "offset") FROM latest'
    ),
    "dedup_latest": _with(COERCED, "SELECT * EXCLUDE (event_date) FROM latest"),
    "silver_sink": _with(
        COERCED, 'SELECT * EXCLUDE (ingest_time, "partition", "offset") FROM latest'
    ),
    "stream_dedup": _with(
        COERCED, f'SELECT {_SILVER_ROW} FROM coerced WHERE "offset" < {REDELIVERY_OFFSET}'
    ),
    "rebuild_silver_range": _with(COERCED, f"SELECT {_SILVER_ROW} FROM latest"),
    "rebuild_silver_from_bronze": _with(COERCED, f"SELECT {_SILVER_ROW} FROM latest"),
    "event_time_watermark": _with(
        COERCED,
        "SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 15 MINUTE AS watermark, "
        "count(*) AS silver_rows FROM latest",
    ),
    "late_data": _with(
        _ARRIVALS,
        f"SELECT {_SILVER_ROW} FROM latest WHERE event_time <= (SELECT reached FROM mark) "
        "AND event_id NOT IN (SELECT event_id FROM arrivals WHERE NOT is_late)",
    ),
    "stream_known_ids": _with(
        COERCED,
        f"""SELECT {_SILVER_ROW} FROM coerced WHERE "offset" < {REDELIVERY_OFFSET}
        UNION ALL SELECT {_SILVER_ROW} FROM latest
        WHERE event_id NOT IN (SELECT event_id FROM coerced WHERE "offset" < {REDELIVERY_OFFSET})""",
    ),
    "lakehouse_counts": _with(
        f"""{_ARRIVALS},
        fresh AS (SELECT * FROM latest
                  WHERE event_id NOT IN (SELECT event_id FROM arrivals WHERE NOT is_late)),
        behind AS (SELECT count(*) AS n FROM fresh WHERE event_time <= (SELECT reached FROM mark)),
        counts AS (SELECT (SELECT count(*) FROM bronze) AS records,
                          (SELECT count(*) FROM judged WHERE validation_errors <> '') AS quarantine,
                          (SELECT n FROM behind) AS late, (SELECT count(*) FROM latest) AS ids)""",
        "SELECT 'records' AS counter, records AS row_count FROM counts UNION ALL "
        "SELECT 'quarantine', quarantine FROM counts UNION ALL SELECT 'late', late FROM counts UNION ALL "
        "SELECT 'silver', ids - late FROM counts UNION ALL "
        "SELECT 'repeated', records - quarantine - ids FROM counts",
    ),
    "rebuild_silver_changes": _with(COERCED, f"SELECT {_SILVER_ROW} FROM latest"),
    "lakehouse_stream": _with(
        COERCED,
        "SELECT 'bronze' AS layer, event_date, count(*) AS row_count FROM bronze GROUP BY ALL "
        "UNION ALL SELECT 'silver', event_date, count(*) FROM latest GROUP BY ALL "
        "UNION ALL SELECT 'quarantine', event_date, count(*) FROM judged "
        "WHERE validation_errors <> '' GROUP BY ALL",
    ),
    "report_daily_kpis": _with(MARTS, "SELECT * FROM daily_kpis ORDER BY event_date DESC"),
    "report_conversion_funnel": _with(
        MARTS, "SELECT * FROM conversion_funnel ORDER BY event_date DESC"
    ),
    "report_session_metrics": _with(
        MARTS,
        "SELECT * EXCLUDE (session_start_time, session_end_time) FROM session_metrics "
        "ORDER BY event_date DESC, session_duration_seconds DESC",
    ),
    "report_product_daily_metrics": _with(
        MARTS, "SELECT * FROM product_daily_metrics ORDER BY event_date DESC, revenue DESC"
    ),
    "check_daily_kpis_not_empty": _with(MARTS, _CHECK_KPIS),
    "check_no_duplicate_event_ids": _with(COERCED, _check_ids("coerced")),
    "check_non_negative_revenue": _with(MARTS, _CHECK_REVENUE),
    "check_product_metrics_not_empty": _with(MARTS, _CHECK_PRODUCTS),
    "run_checks": _with(MARTS, " UNION ALL ".join(check_texts("silver"))),
    "run_checks_sql": _with(MARTS, " UNION ALL ".join(check_texts("silver"))),
    "mart_conform": _breaches(),
    **{f"mart_conform_{table}": _conformed(table) for table in _CONTRACTS},
    "gold_write": _with(MARTS, "SELECT * FROM session_metrics"),
    "warehouse_write": _conformed("session_metrics"),
    "warehouse_namespaces": _with(
        MARTS,
        " UNION ALL ".join(
            f"SELECT '{'staging' if table == 'user_events_silver' else 'analytics'}' AS namespace, "
            f"'{table}' AS table_name, count(*) AS row_count FROM {source}"
            for table, (source, _, _) in _CONTRACTS.items()
        ),
    ),
    **{f"daily_run_{table}": _conformed(table, FEED_MARTS, "latest") for table in _CONTRACTS},
    **dict.fromkeys(("daily_run", "daily_run_range"), _with(
        f"{COERCED}, kpis AS ({_daily_kpis('latest')})",
        "SELECT event_date, CAST(daily_active_users AS INTEGER) AS daily_active_users, "
        "CAST(total_events AS INTEGER) AS total_events, "
        "CAST(total_sessions AS INTEGER) AS total_sessions, "
        "CAST(total_orders AS INTEGER) AS total_orders, "
        "CAST(CAST(total_revenue AS DECIMAL(12, 2)) AS VARCHAR) AS total_revenue, "
        "CAST(purchase_users AS INTEGER) AS purchase_users FROM kpis",
    )),
}
