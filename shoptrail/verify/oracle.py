"""DuckDB statements for the registered queries, written apart from the Spark code.

Each is a chain of common table expressions from the ``events`` test table to the layer a query
reads. Clock columns are left out; money is rounded to 2 places and rates to 6.
"""

from __future__ import annotations

_TYPES = "('view', 'cart', 'remove_from_cart', 'purchase')"

_LAYERS = {
    "delivered": (
        [],
        """
        SELECT e.*, copy,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
        FROM events e, (SELECT unnest([0, 1]) AS copy) c
        WHERE copy = 0 OR event_id % 10 = 0
        """,
    ),
    "raw": (
        ["delivered"],
        """
        SELECT
          CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN ''
               ELSE 'evt_42_' || lpad(CAST(event_id + 1 AS VARCHAR), 10, '0') END AS event_id,
          CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 'not-a-time'
               ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
          CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_type = 'click' THEN 'cart'
               WHEN event_type = 'signup' THEN 'remove_from_cart' ELSE event_type END AS event_type,
          CASE WHEN event_id % 73 = 0 THEN NULL ELSE k END AS product_id,
          CASE WHEN k % 11 = 0 THEN 'n/a'
               ELSE CAST(2053013555631882000 + k % 10 AS VARCHAR) END AS category_id,
          CASE WHEN k % 7 = 0 THEN '  ' WHEN k % 5 = 0 THEN NULL
               ELSE ' cat.' || CAST(k % 10 AS VARCHAR) END AS category_code,
          CASE WHEN k % 13 = 0 THEN '' WHEN event_id % 3 = 0 THEN ' Brand' || CAST(k % 17 AS VARCHAR) || ' '
               ELSE 'brand' || CAST(k % 17 AS VARCHAR) END AS brand,
          CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 67 = 0 THEN -value ELSE value END AS price,
          CASE WHEN event_id % 61 = 0 THEN NULL ELSE user_id END AS user_id,
          CASE WHEN event_id % 59 = 0 THEN ' '
               ELSE 's_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') END AS user_session,
          'shop_events' AS kafka_topic,
          CAST(event_id % 4 AS INTEGER) AS kafka_partition,
          CAST(event_id // 4 + copy * 1000000 AS BIGINT) AS kafka_offset,
          ts AS kafka_timestamp,
          event_id * 2 + copy AS source_row
        FROM delivered
        """,
    ),
    "judged": (
        ["raw"],
        f"""
        SELECT *,
          CASE WHEN event_id IS NULL THEN 'missing_event_id'
               WHEN event_time IS NULL THEN 'missing_event_time'
               WHEN event_type NOT IN {_TYPES} THEN 'invalid_event_type'
               WHEN event_date IS NULL THEN 'unparseable_event_time'
               WHEN event_type IS NULL THEN 'missing_event_type' END AS invalid_reason
        FROM (SELECT *, CAST(try_strptime(regexp_replace(event_time, ' UTC$', ''),
                                          '%Y-%m-%d %H:%M:%S') AS DATE) AS event_date FROM raw)
        """,
    ),
    "bronze": (["judged"], "SELECT * FROM judged WHERE invalid_reason IS NULL"),
    "quarantine": (["judged"], "SELECT * FROM judged WHERE invalid_reason IS NOT NULL"),
    "silver": (
        ["bronze"],
        f"""
        SELECT * EXCLUDE (rank) FROM (
          SELECT event_id,
            strptime(regexp_replace(event_time, ' UTC$', ''), '%Y-%m-%d %H:%M:%S') AS event_ts,
            event_date, event_type, product_id, TRY_CAST(category_id AS BIGINT) AS category_id,
            nullif(trim(category_code), '') AS category_code, lower(nullif(trim(brand), '')) AS brand,
            price, user_id, user_session,
            row_number() OVER (PARTITION BY event_id
              ORDER BY kafka_partition DESC NULLS LAST, kafka_offset DESC NULLS LAST) AS rank
          FROM bronze
          WHERE trim(event_id) <> '' AND event_type IN {_TYPES} AND event_date IS NOT NULL
            AND product_id IS NOT NULL AND user_id IS NOT NULL AND trim(user_session) <> ''
            AND (price IS NULL OR price >= 0))
        WHERE rank = 1
        """,
    ),
    "session_events": (
        ["silver"],
        """
        SELECT * EXCLUDE (user_session), user_session AS session_id,
          CAST(row_number() OVER (PARTITION BY user_session
               ORDER BY event_ts NULLS LAST, event_id NULLS LAST) AS BIGINT) AS event_seq_in_session,
          min(event_ts) OVER (PARTITION BY user_session) AS session_start_ts,
          max(event_ts) OVER (PARTITION BY user_session) AS session_end_ts,
          CAST(epoch(event_ts) - epoch(min(event_ts) OVER (PARTITION BY user_session)) AS BIGINT)
            AS seconds_from_session_start
        FROM silver
        """,
    ),
    "fct_sessions": (
        ["silver"],
        """
        SELECT user_session AS session_id, user_id, CAST(min(event_ts) AS DATE) AS session_date,
          min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts,
          CAST(epoch(max(event_ts)) - epoch(min(event_ts)) AS BIGINT) AS session_duration_seconds,
          count(*) AS event_count,
          count(*) FILTER (event_type = 'view') AS view_count,
          count(*) FILTER (event_type = 'cart') AS cart_count,
          count(*) FILTER (event_type = 'remove_from_cart') AS remove_from_cart_count,
          count(*) FILTER (event_type = 'purchase') AS purchase_count,
          count(DISTINCT product_id) FILTER (event_type = 'view') AS distinct_products_viewed,
          count(DISTINCT product_id) FILTER (event_type = 'purchase') AS distinct_products_purchased,
          coalesce(sum(price) FILTER (event_type = 'purchase'), 0) AS session_revenue,
          count(*) FILTER (event_type = 'purchase') > 0 AS converted
        FROM silver GROUP BY user_session, user_id
        """,
    ),
    "fct_purchases": (
        ["session_events"],
        """
        SELECT event_id AS purchase_id, event_ts AS purchase_ts, event_date AS purchase_date, session_id,
          user_id, product_id, category_id, category_code, brand, price AS purchase_amount,
          event_seq_in_session, seconds_from_session_start
        FROM session_events WHERE event_type = 'purchase'
        """,
    ),
    "agg_product_performance": (
        ["session_events"],
        """
        SELECT *,
          CASE WHEN view_count > 0 THEN least(1.0, purchase_count / view_count) ELSE 0.0 END
            AS view_to_purchase_rate,
          CASE WHEN cart_count > 0 THEN least(1.0, purchase_count / cart_count) ELSE 0.0 END
            AS cart_to_purchase_rate
        FROM (SELECT product_id, max(category_id) AS category_id, max(category_code) AS category_code,
            max(brand) AS brand,
            count(*) FILTER (event_type = 'view') AS view_count,
            count(*) FILTER (event_type = 'cart') AS cart_count,
            count(*) FILTER (event_type = 'remove_from_cart') AS remove_from_cart_count,
            count(*) FILTER (event_type = 'purchase') AS purchase_count,
            count(DISTINCT user_id) FILTER (event_type = 'view') AS unique_viewers,
            count(DISTINCT user_id) FILTER (event_type = 'cart') AS unique_cart_adders,
            count(DISTINCT user_id) FILTER (event_type = 'purchase') AS unique_purchasers,
            coalesce(sum(price) FILTER (event_type = 'purchase'), 0) AS total_revenue,
            max(event_date) AS last_event_date
          FROM session_events GROUP BY product_id)
        """,
    ),
    "flags": (
        ["session_events"],
        """
        SELECT session_id, user_id, session_date,
          CAST(first_view_seq IS NOT NULL AS INTEGER) AS has_view,
          CAST(first_cart_seq IS NOT NULL AS INTEGER) AS has_cart,
          CAST(first_purchase_seq IS NOT NULL AS INTEGER) AS has_purchase,
          first_view_seq, first_cart_seq, first_purchase_seq,
          coalesce(first_view_seq < first_cart_seq, false) AS has_strict_view_to_cart,
          coalesce(first_cart_seq < first_purchase_seq, false) AS has_strict_cart_to_purchase,
          coalesce(first_view_seq < first_purchase_seq, false) AS has_strict_view_to_purchase,
          first_cart_seq IS NOT NULL AND first_purchase_seq IS NULL AS is_cart_abandoned
        FROM (SELECT session_id, min(user_id) AS user_id, min(event_date) AS session_date,
            min(event_seq_in_session) FILTER (event_type = 'view') AS first_view_seq,
            min(event_seq_in_session) FILTER (event_type = 'cart') AS first_cart_seq,
            min(event_seq_in_session) FILTER (event_type = 'purchase') AS first_purchase_seq
          FROM session_events GROUP BY session_id)
        """,
    ),
    "agg_conversion_funnel": (
        ["flags"],
        """
        SELECT *,
          CASE WHEN sessions_with_view > 0 THEN least(1.0, view_to_cart_sessions / sessions_with_view)
               ELSE 0.0 END AS view_to_cart_rate,
          CASE WHEN sessions_with_cart > 0 THEN least(1.0, cart_to_purchase_sessions / sessions_with_cart)
               ELSE 0.0 END AS cart_to_purchase_rate,
          CASE WHEN sessions_with_view > 0 THEN least(1.0, view_to_purchase_sessions / sessions_with_view)
               ELSE 0.0 END AS view_to_purchase_rate,
          CASE WHEN sessions_with_cart > 0 THEN least(1.0, abandoned_cart_sessions / sessions_with_cart)
               ELSE 0.0 END AS cart_abandonment_rate
        FROM (SELECT session_date, count(*) AS total_sessions,
            CAST(sum(has_view) AS BIGINT) AS sessions_with_view,
            CAST(sum(has_cart) AS BIGINT) AS sessions_with_cart,
            CAST(sum(has_purchase) AS BIGINT) AS sessions_with_purchase,
            count(*) FILTER (has_strict_view_to_cart) AS view_to_cart_sessions,
            count(*) FILTER (has_strict_cart_to_purchase) AS cart_to_purchase_sessions,
            count(*) FILTER (has_strict_view_to_purchase) AS view_to_purchase_sessions,
            count(*) FILTER (is_cart_abandoned) AS abandoned_cart_sessions
          FROM flags GROUP BY session_date)
        """,
    ),
    "cart_details": (
        ["session_events"],
        """
        SELECT session_id, min(event_ts) AS first_cart_ts, max(event_ts) AS last_cart_ts,
          count(DISTINCT product_id) AS distinct_products_carted, count(*) AS cart_event_count
        FROM session_events WHERE event_type = 'cart' GROUP BY session_id
        """,
    ),
    "fct_cart_abandonment": (
        ["fct_sessions", "cart_details"],
        """
        SELECT s.session_id, user_id, session_date, session_start_ts, session_end_ts,
          session_duration_seconds, view_count, cart_count, remove_from_cart_count,
          coalesce(cart_event_count, cart_count) AS cart_event_count, distinct_products_carted,
          first_cart_ts, last_cart_ts, true AS abandoned
        FROM fct_sessions s LEFT JOIN cart_details d ON s.session_id = d.session_id
        WHERE cart_count > 0 AND NOT converted
        """,
    ),
}


def _chain(layers: list[str]) -> str:
    """WITH clause holding the layers and everything they build on, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in _LAYERS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for layer in layers:
        visit(layer)
    return "WITH " + ",\n".join(f"{name} AS ({_LAYERS[name][1]})" for name in order)


def over(layers: str, select: str) -> str:
    return f"{_chain(layers.split())}\n{select}"


# --- Quality checks ------------------------------------------------------------------------------

_BLANK = r"({0} IS NULL OR regexp_matches({0}, '^\s*$'))"
_BAD_TYPE = f"event_type IS NULL OR event_type NOT IN {_TYPES}"


def rows_where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def repeats(table: str, key: str) -> str:
    return f"SELECT count({key}) - count(DISTINCT {key}) FROM {table}"


def gap(left: str, right: str) -> str:
    return f"SELECT abs(({left}) - ({right}))"


def excess(left: str, right: str) -> str:
    return f"SELECT greatest(({left}) - ({right}), 0)"


def off_by_a_cent(left: str, right: str) -> str:
    return f"SELECT CAST(abs(({left}) - ({right})) > 0.01 AS BIGINT)"


def count(table: str, condition: str = "true") -> str:
    return rows_where(table, condition)


def short_of(minimum: int, table: str) -> str:
    return excess(str(minimum), count(table))


def check_select(suite: str, checks: dict[str, str], warn: tuple[str, ...] = ()) -> str:
    rows = [
        f"SELECT '{suite}' AS suite, '{name}' AS \"check\", CAST(({sql}) AS BIGINT) AS violations, "
        f"'{'WARN' if name in warn else 'FAIL'}' AS bad"
        for name, sql in {"required_columns": "SELECT 0", **checks}.items()
    ]
    union = " UNION ALL ".join(rows)
    return (
        'SELECT suite, "check", violations, CASE WHEN violations = 0 THEN \'PASS\' ELSE bad END AS status '
        f"FROM ({union})"
    )


BRONZE_CHECKS = {
    "min_rows": short_of(1, "bronze"),
    "blank_event_id": rows_where("bronze", _BLANK.format("event_id")),
    "invalid_event_type": rows_where("bronze", _BAD_TYPE),
    "unparseable_event_time": rows_where(
        "bronze",
        "event_time IS NULL OR try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') IS NULL OR NOT "
        r"regexp_full_match(event_time, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC')",
    ),
    "null_event_date": rows_where("bronze", "event_date IS NULL"),
    "empty_rows": rows_where(
        "bronze",
        "coalesce(event_id, event_time, event_type, category_id, category_code, brand, user_session) "
        "IS NULL AND coalesce(product_id, user_id) IS NULL AND price IS NULL AND event_date IS NULL",
    ),
}
SILVER_CHECKS = {
    "min_rows": short_of(1, "silver"),
    "blank_event_id": rows_where("silver", _BLANK.format("event_id")),
    "invalid_event_type": rows_where("silver", _BAD_TYPE),
    "null_event_ts": rows_where("silver", "event_ts IS NULL"),
    "null_event_date": rows_where("silver", "event_date IS NULL"),
    "null_product_id": rows_where("silver", "product_id IS NULL"),
    "null_user_id": rows_where("silver", "user_id IS NULL"),
    "blank_user_session": rows_where("silver", _BLANK.format("user_session")),
    "negative_price": rows_where("silver", "price < 0"),
    "nan_price": rows_where("silver", "isnan(price)"),
    "duplicate_event_id": repeats("silver", "event_id"),
    "rows_within_bronze": excess(count("silver"), count("bronze")),
}
SESSION_EVENT_CHECKS = {
    "blank_event_id": rows_where("session_events", _BLANK.format("event_id")),
    "blank_session_id": rows_where("session_events", _BLANK.format("session_id")),
    "invalid_sequence": rows_where(
        "session_events", "event_seq_in_session IS NULL OR event_seq_in_session < 1"
    ),
    "negative_seconds": rows_where("session_events", "seconds_from_session_start < 0"),
    "null_session_start": rows_where("session_events", "session_start_ts IS NULL"),
    "rows_match_silver": gap(count("session_events"), count("silver")),
}
_SESSIONS_SEEN = "SELECT count(DISTINCT session_id) FROM session_events WHERE trim(session_id) <> ''"
SESSION_CHECKS = {
    "min_rows": short_of(1, "fct_sessions"),
    "blank_session_id": rows_where("fct_sessions", _BLANK.format("session_id")),
    "event_count_below_one": rows_where("fct_sessions", "event_count IS NULL OR event_count < 1"),
    "negative_duration": rows_where("fct_sessions", "session_duration_seconds < 0"),
    "negative_revenue": rows_where("fct_sessions", "session_revenue < 0"),
    "type_counts_mismatch": rows_where(
        "fct_sessions",
        "event_count <> view_count + cart_count + remove_from_cart_count + purchase_count",
    ),
    "converted_mismatch": rows_where("fct_sessions", "converted <> (purchase_count > 0)"),
    "duplicate_session_id": repeats("fct_sessions", "session_id"),
    "rows_match_sessions": gap(count("fct_sessions"), _SESSIONS_SEEN),
}
_PURCHASE_EVENTS = count("session_events", "event_type = 'purchase'")
PURCHASE_CHECKS = {
    "min_rows": short_of(1, "fct_purchases"),
    "blank_purchase_id": rows_where("fct_purchases", _BLANK.format("purchase_id")),
    "blank_session_id": rows_where("fct_purchases", _BLANK.format("session_id")),
    "null_product_id": rows_where("fct_purchases", "product_id IS NULL"),
    "null_purchase_ts": rows_where("fct_purchases", "purchase_ts IS NULL"),
    "negative_amount": rows_where("fct_purchases", "purchase_amount < 0"),
    "duplicate_purchase_id": repeats("fct_purchases", "purchase_id"),
    "rows_match_purchase_events": gap(count("fct_purchases"), _PURCHASE_EVENTS),
}
_EVENT_REVENUE = "SELECT sum(price) FROM session_events WHERE event_type = 'purchase'"
_PRODUCT_REVENUE = "SELECT sum(total_revenue) FROM agg_product_performance"
PRODUCT_CHECKS = {
    "null_product_id": rows_where("agg_product_performance", "product_id IS NULL"),
    "negative_revenue": rows_where("agg_product_performance", "total_revenue < 0"),
    "negative_view_count": rows_where("agg_product_performance", "view_count < 0"),
    "rate_out_of_range": rows_where(
        "agg_product_performance",
        "least(view_to_purchase_rate, cart_to_purchase_rate) < 0 "
        "OR greatest(view_to_purchase_rate, cart_to_purchase_rate) > 1",
    ),
    "revenue_without_purchases": rows_where(
        "agg_product_performance", "purchase_count = 0 AND total_revenue <> 0"
    ),
    "duplicate_product_id": repeats("agg_product_performance", "product_id"),
    "rows_match_products": gap(
        count("agg_product_performance"), "SELECT count(DISTINCT product_id) FROM session_events"
    ),
    "revenue_matches_events": off_by_a_cent(_PRODUCT_REVENUE, _EVENT_REVENUE),
}
_FUNNEL_SESSIONS = "SELECT sum(total_sessions) FROM agg_conversion_funnel"
FUNNEL_CHECKS = {
    "rate_out_of_range": rows_where(
        "agg_conversion_funnel",
        "least(view_to_cart_rate, cart_to_purchase_rate, view_to_purchase_rate, cart_abandonment_rate) < 0 "
        "OR greatest(view_to_cart_rate, cart_to_purchase_rate, view_to_purchase_rate, "
        "cart_abandonment_rate) > 1",
    ),
    "inconsistent_counts": (
        "SELECT coalesce(sum(CAST(sessions_with_view > total_sessions OR sessions_with_cart > "
        "total_sessions AS BIGINT) + CAST(abandoned_cart_sessions > sessions_with_cart AS BIGINT)), 0) "
        "FROM agg_conversion_funnel"
    ),
    "sessions_match": gap(_FUNNEL_SESSIONS, count("fct_sessions")),
}
CART_CHECKS = {
    "min_rows": short_of(0, "fct_cart_abandonment"),
    "blank_session_id": rows_where("fct_cart_abandonment", _BLANK.format("session_id")),
    "not_abandoned": rows_where("fct_cart_abandonment", "NOT abandoned"),
    "cart_count_below_one": rows_where("fct_cart_abandonment", "cart_count IS NULL OR cart_count < 1"),
    "null_first_cart_ts": rows_where("fct_cart_abandonment", "first_cart_ts IS NULL"),
    "duplicate_session_id": repeats("fct_cart_abandonment", "session_id"),
    "rows_match_sessions": gap(
        count("fct_cart_abandonment"), count("fct_sessions", "cart_count > 0 AND NOT converted")
    ),
}
_PURCHASE_REVENUE = "SELECT sum(purchase_amount) FROM fct_purchases"
CROSS_LAYER_CHECKS = {
    "silver_within_bronze": excess(count("silver"), count("bronze")),
    "session_events_match_silver": gap(count("session_events"), count("silver")),
    "sessions_match_session_ids": gap(
        count("fct_sessions"), "SELECT count(DISTINCT session_id) FROM session_events"
    ),
    "purchases_match_purchase_events": gap(count("fct_purchases"), _PURCHASE_EVENTS),
    "session_revenue_matches_purchases": off_by_a_cent(
        "SELECT sum(session_revenue) FROM fct_sessions", _PURCHASE_REVENUE
    ),
    "purchase_revenue_matches_products": off_by_a_cent(_PURCHASE_REVENUE, _PRODUCT_REVENUE),
    "funnel_matches_sessions": gap(_FUNNEL_SESSIONS, count("fct_sessions")),
}
# suite -> (layers it reads, checks, checks that only warn)
SUITES = {
    "bronze": ("bronze", BRONZE_CHECKS, ()),
    "silver": ("silver bronze", SILVER_CHECKS, ("nan_price",)),
    "session_events": ("session_events", SESSION_EVENT_CHECKS, ()),
    "fct_sessions": ("fct_sessions session_events", SESSION_CHECKS, ()),
    "fct_purchases": ("fct_purchases", PURCHASE_CHECKS, ()),
    "agg_product_performance": ("agg_product_performance", PRODUCT_CHECKS, ()),
    "agg_conversion_funnel": ("agg_conversion_funnel fct_sessions", FUNNEL_CHECKS, ()),
    "fct_cart_abandonment": ("fct_cart_abandonment", CART_CHECKS, ()),
    "cross_layer": (
        "bronze fct_sessions fct_purchases agg_product_performance agg_conversion_funnel",
        CROSS_LAYER_CHECKS,
        (),
    ),
}


def suite(name: str) -> str:
    layers, checks, warn = SUITES[name]
    return over(layers, check_select(name, checks, warn))


def all_suites() -> str:
    layers = " ".join(layers for layers, _, _ in SUITES.values())
    selects = [check_select(name, checks, warn) for name, (_, checks, warn) in SUITES.items()]
    return over(layers, " UNION ALL ".join(selects))


# --- Suites over tables with planted faults ---------------------------------------------------------

#: Fault by fault what is changed, by the number at the end of an event id; SQL that Spark and DuckDB read alike.
FAULTY = {
    "silver": (
        "SELECT event_id, event_ts, event_date, event_type, CASE WHEN n % 41 = 0 THEN NULL ELSE product_id END AS product_id, "
        "category_id, category_code, brand, CASE WHEN n % 43 = 0 THEN -1.5 ELSE price END AS price, "
        "CASE WHEN n % 47 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN n % 53 = 0 THEN '  ' ELSE user_session END AS user_session "
        "FROM {numbered} UNION ALL SELECT event_id, event_ts, event_date, 'unknown' AS event_type, product_id, category_id, category_code, "
        "brand, price, user_id, user_session FROM {numbered} WHERE n % 37 = 0"
    ),
    "fct_sessions": (
        "SELECT CASE WHEN event_count % 3 = 0 THEN ' ' ELSE session_id END AS session_id, user_id, session_date, session_start_ts, "
        "session_end_ts, CASE WHEN view_count = 2 THEN -1 ELSE session_duration_seconds END AS session_duration_seconds, event_count, "
        "view_count + CASE WHEN cart_count = 2 THEN 1 ELSE 0 END AS view_count, cart_count, remove_from_cart_count, purchase_count, "
        "distinct_products_viewed, distinct_products_purchased, session_revenue, "
        "CASE WHEN purchase_count = 2 THEN false ELSE converted END AS converted FROM {table}"
    ),
    "fct_purchases": (
        "SELECT CASE WHEN product_id % 5 = 0 THEN '' ELSE purchase_id END AS purchase_id, purchase_ts, purchase_date, session_id, user_id, "
        "CASE WHEN product_id % 7 = 0 THEN NULL ELSE product_id END AS product_id, category_id, category_code, brand, "
        "CASE WHEN product_id % 3 = 0 THEN -purchase_amount ELSE purchase_amount END AS purchase_amount, event_seq_in_session, "
        "seconds_from_session_start FROM {table}"
    ),
}


def faulty(name: str) -> str:
    """A suite's checks over its table with planted faults."""
    layers, checks, warn = SUITES[name]
    numbered = f"(SELECT *, CAST(substr(event_id, 8) AS BIGINT) AS n FROM {name}) numbered"
    planted = f"({FAULTY[name].format(numbered=numbered, table=name)}) {name}"
    moved = {check: sql.replace(f"FROM {name}", f"FROM {planted}") for check, sql in checks.items()}
    return over(layers, check_select(name, moved, warn))
