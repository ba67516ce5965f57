"""Declared schemas and fixed values shared by every layer.

Schemas are written as text so that a table's column order, which is part of its contract, can be
read at a glance. Everything is nullable.
"""

from pyspark.sql.types import StructType

# --- Fixed values: these must be exactly these for results to be right -------------------------
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TIME_SUFFIX = " UTC"
EVENT_TIME_STRICT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC$"
MISSING_EVENT_ID = "missing_event_id"
MISSING_EVENT_TIME = "missing_event_time"
INVALID_EVENT_TYPE = "invalid_event_type"
UNPARSEABLE_EVENT_TIME = "unparseable_event_time"
MISSING_EVENT_TYPE = "missing_event_type"
EVENT_ID_PATTERN = "evt_%s_%010d"
CURATED_PREFIX = "gold"
PRIVATE_LAYERS = ("raw", "bronze", "silver")
MONEY_TOLERANCE = 0.01
TOP_PRODUCTS = 25
# Counts and tolerances of the one-million-event demo run.
MILESTONES = {
    "bronze_rows": (1_000_000, 0),
    "silver_rows": (1_000_000, 0),
    "fct_sessions": (874_457, 5_000),
    "fct_purchases": (17_405, 500),
    "agg_product_performance": (83_600, 2_000),
    "fct_cart_abandonment": (20_858, 1_000),
    "total_revenue": (5_377_910.49, 1.0),
}
# -----------------------------------------------------------------------------------------------


def _schema(columns: str) -> StructType:
    """``name type, name type, ...`` as a schema, without needing a session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema = schema.add(name, {"bigint": "long", "int": "integer"}.get(kind, kind))
    return schema


# The source file carries no event_id; the sampler stamps one. Everything is text.
SOURCE_CSV = _schema(
    "event_time string, event_type string, product_id string, category_id string, "
    "category_code string, brand string, price string, user_id string, user_session string"
)
SAMPLE_CSV = _schema("event_id string, " + ", ".join(f"{f.name} string" for f in SOURCE_CSV))

# The JSON document inside a topic record.
PAYLOAD = _schema(
    "event_id string, event_time string, event_type string, product_id bigint, "
    "category_id string, category_code string, brand string, price double, "
    "user_id bigint, user_session string"
)
ENVELOPE = _schema(
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)
_ENVELOPE_COLUMNS = (
    "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"
)
_PAYLOAD_COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAYLOAD)

BRONZE = _schema(
    f"{_PAYLOAD_COLUMNS}, event_date date, {_ENVELOPE_COLUMNS}, ingested_at timestamp"
)
# raw_value keeps the record as received, so that a document that did not parse is not lost.
QUARANTINE = _schema(
    f"{_PAYLOAD_COLUMNS}, invalid_reason string, {_ENVELOPE_COLUMNS}, ingested_at timestamp, "
    "raw_value string"
)
SILVER = _schema(
    "event_id string, event_ts timestamp, event_date date, event_type string, "
    "product_id bigint, category_id bigint, category_code string, brand string, price double, "
    "user_id bigint, user_session string, bronze_ingested_at timestamp, "
    "silver_processed_at timestamp"
)
# event_seq_in_session is 64-bit: one runaway session may hold more than 2^31 events.
SESSION_EVENTS = _schema(
    "event_id string, event_ts timestamp, event_date date, event_type string, "
    "product_id bigint, category_id bigint, category_code string, brand string, price double, "
    "user_id bigint, session_id string, event_seq_in_session bigint, "
    "session_start_ts timestamp, session_end_ts timestamp, seconds_from_session_start bigint, "
    "bronze_ingested_at timestamp, silver_processed_at timestamp, sessionized_at timestamp"
)
FCT_SESSIONS = _schema(
    "session_id string, user_id bigint, session_date date, session_start_ts timestamp, "
    "session_end_ts timestamp, session_duration_seconds bigint, event_count bigint, "
    "view_count bigint, cart_count bigint, remove_from_cart_count bigint, "
    "purchase_count bigint, distinct_products_viewed bigint, "
    "distinct_products_purchased bigint, session_revenue double, converted boolean, "
    "gold_processed_at timestamp"
)
FCT_PURCHASES = _schema(
    "purchase_id string, purchase_ts timestamp, purchase_date date, session_id string, "
    "user_id bigint, product_id bigint, category_id bigint, category_code string, "
    "brand string, purchase_amount double, event_seq_in_session bigint, "
    "seconds_from_session_start bigint, bronze_ingested_at timestamp, "
    "silver_processed_at timestamp, gold_processed_at timestamp"
)
AGG_PRODUCT_PERFORMANCE = _schema(
    "product_id bigint, category_id bigint, category_code string, brand string, "
    "view_count bigint, cart_count bigint, remove_from_cart_count bigint, "
    "purchase_count bigint, unique_viewers bigint, unique_cart_adders bigint, "
    "unique_purchasers bigint, total_revenue double, last_event_date date, "
    "view_to_purchase_rate double, cart_to_purchase_rate double, gold_processed_at timestamp"
)
AGG_CONVERSION_FUNNEL = _schema(
    "session_date date, total_sessions bigint, sessions_with_view bigint, "
    "sessions_with_cart bigint, sessions_with_purchase bigint, view_to_cart_sessions bigint, "
    "cart_to_purchase_sessions bigint, view_to_purchase_sessions bigint, "
    "abandoned_cart_sessions bigint, view_to_cart_rate double, cart_to_purchase_rate double, "
    "view_to_purchase_rate double, cart_abandonment_rate double, gold_processed_at timestamp"
)
FCT_CART_ABANDONMENT = _schema(
    "session_id string, user_id bigint, session_date date, session_start_ts timestamp, "
    "session_end_ts timestamp, session_duration_seconds bigint, view_count bigint, "
    "cart_count bigint, remove_from_cart_count bigint, cart_event_count bigint, "
    "distinct_products_carted bigint, first_cart_ts timestamp, last_cart_ts timestamp, "
    "abandoned boolean, gold_processed_at timestamp"
)

# Curated tables: schema and the date column their files are partitioned by (None: not at all).
GOLD = {
    "fct_sessions": (FCT_SESSIONS, "session_date"),
    "fct_purchases": (FCT_PURCHASES, "purchase_date"),
    "agg_product_performance": (AGG_PRODUCT_PERFORMANCE, None),
    "agg_conversion_funnel": (AGG_CONVERSION_FUNNEL, "session_date"),
    "fct_cart_abandonment": (FCT_CART_ABANDONMENT, "session_date"),
}

# Presentation marts: curated table each one is cut from, and its columns in order.
MARTS = {
    "mart_sessions": (
        "fct_sessions",
        [
            "session_id", "user_id", "session_date", "session_start_ts", "session_end_ts",
            "session_duration_seconds", "event_count", "view_count", "cart_count",
            "purchase_count", "session_revenue", "converted", "gold_processed_at",
        ],
    ),
    "mart_product_performance": (
        "agg_product_performance",
        [
            "product_id", "category_code", "brand", "view_count", "cart_count",
            "purchase_count", "unique_purchasers", "total_revenue", "view_to_purchase_rate",
            "cart_to_purchase_rate", "last_event_date", "gold_processed_at",
        ],
    ),
    "mart_conversion_funnel": (
        "agg_conversion_funnel",
        [
            "session_date", "total_sessions", "sessions_with_view", "sessions_with_cart",
            "sessions_with_purchase", "view_to_cart_rate", "cart_to_purchase_rate",
            "view_to_purchase_rate", "cart_abandonment_rate", "abandoned_cart_sessions",
            "gold_processed_at",
        ],
    ),
}
