"""Declared schemas. Nothing in this library infers a schema from data."""

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}


def _struct(ddl: str) -> T.StructType:
    """Flat DDL to a schema; unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = (column.split() for column in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _struct("value STRING")

BRONZE_DDL = """
    event_id STRING, event_type STRING, event_timestamp STRING, customer_id STRING,
    product_id STRING, order_id STRING, cart_id STRING, quantity STRING, unit_price STRING,
    failure_code STRING, category STRING, event_date STRING, _validated_at STRING,
    _is_late_arrival BOOLEAN
"""
BRONZE = _struct(BRONZE_DDL)

QUARANTINE = _struct("reject_detail STRING, rejected_at STRING, raw_payload STRING, raw_base64 STRING")
# A batch that is not compacted yet keeps the reason in its records.
REJECTS = _struct("reject_reason STRING, reject_detail STRING, rejected_at STRING, raw_payload STRING, raw_base64 STRING")

VERDICTS = _struct(
    "reject_reason STRING, reject_detail STRING, rejected_at STRING, raw_payload STRING, raw_base64 STRING, "
    "line STRING, ingest_date STRING"
)
FRESHNESS = _struct("recorded_at TIMESTAMP, lag_seconds DOUBLE")

EVENT_DDL = """
    event_id STRING, event_type STRING, event_timestamp TIMESTAMP, customer_id STRING,
    product_id STRING, order_id STRING, cart_id STRING, quantity INT, unit_price DOUBLE,
    gross_amount DOUBLE, failure_code STRING, is_late_arrival BOOLEAN, event_date STRING
"""
SILVER = _struct(EVENT_DDL)
# Silver's files also have the stamp that decides between copies; its readers leave it out.
STORED_SILVER = _struct(EVENT_DDL.replace("event_date", "validated_at TIMESTAMP, event_date"))

FACT_ORDERS_DDL = """
    order_key STRING, order_id STRING, customer_key STRING, product_key STRING,
    date_key INT, quantity INT, unit_price DOUBLE, gross_amount DOUBLE,
    event_timestamp TIMESTAMP, is_late_arrival BOOLEAN, event_date STRING
"""
FACT_ORDERS = _struct(FACT_ORDERS_DDL)

DIM_CUSTOMER_DDL = """
    customer_key STRING, customer_id STRING, first_seen_at TIMESTAMP,
    last_seen_at TIMESTAMP, total_events BIGINT, total_orders BIGINT
"""
DIM_CUSTOMER = _struct(DIM_CUSTOMER_DDL)

DIM_PRODUCT_DDL = """
    product_key STRING, product_id STRING, category STRING, avg_unit_price DOUBLE,
    times_viewed BIGINT, times_ordered BIGINT
"""
DIM_PRODUCT = _struct(DIM_PRODUCT_DDL)

DIM_DATE_DDL = """
    date_key INT, full_date DATE, year INT, quarter INT, month INT, day INT,
    day_of_week INT, day_name STRING, is_weekend BOOLEAN
"""
DIM_DATE = _struct(DIM_DATE_DDL)

QUARANTINE_SUMMARY_DDL = """
    reject_reason STRING, ingest_date STRING, reject_count BIGINT,
    last_seen_at STRING, sample_detail STRING
"""
QUARANTINE_SUMMARY = _struct(QUARANTINE_SUMMARY_DDL)
