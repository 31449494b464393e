"""The event contract: values that must agree with the data producers and dashboards.

Everything in this module is a fixed value (word lists, limits, labels). Logic lives
elsewhere.
"""

# Accepted event types.
EVENT_TYPES = ("order_placed", "cart_abandoned", "product_viewed", "payment_failed")

# Fields every event needs, in reporting order.
REQUIRED_FIELDS = ("event_id", "event_type", "event_timestamp", "customer_id")

# Extra fields per event type, in reporting order.
FIELDS_BY_TYPE = {
    "order_placed": ("order_id", "product_id", "quantity", "unit_price"),
    "cart_abandoned": ("cart_id", "product_id"),
    "product_viewed": ("product_id",),
    "payment_failed": ("order_id", "failure_code"),
}

# Hex digits and dashes, 8 to 36 of them; one final newline is tolerated.
EVENT_ID_SHAPE = r"^[0-9a-fA-F-]{8,36}\n?\z"

# Clock limits in seconds, both strict.
MAX_FUTURE_SECONDS = 300
LATE_AFTER_SECONDS = 3600

# Fixed value: characters of a detail that a report shows. What is stored is whole.
SHORT_DETAIL_CHARS = 80

# Reject reasons in checking order, with their dashboard labels.
REASON_LABELS = {
    "invalid_json": "Payload was not parseable JSON",
    "not_an_object": "Record was not a JSON object",
    "missing_required_field": "Missing a required field",
    "unknown_event_type": "Event type not in the accepted set",
    "missing_type_specific_field": "Missing a field required for that event type",
    "malformed_event_id": "Event ID failed format check",
    "bad_timestamp_type": "Timestamp was not a string",
    "unparseable_timestamp": "Timestamp could not be parsed",
    "future_timestamp": "Timestamp was implausibly in the future",
    "non_numeric_amount": "Quantity or price was not numeric",
    "non_positive_quantity": "Order quantity was zero or negative",
    "negative_price": "Unit price was negative",
}
REJECT_REASONS = tuple(REASON_LABELS)

# Freshness classes, seconds behind now (strict).
STALE_AFTER_SECONDS = 86_400
LAGGING_AFTER_SECONDS = 21_600

# Reject-rate alarm.
RATE_PERIOD_SECONDS = 300
RATE_THRESHOLD_PCT = 5
RATE_PERIODS_TO_ALARM = 2

# Freshness alarm.
FRESHNESS_PERIOD_SECONDS = 3600
FRESHNESS_THRESHOLD_SECONDS = 86_400

# A buffer of arrivals is stored at this size or age, whichever comes first.
BUFFER_BYTES = 5 * 1024 * 1024
BUFFER_SECONDS = 60
