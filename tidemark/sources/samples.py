"""Raw event payloads derived from ordinary tables, for demos, checks and the benchmark.

``events_as_payloads`` turns an event log into JSON lines and plants known defects and edge
cases by event number. ``order_lines_as_payloads`` turns order lines into events that arrive
when the line ships: lines shipped before their order date become future timestamps, and
repeated line numbers become duplicate copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the sample, of no meaning to the library.
CATEGORIES = ("lamp", "chair", "teapot", "blanket", "notebook", "bicycle", "kettle", "mirror")
FAILURE_CODES = ("limit_reached", "wrong_pin", "account_closed", "timed_out", "bank_offline", "suspicious")


def _array(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _spread(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows over all cores. A row of a few packed bytes becomes a payload of hundreds that is judged, so the
    few splits that a small file has would leave most cores idle."""
    return rows.repartition(2 * spark.sparkContext.defaultParallelism)


def events_as_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value STRING, arrived_at TIMESTAMP``, one row per event copy."""
    columns = ("event_id", "event_type", "ts", "user_id", "props", "value")
    events = _spread(spark, spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns))
    base = events.selectExpr(
        "event_id AS id",
        "lpad(event_id, 12, '0') AS id12",
        "CASE WHEN event_id % 500 BETWEEN 1 AND 16 THEN event_id % 500 ELSE 0 END AS planted",
        "event_type AS kind",
        "cast(date_trunc('SECOND', ts) AS timestamp) AS t0",
        "user_id",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
        "value AS price",
    )
    typed = base.selectExpr(
        "*",
        """CASE WHEN planted IN (5, 10, 11, 12, 13) THEN 'order_placed'
                WHEN planted = 16 THEN 'cart_abandoned'
                WHEN kind = 'purchase' THEN 'order_placed'
                WHEN kind = 'click' THEN 'cart_abandoned'
                WHEN kind = 'error' THEN 'payment_failed'
                ELSE 'product_viewed' END AS type""",
        """CASE WHEN planted = 15 THEN t0 + INTERVAL 1 HOUR
                WHEN planted = 0 AND id % 20 = 3 THEN t0 + make_interval(0, 0, 0, 0, 2 + id % 71)
                ELSE t0 + INTERVAL 5 MINUTES END AS first_arrival""",
        "explode(CASE WHEN planted = 0 AND id % 40 = 7 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    shown = typed.selectExpr(
        "*",
        "first_arrival + make_interval(0, 0, 0, 0, copy) AS arrived_at",
        """CASE WHEN planted = 9 THEN first_arrival + INTERVAL 10 MINUTES
                WHEN planted = 14 THEN first_arrival + INTERVAL 300 SECONDS
                ELSE t0 END AS shown_time""",
        """CASE WHEN planted = 10 THEN '"abcde"' WHEN planted = 11 THEN '0'
                WHEN planted = 16 THEN '"many"' ELSE cast(1 + id % 5 AS string) END AS quantity""",
        """CASE WHEN planted = 12 THEN concat('-', cast(price AS string)) WHEN planted = 13 THEN '0'
                WHEN copy = 1 THEN cast(round(price + 1, 2) AS string)
                ELSE cast(price AS string) END AS unit_price""",
        f"element_at({_array(CATEGORIES)}, cast(k % 8 + 1 AS int)) AS category",
        f"element_at({_array(FAILURE_CODES)}, cast(id % 6 + 1 AS int)) AS failure_code",
    )
    json = shown.selectExpr(
        "planted",
        "arrived_at",
        """concat('{', concat_ws(',',
            concat('"event_id":"', CASE WHEN planted = 6 THEN '#' ELSE '' END, id12, '"'),
            concat('"event_type":"', CASE WHEN planted = 4 THEN 'wishlist_added' ELSE type END, '"'),
            concat('"event_timestamp":',
                   CASE WHEN planted = 7 THEN cast(1700000000 + id AS string)
                        WHEN planted = 8 THEN '"not-a-date"'
                        ELSE date_format(shown_time, "'\\"'yyyy-MM-dd'T'HH:mm:ss'Z\\"'") END),
            CASE WHEN planted <> 3 THEN concat('"customer_id":"cust-', lpad(user_id, 6, '0'), '"') END,
            concat('"product_id":"', category, '-', lpad(k, 5, '0'), '"'),
            concat('"category":"', category, '"'),
            CASE WHEN type IN ('order_placed', 'payment_failed') AND planted <> 5
                 THEN concat('"order_id":"ord-', id12, '"') END,
            CASE WHEN type = 'cart_abandoned' THEN concat('"cart_id":"cart-', id12, '"') END,
            CASE WHEN type <> 'product_viewed' THEN concat('"quantity":', quantity) END,
            CASE WHEN type <> 'product_viewed' THEN concat('"unit_price":', unit_price) END,
            CASE WHEN type = 'payment_failed' THEN concat('"failure_code":"', failure_code, '"') END
        ), '}') AS json""",
    )
    return json.selectExpr(
        """CASE WHEN planted = 1 THEN left(json, length(json) - 10)
                WHEN planted = 2 THEN concat('[', json, ']')
                ELSE json END AS value""",
        "arrived_at",
    )


def order_lines_as_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value STRING, arrived_at TIMESTAMP``, one row per order line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.selectExpr(
        f"""concat(
            '{{"event_id":"', lpad(l_orderkey, 12, '0'), '-', lpad(l_linenumber, 4, '0'),
            '","event_type":"order_placed","event_timestamp":"',
            date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            '","customer_id":"cust-', lpad(o_custkey, 6, '0'),
            '","product_id":"', element_at({_array(CATEGORIES)}, cast(l_partkey % 8 + 1 AS int)),
            '-', lpad(l_partkey, 5, '0'),
            '","order_id":"ord-', lpad(o_orderkey, 12, '0'),
            '","quantity":', cast(l_quantity AS bigint),
            ',"unit_price":', cast(l_extendedprice AS string), '}}') AS value""",
        "cast(l_shipdate AS timestamp) AS arrived_at",
    )
