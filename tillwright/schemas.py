"""Table schemas, keys and column defaults.

Ids are bigint: at the size this runs at, a 32-bit id overflows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

# Table names, column names, column types and defaults of the data model.
TABLE_DDL = {
    "payment_gateways": """
        gateway_id BIGINT, gateway_name STRING, gateway_type STRING, api_version STRING,
        is_active BOOLEAN, created_at TIMESTAMP""",
    "merchants": """
        merchant_id BIGINT, merchant_name STRING, merchant_email STRING, business_type STRING,
        country STRING, currency STRING, commission_rate DECIMAL(5,2), is_verified BOOLEAN,
        created_at TIMESTAMP, updated_at TIMESTAMP""",
    "customers": """
        customer_id BIGINT, customer_email STRING, customer_name STRING, phone_number STRING,
        country STRING, customer_since DATE, total_transactions INT, total_spent DECIMAL(15,2),
        risk_score INT, is_blocked BOOLEAN, created_at TIMESTAMP""",
    "payment_methods": """
        payment_method_id BIGINT, customer_id BIGINT, payment_type STRING, card_last_4 STRING,
        card_brand STRING, expiry_month INT, expiry_year INT, is_default BOOLEAN,
        is_active BOOLEAN, created_at TIMESTAMP""",
    "transactions": """
        transaction_id BIGINT, transaction_uuid STRING, merchant_id BIGINT, customer_id BIGINT,
        payment_method_id BIGINT, gateway_id INT, amount DECIMAL(15,2), currency STRING,
        transaction_status STRING, payment_type STRING, description STRING, customer_ip STRING,
        user_agent STRING, transaction_timestamp TIMESTAMP, processed_timestamp TIMESTAMP,
        gateway_response_code STRING, gateway_response_message STRING,
        is_test_transaction BOOLEAN, metadata STRING""",
    "transaction_logs": """
        log_id BIGINT, transaction_id BIGINT, log_timestamp TIMESTAMP, old_status STRING,
        new_status STRING, changed_by STRING, remarks STRING""",
    "fraud_alerts": """
        alert_id BIGINT, transaction_id BIGINT, alert_type STRING, risk_level STRING,
        alert_message STRING, is_resolved BOOLEAN, resolved_by STRING, created_at TIMESTAMP,
        resolved_at TIMESTAMP""",
    "refunds": """
        refund_id BIGINT, transaction_id BIGINT, refund_amount DECIMAL(15,2),
        refund_reason STRING, refund_status STRING, requested_by STRING, requested_at TIMESTAMP,
        processed_at TIMESTAMP""",
}

# "now" stands for the load instant, "today" for its date.
COLUMN_DEFAULTS = {
    "payment_gateways": {"is_active": True, "created_at": "now"},
    "merchants": {
        "currency": "USD", "commission_rate": "2.5", "is_verified": False,
        "created_at": "now", "updated_at": "now",
    },
    "customers": {
        "customer_since": "today", "total_transactions": 0, "total_spent": "0.00",
        "risk_score": 50, "is_blocked": False, "created_at": "now",
    },
    "payment_methods": {"is_default": False, "is_active": True, "created_at": "now"},
    "transactions": {
        "currency": "USD", "transaction_timestamp": "now", "is_test_transaction": False,
    },
    "transaction_logs": {"log_timestamp": "now"},
    "fraud_alerts": {"is_resolved": False, "created_at": "now"},
    "refunds": {"requested_at": "now"},
}

# Parents before children, so that foreign keys hold while loading.
LOAD_ORDER = (
    "merchants", "customers", "payment_methods", "transactions", "fraud_alerts", "refunds",
)

DERIVED_TRANSACTION_COLUMNS = (
    "transaction_hour", "transaction_day_of_week", "transaction_month", "processing_time_seconds",
)
# End of fixed values.

# Partition column of the monthly transaction store.
MONTH = "transaction_month_start"

# Columns that only cleaned transactions carry.
DERIVED_DDL = """
    transaction_hour INT, transaction_day_of_week INT, transaction_month INT,
    processing_time_seconds DOUBLE"""


@cache
def schema(table: str) -> StructType:
    """A table's schema; parsing it needs a running session."""
    return StructType.fromDDL(TABLE_DDL[table])


def column_type(table: str, column: str, default: str = "string") -> str:
    """Spark type text of a column, or `default` when the model does not know it."""
    known = list(schema(table))
    if table == "transactions":
        known += list(StructType.fromDDL(DERIVED_DDL))
    for field in known:
        if field.name == column:
            return field.dataType.simpleString()
    return default
