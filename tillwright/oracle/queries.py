"""SQL per registered query."""

from __future__ import annotations

from .tables import (
    cents, half_up, money_mean, money_mean_half_even, plain_mean, with_tables,
)

OK = "transaction_status = 'success'"
N_OK = f"count(*) FILTER (WHERE {OK})"
N_FAILED = "count(*) FILTER (WHERE transaction_status = 'failed')"
N_REFUNDED = "count(*) FILTER (WHERE transaction_status = 'refunded')"
REVENUE = f"CAST(coalesce(sum(amount) FILTER (WHERE {OK}), 0) AS DOUBLE)"
REFUNDED = "CAST(coalesce(sum(amount) FILTER (WHERE transaction_status = 'refunded'), 0) AS DOUBLE)"
OK_CENTS = f"sum({cents('amount')}) FILTER (WHERE {OK})"
ALL_CENTS = f"sum({cents('amount')})"
AVG_OK_2 = money_mean(OK_CENTS, N_OK)
AVG_OK = plain_mean(OK_CENTS, N_OK)
AVG_ALL = plain_mean(ALL_CENTS, "count(amount)")
RATE_2 = half_up(f"100 * {N_OK}", "count(*)")
RATE = f"(CAST({N_OK} AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) * 100.0)"
DAY = "CAST(transaction_timestamp AS DATE)"
HOUR = "hour(transaction_timestamp)"


def segment(total: str) -> str:
    return (
        f"CASE WHEN {total} > 5000 THEN 'VIP' WHEN {total} > 2000 THEN 'Premium' "
        f"WHEN {total} > 500 THEN 'Regular' ELSE 'New' END"
    )


def days_before(days: int, as_of: str = "2024-01-31") -> str:
    return f"DATE '{as_of}' - INTERVAL {days} DAY"


def title(column: str) -> str:
    """Words of an underscored name with capital initials."""
    words = f"string_split({column}, '_')"
    return (
        f"array_to_string(list_transform({words}, "
        "lambda w: concat(upper(w[1]), lower(substring(w, 2)))), ' ')"
    )


def capital(column: str) -> str:
    return f"concat(upper(left({column}, 1)), lower(substring({column}, 2)))"


CLEANED = {
    "clean_merchants": """
        SELECT * REPLACE (CAST(commission_rate AS DOUBLE) AS commission_rate) FROM merchants""",
    "clean_customers": """
        SELECT * REPLACE (CAST(risk_score AS BIGINT) AS risk_score) FROM customers""",
    "clean_payment_methods": "SELECT * FROM payment_methods",
    "clean_transactions": """
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(gateway_id AS BIGINT) AS gateway_id)
        FROM transactions""",
    "clean_fraud_alerts": "SELECT * FROM fraud_alerts",
    "clean_refunds": """
        SELECT * REPLACE (CAST(refund_amount AS DOUBLE) AS refund_amount) FROM refunds""",
    "conform_defaults": """
        SELECT transaction_id, transaction_uuid, merchant_id, customer_id,
               CAST(NULL AS BIGINT) AS payment_method_id, CAST(gateway_id AS BIGINT) AS gateway_id,
               CAST(amount AS DOUBLE) AS amount, 'USD' AS currency, transaction_status, payment_type,
               CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS customer_ip,
               CAST(NULL AS VARCHAR) AS user_agent, TIMESTAMP '2024-01-31 00:00:00' AS transaction_timestamp,
               processed_timestamp, CAST(NULL AS VARCHAR) AS gateway_response_code,
               CAST(NULL AS VARCHAR) AS gateway_response_message, false AS is_test_transaction, metadata
        FROM transactions""",
}

REPORTS = {
    "daily_revenue": f"""
        SELECT {DAY} AS transaction_date, count(*) AS total_transactions,
               count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT merchant_id) AS unique_merchants,
               {REVENUE} AS total_revenue, {N_FAILED} AS failed_count, {REFUNDED} AS refunded_amount,
               {AVG_OK_2} AS avg_transaction_value, {RATE_2} AS success_rate_pct
        FROM transactions WHERE transaction_timestamp >= {days_before(30)}
        GROUP BY 1 ORDER BY 1 DESC""",
    "top_merchants": f"""
        SELECT merchant_id, merchant_name, business_type, count(transaction_id) AS total_transactions,
               {REVENUE} AS total_revenue, {AVG_OK_2} AS avg_order_value,
               {RATE_2} AS success_rate_pct, count(DISTINCT customer_id) AS unique_customers
        FROM merchants JOIN transactions USING (merchant_id)
        WHERE transaction_timestamp >= {days_before(30)}
        GROUP BY merchant_id, merchant_name, business_type
        HAVING count(transaction_id) >= 10
        ORDER BY total_revenue DESC, merchant_id LIMIT 20""",
    "customer_lifetime_value": f"""
        SELECT p.customer_id, p.customer_name, p.customer_email, spent.n AS total_transactions,
               spent.value AS lifetime_value, spent.mean AS avg_transaction_value,
               CAST(p.risk_score AS BIGINT) AS risk_score, {segment('spent.value')} AS customer_segment,
               spent.latest AS last_transaction_date,
               CASE WHEN date_diff('day', spent.latest, TIMESTAMP '2024-01-31') -
                         CAST(CAST(spent.latest AS TIME) > TIME '00:00:00' AS INTEGER) > 90 THEN 'At Risk'
                    WHEN date_diff('day', spent.latest, TIMESTAMP '2024-01-31') -
                         CAST(CAST(spent.latest AS TIME) > TIME '00:00:00' AS INTEGER) > 30 THEN 'Inactive'
                    ELSE 'Active' END AS activity_status
        FROM (SELECT customer_id AS payer, count(transaction_id) AS n, {REVENUE} AS value,
                     {AVG_OK_2} AS mean, max(transaction_timestamp) AS latest
              FROM transactions GROUP BY customer_id) AS spent
        JOIN customers p ON p.customer_id = spent.payer
        ORDER BY lifetime_value DESC, p.customer_id LIMIT 100""",
    "payment_method_performance": f"""
        SELECT payment_type, count(*) AS transaction_count, {REVENUE} AS total_revenue,
               {AVG_OK_2} AS avg_transaction_value, {RATE_2} AS success_rate_pct,
               {N_FAILED} AS failed_count,
               {half_up(f"100 * {N_REFUNDED}", N_OK)} AS refund_rate_pct
        FROM transactions WHERE transaction_timestamp >= {days_before(30)}
        GROUP BY payment_type ORDER BY total_revenue DESC, payment_type""",
    "fraud_alert_analysis": f"""
        SELECT risk_level, alert_type, count(*) AS alert_count,
               count(DISTINCT transaction_id) AS affected_transactions,
               CAST(sum(amount) AS DOUBLE) AS total_amount_at_risk,
               count(*) FILTER (WHERE is_resolved) AS resolved_count,
               count(*) FILTER (WHERE NOT is_resolved) AS pending_count,
               {half_up("sum(extract(hour FROM resolved_at - created_at))", "count(resolved_at)")}
                   AS avg_resolution_hours
        FROM fraud_alerts JOIN transactions USING (transaction_id)
        WHERE created_at >= {days_before(30)}
        GROUP BY risk_level, alert_type
        ORDER BY total_amount_at_risk DESC, risk_level, alert_type""",
    "hourly_patterns_sql": f"""
        SELECT {HOUR} AS hour_of_day, count(*) AS transaction_count, {REVENUE} AS revenue,
               {AVG_OK_2} AS avg_value, {RATE_2} AS success_rate_pct
        FROM transactions WHERE transaction_timestamp >= {days_before(7)}
        GROUP BY 1 ORDER BY 1""",
    "geographic": f"""
        SELECT country, count(DISTINCT customer_id) AS customer_count,
               count(transaction_id) AS transaction_count, {REVENUE} AS total_revenue,
               {AVG_OK_2} AS avg_transaction_value,
               {half_up(f"100 * {N_OK}", "count(transaction_id)")} AS success_rate_pct
        FROM customers JOIN transactions USING (customer_id)
        WHERE transaction_timestamp >= {days_before(30)}
        GROUP BY country ORDER BY total_revenue DESC, country""",
    "refund_analysis": f"""
        SELECT refund_reason, count(*) AS refund_count,
               CAST(sum(refund_amount) AS DOUBLE) AS total_refund_amount,
               {money_mean(f"sum({cents('refund_amount')})", "count(refund_amount)")} AS avg_refund_amount,
               count(*) FILTER (WHERE refund_status = 'processed') AS processed_count,
               count(*) FILTER (WHERE refund_status = 'pending') AS pending_count,
               {half_up("sum(extract(day FROM processed_at - requested_at))", "count(processed_at)")}
                   AS avg_processing_days
        FROM refunds WHERE requested_at >= {days_before(30)}
        GROUP BY refund_reason ORDER BY total_refund_amount DESC, refund_reason""",
    "cohort_retention": f"""
        SELECT start AS cohort_month, month AS activity_month, count(*) AS active_customers,
               (12 * (year(month) - year(start)) + month(month) - month(start)) % 12
                   AS months_since_first_purchase
        FROM (SELECT customer_id, month, min(month) OVER (PARTITION BY customer_id) AS start
              FROM (SELECT DISTINCT customer_id,
                           CAST(date_trunc('month', transaction_timestamp) AS TIMESTAMP) AS month
                    FROM long_transactions WHERE {OK}))
        WHERE start >= DATE '1996-01-01' - INTERVAL 6 MONTH
        GROUP BY start, month ORDER BY start, month""",
    "gateway_performance": f"""
        SELECT gateway_name, count(transaction_id) AS total_transactions, {REVENUE} AS total_revenue,
               {RATE_2} AS success_rate_pct,
               {half_up("sum(CAST(extract(second FROM processed_timestamp - transaction_timestamp) AS BIGINT))", "count(processed_timestamp)")}
                   AS avg_processing_seconds,
               {N_FAILED} AS failed_count
        FROM payment_gateways JOIN transactions USING (gateway_id)
        WHERE transaction_timestamp >= {days_before(30)}
        GROUP BY gateway_id, gateway_name ORDER BY total_revenue DESC, gateway_id""",
    "daily_transaction_summary": f"""
        SELECT {DAY} AS transaction_date, merchant_id, count(*) AS total_transactions,
               {N_OK} AS successful_transactions, {N_FAILED} AS failed_transactions,
               {REVENUE} AS total_revenue, {AVG_OK} AS avg_transaction_value
        FROM transactions GROUP BY 1, 2""",
    "high_risk_customers": """
        SELECT p.customer_id, p.customer_email, p.customer_name, CAST(p.risk_score AS BIGINT) AS risk_score,
               coalesce(own.n, 0) AS total_transactions, coalesce(own.alerts, 0) AS fraud_alerts_count,
               coalesce(own.failed, 0) AS failed_transactions
        FROM customers p
        LEFT JOIN (
            SELECT customer_id, count(*) AS n, CAST(sum(coalesce(raised, 0)) AS BIGINT) AS alerts,
                   CAST(sum(greatest(coalesce(raised, 0), 1))
                            FILTER (WHERE transaction_status = 'failed') AS BIGINT) AS failed
            FROM transactions
            LEFT JOIN (SELECT transaction_id, count(*) AS raised FROM fraud_alerts GROUP BY ALL)
                USING (transaction_id)
            GROUP BY customer_id) AS own USING (customer_id)
        WHERE p.risk_score > 70 OR p.is_blocked""",
    "success_rate_by_merchant_type": f"""
        SELECT merchant_id, payment_type, count(*) AS total_transactions, {N_OK} AS successful,
               {N_FAILED} AS failed, {AVG_ALL} AS avg_transaction_amount, {RATE} AS success_rate
        FROM transactions GROUP BY merchant_id, payment_type
        ORDER BY success_rate DESC, merchant_id, payment_type""",
    "hourly_patterns": f"""
        SELECT {HOUR} AS hour, count(*) AS transaction_count,
               CAST(sum(amount) AS DOUBLE) AS total_revenue, {AVG_ALL} AS avg_amount
        FROM transactions GROUP BY 1 ORDER BY 1""",
    "customer_clv_success_only": f"""
        SELECT customer_id, count(*) AS total_transactions,
               CAST(sum(amount) AS DOUBLE) AS lifetime_value, {AVG_ALL} AS avg_transaction_value,
               max(transaction_timestamp) AS last_transaction,
               min(transaction_timestamp) AS first_transaction,
               {segment('sum(amount)')} AS customer_segment
        FROM transactions WHERE {OK} GROUP BY customer_id
        ORDER BY lifetime_value DESC, customer_id""",
    "run_metrics": f"""
        SELECT count(*) AS total_transactions, {REVENUE} AS total_revenue,
               {AVG_OK} AS avg_transaction_value, {RATE} AS success_rate, {REFUNDED} AS total_refunded
        FROM transactions""",
    "weekly_report": f"""
        SELECT {DAY} AS date, count(*) AS total_transactions, {REVENUE} AS revenue,
               {AVG_ALL} AS avg_transaction
        FROM transactions WHERE transaction_timestamp >= {days_before(7)}
        GROUP BY 1 ORDER BY 1 DESC""",
    "weekly_report_totals": f"""
        WITH daily AS (
            SELECT {DAY} AS date, count(*) AS n, sum(amount) FILTER (WHERE {OK}) AS revenue
            FROM transactions WHERE transaction_timestamp >= {days_before(7)} GROUP BY 1
        )
        SELECT CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
               CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS average_daily_transactions
        FROM daily""",
    "summary_report": f"""
        SELECT '2024-01-31 00:00:00' AS report_date,
               format('{{:,}}', count(*)) AS total_transactions,
               format('${{:,.2f}}', {REVENUE}) AS total_revenue,
               format('{{:.2f}}%', {RATE_2}) AS success_rate,
               format('${{:.2f}}', {AVG_OK_2}) AS average_transaction
        FROM transactions""",
}

INSIGHTS = {
    "key_metrics": f"""
        SELECT count(*) AS total_transactions, {N_OK} AS successful_transactions,
               {REVENUE} AS total_revenue, {AVG_OK} AS avg_transaction_value, {RATE} AS success_rate
        FROM transactions""",
    "status_distribution": f"""
        SELECT {capital('transaction_status')} AS status, count(*) AS count,
               CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM transactions) AS DOUBLE) * 100.0 AS pct
        FROM transactions WHERE transaction_status IS NOT NULL
        GROUP BY transaction_status ORDER BY 2 DESC, 1""",
    "payment_type_distribution": f"""
        SELECT {title('payment_type')} AS payment_method, count(*) AS count,
               CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM transactions) AS DOUBLE) * 100.0 AS pct
        FROM transactions WHERE payment_type IS NOT NULL
        GROUP BY payment_type ORDER BY 2 DESC, 1""",
    "top5_merchants": f"""
        WITH leaders AS (
            SELECT merchant_id, sum(amount) AS revenue FROM transactions
            WHERE {OK} GROUP BY merchant_id ORDER BY 2 DESC, 1 LIMIT 5
        )
        SELECT row_number() OVER (ORDER BY revenue DESC, merchant_id) AS rank, merchant_id,
               merchant_name, CAST(revenue AS DOUBLE) AS revenue
        FROM leaders LEFT JOIN merchants USING (merchant_id) ORDER BY rank""",
    "top10_merchants_labelled": f"""
        WITH leaders AS (
            SELECT merchant_id, sum(amount) AS revenue FROM transactions
            WHERE {OK} GROUP BY merchant_id ORDER BY 2 DESC, 1 LIMIT 10
        )
        SELECT merchant_id,
               CASE WHEN length(merchant_name) > 30 THEN concat(left(merchant_name, 30), '...')
                    ELSE merchant_name END AS label,
               CAST(revenue AS DOUBLE) AS revenue
        FROM leaders LEFT JOIN merchants USING (merchant_id) ORDER BY revenue DESC, merchant_id""",
    "customer_insights": """
        SELECT count(*) AS total_customers,
               count(*) FILTER (WHERE risk_score > 70) AS high_risk_customers,
               CAST(count(*) FILTER (WHERE risk_score > 70) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0
                   AS high_risk_pct,
               (SELECT count(DISTINCT customer_id) FROM transactions) AS active_customers
        FROM customers""",
    "fraud_summary": """
        SELECT count(*) AS total_alerts, count(*) FILTER (WHERE is_resolved) AS resolved_alerts,
               count(*) FILTER (WHERE NOT is_resolved) AS pending_alerts
        FROM fraud_alerts""",
    "risk_level_distribution": f"""
        SELECT {capital('risk_level')} AS risk_level, count(*) AS count
        FROM fraud_alerts GROUP BY fraud_alerts.risk_level ORDER BY 2 DESC, 1""",
    "daily_volume": f"""
        SELECT {DAY} AS transaction_date, count(*) AS transaction_count
        FROM transactions GROUP BY 1 ORDER BY 1""",
    "hourly_volume": f"""
        SELECT {HOUR} AS hour, count(*) AS transaction_count
        FROM transactions GROUP BY 1 ORDER BY 1""",
    "revenue_by_payment_type": f"""
        SELECT payment_type, {title('payment_type')} AS label, CAST(sum(amount) AS DOUBLE) AS revenue
        FROM transactions WHERE {OK} GROUP BY payment_type ORDER BY revenue DESC, payment_type""",
    "risk_score_histogram": """
        WITH range AS (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM customers),
        edges AS (
            SELECT bin, lo + (bin - 1) * ((hi - lo) / 20.0) AS bin_start,
                   lo + bin * ((hi - lo) / 20.0) AS bin_end
            FROM range, generate_series(1, 20) AS g(bin)
        ), placed AS (
            SELECT least((risk_score - lo) * 20 // (hi - lo) + 1, 20) AS bin FROM customers, range
        )
        SELECT bin, CAST(bin_start AS DOUBLE) AS bin_start, CAST(bin_end AS DOUBLE) AS bin_end,
               (SELECT count(*) FROM placed p WHERE p.bin = e.bin) AS customer_count,
               CAST(70 AS BIGINT) AS high_risk_threshold
        FROM edges e ORDER BY bin""",
    "customer_segmentation": f"""
        SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total_spent,
               {money_mean_half_even(ALL_CENTS, "count(amount)")} AS avg_transaction,
               count(amount) AS transaction_count, {segment('sum(amount)')} AS segment
        FROM transactions WHERE {OK} GROUP BY customer_id""",
    "segment_summary": f"""
        WITH spenders AS (
            SELECT customer_id, sum(amount) AS total_spent,
                   CAST(round({money_mean_half_even(ALL_CENTS, "count(amount)")} * 100) AS BIGINT)
                       AS avg_cents
            FROM transactions WHERE {OK} GROUP BY customer_id
        )
        SELECT {segment('total_spent')} AS segment, count(*) AS customers,
               CAST(sum(total_spent) AS DOUBLE) AS total_revenue,
               {money_mean_half_even("sum(avg_cents)", "count(*)")} AS avg_transaction
        FROM spenders GROUP BY 1
        ORDER BY list_position(['VIP', 'Premium', 'Regular', 'New'], segment)""",
}

LAGGED = """
    WITH ordered AS (
        SELECT *, lag(transaction_timestamp) OVER (
            PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id
        ) AS prev_transaction_time
        FROM transactions
    ), flagged AS (
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(gateway_id AS BIGINT) AS gateway_id),
               CAST(floor(epoch(transaction_timestamp)) AS BIGINT)
                   - CAST(floor(epoch(prev_transaction_time)) AS BIGINT) AS time_diff_seconds
        FROM ordered
    ), judged AS (
        SELECT *, coalesce(time_diff_seconds < 60, false) OR amount > 1500
                  OR hour(transaction_timestamp) < 6 AS is_suspicious
        FROM flagged
    )
"""

RISK = {
    "fraud_patterns": f"{LAGGED} SELECT * FROM judged",
    "suspicious_transactions": f"{LAGGED} SELECT * FROM judged WHERE is_suspicious",
    "suspicious_count": f"""
        {LAGGED} SELECT count(*) FILTER (WHERE is_suspicious) AS suspicious_count FROM judged""",
}


def line(check: str, table: str, column: str, severity: str, count: str, detail: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
        f"'{severity}' AS severity, CAST(({count}) AS BIGINT) AS bad_count, '{detail}' AS detail"
    )


def nulls(table: str, column: str, source: str) -> str:
    return line(
        "nulls", table, column, "error",
        f"SELECT count(*) FROM {source} WHERE {column} IS NULL", "null values",
    )


def duplicates(table: str, column: str, source: str) -> str:
    count = (
        f"SELECT count(*) - count(DISTINCT {column}) "
        f"- CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END FROM {source}"
    )
    return line("duplicates", table, column, "error", count, "repeated values")


def outside(table: str, column: str, low: int, high: int, source: str) -> str:
    return line(
        "ranges", table, column, "warning",
        f"SELECT count(*) FROM {source} WHERE {column} < {low} OR {column} > {high}",
        f"values outside [{low}, {high}]",
    )


def orphans(child: str, column: str, parent: str, source: str, parent_source: str) -> str:
    count = (
        f"SELECT count(DISTINCT {column}) FROM {source} c WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_source} p WHERE p.{column} = c.{column})"
    )
    return line("referential", f"{child} -> {parent}", column, "error", count, "keys without a parent")


def nonpositive(source: str) -> str:
    return line(
        "nonpositive_amount", "transactions", "amount", "error",
        f"SELECT count(*) FROM {source} WHERE amount <= 0", "amounts not above zero",
    )


def future(as_of: str) -> str:
    return line(
        "future_timestamp", "transactions", "transaction_timestamp", "error",
        f"SELECT count(*) FROM transactions WHERE transaction_timestamp > TIMESTAMP '{as_of}'",
        "times after the run",
    )


def bad_risk(source: str) -> str:
    return line(
        "invalid_risk", "customers", "risk_score", "error",
        f"SELECT count(*) FROM {source} WHERE risk_score < 0 OR risk_score > 100",
        "risk scores out of bounds",
    )


EXCESS = line(
    "excess_refund", "refunds", "refund_amount", "error",
    "SELECT count(*) FROM refunds JOIN transactions USING (transaction_id) "
    "WHERE refund_amount > amount",
    "refunds above the amount paid",
)
UNPROCESSED = line(
    "success_unprocessed", "transactions", "processed_timestamp", "warning",
    f"SELECT count(*) FROM transactions WHERE {OK} AND processed_timestamp IS NULL",
    "successes without a processed time",
)
THRESHOLD = (
    "(SELECT avg(CAST(amount AS DOUBLE)) + 3 * stddev_samp(CAST(amount AS DOUBLE)) FROM transactions)"
)
FAILED_CUSTOMERS = """
    SELECT customer_id, count(*) AS failed_count FROM transactions
    WHERE transaction_status = 'failed' GROUP BY customer_id HAVING count(*) > 5"""


def union(lines: list[str]) -> str:
    return "\nUNION ALL\n".join(lines)


NULL_COLUMNS = (
    ("merchants", "merchant_id"), ("merchants", "merchant_name"), ("merchants", "merchant_email"),
    ("customers", "customer_id"), ("customers", "customer_email"),
    ("transactions", "transaction_id"), ("transactions", "transaction_uuid"),
    ("transactions", "amount"), ("transactions", "transaction_status"),
)
KEY_COLUMNS = (
    ("merchants", "merchant_id"), ("merchants", "merchant_email"),
    ("customers", "customer_id"), ("customers", "customer_email"),
    ("transactions", "transaction_id"), ("transactions", "transaction_uuid"),
)
LINKS = (
    ("transactions", "merchant_id", "merchants"),
    ("transactions", "customer_id", "customers"),
    ("payment_methods", "customer_id", "customers"),
)

SUITE = union(
    [nulls(t, c, t) for t, c in NULL_COLUMNS]
    + [duplicates(t, c, t) for t, c in KEY_COLUMNS]
    + [
        outside("customers", "risk_score", 0, 100, "customers"),
        outside("transactions", "amount", 0, 1000000, "transactions"),
    ]
    + [orphans(child, c, parent, child, parent) for child, c, parent in LINKS]
    + [
        nonpositive("transactions"),
        EXCESS,
        future("2024-01-31 00:00:00"),
        bad_risk("customers"),
        UNPROCESSED,
        line(
            "high_amount", "transactions", "amount", "warning",
            f"SELECT count(*) FROM transactions WHERE CAST(amount AS DOUBLE) > {THRESHOLD}",
            "amounts above the outlier threshold",
        ),
        line(
            "failed_customers", "transactions", "customer_id", "warning",
            f"SELECT count(*) FROM ({FAILED_CUSTOMERS})", "customers with many failures",
        ),
        line(
            "odd_hours", "transactions", "transaction_timestamp", "info",
            f"SELECT count(*) FROM transactions WHERE {HOUR} < 6", "transactions at night",
        ),
    ]
)


def null_gate(table: str, column: str, source: str) -> str:
    count = (
        f"SELECT CASE WHEN (count(*) - count({column})) * 100 > count(*) * 5 "
        f"THEN count(*) - count({column}) ELSE 0 END FROM {source}"
    )
    return line("null_gate", table, column, "warning", count, "nulls above 5%")


QUALITY = {
    "dq_nulls": union(
        [nulls("customers", c, "customers_raw") for c in ("customer_id", "phone_number")]
        + [nulls("payment_methods", c, "payment_methods_raw") for c in ("payment_type", "card_brand")]
        + [nulls("transactions", c, "transactions_raw") for c in ("amount", "processed_timestamp")]
    ),
    "dq_duplicates": union(
        [duplicates("merchants", c, "merchants_raw") for c in ("merchant_id", "merchant_email")]
        + [duplicates("customers", c, "customers_raw") for c in ("customer_email", "phone_number")]
        + [duplicates("transactions", c, "transactions_raw") for c in ("transaction_uuid", "customer_id")]
    ),
    "dq_types": union([
        line("types", "transactions", "transaction_id", "warning", "SELECT 0",
             "expected bigint, found bigint"),
        line("types", "transactions", "amount", "warning", "SELECT 0",
             "expected decimal, found decimal(15,2)"),
        line("types", "transactions", "transaction_timestamp", "warning", "SELECT 0",
             "expected timestamp, found timestamp"),
        line("types", "transactions", "metadata", "warning",
             "SELECT count(*) FROM transactions_raw", "expected struct, found string"),
    ]),
    "dq_ranges": union([
        outside("customers", "risk_score", 0, 100, "customers_raw"),
        outside("transactions", "amount", 0, 1000000, "transactions_raw"),
    ]),
    "dq_referential": union(
        [orphans(child, c, parent, f"{child}_raw", f"{parent}_raw") for child, c, parent in LINKS]
    ),
    "dq_orphan_merchants": """
        SELECT DISTINCT merchant_id AS key FROM transactions t
        WHERE merchant_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = t.merchant_id)""",
    "dq_nonpositive_amount": nonpositive("transactions_raw"),
    "dq_excess_refund": EXCESS,
    "dq_future_timestamp": future("2024-01-25 00:00:00"),
    "dq_invalid_risk": bad_risk("customers_raw"),
    "dq_success_unprocessed": UNPROCESSED,
    "anomaly_high_amount": f"""
        SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount
        FROM transactions WHERE CAST(amount AS DOUBLE) > {THRESHOLD}""",
    "anomaly_failed_customers": FAILED_CUSTOMERS,
    "anomaly_odd_hours": f"""
        SELECT transaction_id, customer_id, transaction_timestamp
        FROM transactions WHERE {HOUR} < 6""",
    "dq_report": SUITE,
    "dq_is_valid": f"""
        SELECT count(*) FILTER (WHERE bad_count > 0 AND severity = 'error') AS total_errors,
               count(*) FILTER (WHERE bad_count > 0 AND severity = 'warning') AS total_warnings,
               count(*) FILTER (WHERE bad_count > 0 AND severity = 'error') = 0 AS is_valid
        FROM ({SUITE})""",
    "dq_config_gates": union(
        [null_gate("customers", "customer_id", "customers_raw"),
         null_gate("customers", "phone_number", "customers_raw"),
         null_gate("transactions", "amount", "transactions"),
         null_gate("transactions", "processed_timestamp", "transactions"),
         line(
             "success_gate", "transactions", "transaction_status", "warning",
             f"SELECT CASE WHEN {N_OK} * 100 < count(*) * 80 THEN count(*) - {N_OK} ELSE 0 END "
             "FROM transactions",
             "success rate below 80%",
         )]
    ),
}

TRANSACTION_ROW = """
    transaction_id, transaction_uuid, merchant_id, customer_id, CAST(gateway_id AS BIGINT) AS gateway_id,
    CAST(amount AS DOUBLE) AS amount, currency, transaction_status, payment_type,
    transaction_timestamp, processed_timestamp, metadata"""

def _doubles(source: str, table: str) -> str:
    """All rows of a table, decimals and 32-bit numbers as the comparison takes them."""
    replaced = {
        "merchants": "CAST(commission_rate AS DOUBLE) AS commission_rate",
        "customers": "CAST(risk_score AS BIGINT) AS risk_score",
        "refunds": "CAST(refund_amount AS DOUBLE) AS refund_amount",
    }.get(table)
    return f"SELECT * {f'REPLACE ({replaced})' if replaced else ''} FROM {source}"


SOURCES = {
    "csv_scan": f"SELECT {TRANSACTION_ROW} FROM transactions_raw",
    "csv_quarantine": """
        SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, false AS is_unreadable FROM transactions_raw
        UNION ALL
        SELECT transaction_id, NULL, true FROM transactions_raw WHERE transaction_status = 'failed'""",
    "csv_sink": f"""
        SELECT {TRANSACTION_ROW}, transaction_hour, transaction_day_of_week, transaction_month,
               processing_time_seconds FROM transactions""",
    "monthly_partitioned_sink": f"""
        SELECT {TRANSACTION_ROW} FROM transactions
        WHERE transaction_timestamp >= TIMESTAMP '2024-01-10'""",
    "dated_backup": "SELECT * REPLACE (CAST(refund_amount AS DOUBLE) AS refund_amount) FROM refunds",
    **{
        f"csv_scan_{table}": _doubles(f"{table}_raw", table)
        for table in ("merchants", "customers", "payment_methods", "fraud_alerts", "refunds")
    },
    **{
        f"{query}_{table}": _doubles(table, table)
        for query in ("csv_sink", "dated_backup", "load")
        for table in ("merchants", "customers", "payment_methods", "fraud_alerts", "refunds")
        if (query, table) != ("dated_backup", "refunds")
    },
    "dated_backup_transactions": f"""
        SELECT {TRANSACTION_ROW}, transaction_hour, transaction_day_of_week, transaction_month,
               processing_time_seconds FROM transactions""",
    "monthly_store": f"SELECT {TRANSACTION_ROW} FROM transactions",
    "load": f"SELECT {TRANSACTION_ROW} FROM transactions",
    "load_order": "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, {place} AS position, (SELECT count(*) FROM {table}) AS row_count,
               (SELECT string_agg(column_name, ',' ORDER BY column_name)
                FROM (DESCRIBE SELECT {columns} FROM {table})) AS columns"""
        for place, (table, columns) in enumerate({
            "merchants": "*", "customers": "*", "payment_methods": "*", "transactions": TRANSACTION_ROW,
            "fraud_alerts": "*", "refunds": "*",
        }.items(), 1)
    ),
    "sql_query_scan": f"""
        SELECT {DAY} AS date, count(*) AS total_transactions, {REVENUE} AS revenue
        FROM transactions WHERE transaction_timestamp >= {days_before(7)} GROUP BY 1 ORDER BY 1 DESC""",
    "gateway_literals": """
        SELECT gateway_id, gateway_name, gateway_type, api_version, true AS is_active,
               count(transaction_id) AS transaction_count
        FROM payment_gateways LEFT JOIN transactions USING (gateway_id) GROUP BY ALL""",
    "table_views": f"""
        SELECT {DAY} AS transaction_date, count(DISTINCT merchant_id) AS merchants,
               count(*) AS transactions, {REVENUE} AS revenue,
               (SELECT count(*) FROM customers WHERE risk_score > 70 OR is_blocked)
                   AS high_risk_customers
        FROM transactions GROUP BY 1 ORDER BY 1""",
}

MESSAGE = """
    transaction_uuid, merchant_id, customer_id, CAST(1 AS BIGINT) AS payment_method_id,
    CAST(gateway_id AS BIGINT) AS gateway_id, CAST(amount AS DOUBLE) AS amount, currency,
    transaction_status, payment_type, transaction_timestamp,
    replace(metadata, ' ', '') AS metadata, false AS is_test_transaction"""

STREAM = {
    "decode_transactions": f"SELECT {MESSAGE} FROM transactions",
    "stream_dedup": f"SELECT {MESSAGE} FROM transactions",
    "stream_fraud_alerts": """
        SELECT transaction_uuid, 'High value transaction' AS alert_type, 'high' AS risk_level,
               'Transaction amount exceeds threshold' AS alert_message, false AS is_resolved
        FROM transactions WHERE amount > 1500""",
    "stream_alert_lookup": """
        SELECT transaction_id, transaction_uuid, 'High value transaction' AS alert_type
        FROM transactions WHERE amount > 1500""",
    "stream_publish": """
        SELECT concat('customer_', customer_id) AS key, transaction_uuid,
               CAST(amount AS DOUBLE) AS amount, replace(metadata, ' ', '') AS metadata
        FROM transactions""",
    "stream_probe": "SELECT least(10, count(*)) AS message_count FROM transactions",
    "stream_ingest": f"""
        SELECT {MESSAGE}, amount > 1500 AS has_alert FROM transactions""",
    "stream_compaction": """
        SELECT CAST(transaction_timestamp AS DATE) AS transaction_date, count(*) AS transactions,
               CAST(sum(amount) AS DOUBLE) AS amount, 0::BIGINT AS batch_folders
        FROM transactions GROUP BY 1""",
    "stream_quarantine": """
        SELECT CASE event_type WHEN 'error' THEN props
                    ELSE concat('{"transaction_id":"part-', event_id, '","amount":5,"currency":null}')
               END AS value, count(*) AS messages
        FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1""",
}

# Views and metrics from day sums kept by month are the ones over all transactions.
KEPT = {
    f"kept_{name}": REPORTS[name]
    for name in ("daily_transaction_summary", "run_metrics", "summary_report", "weekly_report", "weekly_report_totals")
}

STATEMENTS = {**CLEANED, **REPORTS, **INSIGHTS, **RISK, **QUALITY, **SOURCES, **STREAM, **KEPT}


def all_statements() -> dict[str, str]:
    return {name: with_tables(body) for name, body in STATEMENTS.items()}
