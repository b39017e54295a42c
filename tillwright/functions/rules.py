"""Business constants.

Fixed values: thresholds, labels and messages that decide results.
"""

SUCCESS = "success"
FAILED = "failed"
PENDING = "pending"
REFUNDED = "refunded"

# Total successful spend must be strictly above the bound.
SEGMENT_BOUNDS = (("VIP", 5000), ("Premium", 2000), ("Regular", 500))
LOWEST_SEGMENT = "New"
SEGMENT_ORDER = ("VIP", "Premium", "Regular", "New")

# Whole days since the last transaction must be strictly above the bound.
ACTIVITY_BOUNDS = (("At Risk", 90), ("Inactive", 30))
ACTIVE = "Active"

HIGH_RISK_SCORE = 70
HIGH_AMOUNT = 1500
RAPID_SECONDS = 60
NIGHT_HOURS = (0, 1, 2, 3, 4, 5)

COMMISSION_RANGE = (0, 10)
RISK_RANGE = (0, 100)
AMOUNT_RANGE = (0, 1_000_000)
OUTLIER_DEVIATIONS = 3
MAX_FAILED_PER_CUSTOMER = 5
MAX_NULL_PERCENTAGE = 5
MIN_SUCCESS_RATE = 80

NO_PHONE = "Not provided"
UNRESOLVED_BY = "Pending"

STREAM_TOPIC = "payment-transactions"
STREAM_GROUP = "transaction-processor-group"
STREAM_METHOD_ID = 1
ALERT_TYPE = "High value transaction"
ALERT_RISK = "high"
ALERT_MESSAGE = "Transaction amount exceeds threshold"
MESSAGE_KEY_PREFIX = "customer_"

GATEWAYS = (
    (1, "Stripe", "Card Processing", "v1"),
    (2, "PayPal", "Digital Wallet", "v2"),
    (3, "Razorpay", "Unified Payment", "v1"),
    (4, "Square", "Card Processing", "v2"),
)
