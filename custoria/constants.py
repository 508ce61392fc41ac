"""Fixed values that decide query results."""

from __future__ import annotations

# Cleaning and validation thresholds.
EARLIEST_TRANSACTION = "2020-01-01"
ACCEPTED_STATUSES = ["completed", "pending", "processing"]
EXCLUDED_ACCOUNT_STATUSES = ["test", "deleted"]
DEFAULT_LOOKBACK_DAYS = 730
MIN_AGE = 18
MAX_AGE = 100
MAX_DURATION_SECONDS = 7200
AMOUNT_IQR_FACTOR = 3.0
AGE_IQR_FACTOR = 2.0
MAX_MISSING_SHARE = 0.05
OUTLIER_IQR_FACTOR = 3.0
MIN_STDDEV = 0.01
MIN_SAMPLE_ROWS = 1000
MAX_AMOUNT = 1e9
HIGH_SKEW = 3.0
AMOUNT_COLUMNS = ["total_amount", "amount", "price", "revenue", "cost"]
FOREIGN_KEYS = ["customer_id", "product_id", "agent_id", "campaign_id"]
ORDERED_DATE_PAIRS = [
    ("registration_date", "first_transaction_date"),
    ("first_transaction_date", "last_transaction_date"),
    ("created_at", "updated_at"),
]

# Constant fills per dataset.
CUSTOMER_TEXT_FILLS = ["gender", "state", "acquisition_channel", "customer_segment"]
CUSTOMER_FLAG_FILLS = ["email_verified", "phone_verified"]
TRANSACTION_FILLS = {
    "discount_amount": 0.0,
    "payment_method": "Unknown",
    "channel": "Unknown",
    "device_type": "Unknown",
}
DEFAULT_SATISFACTION = 3

# Gender spellings after lower-casing.
GENDER_SPELLINGS = {"m": "M", "male": "M", "f": "F", "female": "F", "other": "Other"}

# Right-closed bin edges and their labels.
AGE_BINS = ([0, 25, 35, 45, 55, 65, 100], ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"])
LIFETIME_BINS = (
    [0, 30, 90, 180, 365, 730, float("inf")],
    ["New", "Getting Started", "Regular", "Established", "Loyal", "Veteran"],
)
ACTIVITY_BINS = (
    [0, 30, 60, 90, 180, float("inf")],
    ["Very Active", "Active", "Moderate", "Inactive", "Dormant"],
)
VALUE_LABELS = ["Low Value", "Medium Value", "High Value", "VIP"]
ENGAGEMENT_LABELS = ["Low", "Medium", "High", "Very High"]

# Calendar arithmetic and look-back windows.
DAYS_PER_MONTH = 30.44
DAYS_PER_YEAR = 365.25
TRANSACTION_WINDOWS = [30, 60, 90, 180, 365]
INTERACTION_WINDOWS = [30, 60, 90]
CHURN_DAYS = 90

# recency/frequency/monetary score codes of each named segment.
RFM_SEGMENTS = {
    "Champions": "555 554 544 545 454 455 445",
    "Loyal Customers": "543 444 435 355 354 345 344 335",
    "Potential Loyalists": "553 551 552 541 542 533 532 531 452 451",
    "New Customers": "512 511 422 421 412 411 311",
    "Promising": "525 524 523 522 521 515 514 513",
    "Need Attention": "535 534 443 434 343 334 325 324",
    "At Risk": "155 154 144 214 215 115 114 113",
    "Cannot Lose Them": "255 254 245 244 253 252 243 242",
    "Lost": "111 112 121 131 141 151",
}

# Selection, encoding and splitting.
SEED = 42
MAX_PAIR_CORRELATION = 0.95
REPORT_PAIR_CORRELATION = 0.8
MIN_VARIANCE = 0.01
HIGH_CARDINALITY = 50
HASH_COLUMNS = 32
SPLIT_SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}
