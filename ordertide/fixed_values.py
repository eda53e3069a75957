"""Labels, bounds and limits that results must carry exactly."""

# Columns of a raw order.
ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "amount", "status", "country"]

# Order statuses, and the one that counts as done.
STATUSES = ["completed", "pending", "cancelled", "returned"]
COMPLETED = "completed"

# Amount buckets as (label, below, min_amount, max_amount).
# An amount belongs to the first bucket whose "below" exceeds it.
AMOUNT_BUCKETS = [
    ("small", 50, 0, "49.99"),
    ("medium", 200, 50, "199.99"),
    ("large", 500, 200, "499.99"),
    ("premium", None, 500, None),
]

# Customer segments and their limits.
SEGMENTS = ["one-time", "occasional", "regular", "loyal", "vip"]
OCCASIONAL_MAX_ORDERS = 3
LOYAL_MIN_VALUE = 500
VIP_MIN_VALUE = 2000

# Days before the newest stored date that a run looks at again.
LOOKBACK_DAYS = 3

# Change actions on the feed, and marks on the merged table.
INSERT, DELETE, UPDATE, INITIAL_LOAD = "INSERT", "DELETE", "UPDATE", "INITIAL_LOAD"

# Freshness limits in hours.
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 48

# Allowed gap between a customer's value and the sum of orders.
VALUE_TOLERANCE = 0.01
