"""Column layouts and fixed vocabularies of the order model."""

# Column names, types and status words of the order model.
ORDERS = (
    "order_id string, customer_id string, product_id string, "
    "order_timestamp timestamp, quantity int, price double, status string"
)
CUSTOMERS = (
    "customer_id string, customer_name string, customer_email string, "
    "customer_segment string, registration_date string"
)
PRODUCTS = (
    "product_id string, product_name string, category string, "
    "brand string, list_price double"
)
DERIVED = "order_date date, order_day_of_week int, hour_of_day int, total_amount double"
# JSON payloads carry the event time as text.
ORDERS_JSON = ORDERS.replace("order_timestamp timestamp", "order_timestamp string")

STATUS_SYNONYMS = {"complete": "completed", "done": "completed", "canceled": "cancelled"}
MISSING_ORDER_ID = "missing_order_id"
INVALID_VALUES = "invalid_values"
INDETERMINATE_VALUES = "indeterminate_values"

ACTIVE = "active"
CANCELLED = "cancelled"
UNCLASSIFIED = "unclassified"

ENRICHED_COLUMNS = [
    "product_id", "customer_id", "order_id", "order_timestamp", "quantity", "price",
    "status", "order_date", "order_day_of_week", "hour_of_day", "total_amount",
    "customer_name", "customer_email", "customer_segment", "registration_date",
    "product_name", "category", "brand", "list_price",
]


def column_names(ddl: str) -> list[str]:
    """Column names of a flat DDL string."""
    return [field.split()[0] for field in ddl.split(",")]
