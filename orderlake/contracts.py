"""Column contracts, allowed values and errors shared by all recipes."""

from __future__ import annotations

# Column names, allowed values and replacement texts that the
# results must carry.
ORDER_COLUMNS = [
    "order_id", "product_id", "product_name", "kategori", "quantity",
    "total_harga", "tanggal_order", "kota", "channel", "status",
    "customer_email",
]
PRODUCT_COLUMNS = ["product_id", "product_name", "kategori", "harga_satuan"]

ORDER_NUMBERS = {"quantity": "bigint", "total_harga": "double"}
PRODUCT_NUMBERS = {"harga_satuan": "bigint"}

STRICT_COLUMNS = [
    "order_id", "product_id", "product_name", "kategori", "quantity",
    "harga_satuan", "total_harga", "unit_price_check", "tanggal_order",
    "order_month", "kota", "channel", "status", "customer_email",
]
GATED_COLUMNS = ORDER_COLUMNS + ["bulan", "kategori_harga"]

STATUSES = ["pending", "shipped", "completed", "cancelled"]
COMPLETED = "completed"

DUPLICATE = "duplicate_order_id"
BAD_PRICE = "missing_or_non_positive_total_harga"
BAD_DATE = "unparsable_date"
BAD_STATUS = "invalid_status"
REASONS = [DUPLICATE, BAD_PRICE, BAD_DATE, BAD_STATUS]

BLANK_EMAILS = ["nan", "none", ""]
PLACEHOLDER_EMAIL = "unknown@placeholder.com"

# Texts that count as missing when a CSV file is read (whole value, exact case).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

SMALL_BELOW = 500000
MEDIUM_UP_TO = 2000000
MAX_CHANNELS = 3

# The ordinal every source adds: rows are compared by it wherever "the first
# one" matters.
POSITION = "pos"


class OrderlakeError(Exception):
    """Base of the errors that stop a run."""


class ContractError(OrderlakeError):
    """A source is missing, unreadable or lacks required columns."""


class GateFailed(OrderlakeError):
    """The validation gate found bad data; nothing was published."""

    def __init__(self, failed: list[str]):
        super().__init__(f"validation gate failed: {', '.join(failed)}")
        self.failed = failed


class PublishConflict(OrderlakeError):
    """Another publisher has published the run, or taken its batches, meanwhile."""
