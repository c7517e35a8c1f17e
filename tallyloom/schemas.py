"""Columns of the persistent tables."""

LEDGER = (
    "filename string, relative_path string, sha256 string, size bigint, date_processed timestamp, "
    "stage string, status string, rows_added int, notes string"
)
PURCHASES = (
    "row_id bigint, date date, company string, category string, net decimal(18,2), sales_tax decimal(18,2), "
    "total decimal(18,2), tax_rate decimal(9,3), payment_method string, notes string, year int, "
    "source_file string, processed_on timestamp, status string, bank_ref string, copied_to_master string"
)
BANK = (
    "bank_id bigint, date date, description string, amount decimal(18,2), direction string, status string, "
    "matched_source string, ref string, statement_file string, statement_start date, statement_end date, "
    "processed_on timestamp"
)
SUPPLIERS = "pos bigint, supplier string, default_category string, count bigint"
ALIASES = "pos bigint, alias string, supplier string"
PENDING = (
    "supplier string, suggested_category string, first_seen timestamp, source_file string, context string, "
    "occurrences bigint"
)
CATEGORIES = "pos bigint, category string, tax_line string"
REPLIES = "source_file string, response string"
FILES = "relative_path string, filename string, stage string, sha256 string, size bigint, content binary"


def names(schema: str) -> list[str]:
    """Column names of a schema text; a decimal's own comma has no blank behind it."""
    return [part.split()[0] for part in schema.split(", ")]
