"""Options every operator reads. Plain values, so a Settings object can be shipped to executors."""

from __future__ import annotations

from dataclasses import dataclass, field

# Company-form words dropped from a supplier name.
LEGAL_SUFFIXES = ("inc", "llc", "ltd", "limited", "corp", "co", "company", "plc")

# Words card processors and banks put before the merchant in a descriptor.
PROCESSOR_WORDS = (
    "sq", "tst", "pp", "paypal", "pos", "dbt", "crd", "chkcard", "checkcard", "purchase",
    "debit", "card", "ach", "pmt", "pymt", "recurring", "ext", "int",
    "recur", "online", "web", "intl", "chk", "ck", "eft", "pre", "auth", "authorized",
    "visa", "mc", "mastercard", "discover", "amex",
)

# Receipt wording -> payment method name, tried in this order.
PAYMENT_WORDS = (
    ("mastercard", "Mastercard"),
    ("mc", "Mastercard"),
    ("master card", "Mastercard"),
    ("visa", "Visa"),
    ("discover", "Discover"),
    ("paypal", "Paypal"),
    ("cashapp", "CashApp"),
    ("cash app", "CashApp"),
    ("cash", "Cash"),
    ("cheque", "Cheque"),
    ("check", "Check"),
    ("bank transfer", "Bank transfer"),
    ("wire transfer", "Wire transfer"),
    ("amex", "American Express"),
    ("american express", "American Express"),
)

# Texts written into notes and statuses.
NO_RECEIPT_NOTE = "From bank statement; no receipt"
NO_BANK_TXN_NOTE = "No bank transaction found"
RECEIPT_ARRIVED = "Receipt arrived: "
NO_TAX_NOTE = "no tax shown; net = total"
NOT_RECONCILED = "amounts do not reconcile: net+tax != total"
AMOUNT_DEFAULTED = "amount missing; defaulted to 0"
DATE_DEFAULTED = "date defaulted to processing date"

# First path component -> stage.
STAGE_FOLDERS = {"expenses": "expense", "bank": "bank"}


@dataclass(frozen=True)
class Settings:
    legal_suffixes: tuple[str, ...] = LEGAL_SUFFIXES
    auto_match_score: float = 92.0
    review_score: float = 70.0
    match_window_days: int = 5
    ignore_terms: tuple[str, ...] = ()
    statement_payment_method: str = "Card (statement)"
    min_confidence: float = 0.75
    default_currency: str = "USD"
    amount_tolerance: str = "0.01"
    filename_strip: tuple[str, ...] = ()
    payment_methods: tuple[str, ...] = ()
    payment_method_map: tuple[tuple[str, str], ...] = ()
    block_on_flags: bool = False
    stages: tuple[str, ...] = ("expense", "bank")
    folders: tuple[str, ...] = ("expenses", "bank")
    stable_polls: int = 2
    settle_max_wait_minutes: int = 60
    quiet_seconds: int = 120
    # Rows of a dimension one task may hold at once; a larger dimension is probed slice by slice.
    dimension_slice_rows: int = 50_000
    # Longest run of consecutive sequence numbers one window task sorts.
    segment_rows: int = 1 << 20
    stage_folders: dict[str, str] = field(default_factory=lambda: dict(STAGE_FOLDERS))


DEFAULTS = Settings()
