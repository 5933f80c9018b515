from strata.functions.dates import business_days, date_precision, lead_time, partial_date
from strata.functions.money import extended_price
from strata.functions.text import normalize_text, safe_cast

__all__ = [
    "business_days",
    "date_precision",
    "extended_price",
    "lead_time",
    "normalize_text",
    "partial_date",
    "safe_cast",
]
