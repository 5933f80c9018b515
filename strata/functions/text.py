"""Text clean-up and casts that never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value", in any spelling.
NULL_TOKENS = ("", "NULL")


def normalize_text(text: Column | str, null_tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Trim spaces; NULL for any spelling of a null token.

    Text and tokens are compared in upper case, as Spark writes it.
    """
    trimmed = F.trim(text)
    if not null_tokens:
        return trimmed
    is_token = F.upper(trimmed).isin(*[F.upper(F.trim(F.lit(token))) for token in null_tokens])
    return F.when(~is_token, trimmed)


def safe_cast(text: Column, sql_type: str) -> Column:
    """Cast that yields NULL where the text does not fit; STRING passes through."""
    return text if sql_type.upper() == "STRING" else text.try_cast(sql_type)
