from strata.operators.conform import cast_failures, changed_values, conform, normalise
from strata.operators.dedupe import keep_best
from strata.operators.enrich import map_values, null_label
from strata.operators.fact import build_fact
from strata.operators.grouped import (
    average_by_group,
    date_span,
    lag_histogram,
    revenue_by_year,
    top_by_group,
)
from strata.operators.heavy import heavy_keys
from strata.operators.quality import (
    check_foreign_key,
    check_primary_key,
    childless_parents,
    conditional_null,
    count_rules,
    duplicate_keys,
    exceeded,
    key_report,
    null_profile,
    quality_report,
    rule_rows,
)
from strata.operators.rule_table import map_values_table, rule_table

__all__ = [
    "average_by_group",
    "build_fact",
    "cast_failures",
    "changed_values",
    "check_foreign_key",
    "check_primary_key",
    "childless_parents",
    "conditional_null",
    "conform",
    "count_rules",
    "date_span",
    "duplicate_keys",
    "exceeded",
    "heavy_keys",
    "keep_best",
    "key_report",
    "lag_histogram",
    "map_values",
    "map_values_table",
    "normalise",
    "null_label",
    "null_profile",
    "quality_report",
    "revenue_by_year",
    "rule_rows",
    "rule_table",
    "top_by_group",
]
