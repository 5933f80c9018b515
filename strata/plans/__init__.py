from strata.plans.sales import (
    average_lead_time_by_category,
    publish_orders,
    publish_product,
    revenue_by_year_and_color,
    top_color_by_year,
)
from strata.plans.stages import LimitExceeded, RunResult, run

__all__ = [
    "LimitExceeded",
    "RunResult",
    "average_lead_time_by_category",
    "publish_orders",
    "publish_product",
    "revenue_by_year_and_color",
    "run",
    "top_color_by_year",
]
