"""Business reports: each takes a mapping of table name to DataFrame and returns a DataFrame."""

from bazaarlens.plans.reports import (
    customer_lifetime_value,
    customer_lifetime_value_full,
    delivery_by_state,
    monthly_revenue,
    payment_breakdown,
    repeat_customers,
    review_by_category,
    state_volume,
    status_breakdown,
    top_categories,
    top_sellers,
)
from bazaarlens.plans.metrics import (
    category_share,
    clv_quartiles,
    order_value_true,
    overall_delivery,
    seller_revenue_true,
    seller_state_concentration,
    state_share,
)

__all__ = [
    "category_share",
    "clv_quartiles",
    "customer_lifetime_value",
    "customer_lifetime_value_full",
    "delivery_by_state",
    "monthly_revenue",
    "order_value_true",
    "overall_delivery",
    "payment_breakdown",
    "repeat_customers",
    "review_by_category",
    "seller_revenue_true",
    "seller_state_concentration",
    "state_share",
    "state_volume",
    "status_breakdown",
    "top_categories",
    "top_sellers",
]
