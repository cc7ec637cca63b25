from tidemark.plans.marts import dim_date, dim_products, dim_users, fact_clickstream, fact_orders
from tidemark.plans.staging import (
    stg_clickstream,
    stg_order_items,
    stg_orders,
    stg_payments,
    stg_products,
    stg_users,
)

__all__ = [
    "dim_date",
    "dim_products",
    "dim_users",
    "fact_clickstream",
    "fact_orders",
    "stg_clickstream",
    "stg_order_items",
    "stg_orders",
    "stg_payments",
    "stg_products",
    "stg_users",
]
